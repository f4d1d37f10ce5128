"""Hard negatives by a vertical scan with branch-and-bound (BOND).

Vectors are held column by column. For each anchor the dimensions are read in the order
of the anchor's descending magnitude. After every few dimensions a row's score lies
between its partial sum plus the least and plus the greatest that the remaining
dimensions can add, given the least and greatest value of each column; rows that these
bounds rule out leave the candidate bitmap. Scores are whole numbers, kept exact.

Two scans: the first finds each anchor's positives (the best rows of its label), the
second the best rows of other labels in the window below each positive's score. A window
is resolved when its rows are: a row stays while it may lie in some window and may still
be among that window's best.

Rows are dealt into chunks and anchors into slots, both of bounded size and by a hash of
a row number, whatever the label or the vector; each pair of a chunk and a slot is one
group. The anchors are a stated query set against all rows, in blocks. Each group returns
no more than a few rows for each anchor or window, which a window function cuts to the
best again.

Defined results: rows with a null id, label or vector, or a null or non-finite component,
or one so large (``LARGEST`` after scaling) that scores might not fit a long, take no part;
rows equal in id, label and vector count once; rows that share an id with the anchor are
neither its positives nor its negatives; vectors of different lengths never meet; an empty
table, or no anchor, gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgersift.llm.common import query, table, written

#: Rows of a chunk and anchors of a slot, about.
CHUNK_ROWS, SLOT_ANCHORS = 65_536, 8_192
#: Smaller chunks, down to this, are made to occupy all cores.
LEAST_CHUNK = 2_048
#: Dimensions read between two tests of the bounds.
STEP = 16
#: Scaled components of this size or more take no part.
LARGEST = 1 << 24


class Vertical:
    """Rows of one length, column by column, ordered by label."""

    def __init__(self, numbers, ids, labels, matrix: np.ndarray, most: int):
        order = np.lexsort((numbers, ids, labels))
        self.numbers, self.ids, self.labels = numbers[order], ids[order], labels[order]
        # the largest sum of products that may occur decides what holds all sums exactly
        bound = matrix.shape[1] * most * int(np.abs(matrix).max(initial=0))
        self.kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64
        self.columns = np.ascontiguousarray(matrix[order].T.astype(self.kind))
        self.low = matrix.min(axis=0, initial=LARGEST).astype(np.int64)
        self.high = matrix.max(axis=0, initial=-LARGEST).astype(np.int64)

    def label_range(self, label: int) -> tuple[int, int]:
        return int(np.searchsorted(self.labels, label)), int(np.searchsorted(self.labels, label, side="right"))

    def partial_sums(self, anchor: np.ndarray, alive: np.ndarray) -> Iterator:
        """Yields (alive, partial sums, least and greatest rest); takes back the rows to go on with."""
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = np.stack([anchor * self.low, anchor * self.high])[:, order]
        least = np.append(ends.min(axis=0)[::-1].cumsum()[::-1], 0)
        greatest = np.append(ends.max(axis=0)[::-1].cumsum()[::-1], 0)
        weights = anchor[order].astype(self.kind)
        sums = np.zeros(len(alive), dtype=self.kind)
        for at in range(0, len(order), STEP):
            end = min(at + STEP, len(order))
            part = self.columns[order[at:end]]
            sums = sums + weights[at:end] @ (part if len(alive) == part.shape[1] else part[:, alive])
            keep = yield alive, sums, least[end], greatest[end]
            if keep is not None:
                alive, sums = alive[keep], sums[keep]
        yield alive, sums, 0, 0


def _scan(block: Vertical, anchor: np.ndarray, alive: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
    """The surviving rows and their scores; ``keep`` maps lower and upper bounds to a mask."""
    steps = block.partial_sums(anchor, alive)
    state = next(steps)
    while True:
        alive, sums, least, greatest = state
        try:
            state = steps.send(keep(sums + least, sums + greatest) if len(alive) else None)
        except StopIteration:
            return alive, sums.astype(np.int64)


def _largest(values: np.ndarray, k: int):
    """The k-th largest value, or None of fewer."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else None


def _best(block: Vertical, rows: np.ndarray, scores: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(score, id, number) of the k rows of highest score; ties by id."""
    if len(rows) > k:
        enough = scores >= _largest(scores, k)
        rows, scores = rows[enough], scores[enough]
    order = np.lexsort((block.numbers[rows], block.ids[rows], -scores))[:k]
    return [(int(scores[i]), int(block.ids[rows[i]]), int(block.numbers[rows[i]])) for i in order]


def positives(block: Vertical, anchor_id: int, label: int, anchor: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """The k best rows of the anchor's label, its own id left out."""
    first, last = block.label_range(label)
    rows = np.arange(first, last)
    rows = rows[block.ids[first:last] != anchor_id]

    def keep(lower, upper):
        least = _largest(lower, k)
        return None if least is None else upper >= least

    return _best(block, *_scan(block, anchor, rows, keep), k)


def negatives(block: Vertical, anchor_id: int, label: int, anchor: np.ndarray, windows: list[tuple[int, int]], k: int) -> list:
    """For each window (least, greatest score), the k best rows of other labels inside it."""
    first, last = block.label_range(label)
    rows = np.concatenate([np.arange(first), np.arange(last, len(block.ids))])
    rows = rows[block.ids[rows] != anchor_id]

    def keep(lower, upper):
        alive = np.zeros(len(lower), dtype=bool)
        for least, greatest in set(windows):
            may = (upper >= least) & (lower <= greatest)
            sure = lower[may & (lower >= least) & (upper <= greatest)]
            floor = _largest(sure, k)
            alive |= may if floor is None else may & (upper >= floor)
        return alive

    rows, scores = _scan(block, anchor, rows, keep)
    inside = [(scores >= least) & (scores <= greatest) for least, greatest in windows]
    return [_best(block, rows[own], scores[own], k) for own in inside]


def _matrices(data: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, matrix) of the rows of each vector length."""
    lists = data.column("q").combine_chunks()
    lengths = lists.value_lengths().to_numpy()
    for n in np.unique(lengths):
        places = np.flatnonzero(lengths == n)
        flat = lists.take(pa.array(places)).flatten().to_numpy()
        yield places, flat.astype(np.int64).reshape(len(places), n)


def _grouped(rows: DataFrame, anchors: DataFrame, work, schema: str) -> DataFrame:
    """``work(block, anchor columns, places, matrix)`` for each chunk of rows and slot of anchors."""
    n_rows, n_anchors = rows.count(), anchors.count()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    chunks = max(-(-n_rows // CHUNK_ROWS), min(cores, -(-n_rows // LEAST_CHUNK)), 1)
    slots = max(-(-n_anchors // SLOT_ANCHORS), 1)
    names = [name.split()[0] for name in schema.split(", ")]

    def dealt(df: DataFrame, own: str, parts: int, other: str, others: int) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        return df.withColumn(own, F.pmod(F.xxhash64("no"), F.lit(parts)).cast("int")).withColumn(other, every)

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[] for _ in names]
        if left.num_rows and right.num_rows:
            by_length = {m.shape[1]: (places, m) for places, m in _matrices(right)}
            plain = {c: right.column(c).to_pylist() for c in right.column_names if c not in ("q", "_chunk", "_slot")}
            for places, matrix in _matrices(left):
                if matrix.shape[1] not in by_length:
                    continue
                column = lambda c: left.column(c).to_numpy()[places]  # noqa: E731,B023
                own_places, own = by_length[matrix.shape[1]]
                block = Vertical(column("no"), column("vec_id"), column("label"), matrix, int(np.abs(own).max(initial=0)))
                for place, anchor in zip(own_places.tolist(), own):
                    for row in work(block, {c: v[place] for c, v in plain.items()}, anchor):
                        for values, value in zip(out, row):
                            values.append(value)
        return pa.table({n: pa.array(v, type=pa.int64()) for n, v in zip(names, out)})

    chunked = dealt(rows, "_chunk", chunks, "_slot", slots)
    slotted = dealt(anchors, "_slot", slots, "_chunk", chunks)
    keys = ("_chunk", "_slot")
    return chunked.groupBy(*keys).cogroup(slotted.groupBy(*keys)).applyInArrow(run, schema)


def scaled(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, label, q) of the rows that take part: components times 256, rounded down; each row once."""
    q = F.transform(F.col(vector_col), lambda x: F.floor(F.lit(256.0) * x.cast("double")))
    fits = F.forall(
        F.col(vector_col),
        lambda x: F.coalesce(F.abs(x.cast("double")) < LARGEST / 256, F.lit(False)) & ~F.isnan(x.cast("double")),
    )
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull())
    return (
        rows.where(fits)
        .select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("bigint").alias("label"), q.cast("array<int>").alias("q"))
        .distinct()
    )


def mine(vectors: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 5, least_percent: int = 80) -> DataFrame:
    """Hard negatives of the anchors among ``vectors`` (see ``scaled``): anchor, positive, rank, negative, scores.

    A negative's score is between ``least_percent`` of the positive's score and that score.
    """
    rows = written(vectors.withColumn("no", F.monotonically_increasing_id()), "vectors")
    anchors = written(rows.where(is_anchor), "anchors")

    def best_positives(block: Vertical, row: dict, anchor: np.ndarray):
        for score, vec_id, number in positives(block, row["vec_id"], row["label"], anchor, n_positives):
            yield row["no"], score, vec_id, number

    near = _grouped(rows, anchors, best_positives, "anchor bigint, score bigint, vec_id bigint, number bigint")
    best = Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id", "number")
    top = near.withColumn("place", F.row_number().over(best)).where(F.col("place") <= n_positives)
    own = top.groupBy("anchor").agg(F.collect_list(F.struct("place", "vec_id", "score")).alias("positives"))
    paired = written(anchors.join(own.withColumnRenamed("anchor", "no"), "no"), "anchor-positives")

    def best_negatives(block: Vertical, row: dict, anchor: np.ndarray):
        # least_percent * p <= 100 * s <= 100 * p: the least whole s is the quotient rounded up
        own = row["positives"]
        windows = [(-(-least_percent * p["score"] // 100), p["score"]) for p in own]
        for p, found in zip(own, negatives(block, row["vec_id"], row["label"], anchor, windows, n_negatives)):
            for score, vec_id, number in found:
                yield row["no"], p["place"], score, vec_id, number

    wanted = paired.select("no", "vec_id", "label", "q", "positives")
    schema = "anchor bigint, place bigint, score bigint, vec_id bigint, number bigint"
    found = _grouped(rows, wanted, best_negatives, schema)
    best = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "vec_id", "number")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n_negatives)
    pairs = paired.select(F.col("no").alias("anchor"), F.col("vec_id").alias("anchor_id"), F.explode("positives").alias("p"))
    joined = ranked.join(pairs.withColumn("place", F.col("p.place").cast("bigint")), ["anchor", "place"])
    return joined.select(
        "anchor_id",
        F.col("p.vec_id").alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        F.col("p.score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )


_SQL = """
WITH v AS (SELECT DISTINCT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, x.vec_id, a.label = x.label AS same,
    list_sum(list_transform(list_zip(a.q, x.q), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v a JOIN v x ON a.vec_id % 100 = 0 AND x.vec_id <> a.vec_id),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
  (row_number() OVER w)::INT AS rank, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER w <= 5
"""


@query("op13_hard_negatives", _SQL)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = scaled(table(spark, sf_dir, "embeddings").withColumn("label", label))
    return mine(vectors, F.col("vec_id") % 100 == 0)
