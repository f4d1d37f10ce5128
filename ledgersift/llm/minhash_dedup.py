"""Near-duplicates by one-permutation MinHash, banded buckets and star-shaped candidates.

Each set of word shingles is hashed once. The hash range is cut into ``BINS`` bins, and the
least hash of each bin makes the sketch; an empty bin takes over the value of the first
filled one in a random order of its own (optimal densification), the same order for all
sets. ``ROWS`` neighbouring bins make a band, and sets with an equal band share a bucket.
At a similarity of 0.85 a band agrees with probability 0.38, so a pair meets in none of
the 40 buckets once in 10^8 or more pairs; a set of five shingles or fewer is similar
enough to equal sets only, which are one node from the start.

Pairs are bounded by stars. Every bucket names a centre, and only the centre is compared
with the others: first the node with most company over all its buckets (an original among
its copies), then, in the buckets that verified links have not yet joined, a centre drawn by hash,
``DRAWN_ROUNDS`` times. The nodes of buckets that are still apart are held against each
other by a prefix filter over their full sets (``_remaining_pairs``), which finds every
similar pair of them that is not in one component yet. So no similar pair that shares a
bucket goes without either a comparison or a common component.

Links are confirmed on the full sets, whose elements are 64-bit hashes of the shingles.

Defined results: null text and text without words have an empty set and are linked with
nothing; of fewer words than a shingle has, the whole sequence is the only element; a null
id counts as the largest, its row is kept where the whole component has no id; repeated
rows are in one component; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgersift.llm.common import map_texts, query, table, written
from ledgersift.llm.components import components

#: Bands of so many bins each.
BANDS, ROWS = 40, 6
BINS = BANDS * ROWS
#: Rounds with centres drawn by hash.
DRAWN_ROUNDS = 2
#: Distinct words whose hashes a slice of texts remembers at most.
KNOWN_WORDS = 500_000


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """XXH64 of words, computed when first asked for."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word, 42)
        if len(self) < KNOWN_WORDS:
            self[word] = value
        return value


def shingle_set(words: list[bytes], size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of ``size`` words; of fewer words, of the whole."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    own = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(size, len(words))
    count = len(words) - width + 1
    mixed = np.full(count, np.uint64(width))
    for k in range(width):
        mixed = _mixed(mixed * np.uint64(0x9E3779B97F4A7C15) + own[k : k + count])
    return np.unique(mixed)


_EDGES = (np.arange(BINS + 1, dtype=object) * (1 << 64) // BINS)[:BINS].astype(np.uint64)
_COLUMNS = np.arange(BINS, dtype=np.uint64)


def _donors(bins: np.ndarray, first: int, last: int) -> np.ndarray:
    """Bins that empty ``bins`` look at, from their ``first`` attempt to before the ``last``."""
    attempts = np.arange(first, last, dtype=np.uint64)
    return (_mixed((bins.astype(np.uint64)[:, None] << np.uint64(32)) + attempts + np.uint64(1)) % np.uint64(BINS)).astype(np.int64)


def sketch(own: np.ndarray) -> np.ndarray:
    """The least hash of each bin of a sorted, non-empty set; empty bins are densified."""
    starts = np.searchsorted(own, _EDGES)
    filled = starts < np.append(starts[1:], len(own))
    out = own[np.minimum(starts, len(own) - 1)]
    if not filled.all():
        empty, first, last = np.flatnonzero(~filled), 0, 8
        while len(empty):
            looked = _donors(empty, first, last)
            hit = filled[looked]
            found = hit.any(axis=1)
            out[empty[found]] = out[looked[found, hit[found].argmax(axis=1)]]
            empty, first, last = empty[~found], last, 3 * last
    return out


def band_keys(own: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of the sketch."""
    bins = sketch(own).reshape(BANDS, ROWS)
    keys = _mixed(_COLUMNS[:BANDS] + np.uint64(1))
    for k in range(ROWS):
        keys = _mixed(keys * np.uint64(0x9E3779B97F4A7C15) + bins[:, k])
    return keys.view(np.int64)


def _list_of(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    values = np.concatenate([*parts, np.zeros(0, dtype=np.int64)]).astype(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _sketched(rows: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, row, n_shingles, digest, bands) of rows (doc_id, row, text); empty sets have no digest."""
    # a set is similar enough to a different one only if one element may be missing
    least = -(-percent // (100 - percent))

    def run(texts: list) -> dict:
        known = WordHashes()
        sets = [shingle_set(_words(t), size, known) for t in texts]
        none = np.zeros(0, dtype=np.int64)
        return {
            "n_shingles": [len(s) for s in sets],
            "digest": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
            "bands": _list_of([band_keys(s) if len(s) >= least else none for s in sets]),
        }

    return map_texts(rows, ["doc_id", "row"], run, "n_shingles bigint, digest binary, bands array<bigint>")


def _shared(nodes: DataFrame) -> DataFrame:
    """(key, node, size, n) of the buckets that n > 1 nodes share."""
    keys = nodes.select("node", F.col("n_shingles").alias("size"), F.explode("bands").alias("key"))
    met = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return written(keys.join(met, "key"), "buckets")


def _sets(rows: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(node, shingles) of the ``wanted`` nodes (node, row, digest), each from one text."""

    def run(texts: list) -> dict:
        known = WordHashes()
        sets = [shingle_set(_words(t), size, known) for t in texts]
        return {
            "digest": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
            "shingles": _list_of([s.view(np.int64) for s in sets]),
        }

    # hashes of rows may collide; the digest of the set decides
    texts = rows.join(wanted.select("row"), "row", "left_semi")
    sets = map_texts(texts, [], run, "digest binary, shingles array<bigint>")
    return written(sets.dropDuplicates(["digest"]).join(wanted.select("digest", "node"), "digest").select("node", "shingles"), "sets")


def _sized(a_size: str, b_size: str, percent: int):
    """Sizes that allow the similarity."""
    return F.least(a_size, b_size) * 100 >= F.greatest(a_size, b_size) * percent


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    met = pairs.join(left, "a").join(right, "b").withColumn("common", common)
    whole = F.size("x") + F.size("y") - F.col("common")
    return met.where(F.col("common") * 100 >= whole * percent).select("a", "b")


def _stars(members: DataFrame, centres: DataFrame, percent: int) -> DataFrame:
    """Distinct (a, b): the nodes of each bucket with its centre, where their size and component allow a new link."""
    met = members.join(centres, "key").where(
        (F.col("node") != F.col("centre")) & (F.col("root") != F.col("centre_root")) & _sized("size", "centre_size", percent)
    )
    return met.select(F.greatest("node", "centre").alias("a"), F.least("node", "centre").alias("b")).distinct()


def _first_stars(shared: DataFrame, percent: int) -> DataFrame:
    company = shared.groupBy("node").agg(F.sum(F.log("n")).alias("company"))
    ranked = shared.join(company, "node")
    centre = F.max(F.struct("company", "node", "size")).alias("c")
    centres = ranked.groupBy("key").agg(centre).select(
        "key", F.col("c.node").alias("centre"), F.col("c.node").alias("centre_root"), F.col("c.size").alias("centre_size")
    )
    return _stars(shared.withColumn("root", F.col("node")), centres, percent)


def _open(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, node, size, root) of the buckets that links have not made one component."""
    placed = shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    apart = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    return written(placed.join(apart.select("key"), "key", "left_semi").select("key", "node", "size", "root"), "open-buckets")


def _drawn_stars(members: DataFrame, number: int, percent: int) -> DataFrame:
    drawn = F.min(F.struct(F.xxhash64("key", "node", F.lit(number)).alias("h"), "node", "root", "size")).alias("c")
    centres = members.groupBy("key").agg(drawn).select(
        "key", F.col("c.node").alias("centre"), F.col("c.root").alias("centre_root"), F.col("c.size").alias("centre_size")
    )
    return _stars(members, centres, percent)


def _remaining_pairs(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Distinct (a, b), among them all similar pairs of ``members`` that are not in one component.

    Elements stand in one order for all sets: first those that only one component has, then by
    the number of sets that have them, rare ones first. Two similar sets share an element among
    the first few of both, and what follows it suffices for the similarity. The elements that
    one component has alone lead to no other, so only the others are joined.
    """
    nodes = members.select("node", "root", "size").distinct()
    elements = nodes.join(sets, "node").select("node", "root", "size", F.explode("shingles").alias("element"))
    spread = (
        elements.groupBy("element")
        .agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
        .where("low <> high")
        .select("element", "n")
    )
    of_node = Window.partitionBy("node")
    before = F.col("size") - F.count(F.lit(1)).over(of_node)
    place = before + F.row_number().over(of_node.orderBy("n", "element"))
    first_places = F.col("size") - F.ceil(F.col("size") * percent / 100 - 1e-9) + 1
    placed = elements.join(spread, "element").withColumn("place", place).where(F.col("place") <= first_places)
    placed = written(placed.select("element", "node", "root", "size", "place"), "places")
    sides = ("node", "root", "size", "place")
    left = placed.select("element", *[F.col(c).alias(f"a_{c}") for c in sides])
    right = placed.select(F.col("element").alias("b_element"), *[F.col(c).alias(f"b_{c}") for c in sides])
    common = F.least(F.col("a_size") - F.col("a_place"), F.col("b_size") - F.col("b_place")) + 1
    condition = (
        (left["element"] == right["b_element"])
        & (F.col("a_node") > F.col("b_node"))
        & (F.col("a_root") != F.col("b_root"))
        & _sized("a_size", "b_size", percent)
        & (common * (100 + percent) >= (F.col("a_size") + F.col("b_size")) * percent)
    )
    return left.join(right, condition).select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct()


def link_components(shared: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, root) of all nodes that verified links tie to a smaller one."""
    tested = written(_first_stars(shared, percent), "pairs")
    links = written(_confirmed(tested, sets, percent), "links")
    roots = components(links)
    for number in range(DRAWN_ROUNDS + 1):
        members = _open(shared, roots)
        pairs = _drawn_stars(members, number, percent) if number < DRAWN_ROUNDS else _remaining_pairs(members, sets, percent)
        pairs = written(pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        more = written(_confirmed(pairs, sets, percent), "links")
        if more.isEmpty():
            # no new link: the buckets stay as they are, other centres may still find some
            tested = tested.unionAll(pairs)
            continue
        tested, links = tested.unionAll(pairs), links.unionAll(more)
        roots = components(links)
    return roots


def near_duplicates(docs: DataFrame, size: int = 3, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    Sets of distinct shingles link where 100 * common >= percent * all; ``percent`` is below 100.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").withColumn("row", F.xxhash64("doc_id", "text"))
    prints = written(_sketched(rows, size, percent), "sketches")
    nodes = written(
        prints.where("n_shingles > 0")
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("first"), F.min("row").alias("row"), F.first("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"), F.count(F.lit(1)).alias("copies"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    shared = _shared(nodes)
    wanted = nodes.join(shared.select("node").distinct(), "node", "left_semi").select("node", "row", "digest")
    roots = link_components(shared, _sets(rows, wanted, size), percent)
    rooted = nodes.select("node", "digest", "first", "copies").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.sum("copies").alias("members"))
    grouped = rooted.join(least.where("members > 1"), "root").select("digest", "component_id", F.lit(True).alias("grouped"))
    component = F.when(F.col("grouped"), F.col("component_id")).otherwise(F.col("doc_id"))
    return (
        prints.select("doc_id", "n_shingles", "digest")
        .join(grouped, "digest", "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


_SQL = """
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
s AS (SELECT DISTINCT r, unnest(list_transform(range(greatest(len(w) - 2, least(len(w), 1))),
  lambda i: array_to_string(w[(i + 1)::INT:(i + 3)::INT], ' '))) AS shingle FROM d),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
p AS (SELECT x.r AS a, y.r AS b, count(*) AS common FROM s x JOIN s y ON x.shingle = y.shingle AND x.r <> y.r GROUP BY x.r, y.r),
l AS (SELECT a, b FROM p JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
reach(a, b) AS (SELECT r, r FROM d UNION SELECT reach.a, l.b FROM reach JOIN l ON l.a = reach.b),
c AS (SELECT reach.a AS r, min(d.doc_id) AS component_id FROM reach JOIN d ON d.r = reach.b GROUP BY reach.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id IS NOT DISTINCT FROM c.component_id AS kept
FROM d JOIN c ON c.r = d.r LEFT JOIN n ON n.r = d.r
"""


@query("op12_minhash_near_dedup", _SQL)
def op12_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
