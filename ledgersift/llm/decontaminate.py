"""Benchmark decontamination by spaced seeds.

Text and item overlap if, the item laid over the text, a window of ``WINDOW`` item words
(the whole item, if shorter) has ``PERCENT`` percent of them equal; items of fewer than
``EXACT_BELOW`` words must be there word for word. A mask ignores some word positions, so
a seed under it is the same whatever words stand there. The masks of each window length
meet every such window in at least one place free of other words, wherever these are
(the tests enumerate all places), so every overlap is found.

Seeds of all items are a table. A bit sieve of them, of bounded size, goes to all tasks;
the seeds of the texts that pass it leave the scan with the words around them and are
joined with the items' seeds by hash. A joined pair places an item over a text, and along
that placement the words around the seed are compared, window by window. Texts are read
once for any number of items, and neither shuffled nor collected; nor are the items.

Defined results: null or empty texts and items overlap nothing; repeated rows or items
each give their own rows (the same ones); empty tables give an empty result; further
columns are kept by the stage, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgersift.llm.common import free_name, give_back_memory, query, row_key, share, table, written

WINDOW, PERCENT, EXACT_BELOW = 20, 80, 8
#: Items of fewer words are reported, but cost no document: so few words occur by chance.
STAGE_LEAST_WORDS = 5
#: Masks by the shortest window they are for; 1 is a word that counts, 0 one that is ignored.
MASKS = {
    15: ("1101111", "110010001011", "110101011", "1110111"),
    8: ("110111", "11001011", "11111"),
}
#: The sieve has this many bits for a seed, within these powers of two.
SIEVE_BITS_A_SEED, LEAST_SIEVE, MOST_SIEVE = 64, 16, 27
#: Seeds handed on at once, each with its ``AROUND`` words.
BATCH_SEEDS = 16_384
AROUND = 2 * WINDOW - 1

_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)
_FACTORS = [(0x9E3779B97F4A7C15 * (2 * k + 1)) & (2**64 - 1) | 1 for k in range(64)]


def folded_words(text: str | None) -> list[bytes]:
    """A-Z lower-cased; words are runs of letters, digits and non-ASCII characters."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    known: dict[bytes, int] = {}
    for w in set(words):
        known[w] = digest(w, 1)
    return np.array([known[w] for w in words], dtype=np.uint64)


def masks_of(length: int) -> tuple[str, ...]:
    """Masks for items of so many words; shorter items than ``EXACT_BELOW`` count whole."""
    if length < EXACT_BELOW:
        return ("1" * length,) if length else ()
    return next(masks for least, masks in MASKS.items() if length >= least)


ALL_MASKS = tuple(dict.fromkeys([m for n in range(1, WINDOW + 1) for m in masks_of(n)]))


def equal_needed(length: int) -> int:
    """Equal words that a window of an item of so many words must have."""
    window = min(WINDOW, length)
    return window if length < EXACT_BELOW else -(-PERCENT * window // 100)


def seed_hashes(words: np.ndarray, mask: str) -> np.ndarray:
    """Hash, at each place, of the words that the mask does not ignore."""
    count = len(words) - len(mask) + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(count, (ALL_MASKS.index(mask) + 1) * 0x632BE59BD9B4E019 & (2**64 - 1), dtype=np.uint64)
    for k, counts in enumerate(mask):
        if counts == "1":
            total += words[k : k + count] * np.uint64(_FACTORS[k])
    total ^= total >> np.uint64(29)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    return total ^ (total >> np.uint64(32))


def around(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The words from ``WINDOW`` - 1 before to as many after each place; zero where there is none."""
    edge = np.zeros(WINDOW - 1, dtype=np.uint64)
    padded = np.concatenate([edge, words, edge])
    return np.lib.stride_tricks.sliding_window_view(padded, AROUND)[at]


def most_equal(left: np.ndarray, right: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For each pair of rows of words, the most equal words in a window that both cover; -1 if none."""
    both = (left != 0) & (right != 0)
    out = np.full(len(windows), -1, dtype=np.int64)
    zero = np.zeros((len(windows), 1), dtype=np.int16)
    covered = np.hstack([zero, np.cumsum(both, axis=1, dtype=np.int16)])
    equal = np.hstack([zero, np.cumsum(both & (left == right), axis=1, dtype=np.int16)])
    for window in np.unique(windows).tolist():
        rows = windows == window
        whole = covered[rows, window:] - covered[rows, :-window] == window
        out[rows] = np.where(whole, equal[rows, window:] - equal[rows, :-window], -1).max(axis=1)
    return out


def _binary(values: np.ndarray) -> pa.Array:
    """One binary value for each row of a matrix."""
    data = np.ascontiguousarray(values)
    size = data.shape[1] * data.itemsize
    offsets = np.arange(0, (len(data) + 1) * size, size, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _matrix(values: pa.Array) -> np.ndarray:
    joined = b"".join(values.to_pylist())
    return np.frombuffer(joined, dtype=np.uint64).reshape(len(values), AROUND)


def _seeds(rows: DataFrame, find: Callable[[np.ndarray], Iterator[tuple]]) -> DataFrame:
    """(row, id, seed, window_words, near) of the seeds that ``find`` gives for the words of each text.

    ``rows`` has the columns row, id and text.
    """
    id_type = rows.schema["id"].dataType
    kind = T.StructType.fromDDL("row bigint, seed bigint, window_words int, near binary").add("id", id_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[tuple] = []
            size = 0

            def handed_on() -> pa.RecordBatch:
                owners, seeds, windows, near = (np.concatenate(part) for part in zip(*held))  # noqa: B023
                taken = pa.array(owners)
                columns = [batch.column("row").take(taken), pa.array(seeds.view(np.int64)), pa.array(windows), _binary(near), batch.column("id").take(taken)]  # noqa: B023
                return pa.RecordBatch.from_arrays(columns, names=kind.names)

            for owner, text in enumerate(batch.column("text")):
                words = word_hashes(folded_words(text.as_py()))
                for seeds, at in find(words):
                    window = min(WINDOW, len(words))
                    for first in range(0, len(at), BATCH_SEEDS):
                        part = at[first : first + BATCH_SEEDS]
                        n = len(part)
                        held.append((np.full(n, owner), seeds[part], np.full(n, window, dtype=np.int32), around(words, part)))
                        size += n
                        if size >= BATCH_SEEDS:
                            yield handed_on()
                            held, size = [], 0
            if size:
                yield handed_on()
        give_back_memory()

    return rows.mapInArrow(run, kind)


def item_seeds(benchmark: DataFrame) -> DataFrame:
    """All seeds of all items, one row for each item, mask and place."""

    def find(words: np.ndarray) -> Iterator[tuple]:
        for mask in masks_of(len(words)):
            seeds = seed_hashes(words, mask)
            yield seeds, np.arange(len(seeds))

    items = benchmark.select(F.monotonically_increasing_id().alias("row"), F.col("item_id").alias("id"), "text")
    return _seeds(items, find)


def _probes(seeds: np.ndarray, bits: int) -> tuple:
    return tuple((part >> np.uint64(64 - bits)).astype(np.int64) for part in (seeds, seeds << np.uint64(bits)))


def _sieve(seeds: DataFrame) -> tuple[int, np.ndarray]:
    """Bits that the seeds set, two for each; tasks set them, at most 2 ** (MOST_SIEVE - 6) words come back."""
    bits = (SIEVE_BITS_A_SEED * seeds.count()).bit_length()
    bits = min(MOST_SIEVE, max(LEAST_SIEVE, bits))
    probes = F.array(*[F.shiftrightunsigned(h, 64 - bits) for h in (F.col("seed"), F.shiftleft("seed", bits))])
    bit = seeds.select(F.explode(probes).alias("bit"))
    one = F.expr("shiftleft(1L, cast(bit & 63 AS int))")
    words = bit.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(one).alias("value")).toArrow()
    sieve = np.zeros(1 << (bits - 6), dtype=np.int64)
    sieve[words["word"].to_numpy()] = words["value"].to_numpy()
    return bits, np.unpackbits(sieve.view(np.uint8), bitorder="little").view(bool) if bits < 22 else sieve


def _passes(sieve: np.ndarray, at: np.ndarray, bits: int) -> np.ndarray:
    """Whether each bit is set; small sieves come as one byte a bit."""
    if sieve.dtype == bool:
        return sieve[at]
    return (sieve[at >> 6] >> (at & 63)) & 1 == 1


def text_seeds(docs: DataFrame, sieve: tuple[int, np.ndarray], masks: list[str]) -> DataFrame:
    """The seeds of the texts that the sieve does not sort out."""
    shared = share(docs.sparkSession, sieve)  # MOST_SIEVE bounds it

    def find(words: np.ndarray) -> Iterator[tuple]:
        bits, held = shared()
        for mask in masks:
            seeds = seed_hashes(words, mask)
            first, second = _probes(seeds, bits)
            at = np.flatnonzero(_passes(held, first, bits))
            yield seeds, at[_passes(held, second[at], bits)]

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").alias("id"), "text")
    return _seeds(rows, find)


def _verified(pairs: DataFrame) -> DataFrame:
    """Pairs of seeds with the most equal words of a window around them, where these are enough."""
    kind = T.StructType([pairs.schema[c] for c in ("row", "id", "item", "item_id", "window_words")]).add("equal_words", T.IntegerType())
    needed = np.array([equal_needed(n) for n in range(WINDOW + 1)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            windows = batch.column("window_words").to_numpy().astype(np.int64)
            equal = most_equal(_matrix(batch.column("near")), _matrix(batch.column("item_near")), windows)
            enough = pa.array(np.flatnonzero(equal >= needed[windows]))
            columns = [batch.column(c).take(enough) for c in kind.names[:-1]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(equal.astype(np.int32)).take(enough)], names=kind.names)

    return pairs.mapInArrow(run, kind)


def _found(docs: DataFrame, benchmark: DataFrame, least_words: int) -> DataFrame:
    """row, id, item, item_id, window_words and equal_words of each text row and item row that overlap."""
    seeds = written(item_seeds(benchmark).where(F.col("window_words") >= least_words), "item-seeds")
    lengths = [r["window_words"] for r in seeds.select("window_words").distinct().collect()]  # at most WINDOW
    masks = [m for m in ALL_MASKS if any(m in masks_of(n) for n in lengths)]
    hits = written(text_seeds(docs, _sieve(seeds), masks), "text-seeds")
    items = seeds.select(
        "seed", "window_words", F.col("row").alias("item"), F.col("id").alias("item_id"), F.col("near").alias("item_near")
    )
    pairs = _verified(hits.drop("window_words").join(items, "seed"))
    # the window's length goes with the item
    return pairs.groupBy("row", "id", "item", "item_id").agg(
        F.max("window_words").alias("window_words"), F.max("equal_words").alias("equal_words")
    )


def overlaps(docs: DataFrame, benchmark: DataFrame, least_words: int = 1) -> DataFrame:
    """doc_id, item_id, window_words and equal_words of every text and item (of so many words) that overlap."""
    found = _found(docs.select("doc_id", "text"), benchmark.select("item_id", "text"), least_words)
    return found.select(F.col("id").alias("doc_id"), "item_id", "window_words", "equal_words")


def without_overlaps(docs: DataFrame, benchmark: DataFrame, least_words: int = STAGE_LEAST_WORDS) -> DataFrame:
    """The pipeline stage: documents that overlap a test item go, the others stay as they are."""
    name = free_name(docs.columns, "_ls_row")
    keyed = docs.withColumn(name, row_key(F.col("doc_id"), F.col("text")))
    searched = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("doc_id"), "text")
    found = _found(searched, benchmark.select("item_id", "text"), least_words)
    gone = written(found.select(F.col("id").alias(name)).distinct(), "overlapping")
    return keyed.join(gone, name, "left_anti").select(*[f"`{c}`" for c in docs.columns])


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)
def _sql_seeds(owner: str, source: str, mask: str, where: str) -> str:
    """Seeds of a table's words under a mask, as text."""
    key = ", ".join(f"words[i + {k + 1}]" for k, counts in enumerate(mask) if counts == "1")
    return (
        f"SELECT {owner}, i, '{mask}' AS m, concat_ws(' ', {key}) AS key "
        f"FROM (SELECT {owner}, words, unnest(range(len(words) - {len(mask) - 1})) AS i FROM {source} WHERE {where})"
    )


def _sql_items() -> str:
    least, parts = WINDOW + 1, []
    bounds = [(n, f"len(words) >= {n}", masks) for n, masks in MASKS.items()]
    for n, from_, masks in bounds:
        upto = "" if least > WINDOW else f" AND len(words) < {least}"
        parts += [_sql_seeds("q", "b", mask, from_ + upto) for mask in masks]
        least = n
    parts += [_sql_seeds("q", "b", "1" * n, f"len(words) = {n}") for n in range(1, EXACT_BELOW)]
    return " UNION ALL ".join(parts)


_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
b AS (SELECT row_number() OVER () AS q, item_id, {_WORDS} AS words FROM benchmark),
bs AS ({_sql_items()}),
ds AS ({" UNION ALL ".join(_sql_seeds("r", "d", mask, f"len(words) >= {len(mask)}") for mask in ALL_MASKS)}),
laid AS (SELECT DISTINCT ds.r, bs.q, ds.i - bs.i AS shift FROM ds JOIN bs ON ds.m = bs.m AND ds.key = bs.key),
pos AS (SELECT laid.r, laid.q, shift, a, least({WINDOW}, len(b.words)) AS win, (b.words[a + 1] = d.words[a + shift + 1])::INT AS eq
  FROM (SELECT laid.*, unnest(range(len(words))) AS a FROM laid JOIN b USING (q)) laid
  JOIN b USING (q) JOIN d ON d.r = laid.r WHERE a + shift >= 0 AND a + shift < len(d.words)),
run AS (SELECT r, q, shift, a, win, sum(eq) OVER w AS upto, row_number() OVER w AS n FROM pos
  WINDOW w AS (PARTITION BY r, q, shift ORDER BY a)),
win AS (SELECT x.r, x.q, x.win, x.upto - coalesce(y.upto, 0) AS equal FROM run x LEFT JOIN run y
  ON y.r = x.r AND y.q = x.q AND y.shift = x.shift AND y.n = x.n - x.win WHERE x.n >= x.win)
SELECT d.doc_id, b.item_id, any_value(win)::INT AS window_words, max(equal)::INT AS equal_words
FROM win JOIN d USING (r) JOIN b USING (q)
WHERE CASE WHEN win < {EXACT_BELOW} THEN equal = win ELSE 100 * equal >= {PERCENT} * win END
GROUP BY r, q, d.doc_id, b.item_id
"""


@query("op6_decontaminate", _SQL)
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
