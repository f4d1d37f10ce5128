"""Periodic runs of words, found by multi-scale minimizers.

A run is a stretch of consecutive words whose smallest period is q, at least
``max(LEAST_WORDS, REPEATS * q)`` words long, that no neighbouring word extends.

* Periods up to ``LAG_SCANS`` are too short for a window: the words are compared with
  those one lag further on, lag by lag.
* Each scale serves the periods in (low, k], k a third above low. It hashes every k
  words, and takes the least hash of each window of w places. Inside a run of period p
  all windows repeat p places on, so their minima do; w is chosen so that two windows p
  places apart always fit into three periods. As p <= k, equal hashes inside the run lie
  whole periods apart, so the minimum and its next equal one are exactly p apart: it
  is enough to pair each chosen place with the next one of equal hash, and the pairs of a
  scale are no more than its places. A pair is extended word by word to both sides, and
  the words of what comes out are compared.

A stretch found under several lags is reported under the least: by the periodicity lemma
the smallest period divides the others, and all of them end at the same words.

All texts of a slice are searched at once as one sequence with a separator of its own
after each text; longer texts come first, so that a scale reads only those long enough.

Defined results: a null text has no words and no runs (hashes of the empty string); an
empty one likewise; a null id counts as empty text in the query's checksum; repeated rows
give repeated answers; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgersift.llm.common import crc32_of_id, map_texts, query, space_words, table

LEAST_WORDS, REPEATS = 24, 3
#: Periods up to this are searched lag by lag.
LAG_SCANS = 16
#: Text searched at once, but for a longer single text; hashes take some ten times its size.
SLICE_BYTES = 4 << 20

Run = tuple[int, int, int]  # start, length, period


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer: every bit of ``x`` reaches every bit of the result."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return _mixed(left * np.uint64(0x9E3779B97F4A7C15) + right)


def _windowed(best, values: np.ndarray, width: int) -> np.ndarray:
    """``best`` (minimum or maximum) of each ``width`` consecutive values."""
    done = 1
    while 2 * done <= width:
        values = best(values[:-done], values[done:])
        done *= 2
    return best(values[: len(values) - (width - done)], values[width - done :]) if done < width else values


def _least_length(period: int) -> int:
    return max(LEAST_WORDS, REPEATS * period)


def _lag_stretches(seq: np.ndarray, period: int) -> list[Run]:
    """Stretches in which words ``period`` apart are equal, long enough for a run."""
    if len(seq) <= period:
        return []
    breaks = np.flatnonzero(seq[period:] != seq[:-period])
    edges = np.concatenate([[-1], breaks, [len(seq) - period]])
    equal = np.diff(edges) - 1
    hits = np.flatnonzero(equal >= _least_length(period) - period)
    return [(int(edges[h]) + 1, int(equal[h]) + period, period) for h in hits]


def _reach(seq: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many places from ``at`` on (or back, with step -1) equal the one ``lag`` after them."""
    reached, size = 0, 64
    while True:
        if step > 0:
            low = at + reached
            high = min(low + size, len(seq) - lag)
        else:
            high = at - reached + 1
            low = max(high - size, 0)
        if low >= high:
            return reached
        differ = np.flatnonzero(seq[low:high] != seq[low + lag : high + lag])
        if len(differ):
            return reached + int(differ[0] if step > 0 else high - low - 1 - differ[-1])
        reached += high - low
        size *= 2


def _chosen(hashes: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the least hash of some window of ``width`` places."""
    least = _windowed(np.minimum, hashes, width)
    edge = np.zeros(width - 1, dtype=np.uint64)
    return np.flatnonzero(_windowed(np.maximum, np.concatenate([edge, least, edge]), width) == hashes)


def _scale_stretches(seq: np.ndarray, hashes: np.ndarray, low: int, k: int) -> list[Run]:
    """Stretches of the periods in (low, k], from the hashes of all k consecutive words."""
    width = 2 * low + 3 - k
    if len(hashes) < width:
        return []
    places = _chosen(hashes, width)
    places = places[np.argsort(hashes[places], kind="stable")]
    lags = places[1:] - places[:-1]
    paired = (hashes[places[1:]] == hashes[places[:-1]]) & (lags > low) & (lags <= k)
    firsts, lags = places[:-1][paired], lags[paired]
    order = np.lexsort((firsts, lags))
    firsts, lags = firsts[order], lags[order]
    # pairs of one lag whose words meet belong to one stretch
    new = np.ones(len(firsts), dtype=bool)
    new[1:] = (lags[1:] != lags[:-1]) | (firsts[1:] - firsts[:-1] > k)
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(firsts)) - 1
    found = []
    for head, tail in zip(heads.tolist(), tails.tolist()):
        lag, first, last = int(lags[head]), int(firsts[head]), int(firsts[tail])
        start = first - _reach(seq, first - 1, lag, -1)
        end = last + k + _reach(seq, last + k, lag, 1) + lag
        if end - start >= _least_length(lag) and np.array_equal(seq[start : end - lag], seq[start + lag : end]):
            found.append((start, end - start, lag))
    return found


def find_runs(texts: list[list]) -> list[list[Run]]:
    """The runs of each list of words, by start, then period."""
    out: list[list[Run]] = [[] for _ in texts]
    order = sorted((i for i, words in enumerate(texts) if len(words) >= LEAST_WORDS), key=lambda i: -len(texts[i]))
    if not order:
        return out
    number: dict = defaultdict()
    number.default_factory = number.__len__
    parts = []
    for place, i in enumerate(order):
        parts.append(np.fromiter(map(number.__getitem__, texts[i]), dtype=np.int64, count=len(texts[i])))
        parts.append(np.array([-1 - place], dtype=np.int64))
    seq = np.concatenate(parts)
    sizes = np.array([len(texts[i]) for i in order])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])

    found = [run for period in range(1, LAG_SCANS + 1) for run in _lag_stretches(seq, period)]
    low, span, blocks = LAG_SCANS, 1, _mixed(seq.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    while True:
        enough = int(np.searchsorted(-sizes, -REPEATS * (low + 1), side="right"))
        if not enough:
            break
        length = int(starts[enough - 1] + sizes[enough - 1] + 1)
        k = low + low // 3
        while 2 * span <= k:
            blocks = _pair_hash(blocks[:-span], blocks[span:])
            span *= 2
        count = length - k + 1
        if count > 0:
            hashes = _pair_hash(blocks[:count], blocks[k - span : k - span + count])
            found += _scale_stretches(seq[:length], hashes, low, k)
        low = k

    least: dict[tuple[int, int], int] = {}
    for start, size, period in found:
        least[start, size] = min(period, least.get((start, size), period))
    for (start, size), period in sorted(least.items(), key=lambda item: (item[0][0], item[1])):
        place = int(np.searchsorted(starts, start, side="right")) - 1
        out[order[place]].append((start - int(starts[place]), size, period))
    return out


def collapse(words: list, runs: list[Run]) -> list:
    """The words without those that follow the first period of a run holding them."""
    if not runs:
        return words
    kept = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(kept).tolist()]


def _sha256(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def _summaries(texts: list) -> dict:
    split = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
    out: dict[str, list] = {name.split()[0]: [] for name in SUMMARY.split(", ")}
    for words, runs in zip(split, find_runs(split)):
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        start, length, period = best or (None, None, None)
        out["n_runs"].append(len(runs))
        out["start"].append(start)
        out["length"].append(length)
        out["period"].append(period)
        out["exponent_milli"].append(1000 * length // period if best else None)
        out["runs_sha256"].append(_sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()))
        out["collapsed_sha256"].append(_sha256(b" ".join(collapse(words, runs))))
    return out


SUMMARY = (
    "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string"
)


def runs(docs: DataFrame) -> DataFrame:
    """doc_id and the array of (start, length, period) of each row's text."""

    def found(texts: list) -> dict:
        split = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
        return {"runs": [[dict(zip(("start", "length", "period"), r)) for r in own] for own in find_runs(split)]}

    kinds = "runs array<struct<start: bigint, length: bigint, period: bigint>>"
    return map_texts(docs.select("doc_id", "text"), ["doc_id"], found, kinds, slice_bytes=SLICE_BYTES)


def collapsed(docs: DataFrame) -> DataFrame:
    """doc_id and text of each row, its words joined by one space, each run cut to its first period."""

    def cut(texts: list) -> dict:
        split = [(t or "").split() for t in texts] if all((t or "").isascii() for t in texts) else None
        split = split or [[w.decode("utf-8", "surrogatepass") for w in (t or "").encode("utf-8", "surrogatepass").split()] for t in texts]
        return {"text": [None if t is None else " ".join(collapse(w, r)) for t, w, r in zip(texts, split, find_runs(split))]}

    return map_texts(docs.select("doc_id", "text"), ["doc_id"], cut, "text string", slice_bytes=SLICE_BYTES)


def summaries(docs: DataFrame) -> DataFrame:
    """doc_id, the number of runs, the run of greatest exponent, and digests of runs and remaining text."""
    return map_texts(docs.select("doc_id", "text"), ["doc_id"], _summaries, SUMMARY, slice_bytes=SLICE_BYTES)


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): the words of one text in ten made periodic from some word on.

    With h the checksum of the id, g = h / 10 and n words, words from a = g % n on repeat
    the p = 1 + (n - a) / (3 + g % 8) words that stand there.
    """
    words, a, p, rest = F.col("_words"), F.col("_a"), F.col("_p"), F.col("_rest")
    count = lambda n: n.cast("int")
    once = F.slice(words, count(a + 1), count(p))
    again: Column = F.slice(F.flatten(F.array_repeat(once, count(F.ceil(rest / p)))), F.lit(1), count(rest))
    return (
        docs.select("doc_id", "text", crc32_of_id(F.col("doc_id")).alias("_h"))
        .withColumn("_words", F.when(F.col("_h") % 10 == 0, space_words(F.col("text"))))
        .withColumn("_n", F.when(F.size("_words") > 0, F.size("_words")))
        .withColumn("_g", F.floor(F.col("_h") / 10))
        .withColumn("_a", F.col("_g") % F.col("_n"))
        .withColumn("_rest", F.col("_n") - F.col("_a"))
        .withColumn("_p", 1 + F.floor(F.col("_rest") / (3 + F.col("_g") % 8)))
        .select(
            "doc_id",
            F.when(F.col("_n").isNull(), F.col("text"))
            .otherwise(F.array_join(F.concat(F.slice(words, F.lit(1), count(a)), again), " "))
            .alias("text"),
        )
    )


# crc32 as a fold: a character is mixed in, then eight shifts (marked by -1) follow.
_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w,
    xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''),
      lambda c: CASE WHEN c = '' THEN []::BIGINT[] ELSE [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] END))),
      lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) AS h
  FROM documents),
n AS (SELECT *, len(w)::BIGINT AS n, h // 10 AS g FROM d),
a AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a FROM n),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
t AS (SELECT r, n, unnest(range(n)) AS i, unnest(list_transform(range(n),
  lambda i: w[(1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END)::INT])) AS word FROM p),
e AS (SELECT x.r, y.i - x.i AS q, x.i FROM t x JOIN t y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND (y.i - x.i) * 3 <= x.n),
s AS (SELECT r, q, min(i) AS start, count(*) + q AS length FROM
  (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM e) GROUP BY r, q, island
  HAVING count(*) + q >= greatest(24, 3 * q)),
u AS (SELECT r, start, length, min(q) AS period FROM s GROUP BY r, start, length),
b AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY length::DOUBLE / period DESC, start, period) AS place FROM u),
m AS (SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs,
  min(start) FILTER (place = 1) AS start, min(length) FILTER (place = 1) AS length, min(period) FILTER (place = 1) AS period
  FROM b GROUP BY r),
k AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS rest FROM t WHERE NOT EXISTS
  (SELECT 1 FROM u WHERE u.r = t.r AND t.i >= u.start + u.period AND t.i < u.start + u.length) GROUP BY r)
SELECT d.doc_id, coalesce(m.n_runs, 0)::BIGINT AS n_runs, m.start::BIGINT AS start, m.length::BIGINT AS length,
  m.period::BIGINT AS period, (1000 * m.length // m.period)::BIGINT AS exponent_milli,
  sha256(coalesce(m.runs, '')) AS runs_sha256, sha256(coalesce(k.rest, '')) AS collapsed_sha256
FROM d LEFT JOIN m ON m.r = d.r LEFT JOIN k ON k.r = d.r
"""


@query("op11_periodic_runs", _SQL)
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries(with_planted_periods(table(spark, sf_dir, "documents")))
