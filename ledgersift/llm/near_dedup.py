"""Near-duplicates by SimHash and Golay-code fuzzy hashing, and by shingle prefixes.

``fingerprint_components`` links fingerprints, ``near_copies`` texts whose sets of shingles
have a given Jaccard similarity; both find all links there are. The second takes the pairs
that share a Golay key first, which are too few; to complete them, shingles stand in one order over the whole corpus, rare ones first, and the first fifth of each set
(for 0.8) are its keys: sets similar enough share one (prefix filter). Fingerprints are cut into segments. With few differing bits, one segment has none and
its neighbour at most two (pigeonhole); the pair of that exact segment and a Golay key
of the neighbour is then shared. Nodes meet at these keys, are verified, and linked ones
form components.

Equal fingerprints (or equal word sequences) are one node from the start, so a group of
copies costs one row per task. A key with up to ``PAIRS_UP_TO`` nodes is joined with
itself; larger ones are linked through stars first:

* ``link_fingerprints`` (at most two bits apart) links the nodes of large keys through the
  65 words within one bit of each: two fingerprints two bits apart share such a word, and
  no word belongs to more than 65 fingerprints. This is exact and linear.
* ``near_copies`` first compares the nodes of a large key with the one that has most company
  over all its keys (an original among its copies). Then it compares all pairs of a key,
  at any size, but those that the first links have joined. A pair's prefixes must agree
  enough (``possible``) before the whole sets of its texts are made.

Defined results: null text counts as empty; texts without words share fingerprint zero
and are linked; a null id counts as the largest and is never a component's id unless all
are null; repeated rows belong to one component, of which one row stays; an empty table
gives an empty result; further columns are kept by the stage, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgersift.llm.common import discard, give_back_memory, map_texts, query, row_key, share, table, written
from ledgersift.llm.components import components
from ledgersift.llm.golay import segment_keys

PAIRS_UP_TO = 16
#: ``near_copies`` counts shingles in blocks of about so many and knows so many common ones at most.
COUNTED_AT_ONCE, MOST_COMMON = 1_000_000, 400_000


def ascii_words(text: str | None) -> list[bytes]:
    """A-Z lower-cased; words are runs of anything but space and U+0009 to U+000D."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(words: list[bytes], size: int) -> list[bytes]:
    """All runs of ``size`` words, repeats included; of fewer words, the whole sequence."""
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]]).tolist()
    text = b" ".join(words)
    return [text[s:e] for s, e in zip(starts, (ends[size - 1 :] - 1).tolist())]


def majority_bits(hashes: np.ndarray) -> np.ndarray:
    """Per bit of rows of big-endian unsigned words: set in over half of the rows."""
    if not len(hashes):
        return np.zeros(hashes.shape[1] * 64, dtype=np.uint8)
    counts = np.zeros(hashes.shape[1] * 64, dtype=np.int64)
    for part in range(0, len(hashes), 4096):
        block = np.ascontiguousarray(hashes[part : part + 4096])
        counts += np.unpackbits(block.view(np.uint8), axis=1).sum(axis=0, dtype=np.int64)
    return (2 * counts > len(hashes)).astype(np.uint8)


def simhash(hashes: np.ndarray) -> int:
    """The majority of each bit of 64-bit hashes, as a signed number."""
    return int(np.packbits(majority_bits(hashes.astype(">u8").reshape(-1, 1))).view(">i8")[0])


def fingerprint(text: str | None, size: int) -> int:
    """64-bit SimHash over the XXH64 (seed 42) of word shingles, as a signed number."""
    digest = xxhash.xxh64_intdigest
    return simhash(np.array([digest(s, 42) for s in shingles(ascii_words(text), size)], dtype=np.uint64))


def fingerprints(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, fp) of every row."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_texts(rows, ["doc_id"], lambda texts: {"fp": [fingerprint(t, size) for t in texts]}, "fp bigint")


def _parts_of(word: np.ndarray) -> np.ndarray:
    """Segments of 22, 21 and 21 bits of 64-bit fingerprints."""
    bits = word.view(np.uint64)
    return np.stack([bits >> np.uint64(42), bits >> np.uint64(21) & np.uint64(0x1FFFFF), bits & np.uint64(0x1FFFFF)], axis=1)


def _sizes(keys: DataFrame) -> DataFrame:
    """Keys with company: (key, n)."""
    return keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def _pairs(keys: DataFrame, sizes: DataFrame) -> DataFrame:
    """(a, b) with a < b for keys of at most PAIRS_UP_TO nodes; may repeat."""
    some = keys.join(sizes.where(f"n <= {PAIRS_UP_TO}").select("key"), "key")
    other = some.select("key", F.col("node").alias("b"))
    return some.select("key", F.col("node").alias("a")).join(other, "key").where("a < b").select("a", "b")


def golay_keys(nodes: DataFrame, node: str) -> DataFrame:
    """(key, node) of all Golay keys of the fingerprints ``fp``; ``node`` names the rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, keys = segment_keys(_parts_of(batch["fp"].to_numpy(dtype=np.int64)))
            yield pd.DataFrame({"key": keys, "node": batch["node"].to_numpy(dtype=np.int64)[rows]})

    return nodes.select("fp", F.col(node).alias("node")).mapInPandas(run, "key bigint, node bigint")


def link_fingerprints(nodes: DataFrame) -> DataFrame:
    """(a, b): enough of the pairs of distinct ``fp`` at most two bits apart to connect them all."""
    keys = golay_keys(nodes, "fp")
    sizes = written(_sizes(keys), "key-sizes")
    near = _pairs(keys, sizes).where("bit_count(a ^ b) <= 2").distinct()
    large = keys.join(sizes.where(f"n > {PAIRS_UP_TO}").select("key"), "key").select("node").distinct()
    within_one = F.concat(
        F.array("node"), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("node").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), i)))
    )
    words = large.select("node", F.explode_outer(within_one).alias("word"))
    met = words.groupBy("word").agg(F.collect_set("node").alias("nodes")).where("size(nodes) > 1")  # 65 at most
    stars = met.select(F.explode_outer("nodes").alias("a"), F.array_min("nodes").alias("b")).where("a <> b")
    return near.unionAll(stars)


def fingerprint_components(docs: DataFrame, size: int = 3) -> DataFrame:
    """doc_id, fp and component_id of every row; fingerprints link at two differing bits or fewer."""
    prints = written(fingerprints(docs, size), "fingerprints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(link_fingerprints(nodes))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_print = rooted.join(ids, "root").select("fp", "component_id")
    return prints.join(by_print, "fp")


def shingle_set(words: list[bytes], size: int) -> np.ndarray:
    """Sorted distinct XXH64 (seed 42) of the shingles."""
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(s, 42) for s in shingles(words, size)], dtype=np.uint64))


def common_shingles(rows: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that occur again within a block, sorted, and roughly how many texts have them.

    They only set the order of ``prefix``, which gives the same links in any order.
    """

    def counted(sets: list[np.ndarray]) -> pd.DataFrame:
        values, counts = np.unique(np.concatenate(sets), return_counts=True)
        again = counts > 1
        return pd.DataFrame({"shingle": values[again].view(np.int64), "n": counts[again].astype(np.int64)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sets, held = [], 0
        for batch in batches:
            for text in batch["text"]:
                sets.append(shingle_set(ascii_words(text), size))
                held += len(sets[-1])
                if held >= COUNTED_AT_ONCE:
                    yield counted(sets)
                    sets, held = [], 0
        if sets:
            yield counted(sets)
        sets.clear()
        give_back_memory()

    found = rows.select("text").mapInPandas(run, "shingle bigint, n bigint")
    totals = written(found.groupBy("shingle").agg(F.sum("n").alias("n")), "common-shingles")
    level = F.floor(F.log2("n")).cast("int")
    least, room = None, MOST_COMMON
    for row in totals.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():  # 63 at most
        room -= row["count"]
        if room < 0:
            break
        least = row["level"]
    kept = totals.where("false") if least is None else totals.where(level >= least)
    table = kept.toPandas()  # MOST_COMMON bounds it
    values = table["shingle"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(values)
    return values[order], table["n"].to_numpy(dtype=np.int64)[order]


def prefix(own: np.ndarray, common: tuple[np.ndarray, np.ndarray], similarity: float) -> np.ndarray:
    """The first shingles of a set, rare ones first: sets similar enough share one of theirs.

    Of n shingles at most n - similarity * n may be missing in a similar set of any size.
    """
    values, counts = common
    often = np.zeros(len(own), dtype=np.int64)
    if len(values):
        at = np.minimum(np.searchsorted(values, own), len(values) - 1)
        often = np.where(values[at] == own, counts[at], 0)
    ordered = own[np.lexsort((own, often))]
    return ordered[: len(own) - int(np.ceil(similarity * len(own) - 1e-9)) + 1]


def _prefixes(rows: DataFrame, size: int, similarity: float, shared) -> DataFrame:
    """(_key, doc_id, digest, handle, fp, n_shingles, prefix) of rows (_key, doc_id, text).

    ``shared`` gives the common shingles.
    """

    def run(texts: list) -> dict:
        out = {"digest": [], "handle": [], "fp": [], "n_shingles": [], "prefix": []}
        for text in texts:
            words = ascii_words(text)
            digest = xxhash.xxh3_128_digest(b" ".join(words))
            own = shingle_set(words, size)
            out["digest"].append(digest)
            out["handle"].append(int.from_bytes(digest[:8], "big", signed=True))
            out["fp"].append(simhash(own))
            out["n_shingles"].append(len(own))
            out["prefix"].append(prefix(own, shared(), similarity).tobytes())
        return out

    return map_texts(rows, ["_key", "doc_id"], run, "digest binary, handle bigint, fp bigint, n_shingles int, prefix binary")


def _prefix_keys(nodes: DataFrame) -> DataFrame:
    """(key, node, place, size) from nodes (handle, n_shingles, prefix); places count from 1."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                keys = [np.frombuffer(p, dtype=np.int64) for p in part["prefix"]]
                lengths = np.array([len(k) for k in keys])
                yield pd.DataFrame(
                    {
                        "key": np.concatenate(keys),
                        "node": np.repeat(part["handle"].to_numpy(dtype=np.int64), lengths),
                        "place": np.concatenate([np.arange(1, n + 1, dtype=np.int32) for n in lengths]),
                        "size": np.repeat(part["n_shingles"].to_numpy(dtype=np.int32), lengths),
                    }
                )
        batch = part = keys = None
        give_back_memory()

    return nodes.select("handle", "n_shingles", "prefix").mapInPandas(run, "key bigint, node bigint, place int, size int")


def shared_keys(nodes: DataFrame) -> DataFrame:
    """(key, node, place, size, n) of the keys that n > 1 nodes have."""
    keys = _prefix_keys(nodes)
    return written(keys.join(_sizes(keys), "key"), "shared-keys")


def _led(large: DataFrame, leaders: DataFrame) -> DataFrame:
    """Distinct (a, b) of the nodes of large keys and the leaders (key, leader) of these."""
    met = large.join(leaders, "key").where("node <> leader")
    return met.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()


def pairs_with_centres(shared: DataFrame, above: int = PAIRS_UP_TO) -> DataFrame:
    """Each node of a key of more than ``above`` nodes with the one that has most company."""
    large = shared.where(f"n > {above}")
    company = large.groupBy("node").agg(F.sum(F.log("n")).alias("company"))
    central = large.join(company, "node").groupBy("key").agg(F.max(F.struct("company", "node")).alias("c"))
    return _led(large.select("key", "node"), central.select("key", F.col("c.node").alias("leader")))


def pairs_across(shared: DataFrame, roots: DataFrame, similarity: float = 0.8) -> DataFrame:
    """All pairs that share a key, may be similar and are not in one component yet.

    Pairs within one component can add nothing to it. If a shared key were the first of all
    common shingles, no more than the places after it could be common; for the true first
    one this holds, so a similar pair always passes. ``roots`` has (node, root) of the nodes that are linked so far.
    """
    placed = written(
        shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "placed-keys"
    )
    split = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    open_keys = placed.join(split.select("key"), "key", "left_semi")
    sides = ("node", "root", "place", "size")
    left = open_keys.select("key", *[F.col(c).alias(f"a_{c}") for c in sides])
    right = open_keys.select("key", *[F.col(c).alias(f"b_{c}") for c in sides])
    after = F.least(F.col("a_size") - F.col("a_place"), F.col("b_size") - F.col("b_place")) + 1
    needed = F.lit(similarity / (1 + similarity)) * (F.col("a_size") + F.col("b_size")) - 1e-6
    condition = (
        (left["key"] == right["key"]) & (F.col("a_node") < F.col("b_node")) & (F.col("a_root") != F.col("b_root"))
        & (F.least("a_size", "b_size") >= F.greatest("a_size", "b_size") * similarity - 1e-6) & (after >= needed)
    )
    return left.join(right, condition).select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct()


def possible(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """Those (a, b) of pairs of handles whose sets can have that similarity by their prefixes.

    All that a set shares with the other, up to the end of the prefix that ends first in the
    order of shingles, is in both prefixes; beyond, it shares at most its rest. So no similar
    pair is lost, and sets that meet in a few shingles alone need not be made.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kept = []
            for left, right, m, n in zip(batch["left"], batch["right"], batch["a_size"], batch["b_size"]):
                both = np.frombuffer(left + right, dtype=np.int64).copy()
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                rest = max(m - len(left) // 8, n - len(right) // 8)
                kept.append(common + rest >= similarity / (1 + similarity) * (m + n) - 1e-6)
            yield batch.loc[kept, ["a", "b"]]
        batch = left = right = None
        give_back_memory()

    left = nodes.select(F.col("handle").alias("a"), F.col("n_shingles").alias("a_size"), F.col("prefix").alias("left"))
    right = nodes.select(F.col("handle").alias("b"), F.col("n_shingles").alias("b_size"), F.col("prefix").alias("right"))
    near = F.least("a_size", "b_size") >= F.greatest("a_size", "b_size") * similarity - 1e-6
    return pairs.join(left, "a").join(right, "b").where(near).mapInPandas(run, "a bigint, b bigint")


def _shingle_sets(texts: DataFrame, size: int) -> DataFrame:
    """(digest, handle, shingles): sorted distinct 64-bit hashes of the shingles, as bytes."""

    def run(texts: list) -> dict:
        return {"shingles": [shingle_set(ascii_words(t), size).tobytes() for t in texts]}

    return map_texts(texts, ["digest", "handle"], run, "shingles binary")


def _similar(pairs: DataFrame, similarity: float) -> DataFrame:
    """(a, b) digests whose shingle sets have at least that Jaccard similarity."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kept = []
            for left, right in zip(batch["left"], batch["right"]):
                x, y = np.frombuffer(left, dtype=np.uint64), np.frombuffer(right, dtype=np.uint64)
                if min(len(x), len(y)) < similarity * max(len(x), len(y)):
                    kept.append(False)
                    continue
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                kept.append(common >= similarity * (len(x) + len(y) - common))
            yield batch.loc[kept, ["a", "b"]]
        batch = left = right = x = y = None
        give_back_memory()

    return pairs.mapInPandas(run, "a binary, b binary")


def near_copies(docs: DataFrame, size: int = 5, similarity: float = 0.8) -> DataFrame:
    """(_key) of one row for each group of near-copies: the row with the lowest id.

    Rows equal in id and text share ``_key`` (see ``row_key``). First candidates are the nodes
    that share a Golay key of their fingerprints, each with the centre of its key; shingles of
    the prefixes, of which all similar pairs share one, complete them. Links come from the exact Jaccard similarity.
    """
    rows = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("_key"), "doc_id", "text")
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("i"), F.col("_key").alias("k"))
    common = share(docs.sparkSession, common_shingles(rows, size))
    nodes = written(
        _prefixes(rows, size, similarity, common)
        .groupBy("digest")
        .agg(F.min(order).alias("first"), *[F.min(c).alias(c) for c in ("handle", "fp", "n_shingles", "prefix")]),
        "nodes",
    )
    common.destroy()
    by_golay = golay_keys(nodes, "handle")
    by_golay = written(by_golay.join(_sizes(by_golay), "key"), "golay-keys")
    shared = shared_keys(nodes)

    def links(pairs: DataFrame) -> DataFrame:
        candidates = written(possible(pairs, nodes, similarity), "possible-pairs")
        ends = candidates.select(F.explode(F.array("a", "b")).alias("handle")).distinct()
        wanted = nodes.join(ends, "handle", "left_semi").select(F.col("first.k").alias("_key"), "digest", "handle")
        sets = written(_shingle_sets(rows.join(wanted, "_key").dropDuplicates(["_key"]), size), "shingles")
        left = sets.select(F.col("handle").alias("a_handle"), F.col("digest").alias("a"), F.col("shingles").alias("left"))
        right = sets.select(F.col("handle").alias("b_handle"), F.col("digest").alias("b"), F.col("shingles").alias("right"))
        met = candidates.toDF("a_handle", "b_handle").join(left, "a_handle").join(right, "b_handle")
        found = written(_similar(met.select("a", "b", "left", "right"), similarity), "links")
        discard(candidates, sets)
        return found

    first = links(pairs_with_centres(by_golay, 1).unionAll(pairs_with_centres(shared)).distinct())
    handles = nodes.select(F.col("digest").alias("node"), "handle")
    by_digest = components(first)
    tops = handles.select(F.col("node").alias("root"), F.col("handle").alias("root_handle"))
    linked = by_digest.join(handles, "node").join(tops, "root")
    second = links(pairs_across(shared, linked.select(F.col("handle").alias("node"), F.col("root_handle").alias("root")), similarity))
    discard(shared, by_golay)
    roots = components(first.unionAll(second))
    rooted = nodes.join(roots.withColumnRenamed("node", "digest"), "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    return rooted.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.k").alias("_key"))


def one_of_each(docs: DataFrame, size: int = 5, similarity: float = 0.8) -> DataFrame:
    """The pipeline stage: of each group of near-copies the row with the lowest id stays."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    keyed = docs.select(row, row_key(F.col("doc_id"), F.col("text")).alias("_key"))
    stays = near_copies(docs, size, similarity)
    return keyed.join(stays, "_key", "left_semi").dropDuplicates(["_key"]).select("_row.*")


@query("op5_simhash_near_dedup")
def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = fingerprint_components(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return linked.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
