"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

Words are hashed to 22-bit buckets; buckets seen in ``LEAST_TEXTS`` training texts or more, and
in one of ``ONE_OF``, have an embedding, all others the zero vector. Filters one, two and three words wide run over the
whole text, are pooled by their maximum and feed a logistic unit. Thresholds are
calibrated on training rows held back from the fit, by language; the language is told
from the function words of the text alone, never from a column. The reported score is
shifted so that 0.5 is the threshold.

Every labelled row with a text takes part, whole: buckets are counted over all of them, and the rows
are dealt by a hash into shards of about ``SHARD_ROWS``, which are trained side by side. After each of
the ``ROUNDS`` the steps of the shards are averaged (those of an embedding over the shards that
moved it), in whole units, so their order does not matter. Thresholds come from the counts of all
calibration rows by logit, in steps of 1 / ``LEVELS``. The driver gets the model and these counts,
both of bounded size. Every text is scored whole, row by row, without a shuffle.

Defined results: null and empty texts are scored like a text without known words; without
labelled rows of both classes every score is the share of toxic labels (0 without labels);
rows labelled twice count as toxic if any label says so; repeated rows are scored alike; an
empty table gives an empty result; further columns are kept by the stage.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import RDD
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgersift.llm.common import crc32_of_id, discard, free_finished_shuffles, free_name, give_back_memory, map_texts, query, share, table, written
from ledgersift.llm.decontaminate import folded_words
from ledgersift.operators.layout import TASKS_PER_CORE

SHARD_ROWS = 2000
WIDTHS, FILTERS, DIMENSIONS = (1, 2, 3), 6, 8
BATCH, RATE, DECAY = 32, 0.1, 1e-4
#: Epochs of each round; with one shard, there is one round of them all.
ROUNDS = (1, 1, 2, 3, 6, 12)
#: Steps are averaged in whole multiples of 1 / UNIT, in tables of so many embeddings.
UNIT, TABLE_ROWS = 2.0**30, 4096
#: Logits are counted in steps of 1 / LEVELS, up to this size.
LEVELS, LARGEST = 1024, 64
SPREAD, DROPPED = 0.05, 0.5  # of first embeddings; share of words hidden at each step
PADS = max(WIDTHS) - 1
#: Training texts that a bucket must occur in to get an embedding: so many, and one of so many.
#: The share is what five were of the 6,000 texts learnt from at most before; it bounds the model.
LEAST_TEXTS, ONE_OF = 5, 1200
#: Weight of a false alarm against a miss when thresholds are chosen.
ALARM_WEIGHT = 3.0
#: Calibration rows of a class below which a language uses the common threshold.
LEAST_ROWS = 15

# Function words that tell the language of a text.
FUNCTION_WORDS = {
    "en": ("the", "of", "and", "to", "is", "that", "for", "with", "was", "by", "this", "are"),
    "de": ("der", "die", "das", "und", "ist", "zu", "von", "mit", "den", "ein", "für", "nicht"),
    "fr": ("le", "les", "et", "un", "une", "du", "est", "dans", "pour", "par", "au", "pas"),
    "es": ("el", "los", "las", "del", "y", "se", "su", "con", "por", "para", "no", "lo"),
}
LANGUAGES = (*FUNCTION_WORDS, "other")


def bucket(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 8) >> 42


@dataclass
class Batch:
    """Words of some texts in a row, each text followed by pads."""

    starts: np.ndarray  # first word of each text
    words: np.ndarray  # number of each word in the embedding table
    languages: np.ndarray  # of each text


def _batch(texts: list, buckets: np.ndarray) -> Batch:
    """``buckets`` are the known ones, sorted; unknown words get the number after the last."""
    split = [folded_words(t) for t in texts]
    distinct = list(set().union(*split))  # in any order: only their numbers in the table go out
    hashed = np.array([bucket(w) for w in distinct], dtype=np.uint64)
    place = np.searchsorted(buckets, hashed)
    known = place < len(buckets)
    known[known] = buckets[place[known]] == hashed[known]
    numbers = np.append(np.where(known, place, len(buckets)), len(buckets))  # the last one is the pad
    at = dict(zip(distinct, range(len(distinct))))
    spoken = np.zeros((len(distinct) + 1, len(FUNCTION_WORDS)), dtype=bool)
    for k, words in enumerate(FUNCTION_WORDS.values()):
        for w in words:
            if w.encode() in at:
                spoken[at[w.encode()], k] = True
    pads = [len(distinct)] * PADS
    order: list = []
    starts = []
    for words in split:
        starts.append(len(order))
        order += [at[w] for w in words]
        order += pads
    flat = np.array(order, dtype=np.int64)
    starts = np.array(starts, dtype=np.int64)
    # only the places of function words are counted, as most words are none
    heard = np.flatnonzero(spoken.any(axis=1)[flat])
    text, tongue = np.nonzero(spoken[flat[heard]])
    text = np.searchsorted(starts, heard[text], side="right") - 1
    counts = np.bincount(text * len(FUNCTION_WORDS) + tongue, minlength=len(starts) * len(FUNCTION_WORDS)).reshape(len(starts), len(FUNCTION_WORDS))
    languages = np.where(counts.max(axis=1) > 0, counts.argmax(axis=1), len(FUNCTION_WORDS)) if len(starts) else np.zeros(0, int)
    return Batch(starts, np.concatenate([numbers[flat], np.full(PADS, len(buckets))]), languages)


class ToxicityModel:
    """Embeddings, filters and the logistic unit."""

    def __init__(self, buckets: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.buckets = buckets
        self.embedding = rng.normal(0, SPREAD, (len(buckets) + 1, DIMENSIONS)).astype(np.float32)
        self.embedding[-1] = 0
        self.filters = [rng.normal(0, 0.3, (w, DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.biases = [np.zeros(FILTERS, dtype=np.float32) for _ in WIDTHS]
        self.weights = rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32)
        self.bias = np.zeros(1, dtype=np.float32)
        self.thresholds = np.zeros(len(LANGUAGES))
        self.squares = [np.full(a.shape, 1e-4, dtype=np.float32) for a in self.arrays()]  # sums of squared gradients

    def arrays(self) -> list[np.ndarray]:
        """All that is trained; the embeddings come first."""
        return [self.embedding, *self.filters, *self.biases, self.weights, self.bias]

    def _convolved(self, words: np.ndarray, tables: list) -> list[np.ndarray]:
        """Filter outputs at every word; a word's share of each is looked up, not multiplied."""
        count, out = len(words) - PADS, []
        for shares, bias in zip(tables, self.biases):
            total = shares[0][words[:count]] + bias
            for k in range(1, len(shares)):
                total += shares[k][words[k : k + count]]
            out.append(total)
        return out

    def tables(self) -> list:
        return [[self.embedding @ part for part in parts] for parts in self.filters]

    def logits(self, batch: Batch, tables: list) -> np.ndarray:
        if not len(batch.starts):
            return np.zeros(0)
        pooled = [np.maximum.reduceat(z, batch.starts, axis=0) for z in self._convolved(batch.words, tables)]
        return np.maximum(np.concatenate(pooled, axis=1), 0) @ self.weights + self.bias[0]

    def train(self, rows: list, labels: np.ndarray, epochs: int, rng: np.random.Generator) -> None:
        """Go over texts, each as the numbers of its words and pads."""
        n = len(WIDTHS)
        places = {"embedding": 0, "weights": 2 * n + 1, "bias": 2 * n + 2}
        places |= {("filter", j): 1 + j for j in range(n)} | {("bias", j): 1 + n + j for j in range(n)}

        def move(name, array, gradient, rows=None):  # Adagrad
            held = self.squares[places[name]]
            if rows is None:
                held += gradient**2
                array -= RATE * gradient / np.sqrt(held)
            else:
                held[rows] += gradient**2
                array[rows] -= RATE * gradient / np.sqrt(held[rows])

        pad = np.full(PADS, len(self.buckets))
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for first in range(0, len(order), BATCH):
                chosen = order[first : first + BATCH]
                sizes = np.cumsum([0] + [len(rows[i]) for i in chosen])
                joined = np.concatenate([*(rows[i] for i in chosen), pad])
                joined[rng.random(len(joined)) < DROPPED] = len(self.buckets)
                used, words = np.unique(joined, return_inverse=True)
                vectors = self.embedding[used]
                tables = [[vectors @ part for part in parts] for parts in self.filters]
                convolved = self._convolved(words, tables)
                tops = [np.stack([a + z[a:b].argmax(axis=0) for a, b in zip(sizes, sizes[1:])]) for z in convolved]
                pooled = np.concatenate([np.take_along_axis(z, t, axis=0) for z, t in zip(convolved, tops)], axis=1)
                active = np.maximum(pooled, 0)
                logit = np.clip(active @ self.weights + self.bias[0], -30, 30)
                slope = (1 / (1 + np.exp(-logit)) - labels[chosen]).astype(np.float32) / len(chosen)
                inner = slope[:, None] * self.weights * (pooled > 0)
                move("weights", self.weights, active.T @ slope + DECAY * self.weights)
                move("bias", self.bias, slope.sum(keepdims=True))
                moved = np.zeros_like(vectors)
                for j, (width, top) in enumerate(zip(WIDTHS, tops)):
                    part = inner[:, j * FILTERS : (j + 1) * FILTERS]
                    change = np.zeros_like(self.filters[j])
                    for k in range(width):
                        at = words[top + k]  # (texts, filters)
                        change[k] = np.einsum("bf,bfd->df", part, vectors[at])
                        np.add.at(moved, at, part[:, :, None] * self.filters[j][k].T[None])
                    move(("bias", j), self.biases[j], part.sum(axis=0))
                    move(("filter", j), self.filters[j], change + DECAY * self.filters[j])
                moved[used == len(self.buckets)] = 0  # unknown words stay at zero
                touched = np.flatnonzero(np.abs(moved).sum(axis=1))
                move("embedding", self.embedding, moved[touched], used[touched])

    def calibrate(self, counts: np.ndarray) -> None:
        """Threshold of each language from rows (language, level, toxic, count)."""
        common = _threshold(counts)
        for k in range(len(LANGUAGES)):
            own = counts[counts[:, 0] == k]
            toxic = own[own[:, 2] == 1, 3].sum()
            enough = min(toxic, own[:, 3].sum() - toxic) >= LEAST_ROWS
            self.thresholds[k] = _threshold(own) if enough else common

    def score(self, texts: list, tables: list) -> np.ndarray:
        batch = _batch(texts, self.buckets)
        shifted = self.logits(batch, tables) - self.thresholds[batch.languages.astype(int)]
        return 1 / (1 + np.exp(-np.clip(shifted, -30, 30).astype(np.float64)))


def _threshold(counts: np.ndarray) -> float:
    """Best hits minus weighted false alarms, in the middle of the widest gap of levels."""
    levels, place = np.unique(counts[:, 1], return_inverse=True)
    toxic, clean = (np.bincount(place, counts[:, 3] * (counts[:, 2] == c), minlength=len(levels)) for c in (1, 0))
    hits = toxic.sum() - np.concatenate([[0], np.cumsum(toxic)])
    alarms = clean.sum() - np.concatenate([[0], np.cumsum(clean)])
    gain = hits / max(toxic.sum(), 1) - ALARM_WEIGHT * alarms / max(clean.sum(), 1)
    values = levels / LEVELS
    edges = np.concatenate([[values[0] - 2], values, [values[-1] + 2]])
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    widest = max(best, key=lambda i: edges[i + 1] - edges[i])
    return float((edges[widest] + edges[widest + 1]) / 2)


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic, calibrates) of every document with a text and a label that may be learnt."""
    known = (
        labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .where(crc32_of_id(F.col("doc_id")) % 5 != 0)
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    )
    calibrates = crc32_of_id(F.col("doc_id")) % 5 == 1
    # merged at any size: the labels grow with the documents
    return docs.select("doc_id", "text").where("text IS NOT NULL").join(known.hint("merge"), "doc_id").withColumn("calibrates", calibrates)


def vocabulary(texts: DataFrame, n_texts: int) -> np.ndarray:
    """The buckets that have an embedding, sorted; all texts are counted."""
    least = max(LEAST_TEXTS, n_texts // ONE_OF)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[int, int] = {}
            for text in batch.column("text"):
                for b in {bucket(w) for w in set(folded_words(text.as_py()))}:
                    seen[b] = seen.get(b, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], names=["bucket", "n"])
        give_back_memory()

    counted = texts.select("text").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    return np.sort(counted.where(F.col("n") >= least).select("bucket").toPandas()["bucket"].to_numpy(dtype=np.uint64))  # ONE_OF x words of a text


def _shards(texts: DataFrame, buckets: np.ndarray, shards: int) -> RDD:
    """(shard, (hash, toxic, words)) of every text, in partitions by shard."""
    known = share(texts.sparkSession, buckets)
    parts = min(shards, TASKS_PER_CORE * texts.sparkSession.sparkContext.defaultParallelism)  # each hands on one sum

    def run(found: list) -> dict:
        batch = _batch(found, known())
        ends = np.append(batch.starts[1:], len(batch.words) - PADS)
        return {"words": [batch.words[a:b].astype(np.int32).tobytes() for a, b in zip(batch.starts, ends)]}

    spread = F.xxhash64(F.lit("toxicity"), "doc_id", "text")
    hashed = texts.select("text", "toxic", spread.alias("spread"), F.pmod(spread, F.lit(shards)).cast("int").alias("shard"))
    rows = map_texts(hashed, ["shard", "spread", "toxic"], run, "words binary")
    return rows.rdd.map(lambda r: (r["shard"], (r["spread"], r["toxic"], bytes(r["words"])))).partitionBy(parts, lambda s: s)


def _one_round(spark: SparkSession, model: ToxicityModel, shards: RDD, epochs: int, seed: int) -> None:
    """Train every shard from the model as it is, and move the model by the average."""
    sent = share(spark, model)

    def run(entries: Iterator[tuple]) -> Iterator[tuple]:
        held: dict = {}
        for shard, entry in entries:
            held.setdefault(shard, []).append(entry)
        tables: dict = {}
        add = lambda key, values: tables.update({key: tables[key] + values if key in tables else values})
        units = lambda new, old: np.rint((new.astype(np.float64) - old) * UNIT).astype(np.int64)
        for shard in sorted(held):
            own = sorted(held.pop(shard))
            before, after = sent(), copy.deepcopy(sent())
            rows = [np.frombuffer(words, dtype=np.int32).astype(np.int64) for _, _, words in own]
            toxic = np.array([t for _, t, _ in own], dtype=np.float32)
            after.train(rows, toxic, epochs, np.random.default_rng([seed, shard]))
            dense = [units(a, b).ravel() for a, b in zip(after.arrays()[1:] + after.squares[1:], before.arrays()[1:] + before.squares[1:])]
            add(-1, np.concatenate([*dense, [1]]))
            moved = (after.squares[0] != before.squares[0]).any(axis=1)
            both = np.concatenate([units(a, b) for a, b in ((after.embedding, before.embedding), (after.squares[0], before.squares[0]))], axis=1)
            both = np.concatenate([both, moved[:, None]], axis=1)
            for first in range(0, len(both), TABLE_ROWS):
                if moved[first : first + TABLE_ROWS].any():
                    add(first, both[first : first + TABLE_ROWS])
        yield from tables.items()
        give_back_memory()

    summed = shards.mapPartitions(run).reduceByKey(lambda a, b: a + b, shards.getNumPartitions()).collect()  # the model's size
    for first, values in summed:
        if first >= 0:
            moves = values[:, :-1] / np.maximum(values[:, -1:], 1) / UNIT
            rows = slice(first, first + len(moves))
            model.embedding[rows] += moves[:, :DIMENSIONS].astype(np.float32)
            model.squares[0][rows] += moves[:, DIMENSIONS:].astype(np.float32)
            continue
        moves, at = values[:-1] / values[-1] / UNIT, 0
        for array in model.arrays()[1:] + model.squares[1:]:
            array += moves[at : at + array.size].reshape(array.shape).astype(np.float32)
            at += array.size
    sent.destroy()
    free_finished_shuffles(spark)  # the sums of the round


def level_counts(rows: DataFrame, model: ToxicityModel) -> np.ndarray:
    """Rows (language, level of the logit, toxic, count) of labelled texts: a bounded number."""
    shared = share(rows.sparkSession, model)

    def run(texts: list) -> dict:
        fitted = shared()
        batch = _batch(texts, fitted.buckets)
        levels = np.rint(np.clip(fitted.logits(batch, fitted.tables()), -LARGEST, LARGEST) * LEVELS)
        return {"language": batch.languages.astype(np.int32), "level": levels.astype(np.int64)}

    counts = map_texts(rows, ["toxic"], run, "language int, level bigint").groupBy("language", "level", "toxic").count()
    return np.array([tuple(r) for r in counts.collect()], dtype=np.int64).reshape(-1, 4)


def fit_toxicity(docs: DataFrame, labels: DataFrame, seed: int = 7) -> ToxicityModel | float:
    """A model, or the share of toxic labels where one class is missing."""
    spark = docs.sparkSession
    rows = written(labelled_rows(docs, labels), "toxicity-labelled")
    free_finished_shuffles(spark)  # the join, which was still in use until here
    counts = {(r["calibrates"], r["toxic"]): r["count"] for r in rows.groupBy("calibrates", "toxic").count().collect()}
    fitted, held = ([counts.get((c, t), 0) for t in (0, 1)] for c in (False, True))
    if not all(fitted):
        discard(rows)
        return float((fitted[1] + held[1]) / max(sum(fitted) + sum(held), 1))
    texts = rows.where("NOT calibrates")
    model = ToxicityModel(vocabulary(texts, sum(fitted)), seed)
    shards = -(-sum(fitted) // SHARD_ROWS)
    dealt = _shards(texts, model.buckets, shards)
    for number, epochs in enumerate(ROUNDS if shards > 1 else (sum(ROUNDS),)):
        _one_round(spark, model, dealt, epochs, seed + number)
    model.calibrate(level_counts(rows.where("calibrates") if all(held) else rows, model))
    discard(rows)
    model.squares = []  # only training needs them
    return model


def scored(docs: DataFrame, model: ToxicityModel | float, keep: list[str], name: str = "_ls_score") -> DataFrame:
    """``keep`` columns with the score of every whole text as ``name``."""
    shared = share(docs.sparkSession, model)  # the vocabulary's bound bounds it

    def run(texts: list) -> dict:
        fitted = shared()
        if isinstance(fitted, float):
            return {name: np.full(len(texts), fitted)}
        if not hasattr(fitted, "made"):
            fitted.made = fitted.tables()
        return {name: fitted.score(texts, fitted.made)}

    return map_texts(docs, keep, run, f"{name} double")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pipeline stage: documents with a score of 0.5 or more go.

    With labels of one class, or none, there is nothing to learn and all documents stay.
    """
    model = fit_toxicity(docs, labels)
    if isinstance(model, float):
        return docs
    columns, name = docs.columns, free_name(docs.columns, "_ls_score")
    return scored(docs, model, columns, name).where(F.col(name) < 0.5).select(*[f"`{c}`" for c in columns])


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = scored(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")), ["doc_id"])
    return rows.select(
        "doc_id",
        (crc32_of_id(F.col("doc_id")) % 5 == 0).alias("held_out"),
        F.col("_ls_score").alias("score"),
        (F.col("_ls_score") >= 0.5).cast("int").alias("predicted"),
    )
