"""Language identification: a bidirectional gated recurrent network over bytes.

The network reads a text in windows of ``WINDOW`` bytes, forwards and backwards, labels
every byte, and the mean of all bytes' probabilities is the document's. It is trained in
numpy by backpropagation through time. Its gates use the piecewise-linear sigmoid, so
that a byte costs little more than two small matrix products.

Training uses windows of a sample of labelled texts, about ``SAMPLE_TEXTS`` of each
language by a hash of the id, ``WINDOWS_PER_TEXT`` evenly spread windows of each; it runs
on the driver. Every text is read whole, row by row, without a shuffle.

Defined results: null texts and texts without a letter are ``und`` with score 0, as is
every text where nothing could be learned; rows without a language teach nothing; equal
probabilities go to the language first in the alphabet; repeated rows are labelled alike;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgersift.llm.common import crc32_of_id, map_texts, query, share, table

WINDOW, HIDDEN, PAD = 64, 8, 256
SAMPLE_TEXTS, WINDOWS_PER_TEXT = 300, 12
EPOCHS, BATCH, RATE = 10, 256, 0.02
SLOPE = 0.2
#: Windows read together.
READ_TOGETHER = 8192
LETTER = re.compile(r"[^\W\d_]")


def _gate(x: np.ndarray) -> np.ndarray:
    x *= SLOPE
    x += 0.5
    return np.clip(x, 0, 1, out=x)


class Direction:
    """One gated recurrent layer; columns of its tables: update, reset, candidate."""

    def __init__(self, rng: np.random.Generator):
        self.inputs = rng.normal(0, 0.3, (PAD + 1, 3 * HIDDEN)).astype(np.float32)
        self.inner = rng.normal(0, 0.3, (HIDDEN, 3 * HIDDEN)).astype(np.float32)

    def states(self, windows: np.ndarray, full: int, memory: list | None = None) -> np.ndarray:
        """(steps, windows, HIDDEN); windows from ``full`` on end in pads, which reset the state."""
        steps, count, h = windows.shape[1], windows.shape[0], HIDDEN
        out = np.empty((steps, count, h), dtype=np.float32)
        state = np.zeros((count, h), dtype=np.float32)
        for t in range(steps):
            symbols = windows[:, t]
            given = np.take(self.inputs, symbols, axis=0)
            held = state @ self.inner
            gates = _gate(given[:, : 2 * h] + held[:, : 2 * h])
            update, reset = gates[:, :h], gates[:, h:]
            fresh = np.tanh(given[:, 2 * h :] + reset * held[:, 2 * h :])
            if memory is not None:
                memory.append((symbols, state, update, reset, fresh, held[:, 2 * h :]))
            state = np.add(fresh, update * (state - fresh), out=out[t])
            if full < count:
                state[full:] *= (symbols[full:] != PAD)[:, None]
        return out

    def gradients(self, memory: list, outer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of ``inputs`` and ``inner``, from the gradient of every state; back through time."""
        back = np.zeros_like(outer[0])
        inner, symbols, givens = np.zeros_like(self.inner), [], []
        for t in range(len(memory) - 1, -1, -1):
            symbol, before, update, reset, fresh, held = memory[t]
            total = outer[t] + back
            d_update = total * (before - fresh) * SLOPE * ((update > 0) & (update < 1))
            d_fresh = total * (1 - update) * (1 - fresh * fresh)
            d_reset = d_fresh * held * SLOPE * ((reset > 0) & (reset < 1))
            through = np.concatenate([d_update, d_reset, d_fresh * reset], axis=1)
            symbols.append(symbol)
            givens.append(np.concatenate([d_update, d_reset, d_fresh], axis=1))
            inner += before.T @ through
            back = total * update + through @ self.inner.T
        inputs = np.zeros_like(self.inputs)
        np.add.at(inputs, np.concatenate(symbols), np.concatenate(givens))
        return inputs, inner


class LanguageModel:
    def __init__(self, languages: list[str], seed: int = 11):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.ways = [Direction(rng), Direction(rng)]
        self.output = rng.normal(0, 0.3, (2 * HIDDEN, len(languages))).astype(np.float32)
        self.bias = np.zeros(len(languages), dtype=np.float32)

    def _probabilities(self, forth: np.ndarray, back: np.ndarray) -> np.ndarray:
        """Of every position; ``back`` in the order of the text."""
        logits = forth @ self.output[:HIDDEN] + back @ self.output[HIDDEN:] + self.bias
        logits -= logits.max(axis=-1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=-1, keepdims=True)
        return logits

    def fit(self, windows: np.ndarray, labels: np.ndarray, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        forth, back = self.ways
        arrays = [forth.inputs, forth.inner, back.inputs, back.inner, self.output, self.bias]
        first, second = [np.zeros_like(a) for a in arrays], [np.zeros_like(a) for a in arrays]
        step = 0
        for epoch in range(EPOCHS):
            order = rng.permutation(len(windows))
            for at in range(0, len(order), BATCH):
                chosen = order[at : at + BATCH]
                text, count = windows[chosen], len(chosen)
                memories: list[list] = [[], []]
                ahead = forth.states(text, count, memories[0])
                behind = back.states(text[:, ::-1], count, memories[1])[::-1]
                slope = self._probabilities(ahead, behind)
                slope[:, np.arange(count), labels[chosen]] -= 1
                slope /= slope.shape[0] * count
                both = np.concatenate([ahead, behind], axis=2)
                d_output = np.tensordot(both, slope, axes=([0, 1], [0, 1]))
                outer = slope @ self.output.T
                gradients = [
                    *forth.gradients(memories[0], outer[:, :, :HIDDEN]),
                    *back.gradients(memories[1], outer[::-1, :, HIDDEN:]),
                    d_output, slope.sum(axis=(0, 1)),
                ]
                size = np.sqrt(sum(float((g * g).sum()) for g in gradients))
                step += 1
                rate = RATE * (1 - epoch / EPOCHS) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                for array, gradient, m, v in zip(arrays, gradients, first, second):  # Adam
                    gradient = gradient * min(1.0, 1.0 / max(size, 1e-12))
                    m += 0.1 * (gradient - m)
                    v += 0.001 * (gradient * gradient - v)
                    array -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities over all bytes of each non-empty text."""
        counts = [-(-len(t) // WINDOW) for t in texts]
        owner = np.repeat(np.arange(len(texts)), counts)
        padded = np.full(int(sum(counts)) * WINDOW, PAD, dtype=np.int32)
        at = 0
        for text, count in zip(texts, counts):
            padded[at : at + len(text)] = np.frombuffer(text, dtype=np.uint8)
            at += count * WINDOW
        windows = padded.reshape(-1, WINDOW)
        order = np.argsort(windows[:, -1] == PAD, kind="stable")  # whole windows first
        total = np.zeros((len(texts), len(self.languages)))
        for first in range(0, len(order), READ_TOGETHER):
            rows = order[first : first + READ_TOGETHER]
            part = windows[rows]
            full = int((part[:, -1] != PAD).sum())
            ahead = self.ways[0].states(part, full)
            behind = self.ways[1].states(part[:, ::-1], full)[::-1]
            each = self._probabilities(ahead, behind)
            if full < len(rows):
                each[:, full:] *= (part[full:] != PAD).T[:, :, None]
            sums = each.sum(axis=0, dtype=np.float64)
            for k in range(sums.shape[1]):
                total[:, k] += np.bincount(owner[rows], weights=sums[:, k], minlength=len(texts))
        return total / np.array([[max(len(t), 1)] for t in texts], dtype=float).reshape(-1, 1)

    def label(self, texts: list) -> tuple[list[str], list[float]]:
        names, scores = ["und"] * len(texts), [0.0] * len(texts)
        spoken = [i for i, t in enumerate(texts) if t is not None and LETTER.search(t)]
        if spoken:
            shares = self.pooled([texts[i].encode("utf-8", "surrogatepass") for i in spoken])
            for i, row in zip(spoken, shares):
                best = int(row.argmax())
                names[i], scores[i] = self.languages[best], float(min(1.0, row[best]))
        return names, scores


def training_windows(docs: DataFrame, texts: int = SAMPLE_TEXTS) -> list:
    """(lang, parts) of about ``texts`` rows of each language, in a fixed order."""
    span = (1 << 62) - 1
    spread = F.xxhash64(F.lit("language"), "doc_id", "text").bitwiseAND(F.lit(span))
    usable = docs.where("lang IS NOT NULL AND text IS NOT NULL").where(crc32_of_id(F.col("doc_id")) % 4 != 2)
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not counts:
        return []
    limit = F.lit(-1).cast("bigint")
    for lang, count in sorted(counts.items()):
        limit = F.when(F.col("lang") == lang, F.lit(int(min(1.0, texts / count) * span))).otherwise(limit)
    part = lambda k: F.substring("text", (F.length("text") * k / WINDOWS_PER_TEXT).cast("int") + 1, F.lit(WINDOW))
    numbers = F.sequence(F.lit(0), F.lit(WINDOWS_PER_TEXT - 1))
    sample = usable.withColumn("spread", spread).where(F.col("spread") <= limit)
    rows = sample.select("lang", "spread", F.transform(numbers, part).alias("parts")).collect()
    return sorted(rows, key=lambda r: (r["spread"], r["parts"]))


def fit_languages(docs: DataFrame, texts: int = SAMPLE_TEXTS) -> LanguageModel | None:
    """A model trained on whole windows; a text shorter than one is repeated. None without texts."""
    windows, labels = [], []
    rows = training_windows(docs, texts)
    languages = sorted({r["lang"] for r in rows})
    for r in rows:
        parts = [part.encode("utf-8", "surrogatepass") for part in r["parts"]]
        whole = [raw[:WINDOW] for raw in parts if len(raw) >= WINDOW]
        longest = max(parts, key=len)
        if not whole and longest:
            whole = [((longest + b" ") * WINDOW)[:WINDOW]]
        windows += [np.frombuffer(raw, dtype=np.uint8) for raw in whole]
        labels += [languages.index(r["lang"])] * len(whole)
    if not windows:
        return None
    model = LanguageModel(languages)
    model.fit(np.array(windows, dtype=np.int32), np.array(labels))
    return model


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """doc_id, lang_pred and score of every row."""
    shared = share(docs.sparkSession, model)  # a few thousand numbers

    def run(texts: list) -> dict:
        fitted = shared()
        names, scores = fitted.label(texts) if fitted else (["und"] * len(texts), [0.0] * len(texts))
        return {"lang_pred": names, "score": scores}

    return map_texts(docs.select("doc_id", "text"), ["doc_id"], run, "lang_pred string, score double")


@query("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, fit_languages(docs))
    return found.select("doc_id", (crc32_of_id(F.col("doc_id")) % 4 == 2).alias("held_out"), "lang_pred", "score")
