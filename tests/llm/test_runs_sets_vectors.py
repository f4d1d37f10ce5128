"""Periodic runs, MinHash near-duplicates and hard negatives against brute force."""

import hashlib
import itertools
import math
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from compare import difference, duck
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgersift.llm import hard_negatives, minhash_dedup, periodic_runs
from ledgersift.llm.queries import CHECKS, QUERIES

DOCS = "doc_id bigint, text string"
OPS = ("op11_periodic_runs", "op12_minhash_near_dedup", "op13_hard_negatives")


@pytest.mark.parametrize("name", OPS)
def test_matches_sql(spark, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    problem = difference(got, duck(sf_dir).execute(CHECKS[name]).df())
    assert problem is None or problem.startswith("TYPES"), problem


# --- periodic runs


def plain_runs(words):
    """Every lag in turn; of equal stretches the one with the least period."""
    found, n = {}, len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, size, q) for (s, size), q in found.items())


def periodic_text(rng, n, letters):
    """Random words with several periodic parts, of short and of long periods."""
    words = []
    while len(words) < n:
        part = [rng.choice(letters) for _ in range(rng.choice([1, 2, 3, 7, 16, 17, 20, 21, 22, 28, 29, 40, 75, 120]))]
        times = rng.choice([1, 1, 2, 3, 3, 4, 9])
        words += (part * times)[: len(part) * times - rng.randrange(0, min(3, len(part)))]
        words += [rng.choice(letters) for _ in range(rng.randrange(0, 5))]
    return words


@pytest.mark.parametrize("letters", [2, 3, 12, 400])
def test_runs_equal_every_lag(letters):
    rng = random.Random(letters)
    names = [f"w{k}" for k in range(letters)]
    texts = [periodic_text(rng, rng.randrange(0, 900), names) for _ in range(60)] + [[], ["a"], ["a"] * 24, ["a"] * 23]
    assert periodic_runs.find_runs(texts) == [plain_runs(t) for t in texts]


@pytest.mark.parametrize("period", [1, 16, 17, 21, 22, 29, 333, 1000])
def test_every_period_is_found_at_its_least_length(period):
    rng = random.Random(period)
    part = [str(rng.random()) for _ in range(period)]
    size = max(24, 3 * period)
    text = ["x", "y"] + (part * 24)[:size] + ["z"]
    assert periodic_runs.find_runs([text, text[:-2]]) == [[(2, size, period)], []]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=120), max_size=4))
def test_runs_of_two_letters(texts):
    assert periodic_runs.find_runs(texts) == [plain_runs(t) for t in texts]


def planted(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    return words


def test_run_query_rows(spark):
    rng = random.Random(5)
    rows = [(i, " \t".join(periodic_text(rng, rng.randrange(0, 300), ["é", "b", "C c", "d"]))) for i in range(150)]
    rows += [(None, "a " * 30), (None, None), (7, ""), (7, rows[7][1]), (8, " \n ")]
    rows.append((next(i for i in range(10**12, 2 * 10**12) if zlib.crc32(str(i).encode()) % 10), "wörd " * 30_000 + "end"))
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], DOCS + ", n_runs int, _words string")
    got = periodic_runs.summaries(periodic_runs.with_planted_periods(docs)).collect()
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 5
    expected = []
    for doc_id, text in rows:
        words = planted(doc_id, text)
        runs = plain_runs(words) if len(words) < 5000 else [(0, 30_000, 1)]
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        expected.append(
            (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
             hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
             hashlib.sha256(b" ".join(w for k, w in enumerate(words) if k not in gone)).hexdigest())
        )
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    assert periodic_runs.summaries(docs.limit(0)).count() == 0


def test_collapsed_texts_and_runs(spark):
    docs = spark.createDataFrame([(1, "so é " + "a b " * 20 + "end"), (2, "plain  text"), (3, None), (4, "")], DOCS)
    texts = {r.doc_id: r.text for r in periodic_runs.collapsed(docs).collect()}
    assert texts == {1: "so é a b end", 2: "plain text", 3: None, 4: ""}
    found = {r.doc_id: [tuple(x) for x in r.runs] for r in periodic_runs.runs(docs).collect()}
    assert found == {1: [(2, 40, 2)], 2: [], 3: [], 4: []}


# --- MinHash near-duplicates


def plain_sets(rows):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        count = max(len(words) - 2, min(len(words), 1))
        sets.append({tuple(words[k : k + 3]) for k in range(count)})
    return sets


def plain_components(rows, percent=85):
    """component of each row by comparing all pairs; None ids count as largest."""
    sets = plain_sets(rows)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            root[find(j)] = find(i)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), math.inf), math.inf if doc_id is None else doc_id)
    ends = [least[find(i)] for i in range(len(rows))]
    return [(r[0], len(s), None if c == math.inf else c) for r, s, c in zip(rows, sets, ends)]


def near_rows(seed, families=14, members=9):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 6)))
    rows = []
    for _ in range(families):
        base = [word() for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 12, 30, 60, 150, 400]))]
        for _ in range(members):
            text = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 20)):
                text[rng.randrange(len(text))] = word()
            if rng.random() < 0.3:
                text = text[: max(1, int(len(text) * rng.uniform(0.8, 1)))]
            rows.append((len(rows) * 3 + 1, " ".join(text).upper() if rng.random() < 0.2 else "  ".join(text)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_equal_all_pairs(spark, seed):
    rows = near_rows(seed)
    rows += [(None, rows[0][1]), (None, "only these three words here and there"), (None, None), (0, ""), (2, " \n"),
             (rows[1][0], rows[1][1]), (rows[1][0], rows[2][1]), (5000, "one"), (5001, "ONE"), (5002, "one two")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DOCS + ", component_id string, digest int")
    got = minhash_dedup.near_duplicates(docs).collect()
    expected = plain_components(rows)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == sorted(expected, key=str)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert len({c for _, n, c in expected if n}) < len(rows) - 20


def test_chains_beyond_every_centre(spark):
    """Each text is near the next only: no centre links them, the full comparison does."""
    rng = random.Random(9)
    words = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(40):
        rows.append((k, " ".join(words)))
        for _ in range(2):
            words[rng.randrange(len(words))] = f"n{k}{rng.random()}"
    got = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {i: c for i, _, c in plain_components(rows)}


def test_large_family_meets_few_pairs(spark):
    rng = random.Random(3)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for k in range(400):
        text = list(base)
        for _ in range(rng.randrange(1, 12)):
            text[rng.randrange(150)] = f"{k}x{rng.randrange(10**6)}"
        rows.append((k, " ".join(text)))
    got = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {i: c for i, _, c in plain_components(rows)}


def test_no_rows(spark):
    empty = spark.createDataFrame([], DOCS)
    assert minhash_dedup.near_duplicates(empty).count() == 0
    blank = spark.createDataFrame([(1, None), (2, "")], DOCS)
    assert [tuple(r) for r in minhash_dedup.near_duplicates(blank).orderBy("doc_id").collect()] == [(1, 0, 1, True), (2, 0, 2, True)]


def test_sketch_estimates_and_densifies():
    rng = np.random.default_rng(2)
    for size in (6, 20, 200, 5000):
        agreed = []
        for _ in range(60):
            values = rng.integers(0, 1 << 64, size + size // 6 + 1, dtype=np.uint64)
            a, b = np.unique(values[:size]), np.unique(values[size // 6 + 1 :])
            similar = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            agreed.append((minhash_dedup.sketch(a) == minhash_dedup.sketch(b)).mean() - similar)
        assert abs(np.mean(agreed)) < 0.05
    own = np.sort(rng.integers(0, 1 << 64, 3, dtype=np.uint64))
    assert set(minhash_dedup.sketch(own)) <= set(own)


def test_bins_hold_their_least_hash():
    own = np.unique(np.random.default_rng(1).integers(0, 1 << 64, 4000, dtype=np.uint64))
    least = {}
    for v in own.tolist():
        least.setdefault(v * minhash_dedup.BINS >> 64, v)
    assert len(least) == minhash_dedup.BINS
    assert minhash_dedup.sketch(own).tolist() == [least[b] for b in range(minhash_dedup.BINS)]


# --- hard negatives

VECTORS = "vec_id bigint, embedding array<float>, label int, score int"


def plain_negatives(rows, every=100, k=5):
    kept = sorted({(i, lab, tuple(math.floor(256 * float(x)) for x in v)) for i, v, lab in rows
                   if None not in (i, v, lab) and all(x is not None and math.isfinite(x) for x in v)})
    out = []
    for i, lab, v in kept:
        if i % every:
            continue
        others = [(sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in kept if j != i and len(w) == len(v)]
        own = sorted((x for x in others if x[2] == lab), key=lambda x: (-x[0], x[1]))[:k]
        for p, pid, _ in own:
            inside = [x for x in others if x[2] != lab and 80 * p <= 100 * x[0] <= 100 * p]
            for rank, (s, j, _) in enumerate(sorted(inside, key=lambda x: (-x[0], x[1]))[:k], 1):
                out.append((i, pid, rank, j, p, s))
    return sorted(out)


def vectors(seed, n, dims, labels):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    rows = []
    for i in range(n):
        v = centres[rng.integers(6)] * 0.2 + rng.normal(size=dims) * rng.choice([0.02, 0.1])
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(labels))))
    return rows


@pytest.mark.parametrize("dims,labels", [(64, 4), (5, 2), (40, 1), (16, 30)])
def test_negatives_equal_brute_force(spark, dims, labels):
    rows = vectors(dims, 700, dims, labels)
    rows += [(700 + k, rows[3][1], 0) for k in range(40)]  # equal scores, ties by id
    rows += [(800, rows[5][1], None), (900, None, 0), (1000, [None] * dims, 0), (1100, [float("nan")] * dims, 0),
             (1200, [float("inf")] * dims, 0), (None, rows[1][1], 0), (1300, [], 0), (1400, [], 1), (1500, [0.5], 0),
             (1501, [0.25], 1), (1502, [0.5], 0)] + [rows[k] for k in range(0, 300, 7)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], VECTORS)
    scaled = hard_negatives.scaled(frame)
    got = sorted(map(tuple, hard_negatives.mine(scaled, F.col("vec_id") % 100 == 0).collect()))
    assert got == plain_negatives(rows)


def test_bounds_remove_rows_before_the_last_dimensions():
    rng = np.random.default_rng(4)
    anchor = np.sort(rng.integers(-90, 90, 64))[::-1].astype(np.int64) * np.linspace(1, 0.01, 64).round(2).astype(np.int64).clip(1)
    anchor[32:] //= 30
    matrix = rng.integers(-90, 90, (3000, 64))
    matrix[:10, :32] = anchor[:32]
    block = hard_negatives.Vertical(np.arange(3000), np.arange(3000), np.zeros(3000, dtype=np.int64), matrix, 90)
    left = []

    def keep(lower, upper):
        least = hard_negatives._largest(lower, 5)
        left.append(int((upper >= least).sum()))
        return upper >= least

    rows, scores = hard_negatives._scan(block, anchor, np.arange(3000), keep)
    assert left[0] < 3000 and left[-1] < 30
    exact = matrix @ anchor
    assert sorted(exact[block.numbers[rows]]) == sorted(scores)
    assert {int(x) for x in np.sort(exact)[-5:]} <= set(scores.tolist())


def test_many_groups_give_the_same(spark, monkeypatch):
    rows = vectors(8, 1500, 12, 3)
    frame = hard_negatives.scaled(spark.createDataFrame([(*r, 1) for r in rows], VECTORS))
    monkeypatch.setattr(hard_negatives, "CHUNK_ROWS", 200)
    monkeypatch.setattr(hard_negatives, "SLOT_ANCHORS", 4)
    got = sorted(map(tuple, hard_negatives.mine(frame, F.col("vec_id") % 100 == 0).collect()))
    assert got == plain_negatives(rows)


def test_no_vectors(spark):
    frame = spark.createDataFrame([], VECTORS)
    assert hard_negatives.mine(hard_negatives.scaled(frame), F.col("vec_id") % 100 == 0).count() == 0
    one = spark.createDataFrame([(1, [0.5], 3, 0)], VECTORS)
    assert hard_negatives.mine(hard_negatives.scaled(one), F.col("vec_id") % 100 == 0).count() == 0
