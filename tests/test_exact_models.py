"""Second-order boosting, prefixes of ensembles, exact areas and pairwise matrices against plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from ledgersift.ml import areas as A
from ledgersift.ml import boosting as B
from ledgersift.ml import train as R
from ledgersift.ml.nested import prefix_scores
from ledgersift.ml.prepare import split
from ledgersift.operators import gram as G
from ledgersift.operators import selection as E
from ledgersift.operators import layout as L
from ledgersift.operators.layout import kept
from ledgersift.plans import model_queries as M
from ledgersift.sources import views as V

ROWS = "x array<double>, label double, weight double, row bigint"


def plain_boost(x, label, weight, ids, edges, rounds, unit):
    """Row-by-row boosting: every cut of every column is tried on the rows of a node."""
    bins = np.array([[sum(v > e for e in own) for v, own in zip(row, edges)] for row in x])
    margin, history = np.zeros(len(x)), []
    for number in range(rounds.trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = np.rint((p - label) * weight / unit) * unit, np.rint(p * (1 - p) * weight / unit) * unit
        used = np.flatnonzero(B.drawn(ids, number, rounds.seed, rounds.row_share))
        columns = B.chosen_columns(len(edges), number, rounds)
        added = np.zeros(len(x))

        def fill(rows, every, level):
            total_g, total_h = g[rows].sum(), h[rows].sum()
            best = None
            for c in columns if level < rounds.depth else ():
                for cut in range(max(len(e) for e in edges)):
                    left = rows[bins[rows, c] <= cut]
                    lg, lh = g[left].sum(), h[left].sum()
                    rg, rh = total_g - lg, total_h - lh
                    if lh < rounds.least_hessian or rh < rounds.least_hessian:
                        continue
                    gain = lg**2 / (lh + rounds.l2) + rg**2 / (rh + rounds.l2) - total_g**2 / (total_h + rounds.l2)
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-12):
                        best = (gain, c, cut)
            if best is None:
                added[every] = -rounds.rate * total_g / (total_h + rounds.l2)
                return
            _, c, cut = best
            for side in (True, False):
                fill(rows[(bins[rows, c] <= cut) == side], every[(bins[every, c] <= cut) == side], level + 1)

        fill(used, np.arange(len(x)), 0)
        margin = margin + added
        history.append(margin)
    return history


def labelled_rows(n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 4)), 2)
    label = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=n) * 0.5 > 0.8).astype(float)
    weight = np.where(label == 1, 3.0, 1.0)
    return x, label, weight, np.arange(n, dtype=np.int64) * 7919


def frame(spark, x, label, weight, ids):
    rows = [(v.tolist(), float(a), float(w), int(i)) for v, a, w, i in zip(x, label, weight, ids)]
    return spark.createDataFrame(rows, ROWS)


@pytest.mark.parametrize("share", [1.0, 0.7])
def test_boosting_equals_plain_version(spark, share, monkeypatch):
    monkeypatch.setattr(B, "ROUNDS_PER_TABLE", 3)
    x, label, weight, ids = labelled_rows()
    edges = [np.unique(np.quantile(x[:, c], [0.2, 0.4, 0.6, 0.8])) for c in range(4)]
    rounds = B.Rounds(trees=8, depth=3, rate=0.3, row_share=share, column_share=0.75 if share < 1 else 1.0)
    unit = 2.0 ** (math.ceil(math.log2(3.0)) - B.GRADIENT_BITS)
    history = plain_boost(x, label, weight, ids, edges, rounds, unit)
    booster = B.boost(frame(spark, x, label, weight, ids).repartition(3), rounds, edges)
    assert np.allclose(booster.margins(x), history[-1], atol=1e-9)
    assert np.allclose(booster.margins(x, 5), history[4], atol=1e-9)
    losses = [np.mean(weight * (np.log1p(np.exp(m)) - label * m)) for m in history]
    if share == 1.0:
        assert all(b < a for a, b in zip(losses, losses[1:]))


def test_boosting_is_the_same_for_any_partitioning(spark, monkeypatch):
    x, label, weight, ids = labelled_rows(300, 5)
    rounds = B.Rounds(trees=3, depth=4)
    made = []
    for parts, limit in ((1, 64), (7, 2)):
        monkeypatch.setattr(B, "SUMS_TO_DRIVER", limit)  # the second adds up in groups
        edges = [np.unique(np.quantile(x[:, c], np.linspace(0.1, 0.9, 9))) for c in range(4)]
        made.append(B.boost(frame(spark, x, label, weight, ids).repartition(parts), rounds, edges).to_json())
    assert made[0] == made[1]


def test_a_level_counts_the_smaller_children(spark, monkeypatch):
    """Every level used to go over all rows from the root; the other children are what these leave of their parents."""
    counted, summed = [], B._Rows._summed
    monkeypatch.setattr(B._Rows, "_summed", lambda self, one: counted.append((one.level, one.n_slots)) or summed(self, one))
    x, label, weight, ids = labelled_rows(300, 6)
    edges = [np.unique(np.quantile(x[:, c], np.linspace(0.1, 0.9, 9))) for c in range(4)]
    booster = B.boost(frame(spark, x, label, weight, ids), B.Rounds(trees=2, depth=4), edges)
    assert [level for level, _ in counted] == [0, 1, 2, 3] * 2
    assert all(n <= max(1, 2**level // 2) for level, n in counted)
    assert all(len(t.column) > 7 for t in booster.trees)


@pytest.mark.parametrize("share", [1.0, 0.7])
def test_boosting_goes_on_where_files_are_lost(spark, share, monkeypatch):
    """All files of a fit are removed, or those of a step, and all is made again with the same trees."""
    monkeypatch.setattr(B, "ROUNDS_PER_TABLE", 2)
    x, label, weight, ids = labelled_rows(300, 9)
    edges = [np.unique(np.quantile(x[:, c], np.linspace(0.1, 0.9, 9))) for c in range(4)]
    df, made = frame(spark, x, label, weight, ids), []
    for newton in (True, False):
        rounds = B.Rounds(trees=6, depth=3, row_share=share, newton=newton)
        df = df if newton else df.withColumn("weight", F.lit(1.0))
        plain = B.boost(df, rounds, edges).to_json()
        summed = B._Rows._summed

        def lossy(self, one):
            folder = self.parts.folder
            lost = {(2, 1): "", (3, 0): "margin-", (4, 2): "at-", (5, 0): ""}.get((one.number, one.level))

            def lose(part):
                import os

                for name in os.listdir(folder(part[0])):
                    if name.startswith(lost):
                        os.remove(os.path.join(folder(part[0]), name))

            if lost is not None:
                made.append(lost)
                self.parts.parts.foreach(lose)
            return summed(self, one)

        with monkeypatch.context() as patch:
            patch.setattr(B._Rows, "_summed", lossy)
            assert B.boost(df, rounds, edges).to_json() == plain
    assert len(made) == 8


def test_boosting_without_rows_or_with_missing_values(spark):
    empty = spark.createDataFrame([], ROWS)
    assert B.boost(empty, B.Rounds(trees=2), [np.array([0.0])]).trees == []
    nan = float("nan")
    x = np.array([[nan], [1.0], [2.0], [nan]] * 10)
    label = np.array([1.0, 0.0, 0.0, 1.0] * 10)
    booster = B.boost(frame(spark, x, label, np.ones(40), np.arange(40)), B.Rounds(trees=2, depth=1, row_share=1.0), [np.array([1.0, 2.0])])
    margins = booster.margins(x)
    assert margins[0] > 0 > margins[1] and margins[1] == margins[2]


@pytest.fixture(scope="module")
def parts(spark, sf_dir):
    with kept(*split(V.transactions(spark, sf_dir))) as (train, test):
        yield train, test


def test_boosted_pipeline_is_saved_and_weighs_frauds(spark, parts, tmp_path):
    train, test = parts
    small = {"maxIter": 4, "maxDepth": 3}
    fitted = R.train(train, "boosted", **small)
    path = str(tmp_path / "boosted")
    R.save_model(fitted.model, path)
    again = R.load_model(path).transform(test).select("tx_id", "probability", "prediction")
    assert again.exceptAll(fitted.model.transform(test).select("tx_id", "probability", "prediction")).count() == 0
    row = R.metrics_table(spark, [R.evaluate(fitted, test)]).first()
    assert row.auc_roc > 0.7


def test_prefixes_equal_separate_fits(parts):
    train, test = parts
    for name, settings in (("gbt", {"maxDepth": 3}), ("boosted", {"maxDepth": 3})):
        large = R.train(train, name, maxIter=4, **settings).model
        prepared = PipelineModel(stages=large.stages[:-1]).transform(test)
        scores = prefix_scores(large.stages[-1], prepared, [2, 4]).select("tx_id", "scores")
        small = R.train(train, name, maxIter=2, **settings).model.transform(test)
        own = small.select("tx_id", A.prediction_score(small).alias("own"))
        apart = scores.join(own, "tx_id").agg(F.max(F.abs(F.col("scores")[0] - F.col("own")))).first()[0]
        assert apart < 1e-9


def test_forest_scores_equal_the_model(parts):
    train, test = parts
    forest = R.train(train, "random_forest", numTrees=6, maxDepth=4).model
    scored = prefix_scores(forest.stages[-1], forest.transform(test), [3, 6])
    apart = scored.agg(F.max(F.abs(F.col("scores")[1] - A.prediction_score(scored)))).first()[0]
    assert apart < 1e-9


def test_grid_by_prefixes(parts):
    train, _ = parts
    grid = {"maxIter": (1, 3), "maxDepth": (2, 3)}
    tuned, table = R.tune(train, "gbt", grid=grid, folds=2, parallelism=2)
    got = {r.parameters: r.auc_roc for r in table.collect()}
    assert list(got) == ["maxIter=1, maxDepth=2", "maxIter=1, maxDepth=3", "maxIter=3, maxDepth=2", "maxIter=3, maxDepth=3"]
    folded = R._with_folds(train, 2)
    own = []
    for fold in range(2):
        rest, held = folded.filter(F.col("fold") != fold), folded.filter(F.col("fold") == fold)
        own.append(R.auc(R.train(rest, "gbt", maxIter=1, maxDepth=3).model.transform(held)))
    assert got["maxIter=1, maxDepth=3"] == pytest.approx(sum(own) / 2, abs=1e-9)
    best = max(got, key=got.get)
    assert f"maxIter={tuned.bestModel.stages[-1].getMaxIter()}" in best
    assert max(tuned.avgMetrics) == got[best]
    assert len(R.LARGE_GRIDS["random_forest"]) == 3


def plain_areas(rows):
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    roc = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / len(pos) / len(neg)
    points, tp, fp = [], 0, 0
    for s in sorted({s for s, _ in rows}, reverse=True):
        tp, fp = tp + sum(p == s for p in pos), fp + sum(n == s for n in neg)
        points.append((tp / len(pos), tp / (tp + fp)))
    points.insert(0, (0.0, points[0][1]))
    return roc, sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))


@pytest.mark.parametrize("groups", [3, 1_000_000])
def test_areas(spark, monkeypatch, groups):
    monkeypatch.setattr(A, "RANGE_GROUPS", groups)
    rng = random.Random(groups)
    rows = [("ab"[i % 2], round(rng.gauss(0, 1), 1), rng.random() < 0.3) for i in range(300)]
    frame = spark.createDataFrame([(c, s, float(y)) for c, s, y in rows], "curve string, score double, label double")
    found = {r.curve: r for r in A.areas(frame, curve="curve").collect()}
    for c in "ab":
        roc, pr = plain_areas([(s, y) for k, s, y in rows if k == c])
        assert (found[c].auc_roc, found[c].auc_pr) == (pytest.approx(roc, abs=1e-12), pytest.approx(pr, abs=1e-12))
    odd = spark.createDataFrame([("x", 1.0, 1.0), ("x", None, 0.0), ("x", 2.0, None)], frame.schema)
    assert A.areas(odd, curve="curve").first().auc_roc is None
    assert A.areas(odd.limit(0)).count() == 0


def test_sixty_columns_with_gaps(spark):
    rng = np.random.default_rng(8)
    values = rng.normal(size=(300, 60)) * np.logspace(-3, 6, 60) + 1e6
    values[:, 7] = values[:, 3] * 2 + rng.normal(size=300) * 1e-4
    values[:, 9] = 5.0
    gaps = rng.random(values.shape) < 0.2
    names = [f"v{i}" for i in range(60)]
    rows = [[None if g else (float("nan") if i % 50 == 49 and c == 11 else float(v)) for c, (v, g) in enumerate(zip(row, gap))]
            for i, (row, gap) in enumerate(zip(values, gaps))]
    rows[0][13], rows[1][13], rows[1][14] = float("inf"), 1.0, None
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(5)
    found = {(r.feature1, r.feature2): r.correlation for r in E.correlation_matrix(df, names).collect()}
    assert len(found) == 60 * 59 // 2
    table = np.array([[np.nan if v is None else v for v in row] for row in rows])
    for (a, b), r in found.items():
        i, j = names.index(a), names.index(b)
        both = ~np.isnan(table[:, i]) & ~np.isnan(table[:, j])
        x, y = table[both, i], table[both, j]
        if not np.isfinite(x).all() or not np.isfinite(y).all() or 9 in (i, j):
            assert r is None
        else:
            assert r == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-7)
    sums = G.pair_sums(df, names)
    assert sums.variance("v5") == pytest.approx(np.nanvar(table[:, 5], ddof=1), rel=1e-9)
    assert sums.mean("v5") == pytest.approx(np.nanmean(table[:, 5]))
    assert math.isnan(sums.variance("v13"))


def test_rows_are_dealt_out_evenly_whatever_the_input(spark, monkeypatch):
    """A table of one partition is fitted by many tasks, and margins go on without reading all trees again."""
    monkeypatch.setattr(L, "TASK_ROWS", 50)
    x, label, weight, ids = labelled_rows(400)
    edges = [np.unique(np.quantile(x[:, c], [0.25, 0.5, 0.75])) for c in range(4)]
    blocks = B.store_binned(frame(spark, x, label, weight, ids).coalesce(1), edges, 400)
    sizes = blocks.map(lambda b: len(b[0]) // 4).collect()
    assert sum(sizes) == 400 and len(sizes) == min(8, L.TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    assert max(sizes) < 100


def test_weighted_boosting_without_test_rows_in_the_sample(spark, sf_dir, monkeypatch):
    """Sample and split go by one hash, so a sample of few rows has no test rows: SQL counts none."""
    whole = M.balanced_sample
    monkeypatch.setattr(M, "balanced_sample", lambda tx, **sizes: whole(tx, fraud_rows=60, normal_rows=600))
    monkeypatch.setitem(R.SETTINGS, "boosted_weighted", R.SETTINGS["boosted_weighted"] | {"maxIter": 5, "maxDepth": 3})
    assert [tuple(r) for r in M.train_boosted_weighted(spark, sf_dir).collect()] == [("boosted_weighted", 0, 0, True, True)]


def test_gradient_trees_lower_the_variance_of_residuals(spark):
    """Every round of the first-order model against a plain version with means and sums of squares."""
    x, label, _, ids = labelled_rows(300, 11)
    x = np.round(x, 1)
    edges = [np.unique(np.quantile(x[:, c], [0.2, 0.4, 0.6, 0.8])) for c in range(4)]
    classifier = B.GradientTreesClassifier(maxIter=4, maxDepth=2, stepSize=0.1)
    booster = B.boost(frame(spark, x, label, np.ones(300), ids).repartition(3), classifier._rounds(), edges)
    bins, sign, score = B.binned(x, edges), 2 * label - 1, np.zeros(300)

    def fit(rows, every, target, level, out):
        best = None
        for c in range(4) if level < 2 else ():
            for cut in range(4):
                left, right = target[rows[bins[rows, c] <= cut]], target[rows[bins[rows, c] > cut]]
                if len(left) and len(right):
                    rest = ((left - left.mean()) ** 2).sum() + ((right - right.mean()) ** 2).sum()
                    if best is None or rest < best[0] - 1e-9:
                        best = (rest, c, cut)
        if best is None:
            out[every] = target[rows].mean()
            return
        for side in (True, False):
            own = rows[(bins[rows, best[1]] <= best[2]) == side]
            fit(own, own, target, level + 1, out)

    for number in range(4):
        target, out = sign if number == 0 else 4 * sign / (1 + np.exp(2 * sign * score)), np.zeros(300)
        fit(np.arange(300), np.arange(300), target, 0, out)
        score = score + (1.0 if number == 0 else 0.1) * out
        assert np.allclose(booster.margins(x, number + 1), 2 * score, atol=1e-6)


def test_models_are_fitted_to_even_partitions(parts, monkeypatch):
    monkeypatch.setattr(L, "TASK_ROWS", 200)
    train, _ = parts
    seen = []
    fit = R.Pipeline.fit
    monkeypatch.setattr(R.Pipeline, "fit", lambda self, rows: seen.append(rows.groupBy(F.spark_partition_id()).count().collect()) or fit(self, rows))
    R.train(train.coalesce(1), "random_forest", numTrees=2, maxDepth=2)
    sizes = [r["count"] for r in seen[0]]
    assert len(sizes) > 4 and max(sizes) < 300
