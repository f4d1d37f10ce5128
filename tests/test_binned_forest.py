"""The forest against plain Python, both ways to grow it, and its smaller forests."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgersift.ml import binned_forest as N
from ledgersift.ml import train as R
from ledgersift.ml.areas import prediction_score
from ledgersift.ml.nested import prefix_scores
from ledgersift.ml.prepare import split
from ledgersift.operators.layout import kept
from ledgersift.sources import views as V

EDGES = [np.linspace(-1.5, 1.5, 7)] * 5


def rows_of(spark, n=500, seed=5):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 5)), 2)
    label = (x[:, 0] * x[:, 1] + x[:, 2] + rng.normal(size=n) > 0.7).astype(float)
    ids = rng.integers(-(2**62), 2**62, n)
    rows = [(v.tolist(), float(a), 1.0, int(i)) for v, a, i in zip(x, label, ids)]
    return x, label, ids, spark.createDataFrame(rows, "x array<double>, label double, weight double, row bigint")


def plan_of(trees, depth, least=1):
    return lambda columns, bins: N.Plan(trees, depth, least, 42, columns, bins)


def plain_scores(x, label, ids, number, plan):
    """Scores of all rows by one tree that tries every cut of every column of a node, row by row."""
    bins = np.array([[sum(v > e for e in own) for v, own in zip(row, EDGES)] for row in x])
    times, out = N.times_drawn(ids, number, plan.seed), np.zeros(len(x))
    gini = lambda rows: sum((times[rows] * (label[rows] == c)).sum() ** 2 for c in (0, 1)) / max(times[rows].sum(), 1)

    def fill(rows, heap, level):
        best = None
        for c in N.tried_columns(np.array([heap], dtype=np.uint64), number, plan)[0] if level < plan.depth else ():
            for cut in range(plan.n_bins - 1):
                left, right = rows[bins[rows, c] <= cut], rows[bins[rows, c] > cut]
                if min(times[left].sum(), times[right].sum()) >= plan.least:
                    gain = gini(left) + gini(right) - gini(rows)
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                        best = (gain, left, right)
        if best is None:
            out[rows] = (times[rows] * label[rows]).sum() / max(times[rows].sum(), 1)
            return
        fill(best[1], 2 * heap, level + 1)
        fill(best[2], 2 * heap + 1, level + 1)

    fill(np.arange(len(x)), 1, 0)
    return out


@pytest.mark.parametrize("local, depth, least", [(0, 5, 1), (10**6, 5, 1), (60, 5, 4), (10**6, 0, 1)])
def test_forest_equals_plain_version(spark, monkeypatch, local, depth, least):
    """Passes alone, subtrees alone and both together; several jobs, bundles and entries."""
    monkeypatch.setattr(N, "LOCAL_ROWS", local)
    monkeypatch.setattr(N, "ROW_BYTES", 0 if local else 20)
    monkeypatch.setattr(N, "JOB_ROWS", 300)
    monkeypatch.setattr(N, "PASS_CELLS", 200)
    monkeypatch.setattr(N, "ENTRY_CELLS", 100)
    monkeypatch.setattr(N, "LOCAL_CELLS", 100)
    x, label, ids, df = rows_of(spark)
    plan = plan_of(4, depth, least)(5, 8)
    forest = N.grow_forest(df.repartition(3), plan_of(4, depth, least), edges=EDGES)
    again = N.Forest.from_text(forest.to_text())
    total = np.zeros(len(x))
    for number in range(4):
        total += plain_scores(x, label, ids, number, plan)
        assert np.allclose(again.scores(x, [number + 1])[:, 0], total, atol=1e-9)


def test_smaller_forests_of_one_fit(spark, monkeypatch):
    """First trees cut at a depth equal separate fits, whatever the partitions and the way to grow."""
    x, _, _, df = rows_of(spark, seed=8)
    large = N.grow_forest(df.repartition(5), plan_of(5, 6), edges=EDGES)
    scores = large.scores(x, [5, 2], [6, 1, 3])
    monkeypatch.setattr(N, "LOCAL_ROWS", 0)
    for place, (depth, trees) in enumerate((d, t) for d in (1, 3, 6) for t in (2, 5)):
        own = N.grow_forest(df.coalesce(1), plan_of(trees, depth), edges=EDGES)
        assert np.array_equal(scores[:, place], own.scores(x, [trees])[:, 0])


def test_forest_without_rows_one_class_or_one_value(spark):
    x, _, _, df = rows_of(spark, 40)
    for rows in (df.limit(0), df.withColumn("label", F.lit(0.0)), df.withColumn("x", F.array(*[F.lit(1.0)] * 5))):
        forest = N.grow_forest(rows, plan_of(3, 4), edges=[np.array([])] * 5 if rows is not df and "x" in rows.columns else EDGES)
        assert all(len(t.column) == 1 for t in forest.trees)
    assert (N.grow_forest(df.withColumn("label", F.lit(1.0)), plan_of(3, 4), edges=EDGES).scores(x, [3]) == 3).all()
    nan = df.withColumn("x", F.array(*[F.when(F.col("label") == 1, F.lit(float("nan"))).otherwise(F.col("x")[i]) for i in range(5)]))
    forest = N.grow_forest(nan, plan_of(3, 2), edges=EDGES)
    assert (forest.scores(np.full((1, 5), np.nan), [3]) > forest.scores(np.full((1, 5), -2.0), [3])).all()


def test_draws_and_columns():
    times = N.times_drawn(np.arange(200_000), 3, 42)
    shares = np.bincount(times, minlength=4)[:4] / len(times)
    assert np.allclose(shares, np.exp(-1) * np.array([1, 1, 0.5, 1 / 6]), atol=5e-3)
    assert (N.times_drawn(np.arange(200_000), 4, 42) != times).mean() > 0.5
    columns = N.tried_columns(np.arange(1, 9001, dtype=np.uint64), 0, N.Plan(1, 5, 1, 42, 9, 8))
    assert columns.shape == (9000, 3) and (np.diff(columns, axis=1) > 0).all()
    assert np.allclose(np.bincount(columns.ravel()) / 9000, 1 / 3, atol=0.03)


def test_one_fit_a_fold_serves_the_grid(spark, sf_dir, monkeypatch):
    """Depths used to be fitted one by one; every point equals its own fit."""
    fits, fit = [], R.fit_dealt
    monkeypatch.setattr(R, "fit_dealt", lambda pipeline, rows: fits.append(pipeline.getStages()[-1]) or fit(pipeline, rows))
    with kept(*split(V.transactions(spark, sf_dir))) as (train, test):
        grid = {"numTrees": (3, 6), "maxDepth": (2, 5)}
        tuned, table = R.tune(train, "random_forest", grid=grid, folds=2)
        assert [f.getNumTrees() for f in fits[:2]] == [6, 6] and len(fits) == 3  # the last: the best point on all rows
        got = {r.parameters: r.auc_roc for r in table.collect()}
        assert list(got) == [f"numTrees={t}, maxDepth={d}" for t in (3, 6) for d in (2, 5)]
        folded = R._with_folds(train, 2)
        own = []
        for fold in range(2):
            rest, held = folded.filter(F.col("fold") != fold), folded.filter(F.col("fold") == fold)
            own.append(R.auc(R.train(rest, "random_forest", numTrees=3, maxDepth=5).model.transform(held)))
        assert got["numTrees=3, maxDepth=5"] == pytest.approx(sum(own) / 2, abs=1e-9)
        with pytest.raises(ValueError):
            prefix_scores(R.train(train, "boosted", maxIter=1, maxDepth=1).model.stages[-1], test, [1], depths=[1])


def test_forest_is_as_good_as_sparks(spark, sf_dir):
    from pyspark.ml.classification import RandomForestClassifier

    settings = {"numTrees": 20, "maxDepth": 6, "seed": 42, "featuresCol": "features", "labelCol": "label"}
    with kept(*split(V.transactions(spark, sf_dir))) as (train, test):
        pipeline = R.full_pipeline(RandomForestClassifier(**settings), train.columns)
        theirs = R.auc(pipeline.fit(train).transform(test))
        scored = R.train(train, "random_forest", numTrees=20, maxDepth=6).model.transform(test)
        assert R.auc(scored) > theirs - 0.02
        assert scored.select(prediction_score(scored)).first()[0] <= 20


@pytest.mark.parametrize("copies", [1, 6])
def test_passes_follow_the_depth_and_rows_move_once(spark, monkeypatch, copies):
    """No more passes with more rows, and a tree's rows are shuffled for its subtrees once at most."""
    monkeypatch.setattr(N, "LOCAL_ROWS", 200)
    levels, moved = [], []
    cut_pass, grow_aside = N._cut_pass, N._grow_aside
    monkeypatch.setattr(N, "_cut_pass", lambda blocks, items, level, plan: levels.append(level) or cut_pass(blocks, items, level, plan))
    monkeypatch.setattr(N, "_grow_aside", lambda blocks, bundles, plan: moved.extend(bundles) or grow_aside(blocks, bundles, plan))
    x, _, _, df = rows_of(spark, 400)
    more = df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).withColumn("row", F.xxhash64("row", "copy")).drop("copy")
    N.grow_forest(more, plan_of(6, 8), edges=EDGES)
    assert levels == sorted(set(levels)) and len(levels) <= 8
    for number in range(6):
        own = [a for n, _, aside in moved if n == number for a in aside]
        assert len({a[0] for a in own}) == len(own) and sum(a[3] for a in own) <= 2 * 400 * copies
    assert moved


def test_rows_of_a_tree_are_drawn_twice_at_most(spark, monkeypatch, tmp_path):
    """For its passes and for its subtrees; they used to be drawn at every level and again for every bundle."""
    log, drawn = str(tmp_path / "draws"), N.times_drawn

    def noted(rows, number, seed):
        with open(log, "a") as file:
            file.write(f"{number} {len(rows)}\n")
        return drawn(rows, number, seed)

    monkeypatch.setattr(N, "times_drawn", noted)
    monkeypatch.setattr(N, "LOCAL_ROWS", 30)
    monkeypatch.setattr(N, "ROW_BYTES", 0)
    monkeypatch.setattr(N, "SENT_ROWS", 100)
    bundles, grow_aside = [], N._grow_aside
    monkeypatch.setattr(N, "_grow_aside", lambda blocks, some, plan: bundles.extend(some) or grow_aside(blocks, some, plan))
    x, label, ids, df = rows_of(spark)
    forest = N.grow_forest(df.repartition(3), plan_of(3, 7), edges=EDGES)
    assert len(bundles) > 9
    with open(log) as file:
        draws = [tuple(map(int, line.split())) for line in file]
    assert all(500 <= sum(n for t, n in draws if t == number) <= 1000 for number in range(3))
    total = sum(plain_scores(x, label, ids, number, plan_of(3, 7)(5, 8)) for number in range(3))
    assert np.allclose(forest.scores(x, [3])[:, 0], total, atol=1e-9)


def test_forest_goes_on_where_files_are_lost(spark, monkeypatch):
    """Without any files, or those of the level before, rows are drawn again: the same trees."""
    monkeypatch.setattr(N, "LOCAL_ROWS", 20)
    monkeypatch.setattr(N, "ROW_BYTES", 0)
    _, _, _, df = rows_of(spark, seed=4)
    plain = N.grow_forest(df, plan_of(3, 6), edges=EDGES).to_text()
    lost, cut_pass, grow_aside = [], N._cut_pass, N._grow_aside

    def lose(blocks, start):
        folder = blocks.folder

        def remove(part):
            import os

            for name in os.listdir(folder(part[0])):
                if name.startswith(start):
                    os.remove(os.path.join(folder(part[0]), name))

        lost.append(start)
        blocks.parts.foreach(remove)

    monkeypatch.setattr(N, "_cut_pass", lambda blocks, items, level, plan: level in (2, 4) and lose(blocks, ("", "live")[level // 4]) or cut_pass(blocks, items, level, plan))
    monkeypatch.setattr(N, "_grow_aside", lambda blocks, some, plan: lose(blocks, "") or grow_aside(blocks, some, plan))
    assert N.grow_forest(df, plan_of(3, 6), edges=EDGES).to_text() == plain
    assert lost[:2] == ["", "live"] and lost[-1] == ""


def test_large_tables_are_counted_at_the_rows_places():
    rng = np.random.default_rng(2)
    bins, slot = rng.integers(0, 8, (60, 5)).astype(np.uint8), rng.integers(0, 40, 60)
    positive, weight = rng.integers(0, 2, 60), rng.integers(1, 4, 60).astype(np.uint8)
    columns = N.tried_columns(np.arange(40, 80, dtype=np.uint64), 1, N.Plan(2, 7, 1, 42, 5, 8))
    for n in (1, 60):  # few rows beside the table, and one row more
        total = np.ones((40, columns.shape[1], 8, 2), dtype=np.int32)
        N.add_counts(total, bins[:n], positive[:n], weight[:n], slot[:n], columns)
        assert np.array_equal(total - 1, N.node_counts(bins[:n], positive[:n], weight[:n], slot[:n], columns, 8))
    few = np.ones((2, columns.shape[1], 8, 2), dtype=np.int32)
    N.add_counts(few, bins, positive, weight, slot % 2, columns[:2])
    assert np.array_equal(few - 1, N.node_counts(bins, positive, weight, slot % 2, columns[:2], 8))
