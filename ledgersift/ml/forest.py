"""Isolation forest: small random trees fitted per group, scored in Arrow batches.

Each tree sees ``sample_rows`` rows, so fitting needs one short group per tree
and the fitted forest is a few hundred kilobytes whatever the table size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgersift.operators.sampling import exact_sample, row_hash

FOREST_COLUMNS = (
    "amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest",
)

_TREE_SCHEMA = (
    "tree int, rows int, feature array<int>, threshold array<double>, child array<int>, depth array<double>"
)


def expected_depth(n):
    """Mean path length of an unsuccessful search among ``n`` points."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3.0)
    long = 2.0 * (np.log(safe - 1.0) + np.euler_gamma) - 2.0 * (safe - 1.0) / safe
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


def grow_tree(points: np.ndarray, rng: np.random.Generator, max_depth: int) -> dict:
    """Random splits until points are alone or the depth limit is reached.

    Node ``i`` sends values below its threshold to ``child[i]`` and others to the
    node after it; leaves have feature -1 and carry their path length.
    """
    nodes = {"feature": [-1], "threshold": [0.0], "child": [0], "depth": [0.0]}
    todo = [(0, points, 0)]
    while todo:
        node, rows, level = todo.pop()
        low, high = rows.min(axis=0), rows.max(axis=0)
        open_features = np.flatnonzero(high > low)
        if level >= max_depth or len(rows) < 2 or not len(open_features):
            nodes["depth"][node] = level + float(expected_depth(len(rows)))
            continue
        feature = int(rng.choice(open_features))
        cut = float(rng.uniform(low[feature], high[feature]))
        if cut <= low[feature]:
            cut = float(high[feature])
        left = rows[:, feature] < cut
        first = len(nodes["feature"])
        nodes["feature"][node], nodes["threshold"][node] = feature, cut
        nodes["child"][node] = first
        for part in (rows[left], rows[~left]):
            todo.append((len(nodes["feature"]), part, level + 1))
            for key, empty in (("feature", -1), ("threshold", 0.0), ("child", 0), ("depth", 0.0)):
                nodes[key].append(empty)
    return nodes


@dataclass
class IsolationForest:
    columns: tuple[str, ...]
    sample_rows: float
    trees: list[tuple[np.ndarray, ...]]

    def path_lengths(self, points: np.ndarray) -> np.ndarray:
        total = np.zeros(len(points))
        every = np.arange(len(points))
        for feature, threshold, child, depth in self.trees:
            at = np.zeros(len(points), dtype=int)
            while True:
                inner = feature[at] >= 0
                if not inner.any():
                    break
                go = every[inner]
                node = at[go]
                right = points[go, feature[node]] >= threshold[node]
                at[go] = child[node] + right
            total += depth[at]
        return total / len(self.trees)

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``anomaly_score`` in (0, 1]; higher is stranger. Nulls count as 0."""
        columns = list(self.columns)
        scale = float(expected_depth(self.sample_rows))
        shared = df.sparkSession.sparkContext.broadcast(self)
        schema = T.StructType([*df.schema.fields, T.StructField("anomaly_score", T.DoubleType())])

        def add_score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            forest = shared.value
            for batch in batches:
                points = batch[columns].fillna(0.0).to_numpy(dtype=float)
                yield batch.assign(anomaly_score=2.0 ** (-forest.path_lengths(points) / scale))

        return df.mapInPandas(add_score, schema)


def fit_isolation_forest(
    df: DataFrame,
    columns: tuple[str, ...] = FOREST_COLUMNS,
    trees: int = 100,
    sample_rows: int = 256,
    seed: int = 42,
    id_col: str = "tx_id",
) -> IsolationForest:
    """Fit ``trees`` trees, each on its own part of one sample drawn by id hash."""
    wanted = df.select(id_col, *[F.coalesce(c, F.lit(0.0)).alias(c) for c in columns])
    sample = exact_sample(wanted, trees * sample_rows, id_col, seed)
    # The sample is short (trees * sample_rows), so dealing it out in order is cheap.
    dealing = Window.orderBy(row_hash(id_col, seed + 1), id_col)
    dealt = sample.withColumn("tree", F.row_number().over(dealing) % trees)
    max_depth = int(np.ceil(np.log2(max(sample_rows, 2))))
    names = list(columns)

    def fit(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        # Order decides what a seeded generator picks, so fix it by id.
        points = group.sort_values(id_col)[names].to_numpy(dtype=float)
        tree = grow_tree(points, np.random.default_rng([seed, int(key[0])]), max_depth)
        nodes = {name: [values] for name, values in tree.items()}
        return pd.DataFrame({"tree": [key[0]], "rows": [len(group)], **nodes})

    fitted = dealt.groupBy("tree").applyInPandas(fit, _TREE_SCHEMA)
    rows = sorted(fitted.collect(), key=lambda r: r.tree)
    arrays = [
        (np.array(r.feature), np.array(r.threshold), np.array(r.child), np.array(r.depth))
        for r in rows
    ]
    mean_rows = sum(r.rows for r in rows) / len(rows)
    return IsolationForest(tuple(columns), mean_rows, arrays)


def find_anomalies(
    df: DataFrame, contamination: float = 0.01, **settings
) -> tuple[DataFrame, IsolationForest]:
    """Score every row and mark about ``contamination`` of them as anomalies.

    The cut comes from a first pass over the forest's columns alone; scoring again
    for the result is cheaper than keeping a scored copy of the whole table.
    """
    forest = fit_isolation_forest(df, **settings)
    scores = forest.score(df.select(*forest.columns))
    cut = scores.approxQuantile("anomaly_score", [1.0 - contamination], 0.0001)[0]
    scored = forest.score(df)
    return scored.withColumn("is_anomaly", F.col("anomaly_score") > cut), forest
