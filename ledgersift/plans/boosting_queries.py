"""Boosting and areas whose numbers SQL can compute: the first tree, and exact areas by curve."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ledgersift.ml.areas import areas
from ledgersift.ml.boosting import Booster, Rounds, boost
from ledgersift.plans.catalog import query
from ledgersift.plans.sql import with_tables
from ledgersift.sources import views as V

_COLUMNS = ("amount", "oldbalanceOrg", "newbalanceDest")
# Cuts of each column, so that SQL can try the same ones.
_EDGES = ((20_000.0, 50_000.0, 100_000.0, 200_000.0), (0.0, 10_000.0, 100_000.0), (0.0, 50_000.0, 150_000.0))
_FIRST = Rounds(trees=1, depth=2, rate=0.1, l2=1.0, least_hessian=1.0, row_share=1.0, column_share=1.0)


def tree_rows(booster: Booster, number: int, names: tuple[str, ...]) -> list[tuple]:
    """(path, column, edge, gradient, hessian, value) of every node of a tree; leaves have no column."""
    tree, rows, todo = booster.trees[number], [], [(0, "")]
    while todo:
        node, path = todo.pop()
        column = tree.column[node]
        split = (names[column], float(booster.edges[column][tree.cut[node]])) if column >= 0 else (None, None)
        rows.append((path, *split, tree.gradient[node], tree.hessian[node], tree.value[node]))
        if column >= 0:
            todo += [(tree.child[node], path + "L"), (tree.child[node] + 1, path + "R")]
    return rows


_CUTS = ", ".join(f"({c}, '{n}', {k}, {float(e)!r}e0)" for c, n in enumerate(_COLUMNS) for k, e in enumerate(_EDGES[c]))
_VALUE = "CASE c.no " + " ".join(f"WHEN {c} THEN x.{n}" for c, n in enumerate(_COLUMNS)) + " END"


def _best_sql(source: str) -> str:
    """The best cut of each node of ``source`` (node, g, columns): largest gain, then first."""
    return f"""(SELECT * FROM (SELECT *, gl * gl / (hl + 1) + gr * gr / (hr + 1) - (gl + gr) * (gl + gr) / (hl + hr + 1) AS gain
  FROM (SELECT x.node, c.no, c.name, c.k, c.edge,
    coalesce(sum(g) FILTER ({_VALUE} <= c.edge), 0) AS gl, 0.25e0 * count(*) FILTER ({_VALUE} <= c.edge) AS hl,
    coalesce(sum(g) FILTER ({_VALUE} > c.edge), 0) AS gr, 0.25e0 * count(*) FILTER ({_VALUE} > c.edge) AS hr
    FROM {source} x, _cuts c GROUP BY x.node, c.no, c.name, c.k, c.edge))
  WHERE hl >= 1 AND hr >= 1 AND gain > 1e-9 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, no, k) = 1)"""


def _dealt_sql(source: str, best: str) -> str:
    """Rows of ``source`` in the children of their node; those of leaves are left out."""
    return f"""(SELECT x.* REPLACE (x.node || CASE WHEN {_VALUE} <= c.edge THEN 'L' ELSE 'R' END AS node)
  FROM {source} x JOIN {best} c ON c.node = x.node)"""


_FIRST_TREE = f"""_cuts(no, name, k, edge) AS (VALUES {_CUTS}),
_r0 AS (SELECT '' AS node, 0.5e0 - isFraud AS g, {", ".join(_COLUMNS)} FROM transactions),
_b0 AS {_best_sql("_r0")}, _r1 AS {_dealt_sql("_r0", "_b0")},
_b1 AS {_best_sql("_r1")}, _r2 AS {_dealt_sql("_r1", "_b1")},
_nodes AS (SELECT node, sum(g) AS g, 0.25e0 * count(*) AS h
  FROM (SELECT node, g FROM _r0 UNION ALL SELECT node, g FROM _r1 UNION ALL SELECT node, g FROM _r2) GROUP BY node),
_best AS (SELECT * FROM _b0 UNION ALL SELECT * FROM _b1)"""


@query(
    "boosted_first_tree",
    with_tables(
        f""", {_FIRST_TREE} SELECT n.node AS path, b.name AS split_column, b.edge AS split_edge,
  round(n.g, 6) AS gradient, round(n.h, 6) AS hessian, round(-0.1e0 * n.g / (n.h + 1), 9) AS leaf_value
FROM _nodes n LEFT JOIN _best b ON b.node = n.node""",
        "transactions",
    ),
)
def boosted_first_tree(spark, sf_dir):
    """Splits, gradient and hessian sums, and leaf values of the first round over all rows."""
    tx = V.transactions(spark, sf_dir)
    rows = tx.select(
        F.array(*_COLUMNS).alias("x"), F.col("isFraud").cast("double").alias("label"), F.lit(1.0).alias("weight"),
        F.xxhash64("tx_id").alias("row"),
    )
    booster = boost(rows, _FIRST, edges=[np.array(e) for e in _EDGES])
    kind = "path string, split_column string, split_edge double, gradient double, hessian double, leaf_value double"
    found = spark.createDataFrame(tree_rows(booster, 0, _COLUMNS), kind)
    return found.withColumns({"gradient": F.round("gradient", 6), "hessian": F.round("hessian", 6), "leaf_value": F.round("leaf_value", 9)})


@query(
    "exact_areas",
    with_tables(
        """SELECT curve, sum(pos)::BIGINT AS positives, sum(neg)::BIGINT AS negatives,
  CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN round(sum(neg * (tp - pos + pos / 2e0)) / sum(pos) / sum(neg), 9) END AS auc_roc,
  CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN round(sum(pos * (tp / (tp + fp) + CASE WHEN tp + fp > pos + neg
    THEN (tp - pos) / (tp + fp - pos - neg) ELSE tp / (tp + fp) END) / 2) / sum(pos), 9) END AS auc_pr
FROM (SELECT *, sum(pos) OVER w::DOUBLE AS tp, sum(neg) OVER w::DOUBLE AS fp
  FROM (SELECT type AS curve, amount, count(*) FILTER (isFraud = 1) AS pos, count(*) FILTER (isFraud = 0) AS neg
    FROM transactions GROUP BY 1, 2 UNION ALL SELECT 'all', amount, count(*) FILTER (isFraud = 1),
    count(*) FILTER (isFraud = 0) FROM transactions GROUP BY 1, 2)
  WINDOW w AS (PARTITION BY curve ORDER BY amount DESC)) GROUP BY curve""",
        "transactions",
    ),
)
def exact_areas(spark, sf_dir):
    """How well the amount alone orders frauds: both areas by type and over all rows."""
    tx = V.transactions(spark, sf_dir).select("type", "amount", "isFraud")
    curves = tx.select("amount", "isFraud", F.explode(F.array(F.lit("all"), F.col("type"))).alias("curve"))
    found = areas(curves, "amount", "isFraud", "curve")
    return found.withColumns({"auc_roc": F.round("auc_roc", 9), "auc_pr": F.round("auc_pr", 9)})
