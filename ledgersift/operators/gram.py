"""Pairwise sums of many columns in one scan, as matrices.

Each Arrow batch is a matrix X of values (missing ones as 0) and a matrix M of presence. The
products X'X, M'M, X'M and (X*X)'M hold, for every pair of columns, the sums over the rows
where both are present. They are added up by task, then in groups, so the driver gets a few
tables of columns x columns, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import isfinite, sqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

import ledgersift.operators as package

# Functions sent to executors travel by value, so executors need no copy of the library.
cloudpickle.register_pickle_by_value(package)

#: Groups in which the tasks' matrices are added up before the driver adds the rest.
GROUPS = 32
#: Rows that tell about where the values of a column lie.
CENTRE_ROWS = 1000


@dataclass
class PairSums:
    """Sums over the rows where both columns of a pair are present, of values less ``centre``.

    ``total[a, b]`` is the sum of a over the rows that have b too, ``square`` that of its square;
    ``endless[a, b]`` counts the infinite values of a in these rows.
    """

    columns: list[str]
    centre: np.ndarray
    rows: np.ndarray
    total: np.ndarray
    square: np.ndarray
    product: np.ndarray
    endless: np.ndarray

    def mean(self, column: str) -> float:
        """0 where there is no value; infinite or NaN values were left out of the sums."""
        i = self.columns.index(column)
        return float(self.centre[i] + self.total[i, i] / self.rows[i, i]) if self.rows[i, i] else 0.0

    def variance(self, column: str) -> float:
        """Sample variance; 0 for fewer than two values, NaN with infinite ones."""
        i = self.columns.index(column)
        n = self.rows[i, i]
        if self.endless[i, i]:
            return float("nan")
        if n < 2:
            return 0.0
        return float(max(self.square[i, i] - self.total[i, i] ** 2 / n, 0.0) / (n - 1))

    def correlation(self, first: str, second: str) -> float | None:
        """Pearson's; None for columns that are constant, or infinite, on the shared rows."""
        a, b = self.columns.index(first), self.columns.index(second)
        n = self.rows[a, b]
        if not n or self.endless[a, b] or self.endless[b, a]:
            return None
        wide = self.square[a, b] - self.total[a, b] ** 2 / n
        high = self.square[b, a] - self.total[b, a] ** 2 / n
        # what is left of a constant column is rounding
        if not (wide > 1e-12 * self.square[a, b] and high > 1e-12 * self.square[b, a]):
            return None
        r = (self.product[a, b] - self.total[a, b] * self.total[b, a] / n) / sqrt(wide * high)
        return max(-1.0, min(1.0, float(r))) if isfinite(r) else None


def _number(column: str) -> Column:
    """The column as double; NaN counts as missing."""
    value = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(value), value)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """Values of a batch, NaN where missing."""
    columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)]
    return np.stack(columns, axis=1).astype(np.float64)


def pair_sums(df: DataFrame, columns: list[str]) -> PairSums:
    """The sums of all pairs of ``columns``: one scan, after a glance at some rows."""
    n = len(columns)
    values = df.select(*[_number(c).alias(f"c{i}") for i, c in enumerate(columns)])
    # any value near the data serves as centre: it keeps digits, and drops out of the results
    finite = lambda c: F.when(F.abs(c) < float("inf"), F.col(c))
    glance = values.limit(CENTRE_ROWS).agg(*[F.avg(finite(c)).alias(c) for c in values.columns]).first()
    centre = np.array([v or 0.0 for v in glance])

    def summed(x: np.ndarray) -> np.ndarray:
        present = ~np.isnan(x)
        endless = np.isinf(x)
        x = np.where(present & ~endless, x - centre, 0.0)
        m = present.astype(np.float64)
        return np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x, endless.T.astype(np.float64) @ m])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((5, n, n))
        for batch in batches:
            total += summed(_matrix(batch))
        part = pa.array([TaskContext.get().partitionId()], type=pa.int32())
        yield pa.RecordBatch.from_arrays([part, pa.array([total.tobytes()], type=pa.binary())], names=["part", "sums"])

    def add(key: tuple, group: pa.Table) -> pa.Table:
        rows = sorted(zip(group.column("part").to_pylist(), group.column("sums").to_pylist()))
        total = sum(np.frombuffer(s) for _, s in rows)
        return pa.table({"part": pa.array([rows[0][0]], type=pa.int32()), "sums": pa.array([total.tobytes()], type=pa.binary())})

    partial = values.mapInArrow(run, "part int, sums binary").withColumn("dealt", F.col("part") % GROUPS)
    added = partial.groupBy("dealt").applyInArrow(add, "part int, sums binary")
    found = sorted((r["part"], bytes(r["sums"])) for r in added.collect())  # GROUPS at most
    total = sum((np.frombuffer(s).reshape(5, n, n) for _, s in found), np.zeros((5, n, n)))
    return PairSums(list(columns), centre, *total)
