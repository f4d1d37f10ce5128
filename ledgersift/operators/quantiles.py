"""Exact quantiles without gathering the column in one task."""

from __future__ import annotations

from math import ceil, floor, inf, nan

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of an interval that may come back to the driver as (value, count).
COLLECTED_VALUES = 10_000
# Accuracy of the sketch that brackets a rank: an error of one row in so many.
SKETCH_ACCURACY = 10_000


def _inside(low: float, high: float):
    """The open interval between two values that are themselves settled."""
    return (F.col("v") > low) & (F.col("v") < high)


def order_statistics(
    values: DataFrame,
    ranks: list[int],
    count: int,
    collected: int = COLLECTED_VALUES,
    accuracy: int = SKETCH_ACCURACY,
) -> dict[int, float]:
    """The ``ranks``-th smallest (from 0) of the ``count`` finite values ``v``.

    Each round a quantile sketch brackets every open rank between two values of the
    column, and one aggregate counts what lies below, on and between them. A rank on
    a bracket is settled; otherwise the rows strictly between go on, a few in
    ``accuracy`` of the rows before. So the rounds grow with the logarithm of the
    rows, whatever the values are, and a short rest comes back as (value, count).
    """
    found: dict[int, float] = {}
    pending = dict.fromkeys(ranks, (-inf, inf, 0, count))  # low, high, rows below, rows inside
    while pending:
        short = {r: i for r, i in pending.items() if i[3] <= collected}
        if short:
            for interval in set(short.values()):
                low, high, below, _ = interval
                rows = values.filter(_inside(low, high)).groupBy("v").count().collect()
                for row in sorted(rows, key=lambda r: r["v"]):
                    for rank in [r for r, i in short.items() if i == interval]:
                        if below <= rank < below + row["count"]:
                            found[rank] = row["v"]
                    below += row["count"]
            pending = {r: i for r, i in pending.items() if r not in short}
            continue
        brackets = _brackets(values, pending, accuracy)
        pending = _narrowed(values, pending, brackets, found)
    return found


def _brackets(values: DataFrame, pending: dict, accuracy: int) -> dict[int, tuple[float, float]]:
    """For each rank two values of its interval that should lie around it."""
    margin, wanted = 2.0 / accuracy, []
    for rank, (low, high, below, size) in pending.items():
        at = (rank - below + 0.5) / size
        shares = F.array(*[F.lit(min(1.0, max(0.0, at + d))) for d in (-margin, margin)])
        inside = F.when(_inside(low, high), F.col("v"))
        wanted.append(F.percentile_approx(inside, shares, accuracy).alias(f"r{rank}"))
    row = values.agg(*wanted).first()
    return {rank: tuple(row[f"r{rank}"]) for rank in pending}


def _narrowed(values: DataFrame, pending: dict, brackets: dict, found: dict) -> dict:
    """Settle ranks that lie on a bracket; the smaller interval of each other one."""
    counts = []
    for rank, (low, high, _, _) in pending.items():
        a, b = brackets[rank]
        inside = _inside(low, high)
        for name, test in (
            ("below", F.col("v") < a), ("a", F.col("v") == a), ("between", _inside(a, b)),
            ("b", (F.col("v") == b) & F.lit(a < b)),
        ):
            counts.append(F.count_if(inside & test).alias(f"{name}{rank}"))
    row = values.agg(*counts).first()
    still = {}
    for rank, (low, high, below, size) in pending.items():
        a, b = brackets[rank]
        edges = [(low, a, row[f"below{rank}"]), (a, a, row[f"a{rank}"]), (a, b, row[f"between{rank}"])]
        edges.append((b, b, row[f"b{rank}"]))
        edges.append((b, high, size - sum(n for _, _, n in edges)))
        for first, last, n in edges:
            if rank < below + n:
                if first == last:
                    found[rank] = first
                else:
                    still[rank] = (first, last, below, n)
                break
            below += n
    return still


def exact_quantiles(
    df: DataFrame, column: str, probabilities: list[float], **settings: int
) -> list[float | None]:
    """Linearly interpolated quantiles of a numeric column; nulls are left out.

    Infinities count as the smallest and largest numbers and NaN as larger still; between
    two equal values there is nothing to interpolate, between an infinity and anything
    else the result is what floating point makes of it.
    """
    v = F.col(column).cast("double")
    values = df.select(v.alias("v")).filter(F.col("v").isNotNull())
    is_nan, low, high = F.isnan("v"), F.col("v") == -inf, F.col("v") == inf
    stats = values.agg(
        F.count("v").alias("n"), F.count_if(low).alias("low"), F.count_if(high).alias("high"),
        F.count_if(is_nan).alias("nan"),
    ).first()
    if not stats["n"]:
        return [None] * len(probabilities)
    places = [p * (stats["n"] - 1) for p in probabilities]
    ranks = sorted({r for x in places for r in (floor(x), ceil(x))})
    finite = stats["n"] - stats["low"] - stats["high"] - stats["nan"]
    at: dict[int, float] = {}
    for rank in ranks:
        if rank < stats["low"]:
            at[rank] = -inf
        elif rank >= stats["low"] + finite:
            at[rank] = inf if rank < stats["n"] - stats["nan"] else nan
    inner = [r - stats["low"] for r in ranks if r not in at]
    if inner:
        plain = values.filter(~(is_nan | low | high))
        settled = order_statistics(plain, inner, finite, **settings)
        at |= {r + stats["low"]: value for r, value in settled.items()}
    return [_between(at[floor(x)], at[ceil(x)], x - floor(x)) for x in places]


def _between(low: float, high: float, share: float) -> float:
    return low if low == high or not share else low + (high - low) * share
