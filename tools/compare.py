"""Run queries against their check SQL in DuckDB and report differences.

usage: python tools/compare.py SF_DIR [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def duck(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]

    def text(v):
        if v is None or (isinstance(v, float) and v != v) or v is pd.NaT or v is pd.NA:
            return "<null>"
        if hasattr(v, "item"):
            v = v.item()
        if isinstance(v, int) and not isinstance(v, bool):
            v = float(v)  # nullable integer columns arrive as floats from one side
        if isinstance(v, float):
            return repr(v + 0.0)
        return str(v)

    return sorted(tuple(text(v) for v in row) for row in df.itertuples(index=False, name=None))


def difference(left: pd.DataFrame, right: pd.DataFrame) -> str | None:
    """None when both frames hold the same rows and column names."""
    if sorted(left.columns) != sorted(right.columns):
        return f"columns {sorted(left.columns)} / {sorted(right.columns)}"
    if len(left) != len(right):
        return f"rows {len(left)} / {len(right)}"
    a, b = canonical(left), canonical(right)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows, e.g. {bad[0]}"
    kinds = {
        c: (str(left[c].dtype), str(right[c].dtype))
        for c in left.columns
        if str(left[c].dtype) != str(right[c].dtype)
    }
    return f"TYPES {kinds}" if kinds else None


def main(argv: list[str]) -> int:
    from ledgersift.plans.queries import CHECKS, QUERIES
    from ledgersift.session import get_session

    sf_dir, names = argv[0], argv[1:] or list(QUERIES)
    spark = get_session(
        "compare", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__master="local[8]", spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failures = 0
    for name in names:
        started = time.monotonic()
        try:
            got = QUERIES[name](spark, sf_dir).toPandas()
            took = time.monotonic() - started
            if name in CHECKS:
                verdict = difference(got, con.execute(CHECKS[name]).df()) or "ok"
            else:
                verdict = f"ok (rows only: {len(got)})"
        except Exception as error:  # noqa: BLE001  (report and go on)
            took, verdict = time.monotonic() - started, f"ERROR {str(error)[:600]}"
        failures += not verdict.startswith(("ok", "TYPES"))
        print(f"{name:28} {took:6.2f}s {verdict}", flush=True)
    print(f"{failures} failures of {len(names)}")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
