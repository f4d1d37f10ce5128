"""Every query with check SQL must give the same rows as DuckDB."""

import pytest
from compare import difference, duck

from ledgersift.plans.queries import CHECKS, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


# Minutes each at the documented settings; tests/test_jobs.py fits these models smaller.
LONG = {
    "train_gbt", "train_boosted", "train_gbt_advanced", "train_rf_advanced", "compare_models", "best_model",
    "train_ensemble", "tune_model",
}


@pytest.mark.parametrize("name", sorted(set(CHECKS) - LONG))
def test_matches_sql(spark, con, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    problem = difference(got, con.execute(CHECKS[name]).df())
    assert problem is None or problem.startswith("TYPES"), problem


def test_entry_points():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.oracle_sql()) >= 90


def test_entry_flagship(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 1500
