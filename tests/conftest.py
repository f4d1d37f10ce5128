import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

from ledgersift.schema import TX_SCHEMA  # noqa: E402
from ledgersift.session import get_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests",
        spark__master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="run-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


# Five transactions whose features and scores are worked out by hand in the tests.
FIVE = [
    (1, 7, "PAYMENT", 80.0, "C11", 640.0, 560.0, "M5", 0.0, 0.0, 0, 0),
    (2, 7, "TRANSFER", 320000.0, "C12", 800000.0, 480000.0, "C13", 0.0, 320000.0, 1, 0),
    (3, 8, "CASH_IN", 2500.0, "C14", 10000.0, 12500.0, "C15", 9000.0, 6500.0, 0, 0),
    (4, 8, "CASH_OUT", 42000.0, "C16", 60000.0, 18000.0, "C17", 500.0, 42500.0, 0, 0),
    (5, 9, "DEBIT", 35.5, "C18", 70.0, 34.5, "C19", 12.0, 47.5, 0, 0),
]


@pytest.fixture(scope="session")
def five(spark):
    return spark.createDataFrame(FIVE, TX_SCHEMA)


@pytest.fixture(scope="session")
def make_tx(spark):
    """Build transactions from dicts; what is not given gets a plain default."""
    base = dict(
        step=1, type="PAYMENT", amount=10.0, nameOrig="C1", oldbalanceOrg=100.0,
        newbalanceOrig=90.0, nameDest="M1", oldbalanceDest=0.0, newbalanceDest=0.0, isFraud=0,
        isFlaggedFraud=0,
    )

    def make(rows):
        full = [base | {"tx_id": i} | row for i, row in enumerate(rows)]
        return spark.createDataFrame([tuple(r[f] for f in TX_SCHEMA.names) for r in full], TX_SCHEMA)

    return make


def rows_by(df, key="tx_id"):
    return {r[key]: r for r in df.collect()}
