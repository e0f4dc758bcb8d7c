import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cardwatch.schema import TRANSACTION_COLUMNS, TRANSACTION_SCHEMA  # noqa: E402
from cardwatch.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make(spark):
    """Transactions from dicts; ``s`` is the time in seconds after the batch start."""

    def build(rows, parts=None):
        full = []
        for i, row in enumerate(rows):
            row = dict(row)
            s = row.pop("s", 0)
            at = None if s is None else START + dt.timedelta(seconds=s)
            base = {
                "transaction_id": i,
                "tx_datetime": at,
                "customer_id": 1,
                "terminal_id": 1,
                "tx_amount": 10.0,
                "tx_time_seconds": None if s is None else int(s),
                "tx_time_days": None if s is None else int(s // 86400),
                "tx_fraud": 0,
                "tx_fraud_scenario": 0,
            }
            base.update(row)
            full.append(tuple(base[c] for c in TRANSACTION_COLUMNS))
        df = spark.createDataFrame(full, TRANSACTION_SCHEMA)
        return df if parts is None else df.repartition(parts)

    return build


def rows_by_id(df, *columns):
    return {
        r["transaction_id"]: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]]
        for r in df.select("transaction_id", *columns).collect()
    }


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
