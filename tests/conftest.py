import datetime as dt
import os
import sys
import time

os.environ["TZ"] = "UTC"
time.tzset()
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import pytest  # noqa: E402

from spendwatch.session import build_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "6g",
        "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


@pytest.fixture(scope="session")
def make_payments(spark):
    """(user, amount, time[, partition]) tuples in arrival order -> payments with ids p0, p1, ..."""
    def make(*rows, ids=None):
        table = []
        for i, (user, amount, at, *rest) in enumerate(rows):
            table.append((ids[i] if ids else f"p{i}", user, amount, ts(at), rest[0] if rest else 0, i))
        df = spark.createDataFrame(
            table, "payment_id string, user_id string, amount string, record_ts timestamp, partition int, offset long")
        return df.withColumn("amount", df.amount.cast("decimal(18,2)"))
    return make
