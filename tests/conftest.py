import datetime as dt
import os
import random
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tidemark.schema import BARS  # noqa: E402

BAR_COLUMNS = "instrument string, ts timestamp_ntz, open double, high double, low double, close double, volume bigint, oi bigint"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def make_bars(spark, rows):
    return spark.createDataFrame(rows, BAR_COLUMNS)


@pytest.fixture(scope="session")
def linear_bars(spark):
    """The fixed linear fixture: 3-minute bars, everything rising."""
    start = dt.datetime(2024, 10, 14, 9, 15)
    return make_bars(
        spark,
        [
            ("X", start + dt.timedelta(minutes=3 * i), 100 + 0.1 * i, 101 + 0.1 * i, 99 + 0.1 * i, 100.5 + 0.1 * i,
             1000 + 10 * i, 500000 + 1000 * i)
            for i in range(100)
        ],
    )


def noisy_rows(name, n, seed, step_choices=(1, 3, 3, 3, 9, 600)):
    rng = random.Random(seed)
    ts, price, oi, rows = dt.datetime(2024, 1, 1, 8, 50), 100.0, 200_000, []
    for _ in range(n):
        ts += dt.timedelta(minutes=rng.choice(step_choices))
        open_ = price
        price = max(1.0, price * (1 + rng.gauss(0, 0.06)))
        oi = max(1000, oi + int(rng.gauss(0, 9000)))
        rows.append((name, ts, round(open_, 2), round(max(open_, price) + 1, 2), round(min(open_, price) - 0.5, 2),
                     round(price, 2), rng.randrange(0, 500), oi))
    return rows


@pytest.fixture(scope="session")
def skewed_bars(spark):
    """One instrument with most rows, some of middle size and one with a single row; shuffled input order."""
    rows = noisy_rows("HOT", 1200, 1)
    for i in range(5):
        rows += noisy_rows(f"M{i}", 150 + 40 * i, 10 + i)
    rows += noisy_rows("ONE", 1, 99)
    random.Random(5).shuffle(rows)
    return make_bars(spark, rows).cache()


__all__ = ["BARS"]
