"""Sweeps: what rules share, how bars reach Python, and accounts from trades without the fields they do not read."""

import datetime as dt

import pyarrow as pa
from pyspark.sql import functions as F

from catalog import load

load()

from catalog.views import DAILY, lineitem_series  # noqa: E402
from helpers import TINY, WHOLE, assert_same  # noqa: E402
from tidemark.operators import analytics as A  # noqa: E402
from tidemark.operators import carried, swept, trades  # noqa: E402
from tidemark.operators import sweeps as W  # noqa: E402


def test_equal_tests_are_made_once(spark):
    rules = list(W.param_grid().values())
    bits = carried.decision_bits(rules, [trades._decisions(r) for r in rules])
    assert {n: str(c).count("CASE WHEN") for n, c in bits.items()} == {"__entry_0": 9, "__first_0": 9, "__second_0": 3, "__decides_0": 3}


def test_arrow_batches_are_put_together():
    n = 1000
    ts = [dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i) for i in range(n)]
    table = pa.table({
        "instrument": ["x"] * n, "__ts": pa.array(ts, pa.timestamp("us")), "__fill_ts": pa.array([*ts[1:], None], pa.timestamp("us")),
        "__fill": [1.0] * n, "close": [1.0] * n, "__opens": [True] + [False] * (n - 1),
        "__entry_0": [i % 4 == 0 for i in range(n)], "__first_0": [i % 4 == 2 for i in range(n)], "__second_0": [0] * n, "__decides_0": [1] * (n - 1) + [0]})
    table = table.set_column(6, "__entry_0", table["__entry_0"].cast("int64")).set_column(7, "__first_0", table["__first_0"].cast("int64"))
    T = swept.T
    out = T.StructType([T.StructField("param", T.IntegerType()), T.StructField("instrument", T.StringType()), T.StructField("trade_no", T.LongType()),
                        *swept.TRADE_FIELDS])
    found = list(swept._follower(("instrument",), 1, None, None, out)(iter(table.to_batches(max_chunksize=10))))
    assert len(found) == 1 and found[0].num_rows == 250


def test_accounts_read_brief_trades(skewed_bars):
    rules = W.param_grid(ma_period=(5, 30), entry=(0.002, 0.004))
    for spec in (WHOLE, TINY):
        ledger = W.sweep_trades(skewed_bars, rules, spec=spec)
        last = A.last_closes(skewed_bars, spec).select(F.explode(F.array(*[F.lit(n) for n in rules])).alias(W.PARAM), "*")
        want = A.accounts(ledger, last, 100_000.0, (W.PARAM, "instrument")).groupBy(W.PARAM).agg(
            F.sum("final_value").alias("final_value"), F.sum("total_trades").alias("total_trades"))
        got = W.sweep_results(skewed_bars, rules, spec=spec)
        assert_same(got.select(W.PARAM, "final_value", "total_trades"), want)


def test_lines_bound_the_daily_series(spark, tmp_path):
    def lines(suppliers):
        spark.createDataFrame([(s,) for s in suppliers], "l_suppkey bigint").write.parquet(f"{tmp_path}/{len(suppliers)}/lineitem.parquet")
        return lineitem_series(spark, f"{tmp_path}/{len(suppliers)}")

    found = lines([1, 1, 2, None])
    assert (found.max_rows, found.rows) == (2, 4)
    assert lines([]).max_rows == 0
    spark.range(DAILY.slice_rows + 1).selectExpr("1L AS l_suppkey").write.parquet(f"{tmp_path}/long/lineitem.parquet")
    assert lineitem_series(spark, f"{tmp_path}/long") == DAILY
