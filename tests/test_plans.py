"""Quantiles, joins with frequent keys, and the shape of physical plans."""

import random

import pytest
from helpers import WHOLE, assert_same
from pyspark.sql import functions as F

from tidemark.operators import indicators as I
from tidemark.operators import resample as R
from tidemark.operators import signals as G
from tidemark.operators import trades as T
from tidemark.plans import quantile as quantile_module
from tidemark.plans.quantile import exact_quantile


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("accuracy", [100_000, 100])
def test_quantile_equals_percentile(spark, monkeypatch, accuracy):
    monkeypatch.setattr(quantile_module, "ACCURACY", accuracy)
    rng = random.Random(3)
    rows = [("big", rng.gauss(0, 1)) for _ in range(5000)] + [("ties", float(rng.randrange(4))) for _ in range(700)]
    rows += [("two", 1.0), ("two", 2.0), ("one", 5.0), ("none", None)]
    rows += [(f"n{n}", float(i)) for n in range(1, 30) for i in range(n)]
    d = spark.createDataFrame(rows, "k string, v double").repartition(5)
    for q in (0.0, 0.1, 0.5, 0.7, 0.99, 1.0):
        want = d.groupBy("k").agg(F.percentile("v", q).alias("p")).filter("p is not null")
        assert_same(exact_quantile(d, "v", q, ("k",), "p"), want)


def test_quantile_without_broadcast(spark):
    d = spark.range(3000).select((F.col("id") % 5).alias("k"), "id", (F.col("id") % 11).cast("double").alias("v"))
    want = d.groupBy("k").agg(F.percentile("v", 0.7).alias("p"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert_same(exact_quantile(d, "v", 0.7, ("k",), "p"), want)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_latest_bar_sorts_no_input_rows(stored):
    """The newest time is a hash aggregate; a sort-based one sees only the rows of that time."""
    plan = plan_of(G.latest_bar(stored, spec=WHOLE))
    assert "HashAggregate" in plan and plan.index("SortAggregate") < plan.index("Join")


@pytest.fixture(scope="module")
def stored(spark, skewed_bars, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "bars")
    skewed_bars.write.parquet(path)
    return spark.read.parquet(path)


def test_columns_are_pruned_and_keys_pushed_down(stored):
    spec = WHOLE.measured(stored)
    plan = plan_of(I.oi_baseline_ma(stored, spec=spec).filter("instrument = 'M1'").select("instrument", "ts", "oi_ma"))
    assert "ReadSchema: struct<instrument:string,ts:timestamp_ntz,oi:bigint>" in plan
    assert "EqualTo(instrument,M1)" in plan


def test_positions_take_one_shuffle_and_one_sort(stored):
    plan = plan_of(G.rule_positions(stored, spec=WHOLE.measured(stored)))
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1
    assert "Python" not in plan and "Pandas" not in plan


def test_ledger_shuffles_bars_once(stored):
    plan = plan_of(T.all_trades(stored, spec=WHOLE.measured(stored)))
    below_python = plan[plan.index("MapInArrow"):]
    assert below_python.count("Exchange") == 1
    assert plan.count("Exchange") == 2  # the second one numbers the trades


def test_resample_is_combined_before_the_shuffle(stored):
    plan = plan_of(R.resample_bars(stored, "15min"))
    assert plan.count("Exchange") == 1 and "partial_sum" in plan and "SortAggregate" not in plan
