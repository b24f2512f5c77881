"""Bar tables derived from the given tables, in Spark and in SQL.

``events_bars``: 3-minute intraday bars per event type.  ``lineitem_bars``: daily bars per supplier.
Both have one row per (instrument, ts).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.series import SeriesSpec

INTRADAY = SeriesSpec()
DAILY = SeriesSpec()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("event_id")  # events are numbered in time order
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("instrument"), F.window("ts", "3 minutes").alias("w"))
        .agg(
            F.min_by("value", at).alias("open"),
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            F.max_by("value", at).alias("close"),
            F.sum(F.get_json_object("props", "$.k").cast("bigint")).alias("volume"),
            (F.floor(F.max_by("value", at) * 1000) + 100000).alias("oi"),
        )
        .select("instrument", F.col("w.start").alias("ts"), "open", "high", "low", "close", "volume", "oi")
    )


def lineitem_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    # (order, line, part) as one number: fixed-width buffers keep the aggregate hash-based
    line = (F.col("l_orderkey") * 100 + F.col("l_linenumber")).cast("decimal(19,0)")
    at = line * F.lit(10**13).cast("decimal(14,0)") + F.col("l_partkey").cast("decimal(19,0)")
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("instrument"), F.col("l_shipdate").alias("ts"))
        .agg(
            F.min_by(price, at).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, at).alias("close"),
            F.sum("l_quantity").cast("bigint").alias("volume"),
            (F.floor(F.max_by("l_extendedprice", at)) + 100000).alias("oi"),
        )
    )


def lineitem_series(spark: SparkSession, sf_dir: str) -> SeriesSpec:
    """``DAILY`` with its bounds, if those of the lines will do: a bar is made of a line at least, and lines are counted without making bars."""
    lines = DAILY.measured(table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("instrument")))
    return lines if lines.whole() else DAILY


EVENTS_BARS = """events_bars AS MATERIALIZED (
  SELECT event_type AS instrument, time_bucket(INTERVAL '3 minutes', ts) AS ts,
    arg_min(value, event_id) AS open, max(value) AS high, min(value) AS low,
    arg_max(value, event_id) AS close,
    CAST(sum(CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT)) AS BIGINT) AS volume,
    CAST(floor(arg_max(value, event_id) * 1000) AS BIGINT) + 100000 AS oi
  FROM events GROUP BY 1, 2)"""

LINEITEM_BARS = """lineitem_bars AS MATERIALIZED (
  SELECT l_suppkey AS instrument, l_shipdate AS ts,
    arg_min(l_extendedprice / l_quantity, {'o': l_orderkey, 'l': l_linenumber, 'p': l_partkey}) AS open,
    max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low,
    arg_max(l_extendedprice / l_quantity, {'o': l_orderkey, 'l': l_linenumber, 'p': l_partkey}) AS close,
    CAST(sum(l_quantity) AS BIGINT) AS volume,
    CAST(floor(arg_max(l_extendedprice, {'o': l_orderkey, 'l': l_linenumber, 'p': l_partkey})) AS BIGINT) + 100000
      AS oi
  FROM lineitem GROUP BY 1, 2)"""


def with_events(sql: str) -> str:
    return f"WITH {EVENTS_BARS}\n{sql}"


def with_lineitem(sql: str) -> str:
    return f"WITH {LINEITEM_BARS}\n{sql}"


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """Floats whose summation order may differ between engines."""
    return df.withColumns({n: F.round(F.col(n), digits) for n in names})
