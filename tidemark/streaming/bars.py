"""Streams of ticks and bars.

Event time on a stream must be TIMESTAMP, so naive times are cast in the session time zone; keep that at
UTC, where the cast changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import first_value_of, last_value_of
from tidemark.operators.clean import in_market_hours
from tidemark.operators.resample import timeframe_seconds
from tidemark.plans.series import BAR_SERIES, SeriesSpec


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, pattern: str | None = None, files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files of a folder as a stream, in batches of ``files_per_trigger`` files."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def stream_market_gate(df: DataFrame, start: str = "09:15:00", end: str = "15:30:00", ts: str = "ts") -> DataFrame:
    """Only bars inside market hours; no state."""
    return df.filter(in_market_hours(ts, start, end))


def stream_resample(
    df: DataFrame, timeframe: str = "3min", delay: str = "15 minutes", spec: SeriesSpec = BAR_SERIES
) -> DataFrame:
    """Bars of a longer timeframe, each emitted once the watermark has passed its end (append mode).

    Rows up to ``delay`` behind the newest one are still counted in.  Partial aggregation reduces a busy
    instrument before the shuffle; the state holds one row per open bar.
    """
    order = spec.order
    return (
        df.withWatermark(spec.ts, delay)
        .groupBy(*spec.keys, F.window(spec.ts, f"{timeframe_seconds(timeframe)} seconds").alias("w"))
        .agg(
            first_value_of("open", order).alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            last_value_of("close", order).alias("close"),
            F.sum("volume").alias("volume"),
            last_value_of("oi", order).alias("oi"),
        )
        .select(*spec.keys, F.col("w.start").alias(spec.ts), "open", "high", "low", "close", "volume", "oi")
    )
