"""Time-bucket aggregation."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.views import INTRADAY, events_bars, rounded, table, with_events
from tidemark.operators.resample import resample_bars as resample
from tidemark.operators.resample import timeframe_sweep as sweep

# the events themselves as ticks: one price per row, ties told apart by event_id
TICKS = INTRADAY.__class__(ties=("event_id",))

AGGREGATES = """arg_min(open, ts) AS open, max(high) AS high, min(low) AS low, arg_max(close, ts) AS close,
  CAST(sum(volume) AS BIGINT) AS volume, arg_max(oi, ts) AS oi"""


def left(minutes: int) -> str:
    return f"time_bucket(INTERVAL '{minutes} minutes', ts)"


def right(minutes: int) -> str:
    return (f"time_bucket(INTERVAL '{minutes} minutes', ts - INTERVAL '1 microsecond') "
            f"+ INTERVAL '{minutes} minutes'")


@query(
    "resample_bars",
    with_events(f"""SELECT instrument, {left(15)} AS ts, {AGGREGATES}, round(avg(spread), 6) AS spread
FROM (SELECT *, high - low AS spread FROM events_bars) GROUP BY 1, 2"""),
)
def resample_bars(spark, sf_dir):
    bars = events_bars(spark, sf_dir).withColumn("spread", F.col("high") - F.col("low"))
    return rounded(resample(bars, "15T", spec=INTRADAY), "spread")


@query(
    "resample_custom_agg",
    with_events(f"""SELECT instrument, {left(60)} AS ts, arg_min(open, ts) AS open, max(high) AS high, min(low) AS low,
  arg_max(close, ts) AS close, max(volume) AS volume, round(avg(oi), 6) AS oi FROM events_bars GROUP BY 1, 2"""),
)
def resample_custom_agg(spark, sf_dir):
    return rounded(resample(events_bars(spark, sf_dir), "1H", agg={"volume": "max", "oi": "mean"}, spec=INTRADAY), "oi")


@query(
    "resample_right_edge",
    """SELECT event_type AS instrument, time_bucket(INTERVAL '3 minutes', ts - INTERVAL '1 microsecond')
    + INTERVAL '3 minutes' AS ts,
  arg_min(value, {'t': ts, 'e': event_id}) AS open, max(value) AS high, min(value) AS low,
  arg_max(value, {'t': ts, 'e': event_id}) AS close FROM events GROUP BY 1, 2""",
)
def resample_right_edge(spark, sf_dir):
    ticks = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("instrument"), "ts", "event_id", *[F.col("value").alias(c) for c in
                                                                    ("open", "high", "low", "close")]
    )
    return resample(ticks, "3min", agg={"event_id": "min"}, edge="right", spec=TICKS).drop("event_id")


@query(
    "timeframe_sweep",
    with_events("\nUNION ALL\n".join(
        f"SELECT {m} AS timeframe, instrument, {right(m)} AS ts, {AGGREGATES} FROM events_bars GROUP BY 1, 2, 3"
        for m in (3, 6, 15, 60)
    )),
)
def timeframe_sweep(spark, sf_dir):
    return sweep(events_bars(spark, sf_dir), (3, 6, 15, 60), spec=INTRADAY)
