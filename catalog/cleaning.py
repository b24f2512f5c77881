"""Cleaning and row filters, on bars with deterministic damage."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.views import INTRADAY, events_bars, rounded, with_events
from tidemark.operators import clean as C
from tidemark.operators.indicators import oi_change

DIRTY = """, dirty AS (
  SELECT instrument, ts, open, CASE WHEN volume % 13 = 5 THEN low - 1 ELSE high END AS high, low,
    CASE WHEN volume % 11 = 3 THEN NULL ELSE close END AS close,
    CASE WHEN volume % 7 = 0 THEN -volume WHEN volume % 19 = 4 THEN NULL ELSE volume END AS volume,
    CASE WHEN volume % 17 = 2 THEN -oi ELSE oi END AS oi FROM events_bars)"""

MISSING = "(open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL)"
INVALID = "(high < low OR high < open OR high < close OR low > open OR low > close)"
CLAMPED = """instrument, ts, open, high, low, close, CASE WHEN volume < 0 THEN 0 ELSE volume END AS volume,
  CASE WHEN oi < 0 THEN 0 ELSE oi END AS oi"""


def with_dirty(sql: str) -> str:
    return with_events(f"{DIRTY}\n{sql}")


def dirty_bars(spark, sf_dir):
    v = F.col("volume")
    return events_bars(spark, sf_dir).withColumns(
        {
            "high": F.when(v % 13 == 5, F.col("low") - 1).otherwise(F.col("high")),
            "close": F.when(v % 11 == 3, F.lit(None)).otherwise(F.col("close")),
            "oi": F.when(v % 17 == 2, -F.col("oi")).otherwise(F.col("oi")),
            "volume": F.when(v % 7 == 0, -v).when(v % 19 == 4, F.lit(None)).otherwise(v),
        }
    )


@query("drop_missing_ohlc", with_dirty(f"SELECT * FROM dirty WHERE NOT {MISSING}"))
def drop_missing_ohlc(spark, sf_dir):
    return C.drop_missing_ohlc(dirty_bars(spark, sf_dir))


@query("drop_invalid_ohlc", with_dirty(f"SELECT * FROM dirty WHERE NOT {MISSING} AND NOT {INVALID}"))
def drop_invalid_ohlc(spark, sf_dir):
    return C.drop_invalid_ohlc(C.drop_missing_ohlc(dirty_bars(spark, sf_dir)))


@query("clamp_negative", with_dirty(f"SELECT {CLAMPED} FROM dirty"))
def clamp_negative(spark, sf_dir):
    return C.clamp_negative(dirty_bars(spark, sf_dir))


@query("sort_bars", with_events("SELECT * FROM events_bars ORDER BY instrument, ts"))
def sort_bars(spark, sf_dir):
    return C.sort_bars(events_bars(spark, sf_dir), INTRADAY)


@query("clean_bars", with_dirty(f"SELECT {CLAMPED} FROM dirty WHERE NOT {MISSING} AND NOT {INVALID}"))
def clean_bars(spark, sf_dir):
    return C.clean_bars(dirty_bars(spark, sf_dir))


@query(
    "bar_quality_report",
    with_dirty(f"""SELECT instrument, count(*) AS rows_in, count(*) FILTER ({MISSING}) AS dropped_missing,
  count(*) FILTER (NOT {MISSING} AND {INVALID}) AS dropped_invalid,
  count(*) FILTER (NOT {MISSING} AND NOT {INVALID} AND volume < 0) AS negative_volume,
  count(*) FILTER (NOT {MISSING} AND NOT {INVALID} AND oi < 0) AS negative_oi,
  count(*) FILTER (NOT {MISSING} AND NOT {INVALID}) AS rows_out FROM dirty GROUP BY 1"""),
)
def bar_quality_report(spark, sf_dir):
    return C.bar_quality_report(dirty_bars(spark, sf_dir), INTRADAY)


@query(
    "market_hours_filter",
    with_events("""SELECT * FROM events_bars
WHERE isodow(ts) <= 5 AND CAST(ts AS TIME) BETWEEN TIME '09:15:00' AND TIME '15:30:00'"""),
)
def market_hours_filter(spark, sf_dir):
    return C.market_hours_filter(events_bars(spark, sf_dir))


@query(
    "sample_hours_filter",
    with_events("""SELECT * FROM events_bars
WHERE hour(ts) >= 9 AND (hour(ts) < 15 OR (hour(ts) = 15 AND minute(ts) <= 30))"""),
)
def sample_hours_filter(spark, sf_dir):
    return C.sample_hours_filter(events_bars(spark, sf_dir))


@query(
    "large_oi_change",
    with_events(""", c AS (SELECT instrument, ts, oi, oi / lag(oi) OVER w::DOUBLE - 1 AS oi_pct_change FROM events_bars
  WINDOW w AS (PARTITION BY instrument ORDER BY ts))
SELECT instrument, ts, oi, round(oi_pct_change, 6) AS oi_pct_change FROM c WHERE abs(oi_pct_change) > 0.05"""),
)
def large_oi_change(spark, sf_dir):
    changed = oi_change(events_bars(spark, sf_dir), spec=INTRADAY)
    return rounded(C.large_oi_change(changed).select("instrument", "ts", "oi", "oi_pct_change"), "oi_pct_change")


@query("oi_line", with_events("SELECT instrument, ts, oi FROM events_bars"))
def oi_line(spark, sf_dir):
    return C.oi_line(events_bars(spark, sf_dir), INTRADAY)
