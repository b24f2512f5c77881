"""Cleaning and row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import as_col, micros_of_day
from tidemark.plans.series import BAR_SERIES, SeriesSpec
from tidemark.schema import PRICE_COLUMNS


def ohlc_missing() -> Column:
    return F.col("open").isNull() | F.col("high").isNull() | F.col("low").isNull() | F.col("close").isNull()


def ohlc_invalid() -> Column:
    """High below or low above another price of the bar; equal prices are valid."""
    lowest_of_rest = F.least("open", "close", "high")
    highest_of_rest = F.greatest("open", "close", "low")
    return (F.col("high") < highest_of_rest) | (F.col("low") > lowest_of_rest)


def drop_missing_ohlc(df: DataFrame) -> DataFrame:
    return df.na.drop(subset=list(PRICE_COLUMNS))


def drop_invalid_ohlc(df: DataFrame) -> DataFrame:
    return df.filter(~ohlc_invalid())


def clamp_negative(df: DataFrame, cols: tuple[str, ...] = ("volume", "oi")) -> DataFrame:
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: F.when(F.col(c) < 0, F.lit(0)).otherwise(F.col(c)) for c in present})


def sort_bars(df: DataFrame, spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    """Global output order by series and time; duplicates stay."""
    return df.orderBy(*spec.keys, *spec.order)


def clean_bars(df: DataFrame) -> DataFrame:
    """Drop bars with missing or contradictory prices and clamp negative volume and open interest.

    Row order is left to the windows that need it; use ``sort_bars`` for ordered output.
    """
    return clamp_negative(drop_invalid_ohlc(drop_missing_ohlc(df)))


def bar_quality_report(df: DataFrame, spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    """What ``clean_bars`` removes or changes, per series. Negative counts refer to the rows that are kept."""
    missing = ohlc_missing()
    invalid = ~missing & F.coalesce(ohlc_invalid(), F.lit(False))
    kept = ~missing & ~invalid
    return df.groupBy(*spec.keys).agg(
        F.count("*").alias("rows_in"),
        F.count_if(missing).alias("dropped_missing"),
        F.count_if(invalid).alias("dropped_invalid"),
        F.count_if(kept & (F.col("volume") < 0)).alias("negative_volume"),
        F.count_if(kept & (F.col("oi") < 0)).alias("negative_oi"),
        F.count_if(kept).alias("rows_out"),
    )


def _micros(time_of_day: str) -> int:
    hours, minutes, seconds = (int(part) for part in time_of_day.split(":"))
    return ((hours * 60 + minutes) * 60 + seconds) * 1_000_000


def in_market_hours(ts: str | Column = "ts", start: str = "09:15:00", end: str = "15:30:00") -> Column:
    """Monday to Friday, both ends included, to the microsecond."""
    ts = as_col(ts)
    return (F.weekday(ts) < 5) & micros_of_day(ts).between(_micros(start), _micros(end))


def market_hours_filter(
    df: DataFrame, start: str = "09:15:00", end: str = "15:30:00", ts: str = "ts"
) -> DataFrame:
    return df.filter(in_market_hours(ts, start, end))


def sample_hours_filter(df: DataFrame, ts: str = "ts") -> DataFrame:
    """The looser intraday window: from 9 o'clock up to and including minute 15:30, any weekday."""
    hour, minute = F.hour(ts), F.minute(ts)
    return df.filter((hour >= 9) & ((hour < 15) | ((hour == 15) & (minute <= 30))))


def large_oi_change(df: DataFrame, threshold: float = 0.05) -> DataFrame:
    """Rows whose ``oi_pct_change`` is larger than the threshold in size."""
    return df.filter(F.abs("oi_pct_change") > threshold)


def oi_line(df: DataFrame, spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    return df.select(*spec.keys, spec.ts, "oi")
