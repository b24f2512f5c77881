"""Instrument master, history slices and broker position lists."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.series import BAR_SERIES, SeriesSpec


def instrument_master(instruments: DataFrame, exchange: str = "NFO") -> DataFrame:
    return instruments.filter(F.col("exchange") == exchange)


def instrument_lookup(
    df: DataFrame, instruments: DataFrame, token: str = "instrument", first_by: str = "tradingsymbol"
) -> DataFrame:
    """Add ``tradingsymbol`` (NULL for an unknown token) and ``label``, which falls back to ``Token-<id>``.

    Of several entries of a token the first in the order of ``first_by`` counts.
    """
    names = instruments.groupBy(F.col("instrument_token").alias(token)).agg(
        F.min_by("tradingsymbol", first_by).alias("tradingsymbol")
    )
    found = df.join(names, token, "left")
    fallback = F.concat(F.lit("Token-"), F.col(token).cast("string"))
    return found.withColumn("label", F.coalesce("tradingsymbol", fallback))


def history_slice(
    df: DataFrame,
    instrument,
    as_of: datetime | Column,
    duration_minutes: int = 5,
    include_oi: bool = True,
    spec: SeriesSpec = BAR_SERIES,
) -> DataFrame:
    """Bars of one instrument from three durations before ``as_of`` up to it, both ends included."""
    end = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp_ntz")
    start = end - F.make_dt_interval(mins=F.lit(3 * duration_minutes))
    (key,) = spec.keys
    out = df.filter((F.col(key) == F.lit(instrument)) & F.col(spec.ts).between(start, end))
    return out if include_oi else out.drop("oi")


def positions_union(net: DataFrame, day: DataFrame) -> DataFrame:
    """Net positions followed by day positions; duplicates stay."""
    return net.unionByName(day, allowMissingColumns=True)
