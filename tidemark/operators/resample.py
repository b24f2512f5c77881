"""Time-bucket aggregation of bars."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import DAY_SECONDS, first_value_of, last_value_of, local_micros
from tidemark.plans.series import BAR_SERIES, SeriesSpec

UNIT_SECONDS = {"s": 1, "t": 60, "min": 60, "m": 60, "minute": 60, "minutes": 60, "h": 3600, "hour": 3600,
                "hours": 3600, "d": DAY_SECONDS, "day": DAY_SECONDS, "days": DAY_SECONDS}

LABEL = "__bucket"

DEFAULT_METHODS = {"open": "first", "high": "max", "low": "min", "close": "last", "volume": "sum", "oi": "last"}


def timeframe_seconds(timeframe: str) -> int:
    """Length of ``5T``, ``15min``, ``1H``, ``3 minutes`` in seconds; it must divide a day."""
    match = re.fullmatch(r"(\d+)\s*([A-Za-z]+)", timeframe.strip())
    if not match or match.group(2).lower() not in UNIT_SECONDS:
        raise ValueError(f"unknown timeframe: {timeframe!r}")
    seconds = int(match.group(1)) * UNIT_SECONDS[match.group(2).lower()]
    if seconds == 0 or DAY_SECONDS % seconds:
        raise ValueError(f"timeframe {timeframe!r} does not divide a day")
    return seconds


def bucket(ts: Column, timeframe: str, edge: str = "left") -> Column:
    """Label of the bucket holding ``ts``: its start for left-closed buckets, its end for right-closed ones.

    Buckets are aligned to midnight of the local time.
    """
    length = timeframe_seconds(timeframe)
    local = ts.cast("timestamp_ntz")
    if edge == "left":
        return local - _past(local, length)
    if edge == "right":
        before = local - F.expr("INTERVAL '0.000001' SECOND")
        return before - _past(before, length) + F.make_dt_interval(secs=F.lit(length))
    raise ValueError(f"edge must be 'left' or 'right', not {edge!r}")


def _past(local: Column, length: int) -> Column:
    """Time since the start of the bucket."""
    micros = F.pmod(local_micros(local), F.lit(length * 1_000_000))
    return F.make_dt_interval(secs=(micros.cast("decimal(18,0)") / 1_000_000).cast("decimal(18,6)"))


def _aggregate(method: str, c: str, order: list[Column]) -> Column:
    if method == "first":
        return first_value_of(c, order)
    if method == "last":
        return last_value_of(c, order)
    simple = {"max": F.max, "min": F.min, "sum": F.sum, "mean": F.avg, "median": F.median, "std": F.stddev_samp,
              "count": F.count}
    if method not in simple:
        raise ValueError(f"unknown aggregation method: {method!r}")
    return simple[method](c)


def resample_bars(
    df: DataFrame,
    timeframe: str,
    agg: dict[str, str] | None = None,
    edge: str = "left",
    spec: SeriesSpec = BAR_SERIES,
) -> DataFrame:
    """Bars of a longer timeframe. Columns beyond the core ones are averaged; bars with any NULL are dropped.

    Every default aggregate combines on the map side, so a bucket or series of any size is reduced before
    the shuffle.
    """
    label = bucket(F.col(spec.ts), timeframe, edge).alias(LABEL)
    return _aggregated(df.select("*", label), df, agg, spec)


def _aggregated(
    labelled: DataFrame, df: DataFrame, agg: dict[str, str] | None, spec: SeriesSpec, *extra_keys: str
) -> DataFrame:
    """One row per series and label."""
    methods = {**DEFAULT_METHODS, **(agg or {})}
    values = [c for c in df.columns if c not in (*spec.keys, spec.ts)]
    for c in values:
        if c not in methods and not isinstance(df.schema[c].dataType, T.NumericType):
            raise ValueError(f"column {c!r} is not numeric: drop it or name its aggregation")
    out = (
        labelled.groupBy(*extra_keys, *spec.keys, LABEL)
        .agg(*[_aggregate(methods.get(c, "mean"), c, spec.order).alias(c) for c in values])
        .select(*extra_keys, *spec.keys, F.col(LABEL).alias(spec.ts), *values)
    )
    return out.na.drop(subset=values)


def timeframe_sweep(
    df: DataFrame, minutes: Iterable[int] = (1, 3, 5, 15), edge: str = "right", spec: SeriesSpec = BAR_SERIES
) -> DataFrame:
    """The bars in several timeframes at once, told apart by a ``timeframe`` column (minutes).

    One pass over the bars: each is counted into one bucket per timeframe, combined before the shuffle.
    """
    labels = F.array(
        *[
            F.struct(F.lit(m).alias("timeframe"), bucket(F.col(spec.ts), f"{m}min", edge).alias(LABEL))
            for m in minutes
        ]
    )
    return _aggregated(df.select("*", F.inline(labels)), df, None, spec, "timeframe")
