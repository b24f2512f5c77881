"""Option chains: strikes around the spot price, expiry distance, trading conditions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import as_col, local_micros
from tidemark.plans.series import BAR_SERIES, SeriesSpec, layout, ranges

SHORT_COVERING = "short_covering"
LONG_UNWINDING = "long_unwinding"
MICROS_PER_DAY = 86_400_000_000


def strike_ladder(chain: DataFrame, keys: tuple[str, ...] = ("underlying", "expiry")) -> DataFrame:
    """The distinct strikes of each chain in ascending order: ``pos`` (from 1), ``strike`` and the next strike."""
    w = Window.partitionBy(*keys).orderBy("strike")
    return (
        chain.select(*keys, "strike")
        .distinct()
        .withColumns({"pos": F.row_number().over(w), "next_strike": F.lead("strike").over(w)})
    )


def atm_strike(
    chain: DataFrame,
    spot: DataFrame,
    keys: tuple[str, ...] = ("underlying", "expiry"),
    slice_rows: int = BAR_SERIES.slice_rows,
) -> DataFrame:
    """Strike closest to the spot, per spot row and chain: ``atm_pos`` and ``atm_strike``. A tie takes the lower strike.

    The distinct spot prices and the strikes are merged in price order, where each price sees the last strike at or
    below it; no price is paired with more than one strike.  The spot rows then look their price up.
    """
    ladder = strike_ladder(chain, keys)
    missing = [k for k in keys if k not in spot.columns]
    if missing:  # a spot counts for every expiry of its underlying
        shared = [k for k in keys if k in spot.columns]
        spot = spot.join(ladder.select(*keys).distinct(), shared).select(*spot.columns, *missing)
    strikes = ladder.select(
        *keys,
        F.col("strike").cast("double").alias("__price"),
        F.lit(0).alias("__kind"),
        F.struct("pos", "strike", "next_strike").alias("__step"),
    )
    prices = spot.select(*keys, "spot").distinct().select(
        *keys, "spot", F.col("spot").cast("double").alias("__price"), F.lit(1).alias("__kind")
    )
    merged = prices.unionByName(strikes, allowMissingColumns=True)
    lay = layout(merged, SeriesSpec(keys, "__price", ("__kind",), slice_rows=slice_rows))
    seen = lay.finish(lay.running(lay.df, __below=("last", F.col("__step"))))
    below = F.col("__below")
    upper_is_closer = below["next_strike"] - F.col("spot") < F.col("spot") - below["strike"]
    pos = F.coalesce(below["pos"] + F.coalesce(upper_is_closer, F.lit(False)).cast("int"), F.lit(1))
    placed = seen.filter(F.col("__kind") == 1).select(*keys, "spot", pos.alias("atm_pos"))
    nearest = _strike_at(placed, ladder, keys, "atm_pos", "atm_strike")
    return spot.join(nearest, [*keys, "spot"]).select(*spot.columns, "atm_pos", "atm_strike")


def _strike_at(df: DataFrame, ladder: DataFrame, keys, pos: str, out: str) -> DataFrame:
    named = ladder.select(*keys, F.col("pos").alias(pos), F.col("strike").alias(out))
    return df.join(named, [*keys, pos]).select(*df.columns, out)


def select_strikes(
    chain: DataFrame,
    spot: DataFrame,
    movement_type: str = SHORT_COVERING,
    max_strikes: int = 3,
    keys: tuple[str, ...] = ("underlying", "expiry"),
) -> DataFrame:
    """The strike at the money and the following ones, upwards for short covering, downwards for long unwinding.

    One row per selected strike, ``rank`` from 0; fewer at the end of the chain; none for another movement type.
    """
    at = atm_strike(chain, spot, keys)
    direction = {SHORT_COVERING: 1, LONG_UNWINDING: -1}.get(movement_type)
    if direction is None or max_strikes < 1:
        return at.withColumns({"rank": F.lit(0), "strike": F.col("atm_strike")}).filter(F.lit(False))
    steps = at.withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(max_strikes - 1))))
    steps = steps.withColumn("__pos", F.col("atm_pos") + F.lit(direction) * F.col("rank"))
    return _strike_at(steps, strike_ladder(chain, keys), keys, "__pos", "strike").drop("__pos")


def option_side(chain: DataFrame, movement_type: str = SHORT_COVERING) -> DataFrame:
    """Calls for short covering, puts for long unwinding."""
    side = {SHORT_COVERING: "CE", LONG_UNWINDING: "PE"}.get(movement_type)
    return chain.filter(F.col("option_type") == F.lit(side))


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole days between two NTZ timestamps, rounded down: an hour ago is -1."""
    return F.floor((local_micros(later) - local_micros(earlier)) / F.lit(MICROS_PER_DAY))


def days_to_expiry(df: DataFrame, expiry: str = "expiry", now: str | Column = "ts", out: str = "dte") -> DataFrame:
    return df.withColumn(out, whole_days(F.col(expiry), as_col(now)))


def dte_filter(df: DataFrame, min_dte: int = 1, max_dte: int = 4, dte: str = "dte") -> DataFrame:
    return df.filter(F.col(dte).between(min_dte, max_dte))


def latest_known(
    df: DataFrame,
    readings: DataFrame,
    value: str,
    out: str,
    ts: str = "ts",
    slice_rows: int = BAR_SERIES.slice_rows,
) -> DataFrame:
    """The latest ``value`` of one time series ``readings(ts, value)`` at or before each row of ``df``.

    Only the distinct times of ``df`` are merged with the readings, range-partitioned by time, where every range carries the last
    reading of the ranges before; the rows then look their time up.
    """
    times = df.select(F.col(ts).alias("at"), F.lit(1).alias("kind")).distinct()
    marks = readings.select(F.col(ts).alias("at"), F.col(value).alias("value"), F.lit(0).alias("kind"))
    merged = times.unionByName(marks, allowMissingColumns=True)
    lay = ranges(merged, SeriesSpec((), "at", ("kind",), slice_rows=slice_rows))
    seen = lay.finish(lay.running(lay.df, seen=("last", F.col("value"))))
    known = seen.filter("kind = 1").select(F.col("at").alias("__at"), F.col("seen").alias("__seen"))
    return df.join(known, F.col(ts) == F.col("__at"), "left").select(*[F.col(c) for c in df.columns], F.col("__seen").alias(out))


def environment_filter(
    signals: DataFrame,
    vix: DataFrame,
    max_vix: float = 25.0,
    price: tuple[float, float] = (1.0, 100.0),
    ts: str = "ts",
    slice_rows: int = BAR_SERIES.slice_rows,
) -> DataFrame:
    """Rows at a tradable price while the last known volatility index (``vix``) is at most ``max_vix``."""
    known = latest_known(signals, vix, "vix", "vix", ts, slice_rows=slice_rows)
    return known.filter((F.col("vix") <= max_vix) & F.col("close").between(*price))
