"""Indicator columns.

Each ``*_columns`` step adds columns given a window; the public functions lay the series out for the
rows they look back on and apply the steps.  Composites apply many steps to one layout: one shuffle, one sort.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.columns import as_col, pct_change, ratio, rolling_mean, rolling_std
from tidemark.plans.series import BAR_SERIES, Layout, SeriesSpec, layout, over_series

SMA_LENGTHS = (5, 10, 20, 50)


# --- exponentially weighted mean -----------------------------------------------------------------

LAGS_PER_LEVEL = 8


def _decay(span: int) -> float:
    return 1.0 - 2.0 / (span + 1.0)


def ewm_taps(span: int) -> int:
    """Rows after which the remaining weight is below double precision."""
    return math.ceil(math.log(1e-16) / math.log(_decay(span)))


def ewm_levels(span: int) -> int:
    levels = 1
    while LAGS_PER_LEVEL**levels < ewm_taps(span):
        levels += 1
    return levels


def ewm_lookback(span: int) -> int:
    return LAGS_PER_LEVEL ** ewm_levels(span)


def ewm_columns(df: DataFrame, w: WindowSpec, inputs: dict[str, tuple[str, int]]) -> DataFrame:
    """Add ``name = exponentially weighted mean of column over span``.

    Weights fall with every row, whether it has a value or not; a row without one keeps the mean before it, and
    before the first value the mean is NULL.  The weighted sums of the values and of their weights over the last 8**k rows
    are built in k passes: each adds eight lagged copies of the previous pass, scaled by the decay.  Constant lags
    only, so the cost per row does not grow with the span and all passes share the window's shuffle and sort.  Rows
    further back weigh less than 1e-16 of the newest.  That holds at rows with a value; ``ewm_kept`` carries their means over gaps.
    """
    names = list(inputs)
    df = df.withColumns({f"__sum_{n}": F.coalesce(F.col(inputs[n][0]).cast("double"), F.lit(0.0)) for n in names})
    df = df.withColumns({f"__weight_{n}": F.col(inputs[n][0]).isNotNull().cast("double") for n in names})
    for level in range(max(ewm_levels(span) for _, span in inputs.values())):
        step = LAGS_PER_LEVEL**level
        sums = {}
        for n in names:
            span = inputs[n][1]
            if level >= ewm_levels(span):
                continue
            for c in (f"__sum_{n}", f"__weight_{n}"):
                total: Column = F.col(c)
                for k in range(1, LAGS_PER_LEVEL):
                    lagged = F.coalesce(F.lag(c, k * step).over(w), F.lit(0.0))
                    total = total + lagged * F.lit(_decay(span) ** (k * step))
                sums[c] = total
        df = df.withColumns(sums)
    means = {n: ratio(F.col(f"__sum_{n}"), F.col(f"__weight_{n}")) for n in names}
    return df.withColumns(means).drop(*[f"__sum_{n}" for n in names], *[f"__weight_{n}" for n in names])


def ewm_kept(lay: Layout, df: DataFrame, inputs: dict[str, tuple[str, int]]) -> DataFrame:
    """The means of ``ewm_columns`` with each row that lacks a value given the mean before it, over gaps of any length.

    On halo rows the means are undefined.
    """
    kept = {f"__kept_{n}": ("last", F.when(F.col(c).isNotNull(), F.col(n))) for n, (c, _) in inputs.items()}
    return lay.running(df, **kept).withColumns({n: F.col(f"__kept_{n}") for n in inputs}).drop(*kept)


# --- price and volume ----------------------------------------------------------------------------


def sma_columns(df: DataFrame, w: WindowSpec, lengths=SMA_LENGTHS, c: str = "close") -> DataFrame:
    return df.withColumns({f"sma_{n}": rolling_mean(c, w, n) for n in lengths})


def rsi_columns(df: DataFrame, w: WindowSpec, n: int = 14, c: str = "close") -> DataFrame:
    change = F.col(c) - F.lag(c).over(w)
    df = df.withColumn("__gain", F.when(change > 0, change).otherwise(F.lit(0.0)))
    df = df.withColumn("__fall", F.when(change < 0, -change).otherwise(F.lit(0.0)))
    gain, loss = rolling_mean("__gain", w, n), rolling_mean("__fall", w, n)
    df = df.withColumn("__gain", gain).withColumn("__fall", loss)
    strength = 100.0 - ratio(F.lit(100.0), 1.0 + ratio(F.col("__gain"), F.col("__fall")))
    only_gains = (F.col("__fall") == 0) & (F.col("__gain") > 0)
    return df.withColumn("rsi", F.when(only_gains, F.lit(100.0)).otherwise(strength)).drop("__gain", "__fall")


def bollinger_columns(df: DataFrame, w: WindowSpec, n: int = 20, k: float = 2.0, c: str = "close") -> DataFrame:
    df = df.withColumn("bb_middle", rolling_mean(c, w, n)).withColumn("__std", rolling_std(c, w, n))
    df = df.withColumns(
        {"bb_upper": F.col("bb_middle") + k * F.col("__std"), "bb_lower": F.col("bb_middle") - k * F.col("__std")}
    )
    return df.withColumns(
        {
            "bb_width": F.col("bb_upper") - F.col("bb_lower"),
            "bb_position": ratio(F.col(c) - F.col("bb_lower"), F.col("bb_upper") - F.col("bb_lower")),
        }
    ).drop("__std")


def volume_columns(df: DataFrame, w: WindowSpec, n: int = 20) -> DataFrame:
    if "volume" not in df.columns:
        return df
    df = df.withColumn("volume_sma", rolling_mean("volume", w, n))
    return df.withColumn("volume_ratio", ratio(F.col("volume").cast("double"), F.col("volume_sma")))


def macd_averages(lay: Layout, df: DataFrame, fast=12, slow=26, c: str = "close") -> DataFrame:
    inputs = {f"ema_{fast}": (c, fast), f"ema_{slow}": (c, slow)}
    df = ewm_kept(lay, ewm_columns(df, lay.window, inputs), inputs)
    return df.withColumn("macd", F.col(f"ema_{fast}") - F.col(f"ema_{slow}"))


def macd_signal_columns(df: DataFrame, w: WindowSpec, signal=9) -> DataFrame:
    """The averages have no gaps after their first value, so nothing is to be kept."""
    df = ewm_columns(df, w, {"macd_signal": ("macd", signal)})
    return df.withColumn("macd_histogram", F.col("macd") - F.col("macd_signal"))


def sma(df: DataFrame, lengths=SMA_LENGTHS, c: str = "close", spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    return over_series(df, lambda d, w: sma_columns(d, w, lengths, c), spec, lookback=max(lengths) - 1)


def ema(df: DataFrame, spans=(12, 26), c: str = "close", spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    inputs = {f"ema_{s}": (c, s) for s in spans}
    lay = layout(df, spec, lookback=max(ewm_lookback(s) for s in spans))
    return lay.finish(ewm_kept(lay, ewm_columns(lay.df, lay.window, inputs), inputs))


def macd(df: DataFrame, fast=12, slow=26, signal=9, c: str = "close", spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    spec = spec.measured(df)
    lay = layout(df, spec, lookback=max(ewm_lookback(fast), ewm_lookback(slow)))
    d = lay.finish(macd_averages(lay, lay.df, fast, slow, c))  # means carried over gaps are not known on halo rows
    return over_series(d, lambda d, w: macd_signal_columns(d, w, signal), spec, lookback=ewm_lookback(signal))


def rsi(df: DataFrame, n: int = 14, c: str = "close", spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    return over_series(df, lambda d, w: rsi_columns(d, w, n, c), spec, lookback=n)


def bollinger(df: DataFrame, n=20, k=2.0, c: str = "close", spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    return over_series(df, lambda d, w: bollinger_columns(d, w, n, k, c), spec, lookback=n - 1)


def volume_ratio(df: DataFrame, n: int = 20, spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    return over_series(df, lambda d, w: volume_columns(d, w, n), spec, lookback=n - 1)


def technical_indicators(df: DataFrame, spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    """Moving averages, MACD, RSI, Bollinger bands and volume ratio; one pass over the series, a second over cut ones."""
    spec = spec.measured(df)
    lay = layout(df, spec, lookback=ewm_lookback(26))
    first = lay.finish(macd_averages(lay, sma_columns(lay.df, lay.window)))

    def build(d: DataFrame, w: WindowSpec) -> DataFrame:
        for step in (macd_signal_columns, rsi_columns, bollinger_columns, volume_columns):
            d = step(d, w)
        return d

    return over_series(first, build, spec, lookback=ewm_lookback(9))


# --- open interest -------------------------------------------------------------------------------


def first_derivative(w: WindowSpec, period: int = 3, variant: str = "indicator", c: str = "oi") -> Column:
    """Change of open interest per unit of time.

    ``indicator`` is 0 on the first bar, ``frame`` is NULL there, ``rounded`` is ``frame`` rounded half-even.
    """
    slope = (F.col(c) - F.lag(c).over(w)) / F.lit(float(period))
    if variant == "indicator":
        return F.when(F.row_number().over(w) == 1, F.lit(0.0)).otherwise(slope)
    if variant == "frame":
        return slope
    if variant == "rounded":
        return F.bround(slope)
    raise ValueError(f"unknown variant: {variant!r}")


def second_derivative(w: WindowSpec, period: int = 3, variant: str = "indicator", c: str = "oi") -> Column:
    """Change of the first derivative per unit of time; variants as for ``first_derivative``.

    On the second bar the ``indicator`` takes the first bar for the missing one before it.
    """
    back1, back2 = F.lag(c, 1).over(w), F.lag(c, 2).over(w)
    square = F.lit(float(period) ** 2)
    if variant == "indicator":
        nth = F.row_number().over(w)
        before = F.when(nth == 2, back1).otherwise(back2)
        return F.when(nth == 1, F.lit(0.0)).otherwise((F.col(c) + before - 2 * back1) / square)
    bend = (F.col(c) + back2 - 2 * back1) / square
    if variant == "frame":
        return bend
    if variant == "rounded":
        return F.bround(bend)
    raise ValueError(f"unknown variant: {variant!r}")


DERIVATIVE_LOOKBACK = 2


def oi_first_derivative(
    df: DataFrame, time_period: int = 3, variant: str = "indicator", spec: SeriesSpec = BAR_SERIES, out: str = "doi"
) -> DataFrame:
    return over_series(
        df, lambda d, w: d.withColumn(out, first_derivative(w, time_period, variant)), spec, lookback=1
    )


def oi_second_derivative(
    df: DataFrame, time_period: int = 3, variant: str = "indicator", spec: SeriesSpec = BAR_SERIES, out: str = "d2oi"
) -> DataFrame:
    return over_series(
        df, lambda d, w: d.withColumn(out, second_derivative(w, time_period, variant)), spec, lookback=2
    )


def oi_sma_ratio_columns(df: DataFrame, w: WindowSpec) -> DataFrame:
    df = df.withColumns({"oi_sma_10": rolling_mean("oi", w, 10), "oi_sma_30": rolling_mean("oi", w, 30)})
    return df.withColumn("oi_ratio", ratio(F.col("oi").cast("double"), F.col("oi_sma_30")))


def oi_change_columns(df: DataFrame, w: WindowSpec) -> DataFrame:
    oi = F.col("oi")
    return df.withColumns(
        {"oi_change": oi - F.lag("oi").over(w), "oi_pct_change": pct_change(oi.cast("double"), w)}
    )


def oi_momentum_columns(df: DataFrame, w: WindowSpec, lag: int = 4) -> DataFrame:
    return df.withColumn("oi_momentum", F.col("oi") - F.lag("oi", lag).over(w))


def divergence_columns(df: DataFrame, w: WindowSpec) -> DataFrame:
    spread = pct_change("close", w) - pct_change(F.col("oi").cast("double"), w)
    return df.withColumn("price_oi_divergence", spread)


def oi_sma_ratio(df: DataFrame, spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    return over_series(df, oi_sma_ratio_columns, spec, lookback=29)


def oi_change(df: DataFrame, fill: bool = False, spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    """Absolute and relative change of open interest.

    With ``fill`` the relative change is taken after carrying the last known value over missing ones.
    """
    lay = layout(df, spec, lookback=1)
    if not fill:
        return lay.finish(oi_change_columns(lay.df, lay.window))
    d = lay.df.withColumn("__last_oi", F.lag("oi").over(lay.window))
    d = lay.finish(lay.running(d, __before=("last", F.col("__last_oi"))))
    known, before = F.coalesce("oi", "__before").cast("double"), F.col("__before").cast("double")
    changes = {"oi_change": F.col("oi") - F.col("__last_oi"), "oi_pct_change": ratio(known, before) - 1}
    return d.withColumns(changes).drop("__last_oi", "__before")


def oi_momentum(df: DataFrame, lag: int = 4, spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    return over_series(df, lambda d, w: oi_momentum_columns(d, w, lag), spec, lookback=lag)


def price_oi_divergence(df: DataFrame, spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    return over_series(df, divergence_columns, spec, lookback=1)


def oi_analysis_columns(df: DataFrame, w: WindowSpec) -> DataFrame:
    for step in (oi_sma_ratio_columns, oi_change_columns, oi_momentum_columns, divergence_columns):
        df = step(df, w)
    return df.withColumns(
        {
            "oi_derivative": first_derivative(w, variant="frame"),
            "oi_second_derivative": second_derivative(w, variant="frame"),
        }
    )


def oi_analysis(df: DataFrame, spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    """All open-interest columns; a table without ``oi`` is returned as it is."""
    if "oi" not in df.columns:
        return df
    return over_series(df, oi_analysis_columns, spec, lookback=29)


def oi_baseline_ma(df: DataFrame, period: int = 50, spec: SeriesSpec = BAR_SERIES, out: str = "oi_ma") -> DataFrame:
    return over_series(df, lambda d, w: d.withColumn(out, rolling_mean("oi", w, period)), spec, lookback=period - 1)


def oi_zscore(df: DataFrame, n: int = 20, spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    def build(d: DataFrame, w: WindowSpec) -> DataFrame:
        d = d.withColumns(
            {
                "price_change": pct_change("close", w),
                "volume_ma": rolling_mean("volume", w, n),
                "__mean": rolling_mean("oi", w, n),
                "__std": rolling_std("oi", w, n),
            }
        )
        return d.withColumn("oi_zscore", ratio(F.col("oi") - F.col("__mean"), F.col("__std"))).drop("__mean", "__std")

    return over_series(df, build, spec, lookback=n)


# --- returns and forecasts -----------------------------------------------------------------------


def returns_vol_trend(df: DataFrame, n: int = 20, spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    def build(d: DataFrame, w: WindowSpec) -> DataFrame:
        d = d.withColumn("returns", pct_change("close", w))
        first = F.lag("close", n - 1).over(w)
        return d.withColumns(
            {"volatility": rolling_std("returns", w, n), "trend": ratio(F.col("close") - first, first)}
        )

    return over_series(df, build, spec, lookback=n)


def next_return(df: DataFrame, spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    return over_series(
        df,
        lambda d, w: d.withColumn("next_return", ratio(F.lead("close").over(w), as_col("close")) - 1),
        spec,
        lookahead=1,
    )


def rolling_ols_forecast(
    df: DataFrame, c: str = "oi", length: int = 3, deviation: float = 0.05, spec: SeriesSpec = BAR_SERIES
) -> DataFrame:
    """Line through the previous ``length`` rows, extrapolated to the current one.

    A row is flagged when the forecast is below the value by more than ``deviation`` of it. Like the forecast
    itself this needs ``length`` rows before it; the flag starts one row later.
    """

    def build(d: DataFrame, w: WindowSpec) -> DataFrame:
        frame = w.rowsBetween(-length, -1)
        y = F.col(c).cast("double")
        x = F.row_number().over(w).cast("double")
        d = d.withColumn("__x", x).withColumn("__y", y)
        full = F.count("__y").over(frame) == length
        slope = F.regr_slope("__y", "__x").over(frame)
        mean_x, mean_y = F.avg("__x").over(frame), F.avg("__y").over(frame)
        d = d.withColumn("slope", F.when(full, slope))
        d = d.withColumn("next_value", F.when(full, mean_y + F.col("slope") * (F.col("__x") - mean_x)))
        late_enough = F.col("__x") > length + 1
        far = F.abs(ratio(F.col("next_value") - F.col("__y"), F.col("__y"))) > deviation
        flagged = late_enough & far & (F.col("next_value") < F.col("__y"))
        return d.withColumn("deviates", F.coalesce(flagged, F.lit(False))).drop("__x", "__y")

    return over_series(df, build, spec, lookback=length + 1)
