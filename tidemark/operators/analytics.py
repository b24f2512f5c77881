"""Statistics over bars, signals, returns and trades; one result per series unless stated otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import join_on, last_value_of, minutes_between, ordering, ratio
from tidemark.operators.indicators import next_return
from tidemark.plans.quantile import exact_quantile
from tidemark.plans.series import BAR_SERIES, SeriesSpec, layout

TRADING_DAYS = 252
REGIMES = ("Trending Up", "Trending Down", "Sideways", "High Volatility")


# --- returns -------------------------------------------------------------------------------------


def _equity(lay, df: DataFrame, r: Column) -> DataFrame:
    df = lay.running(df, equity=("product", 1 + r), running_max=("max", F.col("equity"), "equity"))
    return df.withColumn("drawdown", ratio(F.col("equity") - F.col("running_max"), F.col("running_max")))


def equity_curve(df: DataFrame, returns_col: str = "returns", spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    """Cumulative growth, its running maximum and the drawdown, over rows with a return.

    The starting value 1 does not count as a maximum.
    """
    lay = layout(df.filter(F.col(returns_col).isNotNull()), spec)
    return lay.finish(_equity(lay, lay.df, F.col(returns_col)))


def performance_metrics(df: DataFrame, returns_col: str = "returns", spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    """Ten return figures per series. A table without the column gives no rows, as does a series without returns."""
    if returns_col not in df.columns:
        return df.select(*spec.keys).limit(0)
    curve = equity_curve(df, returns_col, spec)
    r = F.col(returns_col)
    raw = curve.groupBy(*spec.keys).agg(
        F.count(r).alias("total_trades"),
        (F.product(1 + r) - 1).alias("total_return"),
        (F.stddev_samp(r) * F.sqrt(F.lit(float(TRADING_DAYS)))).alias("volatility"),
        F.min("drawdown").alias("max_drawdown"),
        F.count_if(r > 0).alias("__wins"),
        F.coalesce(F.avg(F.when(r > 0, r)), F.lit(0.0)).alias("avg_win"),
        F.coalesce(F.avg(F.when(r < 0, r)), F.lit(0.0)).alias("avg_loss"),
    )
    annual = F.pow(1 + F.col("total_return"), F.lit(float(TRADING_DAYS)) / F.col("total_trades")) - 1
    raw = raw.withColumn("annualized_return", F.when(~F.isnan(annual), annual))
    sharpe = F.when(F.col("volatility") > 0, F.col("annualized_return") / F.col("volatility")).otherwise(F.lit(0.0))
    payoff = F.abs(ratio(F.col("avg_win"), F.col("avg_loss")))
    return raw.select(
        *spec.keys,
        "total_return",
        "annualized_return",
        "volatility",
        sharpe.alias("sharpe_ratio"),
        "max_drawdown",
        (F.col("__wins") / F.col("total_trades")).alias("win_rate"),
        "avg_win",
        "avg_loss",
        F.coalesce(payoff, F.lit(0.0)).alias("profit_factor"),
        "total_trades",
    )


# --- trades --------------------------------------------------------------------------------------


def trade_summary(trades: DataFrame, by: tuple[str, ...] = ("instrument",)) -> DataFrame:
    """Counts, win rate in percent, win and loss sizes of closed trades. A win has a gross profit above zero.

    ``profit_factor`` is the average win over the average loss, 0 without losses.
    """
    pnl = F.col("pnl")
    won, lost = F.when(pnl > 0, pnl), F.when(pnl <= 0, pnl)
    summary = trades.filter(F.col("exit_ts").isNotNull()).groupBy(*by).agg(
        F.count("*").alias("total_trades"),
        F.count(won).alias("winning_trades"),
        F.count(lost).alias("losing_trades"),
        F.coalesce(F.avg(won), F.lit(0.0)).alias("avg_win"),
        F.coalesce(F.max(won), F.lit(0.0)).alias("max_win"),
        F.coalesce(F.avg(lost), F.lit(0.0)).alias("avg_loss"),
        F.coalesce(F.min(lost), F.lit(0.0)).alias("max_loss"),
    )
    rate = F.coalesce(ratio(100.0 * F.col("winning_trades"), F.col("total_trades").cast("double")), F.lit(0.0))
    payoff = F.coalesce(F.abs(ratio(F.col("avg_win"), F.col("avg_loss"))), F.lit(0.0))
    return summary.withColumns({"win_rate_pct": rate, "profit_factor": payoff})


def running_win_rate(trades: DataFrame, spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    """Win rate in percent after each closed trade, in order of ``trade_no``."""
    closed = trades.filter(F.col("exit_ts").isNotNull())
    lay = layout(closed, spec.reordered("trade_no"))
    won = F.when(F.col("pnl") > 0, F.lit(1)).otherwise(F.lit(0))
    out = lay.finish(lay.running(lay.df, __wins=("sum", won), __closed=("sum", F.lit(1))))
    return out.withColumn("win_rate_pct", 100.0 * F.col("__wins") / F.col("__closed")).drop("__wins", "__closed")


def last_closes(bars: DataFrame, spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    return bars.groupBy(*spec.keys).agg(last_value_of("close", spec.order).alias("last_close"))


def accounts(trades: DataFrame, last: DataFrame, cash: float, keys: tuple[str, ...]) -> DataFrame:
    """One account per row of ``last(keys, last_close)``, whether it traded or not, with its trade counts."""
    still_open = F.col("exit_ts").isNull()
    sums = trades.groupBy(*keys).agg(
        F.sum("pnl_net").alias("__closed"),
        F.count("pnl").alias("total_trades"),
        F.count_if(F.col("pnl") > 0).alias("winning_trades"),
        F.sum(F.when(still_open, F.col("size"))).alias("__size"),
        F.sum(F.when(still_open, F.col("entry_price") * F.col("size") + F.col("commission"))).alias("__spent"),
    )
    joined = join_on(last, sums, keys, "left")
    open_value = F.coalesce(F.col("__size") * F.col("last_close") - F.col("__spent"), F.lit(0.0))
    final = F.lit(cash) + F.coalesce("__closed", F.lit(0.0)) + open_value
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("total_trades", "winning_trades")]
    out = joined.select(*keys, F.lit(cash).alias("starting_value"), final.alias("final_value"), *counts)
    total = F.col("final_value") - F.col("starting_value")
    return out.withColumns({"total_return": total, "total_return_pct": total / F.lit(cash) * 100})


def portfolio_return(
    trades: DataFrame, bars: DataFrame, cash: float = 100_000.0, spec: SeriesSpec = BAR_SERIES
) -> DataFrame:
    """Start, end and return of an account per series.

    Closed trades count with their net profit; a trade still open with its value at the last close, less
    the commission of its entry.
    """
    return accounts(trades, last_closes(bars, spec), cash, spec.keys).drop("total_trades", "winning_trades")


# --- open interest and signals -------------------------------------------------------------------


def oi_summary(df: DataFrame, spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    return df.groupBy(*spec.keys).agg(
        F.min("oi").alias("oi_min"),
        F.max("oi").alias("oi_max"),
        F.avg("oi").alias("oi_mean"),
        F.stddev_samp("oi").alias("oi_std"),
    )


def correlations(
    df: DataFrame,
    pairs=(("price_change", "oi_pct_change"), ("volume", "oi")),
    spec: SeriesSpec = BAR_SERIES,
) -> DataFrame:
    """Pearson correlation of column pairs, ``corr_<a>_<b>``; rows with a NULL in the pair do not count."""

    def pearson(a: str, b: str) -> Column:
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        c = F.corr(x, y)
        return F.when(~F.isnan(c), c).alias(f"corr_{a}_{b}")

    return df.groupBy(*spec.keys).agg(*[pearson(a, b) for a, b in pairs])


def signal_stats(df: DataFrame, entry: str = "entry", spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    """Number and share of entry rows, and the minutes between consecutive ones."""
    lay = layout(df, spec, lookback=1)
    at = F.when(F.col(entry), F.col(spec.ts))
    d = lay.df.withColumn("__last_at", F.lag(at).over(lay.window))
    d = lay.finish(lay.running(d, __before=("last", F.col("__last_at"))))
    gap = F.when(F.col(entry), minutes_between(F.col(spec.ts), F.col("__before")))
    return d.groupBy(*spec.keys).agg(
        F.count_if(F.col(entry)).alias("buy_signals"),
        (F.lit(100.0) * F.count_if(F.col(entry)) / F.count("*")).alias("buy_signal_pct"),
        F.avg(gap).alias("mean_minutes"),
        F.min(gap).alias("min_minutes"),
        F.max(gap).alias("max_minutes"),
    )


def signal_quality(df: DataFrame, entry: str = "entry", spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    """Mean return of the bar after an entry row and the share of gains. Rows with any NULL do not count."""
    rows = next_return(df, spec).filter(F.col(entry)).na.drop()
    r = F.col("next_return")
    return rows.groupBy(*spec.keys).agg(
        F.count("*").alias("signals"),
        F.avg(r).alias("avg_next_return"),
        F.avg(F.when(r > 0, 1.0).otherwise(0.0)).alias("win_rate"),
    )


def oi_decline(df: DataFrame, spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    """Fall of open interest from the first to the last row, in percent of the first."""
    ends = df.groupBy(*spec.keys).agg(
        F.min_by("oi", ordering(spec.order)).alias("first_oi"), F.max_by("oi", ordering(spec.order)).alias("last_oi")
    )
    fall = ratio((F.col("first_oi") - F.col("last_oi")).cast("double"), F.col("first_oi").cast("double")) * 100
    return ends.withColumn("decline_pct", fall)


def signal_counts(
    df: DataFrame, entry: str = "entry", exit: str = "exit", spec: SeriesSpec = BAR_SERIES
) -> DataFrame:
    return df.groupBy(*spec.keys).agg(
        F.count_if(F.col(entry)).alias("buy_signals"), F.count_if(F.col(exit)).alias("sell_signals")
    )


def first_round_trip(
    df: DataFrame, entry: str = "entry", exit: str = "exit", spec: SeriesSpec = BAR_SERIES
) -> DataFrame:
    """First entry row, first exit row strictly after it, and the return between them in percent.

    Series without an entry are left out; without a later exit the exit columns are NULL.
    """
    ts = F.col(spec.ts)
    lay = layout(df, spec)
    d = lay.finish(lay.running(lay.df, __since=("min", F.when(F.col(entry), ts))))
    after = F.col(exit) & (ts > F.col("__since"))
    found = d.groupBy(*spec.keys).agg(
        F.min(F.when(F.col(entry), ts)).alias("entry_ts"),
        F.min_by("close", F.when(F.col(entry), ordering(spec.order))).alias("entry_price"),
        F.min(F.when(after, ts)).alias("exit_ts"),
        F.min_by("close", F.when(after, ordering(spec.order))).alias("exit_price"),
    )
    gain = ratio(F.col("exit_price") - F.col("entry_price"), F.col("entry_price")) * 100
    return found.filter(F.col("entry_ts").isNotNull()).withColumn("return_pct", gain)


# --- regimes and distributions -------------------------------------------------------------------


def regime_label(
    df: DataFrame, q: float = 0.7, trend: float = 0.02, spec: SeriesSpec = BAR_SERIES
) -> DataFrame:
    """``regime`` from ``volatility`` (against its ``q`` quantile in the series) and ``trend``."""
    threshold = exact_quantile(df, "volatility", q, spec.keys, "__threshold")
    d = join_on(df, threshold, spec.keys, "left")
    calm = F.col("volatility") < F.col("__threshold")
    up, down, flat, wild = REGIMES
    label = (
        F.when(calm & (F.col("trend") > trend), up)
        .when(calm & (F.col("trend") < -trend), down)
        .when(calm & (F.abs("trend") <= trend), flat)
        .when(F.col("volatility") >= F.col("__threshold"), wild)
        .otherwise("Unknown")
    )
    return d.withColumn("regime", label).drop("__threshold")


def regime_distribution(df: DataFrame, spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    """Rows and percentage of each regime."""
    counts = df.groupBy(*spec.keys, "regime").agg(F.count("*").alias("periods"))
    totals = counts.groupBy(*spec.keys).agg(F.sum("periods").alias("__all"))
    share = F.lit(100.0) * F.col("periods") / F.col("__all")
    return join_on(counts, totals, spec.keys).withColumn("pct", share).drop("__all")


def oi_by_regime(df: DataFrame, spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    named = df.filter(F.col("regime").isin(*REGIMES))
    return named.groupBy(*spec.keys, "regime").agg(
        F.avg("oi_pct_change").alias("avg_oi_change"), F.stddev_samp("oi_pct_change").alias("oi_volatility")
    )


def derivative_histogram(
    df: DataFrame, c: str = "oi_derivative", bins: int = 50, spec: SeriesSpec = BAR_SERIES
) -> DataFrame:
    """Equal-width bins from the smallest to the largest value, the last one closed; empty bins are listed too."""
    values = df.filter(F.col(c).isNotNull()).select(*spec.keys, F.col(c).cast("double").alias("__v"))
    ends = values.groupBy(*spec.keys).agg(F.min("__v").alias("__a"), F.max("__v").alias("__b"))
    single = F.col("__a") == F.col("__b")
    ends = ends.select(
        *spec.keys,
        F.when(single, F.col("__a") - 0.5).otherwise(F.col("__a")).alias("__from"),
        (F.when(single, F.lit(1.0)).otherwise(F.col("__b") - F.col("__a")) / F.lit(bins)).alias("__width"),
    )
    nth = F.least(F.floor((F.col("__v") - F.col("__from")) / F.col("__width")), F.lit(bins - 1)).cast("int")
    counts = (
        join_on(values, ends, spec.keys)
        .groupBy(*spec.keys, nth.alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    every = ends.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return join_on(every, counts, (*spec.keys, "bin"), "left").select(
        *spec.keys,
        "bin",
        (F.col("__from") + F.col("bin") * F.col("__width")).alias("bin_from"),
        (F.col("__from") + (F.col("bin") + 1) * F.col("__width")).alias("bin_to"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def linear_fit(df: DataFrame, x: str, y: str, by: tuple[str, ...]) -> DataFrame:
    """Least-squares line per group: ``slope`` and ``intercept``."""
    fit = df.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.regr_slope(F.col(y).cast("double"), F.col(x).cast("double")).alias("slope"),
        F.regr_intercept(F.col(y).cast("double"), F.col(x).cast("double")).alias("intercept"),
    )
    return fit


def fitted_values(df: DataFrame, x: str, y: str, by: tuple[str, ...], out: str = "fitted") -> DataFrame:
    """The value of its group's line at every row."""
    lines = linear_fit(df, x, y, by).drop("n")
    d = join_on(df, lines, by, "left")
    return d.withColumn(out, F.col("slope") * F.col(x) + F.col("intercept")).drop("slope", "intercept")


