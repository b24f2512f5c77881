"""Entry and exit signals, and the position they lead to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.columns import ordering, rolling_mean
from tidemark.functions.rules import Rule, rule_of
from tidemark.operators.indicators import first_derivative, second_derivative
from tidemark.plans.series import BAR_SERIES, Layout, SeriesSpec, layout, over_series


def derivative_columns(df: DataFrame, w: WindowSpec, rule: Rule, time_period: int = 3) -> DataFrame:
    """The columns a rule reads."""
    ma = rolling_mean("oi", w, rule.ma_period) if rule.ma_period else F.lit(None).cast("double")
    return df.withColumns(
        {
            "doi": first_derivative(w, time_period, rule.variant),
            "d2oi": second_derivative(w, time_period, rule.variant),
            "oi_ma": ma,
        }
    )


def _with_derivatives(df, rule, spec, build, extra_lookback: int = 0) -> DataFrame:
    return over_series(
        df,
        lambda d, w: build(derivative_columns(d, w, rule)),
        spec,
        lookback=rule.lookback + extra_lookback,
    )


def signal_thresholds(df: DataFrame, preset="share_of_ma", spec: SeriesSpec = BAR_SERIES, **params) -> DataFrame:
    rule = rule_of(preset, **params)

    def build(d: DataFrame) -> DataFrame:
        return d.withColumns(
            {
                "entry_threshold": rule.entry_threshold(),
                "exit_doi_threshold": rule.first_exit_threshold(),
                "exit_d2oi_threshold": rule.second_exit_threshold(),
            }
        )

    return _with_derivatives(df, rule, spec, build)


def entry_signal(df: DataFrame, preset="share_of_ma", spec: SeriesSpec = BAR_SERIES, **params) -> DataFrame:
    rule = rule_of(preset, **params)
    return _with_derivatives(df, rule, spec, lambda d: d.withColumn("entry", rule.entry()))


def exit_signal(df: DataFrame, preset="share_of_ma", spec: SeriesSpec = BAR_SERIES, **params) -> DataFrame:
    rule = rule_of(preset, **params)
    return _with_derivatives(
        df, rule, spec, lambda d: d.withColumns({"exit": rule.exit(), "exit_reason": rule.exit_reason()})
    )


def flag_columns(df: DataFrame, rule: Rule) -> DataFrame:
    return df.withColumns({"entry": rule.entry(), "exit": rule.exit()})


def signal_flags(df: DataFrame, preset="share_of_ma", spec: SeriesSpec = BAR_SERIES, **params) -> DataFrame:
    """Derivatives, moving average and both flags."""
    rule = rule_of(preset, **params)
    return _with_derivatives(df, rule, spec, lambda d: flag_columns(d, rule))


def signal_columns(df: DataFrame, rule: Rule, enough_rows: Column) -> DataFrame:
    """BUY before SELL before HOLD, with the reason."""
    two_digits = lambda c: F.format_string("%.2f", F.col(c).cast("double"))
    signal = (
        F.when(~enough_rows, F.lit("HOLD"))
        .when(rule.entry(), F.lit("BUY"))
        .when(rule.exit(), F.lit("SELL"))
        .otherwise(F.lit("HOLD"))
    )
    reason = (
        F.when(~enough_rows, F.lit("Insufficient data"))
        .when(
            rule.entry(),
            F.concat(F.lit("OI derivatives indicate selling pressure (doi: "), two_digits("doi"),
                     F.lit(", d2oi: "), two_digits("d2oi"), F.lit(")")),
        )
        .when(rule.first_exit() & rule.exit(), F.concat(F.lit("First derivative exit (doi: "), two_digits("doi"),
                                                        F.lit(")")))
        .when(rule.exit(), F.concat(F.lit("Second derivative exit (d2oi: "), two_digits("d2oi"), F.lit(")")))
        .otherwise(F.lit("No clear signal"))
    )
    return df.withColumns({"signal": signal, "reason": reason})


def classify_signal(df: DataFrame, preset="absolute", spec: SeriesSpec = BAR_SERIES, **params) -> DataFrame:
    """Signal of every bar, judged as if it were the newest one. The first bar has too little data."""
    rule = rule_of(preset, **params)

    def build(d: DataFrame, w: WindowSpec) -> DataFrame:
        d = derivative_columns(d, w, rule).withColumn("__nth", F.row_number().over(w))
        return signal_columns(d, rule, F.col("__nth") >= 2).drop("__nth")

    return over_series(df, build, spec, lookback=rule.lookback)


def latest_bar(df: DataFrame, spec: SeriesSpec = BAR_SERIES, times: DataFrame | None = None) -> DataFrame:
    """Newest row of each series; of rows of one time the last in the series' order.

    The newest time of each series is a hash aggregate over keys and times, of ``times`` where that is a cheaper table of the
    same rows.  Only rows of that time are compared as a whole.
    """
    named = {k: f"__newest_{k}" for k in spec.keys}
    newest = (df if times is None else times).groupBy(*[F.col(k).alias(n) for k, n in named.items()]).agg(
        F.max(spec.ts).alias("__newest"))
    same = F.col(spec.ts).eqNullSafe(F.col("__newest"))
    for k, n in named.items():
        same = same & F.col(k).eqNullSafe(F.col(n))
    row = F.struct(*[F.col(c) for c in df.columns])
    last = df.join(newest, same).groupBy(*spec.keys).agg(F.max_by(row, ordering(spec.order)).alias("__row"))
    return last.select("__row.*")


def latest_signal(df: DataFrame, preset="absolute", spec: SeriesSpec = BAR_SERIES, **params) -> DataFrame:
    """Signal of the newest bar of each series; only those bars get their reason written out."""
    rule = rule_of(preset, **params)

    def build(d: DataFrame, w: WindowSpec) -> DataFrame:
        return derivative_columns(d, w, rule).withColumn("__enough", F.row_number().over(w) >= 2)

    newest = latest_bar(over_series(df, build, spec, lookback=rule.lookback), spec, times=df)
    return signal_columns(newest, rule, F.col("__enough")).drop("__enough")


# --- positions -----------------------------------------------------------------------------------


def position_columns(lay: Layout, df: DataFrame, flags: dict[str, tuple[Column, Column]]) -> DataFrame:
    """For every name: (entry, exit) a column with the position (0 flat, 1 long) after every bar.

    A bar acts on the position in one of four ways: set it (entry alone or exit alone), flip it (both), or keep it.
    The position is the value last set plus the flips since, modulo two: two running aggregates, no fold.
    """
    running, positions = {}, {}
    for name, (enters, leaves) in flags.items():
        flipped, last_set = f"__flips_{name}", f"__set_{name}"
        value = F.when(enters & ~leaves, F.lit(1)).when(leaves & ~enters, F.lit(0))
        running[flipped] = ("sum", F.when(enters & leaves, F.lit(1)).otherwise(F.lit(0)))
        running[last_set] = ("last", value - F.col(flipped), f"-{flipped}")
        positions[name] = F.pmod(F.coalesce(F.col(last_set), F.lit(0)) + F.col(flipped), F.lit(2)).cast("int")
    return lay.running(df, **running).withColumns(positions).drop(*running)


def position_state(
    df: DataFrame, entry: str = "entry", exit: str = "exit", spec: SeriesSpec = BAR_SERIES
) -> DataFrame:
    """Position after every bar from the two flag columns."""
    lay = layout(df, spec)
    return lay.finish(position_columns(lay, lay.df, {"position": (F.col(entry), F.col(exit))}))


def rule_positions(df: DataFrame, preset="share_of_ma", spec: SeriesSpec = BAR_SERIES, **params) -> DataFrame:
    """Bars to positions in one layout: derivatives, average, flags, position."""
    rule = rule_of(preset, **params)
    lay = layout(df, spec, lookback=rule.lookback)
    flagged = flag_columns(derivative_columns(lay.df, lay.window, rule), rule)
    return lay.finish(position_columns(lay, flagged, {"position": (F.col("entry"), F.col("exit"))}))


def position_state_live(df: DataFrame, signal: str = "signal", spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    """Position after every bar from BUY / SELL / HOLD: the last signal that was not HOLD decides."""
    value = F.when(F.col(signal) == "BUY", 1).when(F.col(signal) == "SELL", 0)
    lay = layout(df, spec)
    out = lay.finish(lay.running(lay.df, position=("last", value)))
    return out.withColumn("position", F.coalesce(F.col("position"), F.lit(0)))


def live_orders(df: DataFrame, signal: str = "signal", spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    """Bars on which the live position changes, ``side`` BUY or SELL, with the position after them."""
    value = F.when(F.col(signal) == "BUY", 1).when(F.col(signal) == "SELL", 0)
    lay = layout(df, spec, lookback=1)
    d = lay.df.withColumn("__value", value)
    d = d.withColumn("__last_value", F.lag("__value").over(lay.window))
    d = lay.finish(lay.running(d, __before=("last", F.col("__last_value"))))
    before = F.coalesce(F.col("__before"), F.lit(0))
    side = F.when(F.col("position") == 1, F.lit("BUY")).otherwise(F.lit("SELL"))
    changed = d.withColumn("position", F.coalesce(F.col("__value"), before)).filter(F.col("position") != before)
    return changed.withColumn("side", side).drop("__value", "__last_value", "__before")


def stop_take_check(
    df: DataFrame, stop_loss_pct: float = 0.15, take_profit_pct: float = 0.30, entry_price: str = "entry_price"
) -> DataFrame:
    """``stop_take``: STOP LOSS, TAKE PROFIT or NULL. Needs an entry price that is neither NULL nor zero."""
    return df.withColumn(
        "stop_take", stop_take(F.col(entry_price), F.col("close"), stop_loss_pct, take_profit_pct)
    )


def stop_take(
    entry_price: Column, price: Column, stop_loss_pct: float | None, take_profit_pct: float | None
) -> Column:
    held = entry_price.isNotNull() & (entry_price != 0)
    outcome = F.lit(None).cast("string")
    if take_profit_pct is not None:
        outcome = F.when(held & (price >= entry_price * F.lit(1 + take_profit_pct)), F.lit("TAKE PROFIT"))
    if stop_loss_pct is not None:
        hit = held & (price <= entry_price * F.lit(1 - stop_loss_pct))
        outcome = F.when(hit, F.lit("STOP LOSS")).otherwise(outcome)
    return outcome


def signal_to_next_bar(df: DataFrame, spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    """``fill_ts`` and ``fill_price``: time and open of the following bar, where a decision is filled."""
    return over_series(
        df,
        lambda d, w: d.withColumns({"fill_ts": F.lead(spec.ts).over(w), "fill_price": F.lead("open").over(w)}),
        spec,
        lookahead=1,
    )


def trade_cap(
    df: DataFrame, cap: int, per: str = "run", entry: str = "entry", spec: SeriesSpec = BAR_SERIES, across: bool = False
) -> DataFrame:
    """Rows flagged ``entry``, at most the first ``cap`` of a series, or of each of its days.

    With ``across`` one counter serves all series, in the order of time, then keys.
    """
    if per not in ("run", "day"):
        raise ValueError(f"per must be 'run' or 'day', not {per!r}")
    entries = df.filter(F.col(entry))
    if across:
        return trade_cap(entries, cap, per, entry, spec.keyed_by().reordered(spec.ts, *spec.keys, *spec.ties))
    if per == "day":
        days = entries.withColumn("__day", F.to_date(spec.ts))
        by_day = spec.keyed_by(*spec.keys, "__day")
        lay = layout(days, by_day)
    else:
        lay = layout(entries, spec)
    numbered = lay.finish(lay.running(lay.df, entry_no=("sum", F.lit(1))))
    return numbered.filter(F.col("entry_no") <= cap).drop("__day")
