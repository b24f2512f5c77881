"""The same strategy under many parameter sets at once.

Parameters are a short list fixed by the caller, so each set becomes a few more columns in the windows over the bars: one
shuffle and one sort however many sets there are.  Only then is a bar repeated per set, and for trades only under the sets
where it can trade.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import ratio, rolling_mean
from tidemark.functions.rules import Rule, share_of_ma
from tidemark.operators.analytics import accounts, last_closes
from tidemark.operators.indicators import first_derivative, second_derivative
from tidemark.operators.signals import position_columns
from tidemark.operators.trades import followed
from tidemark.plans.series import BAR_SERIES, Layout, SeriesSpec, layout

PARAM = "param_id"


def param_grid(ma_period=(30, 50, 70), entry=(0.003, 0.005, 0.007), exit_first=(0.0005, 0.001, 0.0015), **fixed):
    """Named rules for every combination of the main rule's parameters."""
    return {
        f"ma{m}_e{e}_x{x}": share_of_ma(entry=e, exit_first=x, ma_period=m, **fixed)
        for m, e, x in product(ma_period, entry, exit_first)
    }


def _bars(df: DataFrame, rules: dict[str, Rule], spec: SeriesSpec) -> tuple[Layout, DataFrame, dict[str, Rule]]:
    """Bars with the derivatives and one moving average per distinct period, and the rules reading them."""
    first = next(iter(rules.values()))
    shape = lambda r: (r.variant, r.both, r.held, r.stop_loss, r.take_profit)
    if any(shape(r) != shape(first) for r in rules.values()):
        raise ValueError("the parameter sets of a sweep may differ in levels and moving-average period only")
    if first.held:
        raise ValueError("levels held at entry differ per trade: run trade_ledger per parameter set")
    periods = sorted({r.ma_period or 0 for r in rules.values()})
    lay = layout(df, spec, lookback=max([2, *periods]) + 1, lookahead=1)
    w = lay.window
    averages = {f"oi_ma_{p}": rolling_mean("oi", w, p) if p else F.lit(None).cast("double") for p in periods}
    derivatives = {
        "doi": first_derivative(w, variant=first.variant), "d2oi": second_derivative(w, variant=first.variant)
    }
    return (
        lay,
        lay.df.withColumns(derivatives | averages),
        {name: r.with_(ma=f"oi_ma_{r.ma_period or 0}") for name, r in rules.items()},
    )


def param_sweep(df: DataFrame, rules: dict[str, Rule], spec: SeriesSpec = BAR_SERIES) -> DataFrame:
    """Flags and position after every bar under every parameter set."""
    lay, d, rules = _bars(df, rules, spec)
    flags = {f"__position_{i}": (r.entry(), r.exit()) for i, r in enumerate(rules.values())}
    d = lay.finish(position_columns(lay, d, flags))
    views = [
        F.struct(F.lit(name).alias(PARAM), F.col(r.ma).alias("oi_ma"), r.entry().alias("entry"), r.exit().alias("exit"),
                 F.col(f"__position_{i}").alias("position"))
        for i, (name, r) in enumerate(rules.items())
    ]
    return d.select(*df.columns, "doi", "d2oi", F.inline(F.array(*views)))


def sweep_trades(
    df: DataFrame, rules: dict[str, Rule], commission=0.001, size=1, spec: SeriesSpec = BAR_SERIES
) -> DataFrame:
    """Trades of every series under every parameter set, open ones included."""
    lay, d, rules = _bars(df, rules, spec)
    trades = followed(lay, d, list(rules.values()), commission, size, PARAM)
    names = F.array(*[F.lit(n) for n in rules])
    return trades.withColumn(PARAM, F.element_at(names, F.col(PARAM) + 1))


def sweep_results(
    df: DataFrame,
    rules: dict[str, Rule],
    cash: float = 100_000.0,
    commission: float = 0.001,
    spec: SeriesSpec = BAR_SERIES,
) -> DataFrame:
    """One row per parameter set: an account per series, summed over the series, with trade counts."""
    lay, d, varied = _bars(df, rules, spec)
    trades = followed(lay, d, list(varied.values()), commission, 1, PARAM, brief=True)
    numbers = F.explode(F.array(*[F.lit(i) for i in range(len(rules))])).alias(PARAM)
    last = last_closes(df, spec).select(numbers, "*")
    money = accounts(trades, last, cash, (PARAM, *spec.keys)).groupBy(PARAM).agg(
        *[F.sum(c).alias(c) for c in ("starting_value", "final_value", "total_trades", "winning_trades")]
    )
    gain = F.col("final_value") - F.col("starting_value")
    wins = ratio(100.0 * F.col("winning_trades"), F.col("total_trades").cast("double"))
    names = F.array(*[F.lit(n) for n in rules])
    return money.withColumn(PARAM, F.element_at(names, F.col(PARAM) + 1)).withColumns(
        {"total_return_pct": gain / F.col("starting_value") * 100, "win_rate_pct": F.coalesce(wins, F.lit(0.0))}
    ).drop("winning_trades")


def rank_param_sets(results: DataFrame, k: int | None = None, by: str = "total_return_pct") -> DataFrame:
    """Parameter sets by return, best first; the best ``k`` if given."""
    ranked = results.orderBy(F.col(by).desc(), F.col(PARAM))
    return ranked.limit(k) if k is not None else ranked
