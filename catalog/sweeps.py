"""Parameter and timeframe sweeps."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.indicators import FIRST, LAGS, SECOND, mean, windows
from catalog.registry import query
from catalog.resampling import AGGREGATES, right
from catalog.signals import derived
from catalog.strategy import POSITION_SQL
from catalog.trades import SUMMARY_SQL, recursive, walk
from catalog.views import INTRADAY, events_bars, lineitem_bars, lineitem_series, rounded, with_events, with_lineitem
from tidemark.functions.rules import absolute
from tidemark.operators import analytics as A
from tidemark.operators import sweeps as W
from tidemark.operators.resample import timeframe_sweep
from tidemark.operators.trades import trade_ledger
from tidemark.plans.series import SeriesSpec

# The three named parameter sets (sensitivity, feeling).
NAMED = {"Conservative": (0.005, 2_000_000.0), "Balanced": (0.010, 3_000_000.0), "Aggressive": (0.015, 4_000_000.0)}

NAMED_SQL = "sets(param_id, unit) AS (VALUES " + ", ".join(f"('{n}', {s}::DOUBLE * {f})" for n, (s, f) in NAMED.items()) + ")"
GRID = W.param_grid()
GRID_SQL = ("grid(param_id, period, entry_pct, exit_pct) AS (VALUES "
            + ", ".join(f"('{n}', {r.ma_period}, {r.entry_level}::DOUBLE, {r.exit_first_level}::DOUBLE)" for n, r in GRID.items())
            + ")")

PER_SET = POSITION_SQL.replace("PARTITION BY instrument", "PARTITION BY param_id, instrument")


@query("param_sweep", with_events(f""", {NAMED_SQL}, {derived('events_bars', 'rounded', 50)},
f AS (SELECT s.*, param_id, coalesce(doi < 0 AND d2oi < -0.1::DOUBLE * unit, false) AS entry,
  coalesce(doi > -1 * unit, false) AS exit1, coalesce(d2oi > -0.1::DOUBLE * unit, false) AS exit2 FROM s, sets), {PER_SET}
SELECT param_id, instrument, ts, entry, exit, position FROM r"""))
def param_sweep(spark, sf_dir):
    rules = {n: absolute(s, f) for n, (s, f) in NAMED.items()}
    out = W.param_sweep(events_bars(spark, sf_dir), rules, INTRADAY)
    return out.select("param_id", "instrument", "ts", "entry", "exit", "position")


GRID_BARS = f"""{LAGS.format(bars='events_bars')},
m AS (SELECT *, {FIRST['indicator']} AS doi, {SECOND['indicator']} AS d2oi, {mean('oi', 30)} AS ma30,
  {mean('oi', 50)} AS ma50, {mean('oi', 70)} AS ma70 FROM l {windows(30, 50, 70)}),
s AS (SELECT m.*, param_id, entry_pct, exit_pct, CASE period WHEN 30 THEN ma30 WHEN 50 THEN ma50 ELSE ma70 END AS oi_ma
  FROM m, grid)"""


@query("param_grid", with_events(f""", {GRID_SQL}, {GRID_BARS},
f AS (SELECT *, coalesce(doi < 0 AND d2oi < entry_pct * oi_ma, false) AS entry,
  coalesce(doi > exit_pct * oi_ma, false) AS exit1, coalesce(d2oi > -0.005::DOUBLE * oi_ma, false) AS exit2 FROM s),
{PER_SET}
SELECT param_id, instrument, count(*) FILTER (entry) AS entries, count(*) FILTER (exit) AS exits,
  CAST(sum(position) AS BIGINT) AS bars_long FROM r GROUP BY 1, 2"""))
def param_grid(spark, sf_dir):
    out = W.param_sweep(events_bars(spark, sf_dir), GRID, INTRADAY)
    return out.groupBy("param_id", "instrument").agg(
        F.count_if("entry").alias("entries"), F.count_if("exit").alias("exits"), F.sum("position").alias("bars_long")
    )


def grid_walk(bars: str) -> str:
    source = f"{GRID_SQL}, {GRID_BARS.replace('events_bars', bars)}"
    sql = walk("share_of_ma", bars, keys="param_id, instrument", source=source)
    return (sql.replace("d2oi < -0.005::DOUBLE * oi_ma", "d2oi < entry_pct * oi_ma")
            .replace("-0.001::DOUBLE * b.oi_ma", "b.exit_pct * b.oi_ma"))


def results_sql(bars: str) -> str:
    """An account per parameter set and instrument, summed over the instruments."""
    return f""", {grid_walk(bars)},
last AS (SELECT instrument, arg_max(close, ts) AS last_close FROM {bars} GROUP BY 1),
acc AS (SELECT grid.param_id, last.instrument, 100000.0::DOUBLE + coalesce(sum(pnl_net), 0)
    + coalesce(sum(CASE WHEN t.entry_ts IS NOT NULL AND exit_ts IS NULL THEN last_close - entry_price - commission END), 0)
    AS final_value, count(exit_ts) AS n, count(exit_ts) FILTER (pnl > 0) AS wins
  FROM grid CROSS JOIN last LEFT JOIN trades t ON t.param_id = grid.param_id AND t.instrument = last.instrument GROUP BY 1, 2)
SELECT param_id, sum(100000.0::DOUBLE) AS starting_value, round(sum(final_value), 4) AS final_value,
  round((sum(final_value) - sum(100000.0::DOUBLE)) / sum(100000.0::DOUBLE) * 100, 6) AS total_return_pct,
  CAST(sum(n) AS BIGINT) AS total_trades, round(coalesce(100.0::DOUBLE * sum(wins) / nullif(sum(n), 0), 0), 6) AS win_rate_pct
FROM acc GROUP BY 1"""


def ranked(spark, bars, spec):
    out = W.rank_param_sets(W.sweep_results(bars, GRID, spec=spec))
    return rounded(rounded(out, "final_value", digits=4), "total_return_pct", "win_rate_pct")


@query("rank_param_sets", recursive(with_events(results_sql("events_bars"))))
def rank_param_sets(spark, sf_dir):
    return ranked(spark, events_bars(spark, sf_dir), INTRADAY)


@query("sweep_daily", recursive(with_lineitem(results_sql("lineitem_bars"))))
def sweep_daily(spark, sf_dir):
    """Accounts of the whole grid over the daily bars."""
    return ranked(spark, lineitem_bars(spark, sf_dir), lineitem_series(spark, sf_dir))


@query("sweep_trades", recursive(with_events(f""", {grid_walk('events_bars')}
SELECT param_id, instrument, trade_no, entry_ts, entry_price, exit_ts, exit_price, exit_reason FROM trades""")))
def sweep_trades(spark, sf_dir):
    out = W.sweep_trades(events_bars(spark, sf_dir), GRID, spec=INTRADAY)
    return out.select("param_id", "instrument", "trade_no", "entry_ts", "entry_price", "exit_ts", "exit_price", "exit_reason")


TIMEFRAMES = (3, 6, 15, 60)
FRAMES_SQL = "tf AS (" + "\nUNION ALL\n".join(
    f"SELECT {m} AS timeframe, instrument, {right(m)} AS ts, {AGGREGATES} FROM events_bars GROUP BY 1, 2, 3" for m in TIMEFRAMES
) + ")"
PER_FRAME = derived("tf", "indicator", 50).replace("PARTITION BY instrument", "PARTITION BY timeframe, instrument")


@query("timeframe_strategy", recursive(with_events(f""", {FRAMES_SQL},
{walk('share_of_ma', 'tf', keys='timeframe, instrument', source=PER_FRAME)}
SELECT timeframe, {SUMMARY_SQL} FROM trades WHERE exit_ts IS NOT NULL GROUP BY 1""")))
def timeframe_strategy(spark, sf_dir):
    """The main rule on bars of several timeframes."""
    bars = timeframe_sweep(events_bars(spark, sf_dir), TIMEFRAMES, spec=INTRADAY)
    trades = trade_ledger(bars, spec=SeriesSpec(("timeframe", "instrument")))
    return rounded(A.trade_summary(trades, ("timeframe",)), "avg_win", "avg_loss", "win_rate_pct", "profit_factor")
