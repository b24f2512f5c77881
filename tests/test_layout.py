"""Cutting long series must not change any result."""

import datetime as dt
import random
import time

import pytest
from conftest import make_bars, noisy_rows
from helpers import TINY, WHOLE, assert_same
from pyspark.sql import functions as F

from tidemark.functions.rules import absolute, share_of_ma
from tidemark.operators import analytics as A
from tidemark.operators import indicators as I
from tidemark.operators import sessions as S
from tidemark.operators import signals as G
from tidemark.operators import sweeps as W
from tidemark.operators import trades as T
from tidemark.plans.series import HOME, SLICE, SeriesSpec, layout


def flagged(d):
    return d.withColumns({"entry": F.col("volume") % 3 == 0, "exit": F.col("volume") % 5 < 2})


OPERATORS = {
    "technical_indicators": lambda d, s: I.technical_indicators(d, s),
    "oi_analysis": lambda d, s: I.oi_analysis(d, s),
    "oi_zscore": lambda d, s: I.oi_zscore(d, spec=s),
    "oi_change_filled": lambda d, s: I.oi_change(
        d.withColumn("oi", F.when(F.col("volume") % 3 == 0, F.col("oi"))), True, s),
    "derivatives": lambda d, s: I.oi_second_derivative(I.oi_first_derivative(d, spec=s), spec=s),
    "rolling_ols_forecast": lambda d, s: I.rolling_ols_forecast(d, spec=s),
    "next_return": lambda d, s: I.next_return(d, s),
    "market_sessions": lambda d, s: S.market_sessions(d, spec=s),
    "market_sessions_daily": lambda d, s: S.market_sessions(d, True, s),
    "position_state": lambda d, s: G.position_state(flagged(d), spec=s),
    "rule_positions": lambda d, s: G.rule_positions(d, spec=s),
    "live": lambda d, s: G.live_orders(G.classify_signal(d, spec=s), spec=s),
    "latest_signal": lambda d, s: G.latest_signal(d, spec=s),
    "signal_to_next_bar": lambda d, s: G.signal_to_next_bar(d, s),
    "trade_cap": lambda d, s: G.trade_cap(flagged(d), 30, spec=s),
    "trade_ledger": lambda d, s: T.all_trades(d, spec=s),
    "trade_ledger_held": lambda d, s: T.all_trades(d, "held_ma", spec=s),
    "trade_ledger_both": lambda d, s: T.all_trades(d, "absolute_both", spec=s),
    "equity_curve": lambda d, s: A.equity_curve(I.returns_vol_trend(d, spec=s), spec=s),
    "performance_metrics": lambda d, s: A.performance_metrics(I.returns_vol_trend(d, spec=s), spec=s),
    "running_win_rate": lambda d, s: A.running_win_rate(T.trade_ledger(d, spec=s), s),
    "signal_stats": lambda d, s: A.signal_stats(flagged(d), spec=s),
    "signal_quality": lambda d, s: A.signal_quality(flagged(d), spec=s),
    "first_round_trip": lambda d, s: A.first_round_trip(flagged(d), spec=s),
    "regime_label": lambda d, s: A.regime_label(I.returns_vol_trend(d, spec=s), spec=s),
    "param_sweep": lambda d, s: W.param_sweep(d, {"a": absolute(), "b": absolute(0.005, 2e6)}, s),
    "sweep_results": lambda d, s: W.sweep_results(d, W.param_grid(ma_period=(5, 30), entry=(0.002,)), spec=s),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_cut_series_give_the_same_rows(skewed_bars, name):
    op = OPERATORS[name]
    assert_same(op(skewed_bars, TINY), op(skewed_bars, WHOLE))


def test_negative_growth_keeps_the_running_maximum_exact(skewed_bars):
    wild = skewed_bars.withColumn("returns", (F.col("volume") % 7 - 3) / 2)
    assert_same(A.equity_curve(wild, spec=TINY).select("instrument", "ts", "running_max"),
                A.equity_curve(wild, spec=WHOLE).select("instrument", "ts", "running_max"))


def test_slices_hold_their_rows_and_halos(skewed_bars):
    lay = layout(skewed_bars, TINY, lookback=5, lookahead=2)
    assert lay.split
    per_slice = lay.df.groupBy(SLICE).agg(
        F.count_if(F.col(SLICE) == F.col(HOME)).alias("own"), F.count_if(F.col(SLICE) != F.col(HOME)).alias("halo")).collect()
    total = skewed_bars.count()
    own = [r.own for r in per_slice if r.own]
    assert sum(own) == total and max(own) == 37 and sorted(own)[1] == 37 and len(own) == -(-total // 37)
    assert max(r.halo for r in per_slice) <= 7


def test_rows_of_one_time_are_cut_too(spark):
    same = make_bars(spark, [(n, dt.datetime(2024, 1, 1), *r) for n, _, *r in noisy_rows("HOT", 500, 8)])
    lay = layout(same, TINY, lookback=3)
    assert max(r["count"] for r in lay.df.groupBy(SLICE).count().collect()) <= 40
    counted = lay.finish(lay.running(lay.df, nth=("sum", F.lit(1))))
    assert sorted(r.nth for r in counted.collect()) == list(range(1, 501))


def test_columns_may_be_called_as_the_layouts_are(skewed_bars):
    odd = ["__slice", "__home", "__place", "__at", "__part", "__tie", "__step", "__low", "__crowded", "__slice_"]
    named = skewed_bars.withColumns({c: F.col("volume") + i for i, c in enumerate(odd)})
    for op in (lambda d, s: I.technical_indicators(d, s), lambda d, s: S.market_sessions(d, spec=s), lambda d, s: G.rule_positions(d, spec=s)):
        assert_same(op(named, TINY), op(named, WHOLE))


def test_a_cut_chain_builds_quickly(skewed_bars):
    bars = skewed_bars.limit(600).cache()
    spec = TINY.measured(bars)
    begin = time.perf_counter()
    trades = T.trade_ledger(bars, spec=spec)
    assert trades._jdf.queryExecution().optimizedPlan().toString().count("\n") < 60
    rate = A.running_win_rate(trades, spec)
    assert rate._jdf.queryExecution().optimizedPlan().toString().count("\n") < 60
    assert time.perf_counter() - begin < 15  # the ledger alone took 37 s when its layouts counted in loops


STOPS_ONLY = {"exit_first": -1e6, "exit_second": -1e6, "ma_period": 5}  # no derivative ever reaches these levels


@pytest.mark.parametrize("params", [
    {"stop_loss": 0.03, "take_profit": 0.05}, {"stop_loss": 0.2, "take_profit": None}, {"stop_loss": None, "take_profit": 0.4},
    {"stop_loss": None, "take_profit": None}, {"stop_loss": 0.01, "take_profit": 0.01, "entry": -1e9},
], ids=["both", "stop", "take", "none", "always entering"])
@pytest.mark.parametrize("rows", [5, 41])
def test_trades_of_series_that_are_never_flat(spark, params, rows):
    bars = noisy_rows("LONG", 700, 21) + noisy_rows("B", 90, 22) + noisy_rows("C", 1, 23)
    for i in (50, 51, 300, 640):
        bars[i] = (*bars[i][:5], None, *bars[i][6:])  # no close
    bars[200] = (*bars[200][:2], 0.0, *bars[200][3:])  # an entry at nothing is never stopped
    bars[410] = (*bars[410][:2], None, *bars[410][3:])
    df = make_bars(spark, bars)
    cut = T.all_trades(df, spec=SeriesSpec(slice_rows=rows), **STOPS_ONLY, **params)
    whole = T.all_trades(df, spec=WHOLE, **STOPS_ONLY, **params)
    assert whole.count() > 0
    assert_same(cut, whole)


@pytest.mark.parametrize("preset", ["held_ma", "absolute_both", "absolute"])
def test_trades_of_small_slices(spark, preset):
    df = make_bars(spark, noisy_rows("LONG", 500, 31) + noisy_rows("B", 60, 32))
    assert_same(T.all_trades(df, preset, spec=SeriesSpec(slice_rows=6)), T.all_trades(df, preset, spec=WHOLE))


def test_more_rules_than_bits(spark):
    rules = {str(i): share_of_ma(entry=0.001 * (i % 9), exit_first=0.0005 * i, ma_period=5 + i % 3) for i in range(65)}
    df = make_bars(spark, noisy_rows("LONG", 260, 41))
    assert_same(W.sweep_trades(df, rules, spec=SeriesSpec(slice_rows=60)), W.sweep_trades(df, rules, spec=WHOLE))


def test_a_long_series_that_is_never_flat_spreads_over_its_slices(spark):
    rows = 20_000
    bars = spark.range(rows).select(
        F.lit("X").alias("instrument"), F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("ts"),
        *[(100 + 20 * F.sin(F.col("id") / 50) + F.rand(3)).alias(c) for c in ("open", "high", "low", "close")],
        F.lit(1).cast("bigint").alias("volume"), (1_000_000 + 50_000 * F.rand(4)).cast("bigint").alias("oi")).cache()
    spec = SeriesSpec(slice_rows=1000)
    out = T.all_trades(bars, spec=spec, **STOPS_ONLY, stop_loss=0.1, take_profit=0.1)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "MapInArrow" in plan
    assert_same(out, T.all_trades(bars, spec=WHOLE, **STOPS_ONLY, stop_loss=0.1, take_profit=0.1))
    assert layout(bars, spec, 1, 1).df.groupBy(SLICE).count().agg(F.max("count"), F.count("*")).first()[:] == (1002, rows // 1000 + 1)


def bursts(spark):
    """One instrument: a few days apart, then most rows within seconds, the densest of them within milliseconds."""
    start = dt.datetime(2024, 1, 1)
    seconds = [86400.0 * i for i in range(40)] + [86400.0 * 40 + i for i in range(300)] + [86400.0 * 41 + 0.001 * i for i in range(900)]
    rows = noisy_rows("HOT", len(seconds), 4)
    rows = [(n, start + dt.timedelta(seconds=s), *r) for s, (n, _, *r) in zip(seconds, rows)]
    rows += [("HOT", None, *r) for _, _, *r in noisy_rows("HOT", 1, 5)]
    random.Random(1).shuffle(rows)
    return make_bars(spark, rows)


def test_bursts_are_cut(spark):
    lay = layout(bursts(spark), TINY, lookback=5)
    per_slice = lay.df.groupBy(SLICE).agg(
        F.count_if(F.col(SLICE) == F.col(HOME)).alias("own"), F.count_if(F.col(SLICE) != F.col(HOME)).alias("halo"))
    worst = per_slice.agg(F.max("own"), F.max("halo"), F.sum("own")).first()
    assert worst[0] == 37 and worst[1] <= 5 and worst[2] == 1241


@pytest.mark.parametrize("name", ["technical_indicators", "rule_positions", "trade_ledger", "next_return", "param_sweep"])
def test_cut_bursts_give_the_same_rows(spark, name):
    bars = bursts(spark)
    assert_same(OPERATORS[name](bars, TINY), OPERATORS[name](bars, WHOLE))


def test_short_series_are_not_cut(skewed_bars):
    assert not layout(skewed_bars, WHOLE, lookback=5).split


def test_interleaved_series_are_independent(skewed_bars):
    both = I.technical_indicators(skewed_bars, WHOLE)
    alone = I.technical_indicators(skewed_bars.filter("instrument = 'M1'"), WHOLE)
    assert_same(both.filter("instrument = 'M1'"), alone)


def test_one_shuffle_and_one_sort_for_a_chain(skewed_bars):
    plan = I.technical_indicators(skewed_bars, WHOLE.measured(skewed_bars))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1


def plain_sweep(bars, rules):
    """Trades of every series under every rule, bar by bar; ``bars`` are dicts in order."""
    out = []
    for name, rule in rules.items():
        for key in {b["instrument"] for b in bars}:
            held, nth = None, 0
            mine = [b for b in bars if b["instrument"] == key]
            for b, after in zip(mine, mine[1:]):
                oi_ma = b[f"oi_ma_{rule.ma_period}"]
                if oi_ma is None:
                    continue
                if held is None:
                    if b["doi"] < 0 and b["d2oi"] is not None and b["d2oi"] < rule.entry_level * oi_ma:
                        nth += 1
                        held = (name, key, nth, b["ts"], after["ts"], after["open"])
                    continue
                price, close = held[-1], b["close"]
                first, second = b["doi"] > rule.exit_first_level * oi_ma, b["d2oi"] > rule.exit_second_level * oi_ma
                why = None
                if price and close is not None and close <= price * (1 - rule.stop_loss):
                    why = "STOP LOSS"
                elif price and close is not None and close >= price * (1 + rule.take_profit):
                    why = "TAKE PROFIT"
                elif first or second:
                    why = "First derivative exit" if first else "Second derivative exit"
                if why:
                    out.append((*held, b["ts"], after["ts"], after["open"], why))
                    held = None
            if held:
                out.append((*held, None, None, None, None))
    return out


@pytest.mark.parametrize("batch", [10_000, 7])
@pytest.mark.parametrize("exits", [(0.0005, 0.0015), (0.5,)], ids=["frequent", "by stops alone"])
def test_swept_trades_equal_a_walk(spark, skewed_bars, batch, exits):
    """Many rules (more than a word holds), missing closes, fills of zero, batches that end inside of series."""
    rules = W.param_grid(ma_period=(4, 9), entry=tuple(-0.001 * i for i in range(17)), exit_first=exits)
    rules = {n: r.with_(stop_loss=0.05, take_profit=0.08, exit_second_level=max(exits) * 9) for n, r in rules.items()}
    holed = skewed_bars.withColumns({
        "close": F.when(F.col("volume") % 7 != 0, F.col("close")), "open": F.when(F.col("volume") % 11 != 0, F.col("open")).otherwise(F.lit(0.0))})
    _, known, _ = W._bars(holed, rules, WHOLE.measured(holed))
    bars = [r.asDict() for r in known.orderBy("instrument", "ts").collect()]
    want = plain_sweep(bars, rules)
    default = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = W.sweep_trades(holed, rules, spec=WHOLE).select(
            "param_id", "instrument", "trade_no", "entry_signal_ts", "entry_ts", "entry_price", "exit_signal_ts", "exit_ts", "exit_price", "exit_reason").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", default)
    assert len(rules) > (60 if len(exits) > 1 else 30) and len(want) > 500
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_a_sweep_shuffles_bars_once(skewed_bars):
    spec = WHOLE.measured(skewed_bars)
    rules = W.param_grid(entry=tuple(0.001 * i for i in range(12)))
    plan = W.sweep_trades(skewed_bars, rules, spec=spec)._jdf.queryExecution().executedPlan().toString()
    assert len(rules) == 108 and plan.count("Exchange") == 1 and plan.count("Sort [") == 1


def test_empty_input(skewed_bars):
    empty = skewed_bars.filter("instrument = 'nothing'")
    for name, op in OPERATORS.items():
        assert op(empty, WHOLE).count() == 0, name


def plain_ewm(values, span):
    """The mean after each value, by recursion from the first row."""
    decay, total, weight, out = 1 - 2 / (span + 1), 0.0, 0.0, []
    for v in values:
        total, weight = total * decay + (v or 0.0), weight * decay + (v is not None)
        mean = total / weight if weight > 1e-300 else None
        out.append(mean if v is not None or not out else out[-1])
    return out


@pytest.mark.parametrize("gap", [450, 600])
@pytest.mark.parametrize("spec", [WHOLE, TINY], ids=["whole", "cut"])
def test_exponential_averages_keep_over_gaps(spark, gap, spec):
    rows = [list(r) for r in noisy_rows("GAP", gap + 160, 6)]
    for i in [*range(3), *range(100, 100 + gap), gap + 110]:
        rows[i][5] = None
    bars = make_bars(spark, [tuple(r) for r in rows])
    close = [r[5] for r in rows]
    fast, slow = plain_ewm(close, 12), plain_ewm(close, 26)
    line = [None if s is None else f - s for f, s in zip(fast, slow)]
    want = {"ema_12": fast, "ema_26": slow, "macd": line, "macd_signal": plain_ewm(line, 9)}
    for out, names in [(I.ema(bars, spec=spec), ("ema_12", "ema_26")), (I.macd(bars, spec=spec), want), (I.technical_indicators(bars, spec=spec), want)]:
        got = out.orderBy("ts").collect()
        assert len(got) == len(rows)
        for n in names:
            for g, w in zip(got, want[n]):
                assert g[n] == w if w is None else g[n] == pytest.approx(w, rel=1e-9, abs=1e-9), n
