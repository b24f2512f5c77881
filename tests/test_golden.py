"""Hand-computed cases."""

import datetime as dt

import pytest
from conftest import make_bars
from helpers import by_order
from pyspark.sql import functions as F

from tidemark.functions.columns import local_micros
from tidemark.functions.rules import absolute, coarse_absolute, rule_of, share_of_ma
from tidemark.operators import analytics as A
from tidemark.operators import clean as C
from tidemark.operators import indicators as I
from tidemark.operators import lookups as L
from tidemark.operators import options as O
from tidemark.operators import resample as R
from tidemark.operators import sessions as S
from tidemark.operators import signals as G
from tidemark.operators import trades as T
from tidemark.operators.segments import piecewise_segments
from tidemark.plans.series import SeriesSpec

DAY = dt.datetime(2024, 10, 14)  # a Monday


def bars_of(spark, ois, closes=None, opens=None, name="X", start=DAY + dt.timedelta(hours=9, minutes=15)):
    closes = closes or [100.0] * len(ois)
    opens = opens or closes
    return make_bars(spark, [
        (name, start + dt.timedelta(minutes=3 * i), float(o), float(max(o, c)), float(min(o, c)), float(c), 10, oi)
        for i, (oi, c, o) in enumerate(zip(ois, closes, opens))
    ])


def test_derivative_variants(spark):
    d = bars_of(spark, [1000, 1100, 1200, 1150, 1300])
    expected = {
        "indicator": ([0, 100 / 3, 100 / 3, -50 / 3, 50], [0, 100 / 9, 0, -150 / 9, 200 / 9]),
        "frame": ([None, 100 / 3, 100 / 3, -50 / 3, 50], [None, None, 0, -150 / 9, 200 / 9]),
        "rounded": ([None, 33, 33, -17, 50], [None, None, 0, -17, 22]),
    }
    for variant, (first, second) in expected.items():
        out = I.oi_second_derivative(I.oi_first_derivative(d, variant=variant), variant=variant)
        got = by_order(out, "doi", "d2oi")
        for (a, b), x, y in zip(got, first, second):
            assert a == (None if x is None else pytest.approx(x))
            assert b == (None if y is None else pytest.approx(y))


def test_rounding_is_half_even(spark):
    d = bars_of(spark, [0, 15, 60, 0])  # thirds: 5, 15, -20
    out = I.oi_first_derivative(d, time_period=2, variant="rounded")  # 7.5, 22.5, -30
    assert [r[0] for r in by_order(out, "doi")] == [None, 8, 22, -30]


def test_linear_fixture_never_enters(linear_bars):
    out = G.signal_flags(linear_bars)
    tail = out.orderBy(F.desc("ts")).first()
    assert tail["doi"] == pytest.approx(1000 / 3) and tail["d2oi"] == 0
    assert out.filter("entry").count() == 0
    assert T.trade_ledger(linear_bars).count() == 0


@pytest.mark.parametrize(
    "doi, d2oi, entry, exit, reason",
    [
        (-200.0, -501.0, True, False, None),
        (-200.0, -500.0, False, False, None),
        (-99.0, -600.0, True, True, "First derivative exit"),
        (-200.0, -499.0, False, True, "Second derivative exit"),
        (0.0, -600.0, False, True, "First derivative exit"),
        (-100.0, -600.0, True, False, None),
    ],
)
def test_main_rule(spark, doi, d2oi, entry, exit, reason):
    rule = share_of_ma()
    row = spark.createDataFrame([(doi, d2oi, 100000.0)], "doi double, d2oi double, oi_ma double").select(
        rule.entry().alias("e"), rule.exit().alias("x"), rule.exit_reason().alias("r")).first()
    assert (row.e, row.x, row.r) == (entry, exit, reason)


def test_unknown_values_give_no_signal(spark):
    rule = share_of_ma()
    d = spark.createDataFrame([(None, -9.0, 1.0), (-1.0, -9.0, None)], "doi double, d2oi double, oi_ma double")
    assert [tuple(r) for r in d.select(rule.entry(), (d.oi_ma > 0) & rule.exit()).collect()][1][0] is False
    assert d.select(rule.entry().alias("e")).filter("e").count() == 0


def test_levels_of_presets():
    assert absolute().entry_level == pytest.approx(-3000) and absolute().exit_first_level == pytest.approx(-30000)
    coarse = coarse_absolute(7, 5_000_000)
    assert (coarse.entry_level, coarse.exit_first_level) == (-35000, -350000)
    assert coarse_absolute(0.5, 2999).entry_level == -2  # rounded down
    with pytest.raises(ValueError):
        rule_of("nothing")
    with pytest.raises(ValueError):
        rule_of("held_ma").first_exit()


def test_stop_and_take(spark):
    d = spark.createDataFrame(
        [(100.0, 85.0), (100.0, 85.01), (100.0, 131.0), (0.0, 1.0), (None, 1.0)], "entry_price double, close double")
    assert [r.stop_take for r in G.stop_take_check(d).collect()] == ["STOP LOSS", None, "TAKE PROFIT", None, None]


def test_entry_and_exit_on_one_bar_flip(spark):
    flags = [(False, False), (True, True), (False, False), (True, True), (True, True), (False, True), (True, False)]
    d = spark.createDataFrame(
        [("X", DAY + dt.timedelta(minutes=i), e, x) for i, (e, x) in enumerate(flags)],
        "instrument string, ts timestamp_ntz, entry boolean, exit boolean")
    assert [p for (p,) in by_order(G.position_state(d), "position")] == [0, 1, 1, 0, 1, 0, 1]


def test_sessions(spark):
    times = ["08:59", "09:00", "09:14", "09:15", "15:29", "15:30", "15:40", "16:00"]
    d = spark.createDataFrame(
        [("X", dt.datetime.fromisoformat(f"2024-10-14 {t}:00")) for t in times], "instrument string, ts timestamp_ntz")
    out = by_order(S.market_sessions(d), "session", "session_start", "session_end", "minutes_in_session")
    assert [o[0] for o in out] == [
        "closed", "pre_market", "pre_market", "normal", "normal", "closed", "post_market", "closed"]
    assert [o[3] for o in out] == [0, 0, 1, 0, 1, 0, 0, 0]
    assert [o[1] for o in out] == [True, True, False, True, False, True, True, True]


def test_a_run_may_span_a_night(spark):
    times = ["2024-10-14 15:27", "2024-10-15 09:15", "2024-10-15 09:18"]
    d = spark.createDataFrame([("X", dt.datetime.fromisoformat(t)) for t in times], "instrument string, ts timestamp_ntz")
    assert [r[0] for r in by_order(S.market_sessions(d), "minutes_in_session")] == [0, 1, 2]
    assert [r[0] for r in by_order(S.market_sessions(d, reset_daily=True), "minutes_in_session")] == [0, 0, 1]


def test_strikes(spark):
    chain = spark.createDataFrame([("N", float(k)) for k in (24800, 24900, 25000, 25100, 25200)],
                                  "underlying string, strike double")
    spot = spark.createDataFrame([("N", 25040.0)], "underlying string, spot double")
    pick = lambda c, s, m: [r.strike for r in O.select_strikes(c, s, m, 3, ("underlying",)).orderBy("rank").collect()]
    assert pick(chain, spot, "short_covering") == [25000, 25100, 25200]
    assert pick(chain, spot, "long_unwinding") == [25000, 24900, 24800]
    assert pick(chain, spot, "sideways") == []
    two = spark.createDataFrame([("N", 100.0), ("N", 200.0)], "underlying string, strike double")
    tie = spark.createDataFrame([("N", 150.0)], "underlying string, spot double")
    assert pick(two, tie, "short_covering") == [100, 200]
    assert pick(two, tie, "long_unwinding") == [100]


def test_strikes_per_expiry_and_beyond_the_ends(spark):
    e1, e2 = DAY, DAY + dt.timedelta(days=7)
    chain = spark.createDataFrame(
        [("N", e1, 10.0), ("N", e1, 20.0), ("N", e2, 16.0), ("M", e1, 5.0)], "underlying string, expiry timestamp_ntz, strike double")
    spot = spark.createDataFrame([("N", 17.0), ("N", 1.0), ("N", 99.0), ("M", 4.0), ("Z", 1.0)], "underlying string, spot double")
    out = {(r.underlying, r.expiry, r.spot): r.atm_strike for r in O.atm_strike(chain, spot).collect()}
    cut = {(r.underlying, r.expiry, r.spot): r.atm_strike for r in O.atm_strike(chain, spot, slice_rows=2).collect()}
    assert cut == out
    assert out == {("N", e1, 17.0): 20, ("N", e2, 17.0): 16, ("N", e1, 1.0): 10, ("N", e2, 1.0): 16,
                   ("N", e1, 99.0): 20, ("N", e2, 99.0): 16, ("M", e1, 4.0): 5}


def test_days_to_expiry_round_down(spark):
    d = spark.createDataFrame([(DAY, DAY + dt.timedelta(hours=1)), (DAY, DAY - dt.timedelta(days=1, hours=23)), (DAY, DAY)],
                              "expiry timestamp_ntz, ts timestamp_ntz")
    assert [r.dte for r in O.days_to_expiry(d).collect()] == [-1, 1, 0]
    assert O.dte_filter(O.days_to_expiry(d)).count() == 1


def test_option_side(spark):
    chain = spark.createDataFrame([("CE",), ("PE",)], "option_type string")
    assert O.option_side(chain, "short_covering").first()[0] == "CE"
    assert O.option_side(chain, "long_unwinding").first()[0] == "PE"
    assert O.option_side(chain, "else").count() == 0


def test_environment(spark):
    at = lambda h: DAY + dt.timedelta(hours=h)
    signals = spark.createDataFrame([(at(9), 50.0), (at(10), 50.0), (at(11), 50.0), (at(11), 500.0), (at(12), 0.5), (at(13), 5.0)],
                                    "ts timestamp_ntz, close double")
    vix = spark.createDataFrame([(at(10), 20.0), (at(13), 26.0)], "ts timestamp_ntz, vix double")
    out = O.environment_filter(signals, vix)
    assert sorted(r.ts.hour for r in out.collect()) == [10, 11]
    cut = O.environment_filter(signals, vix, slice_rows=2)
    assert sorted(r.ts.hour for r in cut.collect()) == [10, 11]


def returns(spark, values):
    return spark.createDataFrame([("X", DAY + dt.timedelta(days=i), v) for i, v in enumerate(values)],
                                 "instrument string, ts timestamp_ntz, returns double")


def test_performance(spark):
    m = A.performance_metrics(returns(spark, [0.10, -0.05, 0.02, None])).first()
    assert m.total_return == pytest.approx(0.0659) and m.win_rate == pytest.approx(2 / 3)
    assert m.max_drawdown == pytest.approx(-0.05) and m.profit_factor == pytest.approx(1.2)
    assert m.total_trades == 3 and m.annualized_return == pytest.approx(1.0659**84 - 1)


def test_performance_edges(spark):
    flat = A.performance_metrics(returns(spark, [0.0, 0.0])).first()
    assert (flat.sharpe_ratio, flat.profit_factor, flat.avg_win, flat.win_rate) == (0, 0, 0, 0)
    assert A.performance_metrics(returns(spark, [None])).count() == 0
    assert A.performance_metrics(returns(spark, [0.1]), "missing").count() == 0
    ruin = A.performance_metrics(returns(spark, [-3.0, 0.0, 0.0, 0.0, 0.0])).first()
    assert ruin.annualized_return is None


def test_clean(spark):
    d = make_bars(spark, [
        ("X", DAY, 1.0, 0.5, 0.6, 1.0, 5, 5),
        ("X", DAY, 1.0, 2.0, 0.5, None, 5, 5),
        ("X", DAY, 1.0, 2.0, 0.5, 1.5, -5, -7),
        ("X", DAY, 1.0, 1.0, 1.0, 1.0, None, 3),
    ])
    out = sorted(((r.volume, r.oi) for r in C.clean_bars(d).collect()), key=str)
    assert out == [(0, 0), (None, 3)]
    report = C.bar_quality_report(d).first()
    assert tuple(report)[1:] == (4, 1, 1, 1, 1, 2)


def test_market_hours(spark):
    times = ["2024-10-14 15:30:00", "2024-10-14 15:30:01", "2024-10-14 15:30:00.5", "2024-10-19 10:00:00", "2024-10-14 09:15:00",
             "2024-10-14 09:14:59"]
    d = spark.createDataFrame([(dt.datetime.fromisoformat(t),) for t in times], "ts timestamp_ntz")
    assert sorted(str(r.ts) for r in C.market_hours_filter(d).collect()) == ["2024-10-14 09:15:00", "2024-10-14 15:30:00"]


def test_resample_edges_and_nulls(spark):
    rows = [(0, 1.0, 10), (1, 2.0, None), (3, 3.0, 30), (4, 4.0, None)]
    d = make_bars(spark, [("X", DAY + dt.timedelta(minutes=555 + m), c, c, c, c, 1, oi) for m, c, oi in rows])
    left = by_order(R.resample_bars(d, "3T"), "ts", "open", "close", "volume", "oi")
    start = DAY + dt.timedelta(minutes=555)
    assert left == [(start, 1.0, 2.0, 2, 10), (start + dt.timedelta(minutes=3), 3.0, 4.0, 2, 30)]
    right = by_order(R.resample_bars(d, "3min", edge="right"), "ts", "open", "close")
    assert right == [(start, 1.0, 1.0), (start + dt.timedelta(minutes=3), 2.0, 3.0)]  # the last bucket has no oi
    for bad in ("7min", "x", "0min", "3 fortnights"):
        with pytest.raises(ValueError):
            R.resample_bars(d, bad)
    with pytest.raises(ValueError):
        R.resample_bars(d.withColumn("name", F.lit("a")), "3T")
    assert R.resample_bars(d, "1 hour", agg={"close": "max"}).first()["close"] == 4.0


def test_rsi_extremes(spark):
    up = I.rsi(bars_of(spark, [1] * 20, [100.0 + i for i in range(20)]))
    assert [r[0] for r in by_order(up, "rsi")][12:15] == [None, 100.0, 100.0]
    flat = I.rsi(bars_of(spark, [1] * 20))
    assert {r[0] for r in by_order(flat, "rsi")} == {None}


def test_ema_equals_the_definition(spark):
    import pandas as pd

    closes = [100 + ((i * 37) % 23) - 0.3 * (i % 7) for i in range(700)]
    out = [r for r in by_order(I.macd(bars_of(spark, [1] * 700, closes)), "ema_12", "ema_26", "macd_signal")]
    s = pd.Series(closes)
    e12, e26 = s.ewm(span=12).mean(), s.ewm(span=26).mean()
    signal = (e12 - e26).ewm(span=9).mean()
    for i, (a, b, c) in enumerate(out):
        assert a == pytest.approx(e12[i], rel=1e-12) and b == pytest.approx(e26[i], rel=1e-12)
        assert c == pytest.approx(signal[i], rel=1e-9, abs=1e-9)


def test_zero_oi_and_zero_range(spark):
    d = bars_of(spark, [0, 0, 5, 0])
    assert [r[0] for r in by_order(I.oi_change(d), "oi_pct_change")] == [None, None, None, -1.0]
    assert {r[0] for r in by_order(I.bollinger(bars_of(spark, [1] * 25)), "bb_position")} == {None}


def test_ols_forecast(spark):
    out = by_order(I.rolling_ols_forecast(bars_of(spark, [100, 110, 120, 130, 160, 100])), "next_value", "slope", "deviates")
    assert out[2] == (None, None, False)
    assert out[3][0] == pytest.approx(130) and out[3][1] == pytest.approx(10) and out[3][2] is False
    assert out[4][0] == pytest.approx(140) and out[4][2] is True
    assert out[5][2] is False  # forecast above the value


def fold(bars, stop, take, period, entry, first, second):
    """The state machine, bar by bar, as specified."""
    trades, pending, price, ois = [], None, None, []
    entered = None
    for t, (ts, open_, close, oi) in enumerate(bars):
        ois.append(oi)
        if pending == "BUY":
            price, entered = open_, ts
        elif pending:
            trades.append((entered, price, ts, open_, pending))
            price = None
        pending = None
        if len(ois) < period:
            continue
        ma = sum(ois[-period:]) / period
        doi = 0.0 if t == 0 else (ois[-1] - ois[-2]) / 3
        d2 = 0.0 if t == 0 else (ois[-1] + (ois[-3] if t > 1 else ois[-2]) - 2 * ois[-2]) / 9
        if price is None:
            if doi < 0 and d2 < -entry * ma:
                pending = "BUY"
        elif close <= price * (1 - stop):
            pending = "STOP LOSS"
        elif close >= price * (1 + take):
            pending = "TAKE PROFIT"
        elif doi > -first * ma:
            pending = "First derivative exit"
        elif d2 > -second * ma:
            pending = "Second derivative exit"
    return trades, (entered, price) if price is not None else None


@pytest.mark.parametrize("spec", [SeriesSpec(), SeriesSpec(slice_rows=60)], ids=["whole", "cut"])
@pytest.mark.parametrize(
    "stop, take, entry, first, second",
    [(0.15, 0.30, 0.005, 0.001, 0.005), (0.02, 0.03, 0.001, 0.02, -0.02), (0.05, 0.08, 0.0005, 0.03, -0.05)],
)
def test_ledger_equals_the_fold(skewed_bars, spec, stop, take, entry, first, second):
    params = dict(entry=entry, exit_first=-first if first < 0 else first, exit_second=second, ma_period=10, stop_loss=stop,
                  take_profit=take)
    got, still_open = {}, {}
    for r in T.all_trades(skewed_bars, spec=spec, **params).collect():
        if r.exit_ts is None:
            still_open[r.instrument] = (r.entry_ts, r.entry_price)
        else:
            got.setdefault(r.instrument, []).append(
                (r.trade_no, r.entry_ts, r.entry_price, r.exit_ts, r.exit_price, r.exit_reason))
    series = {}
    for r in skewed_bars.orderBy("instrument", "ts").collect():
        series.setdefault(r.instrument, []).append((r.ts, r.open, r.close, r.oi))
    total = 0
    for name, bars in series.items():
        trades, held = fold(bars, stop, take, 10, entry, first, second)
        numbered = [(i + 1, *t) for i, t in enumerate(trades)]
        assert sorted(got.get(name, [])) == numbered
        assert still_open.get(name) == held
        total += len(trades)
    assert total > 50


def test_stateless_positions_equal_the_fold(skewed_bars):
    flagged = skewed_bars.withColumns({"entry": F.col("volume") % 3 == 0, "exit": F.col("volume") % 5 < 2})
    state = {}
    for r in G.position_state(flagged).orderBy("instrument", "ts").collect():
        held = state.get(r.instrument, 0)
        held = (0 if r.exit else 1) if held else (1 if r.entry else 0)
        state[r.instrument] = held
        assert r.position == held


def test_trade_summary_and_running_rate(spark):
    trades = spark.createDataFrame(
        [("X", i + 1, DAY + dt.timedelta(days=i), p) for i, p in enumerate([5.0, -2.0, 0.0, 1.0])] + [("X", 5, None, None)],
        "instrument string, trade_no bigint, exit_ts timestamp_ntz, pnl double")
    s = A.trade_summary(trades).first()
    assert (s.total_trades, s.winning_trades, s.losing_trades, s.max_win, s.max_loss) == (4, 2, 2, 5.0, -2.0)
    assert s.win_rate_pct == 50 and s.avg_loss == -1 and s.profit_factor == 3
    assert [r[0] for r in by_order(A.running_win_rate(trades), "win_rate_pct", order=("trade_no",))] == [
        100, 50, pytest.approx(100 / 3), 50]


def test_lookup(spark):
    d = spark.createDataFrame([(1,), (2,), (3,)], "instrument bigint")
    names = spark.createDataFrame([(1, "B"), (1, "A"), (2, "C")], "instrument_token bigint, tradingsymbol string")
    out = {r.instrument: (r.tradingsymbol, r.label) for r in L.instrument_lookup(d, names).collect()}
    assert out == {1: ("A", "A"), 2: ("C", "C"), 3: (None, "Token-3")}


def test_history_slice_includes_both_ends(linear_bars):
    as_of = dt.datetime(2024, 10, 14, 10, 15)
    out = L.history_slice(linear_bars, "X", as_of, 5, include_oi=False)
    assert out.count() == 6 and "oi" not in out.columns


def test_segments(spark):
    d = bars_of(spark, [100, 110, 120, 130, 60, 50, 40, 30])
    got = [(r.start_row, r.end_row) for r in piecewise_segments(d, max_deviation=0.05, min_segment_len=2).orderBy("start_row").collect()]
    assert got == [(0, 3), (4, 7)]
    one = piecewise_segments(bars_of(spark, [7]))
    assert [(r.start_row, r.end_row) for r in one.collect()] == [(0, 0)]


def test_segments_equal_the_plain_walk(skewed_bars):
    import numpy as np

    def walk(y, dev, least):
        out, start = [], 0
        for i in range(1, len(y)):
            if i - start + 1 < least:
                continue
            x = np.arange(start, i + 1)
            m, c = np.polyfit(x, y[start:i + 1], 1)
            if (np.abs(y[start:i + 1] - (m * x + c)) / y[start:i + 1]).max() > dev:
                out.append((start, i - 1))
                start = i
        return [*out, (start, len(y) - 1)]

    got = {}
    for r in piecewise_segments(skewed_bars, max_deviation=0.04, min_segment_len=3, by=("instrument",)).collect():
        got.setdefault(r.instrument, []).append((r.start_row, r.end_row))
    for name, found in got.items():
        y = np.array([r.oi for r in skewed_bars.filter(F.col("instrument") == name).orderBy("ts").collect()], dtype=float)
        assert sorted(found) == walk(y, 0.04, 3)


def test_local_micros(spark):
    d = spark.createDataFrame([(dt.datetime(1970, 1, 2, 0, 0, 1, 5),)], "ts timestamp_ntz")
    assert d.select(local_micros(F.col("ts"))).first()[0] == 86_401_000_005


def test_exponential_average_over_a_gap(spark):
    d = bars_of(spark, [1000] * 6, closes=[0.0, 1.0, 2.0, 9.0, 4.0, 5.0])
    holed = d.withColumn("price", F.when(F.col("close") != 9.0, F.col("close")))
    got = [r[0] for r in by_order(I.ema(holed, (3,), "price"), "ema_3")]
    assert got == pytest.approx([0.0, 2 / 3, 10 / 7, 10 / 7, 3.217391304, 4.254545455], abs=1e-9)
    late = d.withColumn("price", F.when(F.col("close") > 3.0, F.col("close")))
    assert [r[0] for r in by_order(I.ema(late, (3,), "price"), "ema_3")][:3] == [None] * 3


def test_cap_over_all_series(spark):
    a = bars_of(spark, [1000] * 6, name="A")
    b = bars_of(spark, [1000] * 6, name="B")
    both = a.unionByName(b).withColumn("entry", F.lit(True))
    got = [r for r in by_order(G.trade_cap(both, 5, across=True), "instrument", "entry_no", order=("entry_no",))]
    assert got == [("A", 1), ("B", 2), ("A", 3), ("B", 4), ("A", 5)]
    assert G.trade_cap(both, 5, "day", across=True).count() == 5


def test_rows_without_an_instrument_are_a_series(spark):
    """What is joined back to its series is joined to that of no instrument as well."""
    rows = [(name, i, float(v), t) for name in ("A", None) for i, (v, t) in enumerate([(1, 0.5), (2, -0.5), (3, 0.0), (4, 0.5), (50, 0.1)])]
    d = spark.createDataFrame(rows, "instrument string, nth int, volatility double, trend double")
    labelled = A.regime_label(d)
    by_name = {n: [r.regime for r in labelled.orderBy("nth").collect() if r.instrument == n] for n in ("A", None)}
    assert by_name["A"] == by_name[None] and "Unknown" not in by_name[None]
    shares = A.regime_distribution(labelled).collect()
    assert sum(r.pct for r in shares if r.instrument is None) == pytest.approx(100.0)
    bins = A.derivative_histogram(d, "volatility", 4).filter("instrument is null").orderBy("bin").collect()
    assert [r.n for r in bins] == [4, 0, 0, 1]
    lines = A.fitted_values(d, "nth", "trend", ("instrument",)).collect()
    assert len({round(r.fitted, 9) for r in lines if r.nth == 2}) == 1
    trades = T.all_trades(bars_of(spark, [1000 - (i % 7) * 90 for i in range(200)], name=None), ma_period=5)
    last = spark.createDataFrame([(None, 5.0)], "instrument string, last_close double")
    assert trades.count() and A.accounts(trades, last, 100.0, ("instrument",)).first().total_trades > 0
