"""A replayed stream must give what the batch operators give."""

import datetime as dt
import random
import time

import pytest
from conftest import make_bars, noisy_rows
from helpers import assert_same, by_order
from pyspark.sql import functions as F

from tidemark.functions.rules import absolute
from tidemark.operators import resample as R
from tidemark.operators import signals as G
from tidemark.plans.storage import new_folder
from tidemark.streaming import bars as B
from tidemark.streaming import live as V
from tidemark.streaming import sinks as S

RULE = dict(sensitivity=0.001, feeling=3e6)


def as_files(spark, bars, parts):
    """The bars in time order, one file per part."""
    path = new_folder(spark, "in")
    rows = sorted((tuple(r) for r in bars.collect()), key=lambda r: r[1])
    step = -(-len(rows) // parts)
    for i in range(0, len(rows), step):
        spark.createDataFrame(rows[i:i + step], bars.schema).coalesce(1).write.mode("append").parquet(path)
    return path


def stream_of(spark, bars, parts=6):
    return B.event_time(B.read_stream(spark, as_files(spark, bars, parts), bars.schema, files_per_trigger=1))


def run(spark, stream):
    path = new_folder(spark, "out")
    S.write_table(stream, path, new_folder(spark, "ckpt"), availableNow=True).awaitTermination()
    out = spark.read.schema(stream.schema).parquet(path)
    return out.withColumns({n: F.col(n).cast("timestamp_ntz") for n, t in out.dtypes if t == "timestamp"})


def two_series(spark):
    return make_bars(spark, noisy_rows("A", 300, 21) + noisy_rows("B", 250, 22))


def test_signals_over_many_batches(spark):
    bars = two_series(spark)
    for preset, params in (("absolute", RULE), ("share_of_ma", dict(ma_period=20)), ("absolute_both", RULE)):
        live = run(spark, V.stream_signals(stream_of(spark, bars), preset, **params))
        batch = G.classify_signal(bars, preset, **params).select(*live.columns)
        assert_same(live, batch)


def test_round_trips_over_many_batches(spark):
    bars = two_series(spark)
    live = run(spark, V.stream_positions(stream_of(spark, bars), **RULE))
    orders = G.live_orders(G.classify_signal(bars, absolute(**RULE)))
    sells = by_order(orders.filter("side = 'SELL'"), "instrument", "ts", "close")
    buys = by_order(orders.filter("side = 'BUY'"), "instrument", "ts", "close")
    assert len(sells) > 20
    assert by_order(live, "instrument", "exit_ts", "exit_price", order=("instrument", "exit_ts")) == sells
    entered = by_order(live, "instrument", "entry_ts", "entry_price", order=("instrument", "entry_ts"))
    assert set(entered) <= set(buys) and len(buys) - len(entered) <= 2
    for r in live.collect():
        assert r.pnl == (r.exit_price - r.entry_price) * 25
        assert r.minutes_held == (r.exit_ts - r.entry_ts).total_seconds() / 60


def test_cap_per_run_and_day(spark):
    bars = two_series(spark)
    capped = run(spark, V.stream_trade_cap(stream_of(spark, bars), 3, "run", **RULE))
    buys = capped.filter("action = 'BUY'").groupBy("instrument").count().collect()
    assert {r["count"] for r in buys} == {3}
    daily = run(spark, V.stream_trade_cap(stream_of(spark, bars), 2, "day", **RULE))
    per_day = daily.filter("action = 'BUY'").groupBy("instrument", F.to_date("ts")).count()
    assert per_day.agg(F.max("count")).first()[0] == 2 and per_day.count() > 10


def test_repeated_bars_are_skipped(spark):
    bars = two_series(spark)
    path = as_files(spark, bars, 3)
    bars.coalesce(1).write.mode("append").parquet(path)  # everything once more
    stream = B.event_time(B.read_stream(spark, path, bars.schema, files_per_trigger=1))
    live = run(spark, V.stream_signals(stream, **RULE))
    assert_same(live, G.classify_signal(bars, absolute(**RULE)).select(*live.columns))


# minutes of the bars in each file, whatever batches they make up
REPLAYS = {
    "in order": [[0, 3, 6, 9, 12]],
    "late by one": [[0, 3, 9], [6, 12]],
    "one file with a repetition": [[0, 3, 6, 6, 9, 12]],
    "a repetition in the next file": [[0, 3, 6], [6, 9, 12]],
    "backwards": [[12], [9], [6], [3], [0]],
}


@pytest.mark.parametrize("name", REPLAYS)
def test_results_do_not_depend_on_batches(spark, name):
    """Held for a quarter of an hour, bars may come in any order; what repeats a time is counted, not lost."""
    start = dt.datetime(2024, 1, 2, 10)
    oi = {0: 1000, 3: 990, 6: 900, 9: 1400, 12: 1300, 60: 1}

    def bar(minute):
        return ("A", start + dt.timedelta(minutes=minute), 1.0, 1.0, 1.0, float(100 + minute), 1, oi[minute])

    schema = make_bars(spark, [bar(0)]).schema
    path = new_folder(spark, "replay")
    for minutes in [*REPLAYS[name], [60]]:  # the last bar moves time on
        spark.createDataFrame([bar(m) for m in minutes], schema).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.01)

    def stream():
        return B.event_time(B.read_stream(spark, path, schema, files_per_trigger=1))

    rule = dict(sensitivity=1.0, feeling=10.0)
    live = run(spark, V.stream_signals(stream(), delay=900, **rule))
    bars = spark.createDataFrame([bar(m) for m in (0, 3, 6, 9, 12)], schema)
    assert_same(live, G.classify_signal(bars, absolute(**rule)).select(*live.columns))
    skipped = run(spark, V.stream_skipped(stream(), delay=900, **rule))
    repeated = sum(map(len, REPLAYS[name])) - 5
    assert [r.ts.minute for r in skipped.collect()] == [6] * repeated


def test_late_bars_are_returned(spark):
    start = dt.datetime(2024, 1, 2, 10)
    bars = [("A", start + dt.timedelta(minutes=m), 1.0, 1.0, 1.0, float(m), 1, 100 + m) for m in (0, 3, 9, 6, 12)]
    schema = make_bars(spark, bars).schema
    path = new_folder(spark, "late-bars")
    for part in (bars[:3], bars[3:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.01)
    live = run(spark, V.live_bars(B.event_time(B.read_stream(spark, path, schema, files_per_trigger=1))))
    assert by_order(live, "close", "skipped") == [(0.0, False), (3.0, False), (6.0, True), (9.0, False), (12.0, False)]
    late = live.filter("skipped").first()
    assert late.signal is None and late.action is None and late.nth is None


def test_quiet_instruments_are_released(spark):
    """Bars come up to 12 minutes late; A goes on long after B's last bar, which nothing of B's own releases."""
    start = dt.datetime(2024, 1, 2, 10)
    rng = random.Random(4)

    def bar(name, i):
        return (name, start + dt.timedelta(minutes=3 * i), 1.0, 1.0, 1.0, float(i), 1, 1000 + (i * 37) % 101)

    rows = [bar("A", i) for i in range(60)] + [bar("B", i) for i in range(25)] + [bar(None, i) for i in range(25)]
    late = sorted(rows, key=lambda r: (r[1] + dt.timedelta(minutes=rng.randrange(12)), str(r[0])))
    schema = make_bars(spark, rows).schema
    path = new_folder(spark, "quiet")
    for i in range(0, len(late), 23):
        spark.createDataFrame(late[i:i + 23], schema).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.01)
    stream = B.event_time(B.read_stream(spark, path, schema, files_per_trigger=1))
    live = run(spark, V.live_bars(stream, delay=900, sensitivity=1.0, feeling=10.0))
    assert live.filter("skipped").count() == 0
    want = G.classify_signal(make_bars(spark, rows), absolute(sensitivity=1.0, feeling=10.0)).select("instrument", "ts", "close", "doi", "d2oi", "signal", "reason")
    end = start + dt.timedelta(minutes=3 * 59 - 15)
    assert_same(live.select(*want.columns), want.filter(F.col("ts") <= F.lit(end)))
    assert live.filter("instrument = 'B'").count() == live.filter("instrument is null").count() == 25


@pytest.mark.parametrize("parts", [1, 5])
@pytest.mark.parametrize("per,cap", [("run", 9), ("day", 2), ("run", 0)])
def test_one_cap_for_all_instruments(spark, parts, per, cap):
    bars = two_series(spark).unionByName(make_bars(spark, noisy_rows(None, 120, 23)))
    end = bars.agg(F.max("ts") + F.expr("INTERVAL 2 DAYS")).first()[0]
    closing = make_bars(spark, [("end", end, 1.0, 1.0, 1.0, 1.0, 1, 1)])  # moves time on
    stream = stream_of(spark, bars.unionByName(closing), parts)
    live = run(spark, V.live_bars(stream, **RULE))  # its files are in no order, as they hold an instrument each
    live = run(spark, V.stream_cap_across(stream_of(spark, live, parts), cap, per, delay=3600))
    orders = G.live_orders(G.classify_signal(bars, absolute(**RULE))).withColumn("entry", F.col("side") == "BUY")
    entered = G.trade_cap(orders, cap, per, across=True).select("instrument", "ts", "close", "entry_no")
    assert_same(live.filter("action = 'BUY'").select(*entered.columns), entered)
    assert entered.count() == 9 if per == "run" and cap else entered.count() >= cap
    # every trade that was entered is left, unless it is open at the end; no other is
    left = {(r.instrument, r.ts) for r in orders.filter("side = 'SELL'").collect()}
    sold = [(r.instrument, r.ts, r.entry_no) for r in live.filter("action = 'SELL'").collect()]
    assert {s[:2] for s in sold} <= left and entered.count() - 3 <= len(sold) <= entered.count()
    at = {(r.instrument, r.ts): r.entry_no for r in entered.collect()}
    for name, ts, number in sold:
        newest = max(t for n, t in at if n == name and t < ts)
        assert per == "day" or at[name, newest] == number


def test_late_orders_are_counted_when_they_come(spark):
    schema = "instrument string, ts timestamp, action string, close double, entry_ts timestamp"
    at = lambda m: dt.datetime(2024, 1, 2, 10, m)
    parts = [[("A", at(0), "BUY", 1.0, at(0)), ("B", at(30), "BUY", 2.0, at(30))], [("C", at(5), "BUY", 3.0, at(5)), ("D", None, "BUY", 9.0, None)],
             [("A", at(31), "SELL", 4.0, at(0)), ("D", at(50), None, 5.0, None), ("B", at(32), "SELL", 2.0, at(30)), ("C", at(33), "SELL", 2.0, at(5))],
             [("E", at(2), "BUY", 7.0, at(2)), ("D", at(59), None, 5.0, None)]]
    path = new_folder(spark, "late-orders")
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.01)
    stream = B.read_stream(spark, path, spark.createDataFrame([], schema).schema, files_per_trigger=1)
    got = by_order(run(spark, V.stream_cap_across(stream, 4, delay=60)), "instrument", "action", "entry_no", order=("ts",))
    assert got == [("A", "BUY", 1), ("E", "BUY", 4), ("C", "BUY", 2), ("B", "BUY", 3), ("A", "SELL", 1), ("B", "SELL", 3), ("C", "SELL", 2)]


def test_resample_counts_late_rows_within_the_delay(spark):
    bars = two_series(spark)
    swapped = bars.withColumn("shift", F.col("volume") % 2)
    rows = sorted((tuple(r) for r in swapped.collect()), key=lambda r: r[1] + dt.timedelta(minutes=5 * r[-1]))
    path = new_folder(spark, "late")
    for i in range(0, len(rows), 120):
        part = spark.createDataFrame(rows[i:i + 120], swapped.schema).drop("shift")
        part.coalesce(1).write.mode("append").parquet(path)
    stream = B.event_time(B.read_stream(spark, path, bars.schema, files_per_trigger=1))
    live = run(spark, B.stream_resample(stream, "15min", "15 minutes"))
    end = bars.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=30)
    batch = R.resample_bars(bars, "15min").filter(F.col("ts") <= F.lit(end).cast("timestamp_ntz"))
    assert_same(live, batch.select(*live.columns))


def test_gate_and_events(spark):
    bars = two_series(spark)
    gated = run(spark, B.stream_market_gate(stream_of(spark, bars, 2)))
    from tidemark.operators.clean import market_hours_filter

    assert_same(gated, market_hours_filter(bars).select(*gated.columns))
    path = new_folder(spark, "events")
    live = V.live_bars(stream_of(spark, bars), **RULE)
    S.stream_event_sink(live, path, new_folder(spark, "ckpt"), availableNow=True).awaitTermination()
    kinds = {r.kind: r["count"] for r in spark.read.parquet(path).groupBy("kind").count().collect()}
    orders = G.live_orders(G.classify_signal(bars, absolute(**RULE)))
    assert kinds["ORDER"] == kinds["SIGNAL"] == orders.count()
    assert kinds["TRADE CLOSED"] == orders.filter("side = 'SELL'").count()
