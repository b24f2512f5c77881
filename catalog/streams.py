"""Streams: the tables are replayed as files, and what the stream wrote is read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.registry import query
from catalog.signals import LIVE
from catalog.views import EVENTS_BARS, INTRADAY, events_bars, table
from tidemark.plans.storage import new_folder
from tidemark.streaming import bars as B
from tidemark.streaming import live as V
from tidemark.streaming import sinks as S

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
TICKS = INTRADAY.__class__(ties=("event_id",))
BAR_COLUMNS = ["instrument", "ts", "open", "high", "low", "close", "volume", "oi"]


def ticks(spark, folder, pattern="events.parquet"):
    """The events as ticks: every price column is the value."""
    events = B.event_time(B.read_stream(spark, folder, EVENTS, pattern))
    value = F.col("value")
    return events.select(
        F.col("event_type").alias("instrument"), "ts", "event_id", *[value.alias(c) for c in ("open", "high", "low", "close")],
        F.get_json_object("props", "$.k").cast("bigint").alias("volume"),
        (F.floor(value * 1000) + 100000).alias("oi"),
    )


def replay(spark, stream, name):
    """Run a stream over all that is there, and read what it wrote."""
    path = new_folder(spark, name)
    S.write_table(stream, path, new_folder(spark, f"{name}-checkpoint"), availableNow=True).awaitTermination()
    out = spark.read.schema(stream.schema).parquet(path)
    times = [f.name for f in stream.schema if isinstance(f.dataType, T.TimestampType)]
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


def bar_stream(spark, sf_dir, arrival=None, closing=False):
    """Bars as they would be appended to a table: in three parts by time of arrival, one after the other, each a batch of its own.

    With ``closing`` a bar of no known instrument follows a day later, which moves time past all others.
    """
    path = new_folder(spark, "bars")
    bars = events_bars(spark, sf_dir)
    begin, end = bars.agg(F.min("ts"), F.max("ts")).first()
    third, arrives = (end - begin) / 3, F.col("ts") if arrival is None else arrival
    for since, until in ((None, begin + third), (begin + third, begin + 2 * third), (begin + 2 * third, None)):
        part = bars if since is None else bars.where(arrives >= F.lit(since))
        part = part if until is None else part.where(arrives < F.lit(until))
        part.coalesce(1).write.mode("append").parquet(path)
    if closing:
        bars.agg((F.max("ts") + F.expr("INTERVAL 1 DAY")).alias("ts")).select(
            *[F.col("ts") if f.name == "ts" else F.lit("(end)" if f.name == "instrument" else None).cast(f.dataType).alias(f.name) for f in bars.schema]
        ).write.mode("append").parquet(path)
    return B.event_time(B.read_stream(spark, path, bars.schema, files_per_trigger=1))


def closed_bars(spark, sf_dir):
    """All bars as a stream: a last tick a day later moves the watermark past the end of every other one's bar."""
    path = new_folder(spark, "ticks")
    events = table(spark, sf_dir, "events")
    events.write.parquet(path)
    end = events.agg((F.max("ts") + F.expr("INTERVAL 1 DAY")).alias("ts"), F.max("event_id").alias("event_id"))
    end.select("event_id", "ts", *[F.lit(None).cast(events.schema[c].dataType).alias(c) for c in events.columns[2:]]).write.mode("append").parquet(path)
    return B.stream_resample(ticks(spark, path, None), "3min", "15 minutes", TICKS)


@query("stream_resample", f"WITH {EVENTS_BARS} SELECT * FROM events_bars")
def stream_resample(spark, sf_dir):
    return replay(spark, closed_bars(spark, sf_dir), "stream-bars").select(*BAR_COLUMNS)


@query("stream_market_gate", """SELECT event_id, ts, event_type FROM events
WHERE isodow(ts) <= 5 AND CAST(ts AS TIME) BETWEEN TIME '09:15:00' AND TIME '15:30:00'""")
def stream_market_gate(spark, sf_dir):
    events = B.event_time(B.read_stream(spark, sf_dir, EVENTS, "events.parquet"))
    return replay(spark, B.stream_market_gate(events).select("event_id", "ts", "event_type"), "stream-gate")


@query("stream_signals", f"""WITH {EVENTS_BARS}, {LIVE.format(bars='events_bars')}
SELECT instrument, ts, close, doi, d2oi, signal, reason FROM c""")
def stream_signals(spark, sf_dir):
    """Two streams: ticks to a table of bars, and that table to signals."""
    bars = closed_bars(spark, sf_dir)
    path = new_folder(spark, "stream-bars")
    S.write_table(bars, path, new_folder(spark, "stream-bars-checkpoint"), availableNow=True).awaitTermination()
    again = B.read_stream(spark, path, bars.schema)
    out = replay(spark, V.stream_signals(again, spec=INTRADAY), "stream-signals")
    return out.select("instrument", "ts", "close", "doi", "d2oi", "signal", "reason")


@query("stream_signals_late", f"""WITH {EVENTS_BARS}, {LIVE.format(bars='events_bars')}
SELECT instrument, ts, close, doi, d2oi, signal, reason FROM c""")
def stream_signals_late(spark, sf_dir):
    """Bars that arrive up to twelve minutes late, out of order; the closing bar is of another instrument."""
    late = F.col("ts") + F.make_dt_interval(mins=(F.col("oi") % 5 * 3).cast("int"))
    stream = bar_stream(spark, sf_dir, late, closing=True)
    out = replay(spark, V.stream_signals(stream, spec=INTRADAY, delay=900), "stream-signals-late")
    return out.select("instrument", "ts", "close", "doi", "d2oi", "signal", "reason")


ROUND_TRIPS = """p AS (SELECT *, coalesce(last_value(CASE signal WHEN 'BUY' THEN 1 WHEN 'SELL' THEN 0 END IGNORE NULLS)
  OVER (PARTITION BY instrument ORDER BY ts ROWS UNBOUNDED PRECEDING), 0) AS pos FROM c),
o AS (SELECT *, CASE WHEN pos = 1 THEN 'BUY' ELSE 'SELL' END AS action FROM (SELECT *,
  coalesce(lag(pos) OVER (PARTITION BY instrument ORDER BY ts), 0) AS before FROM p) WHERE pos <> before),
t AS (SELECT *, lag(ts) OVER w AS entry_ts, lag(close) OVER w AS entry_price,
  (row_number() OVER w + 1) // 2 AS entry_no FROM o WINDOW w AS (PARTITION BY instrument ORDER BY ts))"""


@query("stream_positions", f"""WITH {EVENTS_BARS}, {LIVE.format(bars='events_bars')}, {ROUND_TRIPS}
SELECT instrument, entry_ts, entry_price, ts AS exit_ts, close AS exit_price, (close - entry_price) * 25 AS pnl,
  epoch(ts - entry_ts) / 60.0::DOUBLE AS minutes_held, reason AS exit_reason FROM t WHERE action = 'SELL'""")
def stream_positions(spark, sf_dir):
    return replay(spark, V.stream_positions(bar_stream(spark, sf_dir), spec=INTRADAY), "stream-positions")


@query("stream_trade_cap", f"""WITH {EVENTS_BARS}, {LIVE.format(bars='events_bars')}, {ROUND_TRIPS}
SELECT instrument, ts, action, close, entry_no FROM t WHERE entry_no <= 7""")
def stream_trade_cap(spark, sf_dir):
    return replay(spark, V.stream_trade_cap(bar_stream(spark, sf_dir), 7, spec=INTRADAY), "stream-cap")


@query("stream_trade_cap_across", f"""WITH {EVENTS_BARS}, {LIVE.format(bars='events_bars')}, {ROUND_TRIPS},
n AS (SELECT instrument, entry_no, row_number() OVER (ORDER BY ts, instrument) AS nth FROM t WHERE action = 'BUY')
SELECT t.instrument, ts, action, close, n.nth AS entry_no FROM t JOIN n ON n.instrument = t.instrument AND n.entry_no = t.entry_no WHERE n.nth <= 25""")
def stream_trade_cap_across(spark, sf_dir):
    """Two streams: bars to a table of live bars, and that table to the orders that one counter lets through."""
    live = V.live_bars(bar_stream(spark, sf_dir, closing=True), cap=25, spec=INTRADAY)
    path = new_folder(spark, "stream-live")
    S.write_table(live, path, new_folder(spark, "stream-live-checkpoint"), availableNow=True).awaitTermination()
    again = B.read_stream(spark, path, live.schema)
    return replay(spark, V.stream_cap_across(again, 25, spec=INTRADAY, delay=900), "stream-cap-across")


@query("stream_event_sink", f"""WITH {EVENTS_BARS}, {LIVE.format(bars='events_bars')}, {ROUND_TRIPS}
SELECT 'SIGNAL' AS kind, instrument, ts, action, close AS price, NULL::BIGINT AS quantity, NULL::DOUBLE AS pnl,
  NULL AS status, reason FROM t
UNION ALL SELECT 'ORDER', instrument, ts, action, close, 25, NULL, NULL, reason FROM t
UNION ALL SELECT 'TRADE CLOSED', instrument, ts, action, close, NULL, (close - entry_price) * 25,
  CASE WHEN close > entry_price THEN 'PROFIT' ELSE 'LOSS' END, reason FROM t WHERE action = 'SELL'""")
def stream_event_sink(spark, sf_dir):
    path = new_folder(spark, "stream-events")
    live = V.live_bars(bar_stream(spark, sf_dir), spec=INTRADAY)
    S.stream_event_sink(live, path, new_folder(spark, "stream-events-checkpoint"), availableNow=True).awaitTermination()
    return spark.read.parquet(path).select("kind", "instrument", "ts", "action", "price", "quantity", "pnl", "status", "reason")
