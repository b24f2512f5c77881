"""Files in and out. The bars of the given tables are written by Spark and read back by the operator."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.signals import LIVE
from catalog.trades import recursive, walk
from catalog.views import INTRADAY, events_bars, with_events
from tidemark.operators.signals import classify_signal, live_orders
from tidemark.operators.trades import all_trades
from tidemark.schema import BAR_TS_FORMAT
from tidemark.sources import bars as B
from tidemark.sources import events as E
from tidemark.sources.files import bar_file_profile as profile
from tidemark.sources.files import list_bar_files as list_files
from tidemark.plans.storage import new_folder

ALL = "instrument, ts, open, high, low, close, volume, oi"
# instruments as folders, one file each; the instrument is not in the file
FOLDER = r"instrument=([^/]+)/"


def _csv_folders(spark, sf_dir, columns=("ts", "open", "high", "low", "close", "volume", "oi"), header=True, lost=None):
    """One CSV file per instrument; bars that are ``lost`` have no valid time."""
    path = new_folder(spark, "bars-csv")
    bars = events_bars(spark, sf_dir).withColumn("ts", F.date_format("ts", BAR_TS_FORMAT))
    if lost is not None:
        bars = bars.withColumn("ts", F.when(lost, F.lit("lost")).otherwise(F.col("ts")))
    one_file_each = bars.select("instrument", *columns).repartition("instrument")
    one_file_each.write.option("header", header).partitionBy("instrument").csv(path)
    return path


@query("read_bars_csv", with_events(f"SELECT {ALL}, close - open AS body FROM events_bars"))
def read_bars_csv(spark, sf_dir):
    path = new_folder(spark, "bars-csv")
    bars = events_bars(spark, sf_dir).withColumn("body", F.col("close") - F.col("open"))
    B.write_bars(bars, path, "csv", by_day=False)
    return B.read_bars_csv(spark, path, extra_types={"instrument": "string"})


@query("normalize_bar_columns", with_events(f"SELECT {ALL.replace(', oi', '')}, oi, oi AS openinterest FROM events_bars"))
def normalize_bar_columns(spark, sf_dir):
    bars = events_bars(spark, sf_dir).withColumnsRenamed(
        {"open": "o", "high": "High", "low": "l", "close": "Close", "volume": "v", "oi": "openinterest"}
    )
    return B.normalize_bar_columns(bars)


@query("read_bars_positional", with_events("SELECT ts, open, high, low, close, volume, oi FROM events_bars"))
def read_bars_positional(spark, sf_dir):
    path = _csv_folders(spark, sf_dir, header=False)
    return B.read_bars_positional(spark, path, recursiveFileLookup=True)


@query("read_bars_positions_given", with_events("SELECT ts, open, high, low, close, volume, 0::BIGINT AS oi FROM events_bars"))
def read_bars_positions_given(spark, sf_dir):
    path = _csv_folders(spark, sf_dir, ("volume", "close", "low", "high", "open", "ts"), header=False)
    at = {"volume": 0, "close": 1, "low": 2, "high": 3, "open": 4, "ts": 5, "oi": -1}
    return B.read_bars_positional(spark, path, at, recursiveFileLookup=True)


@query("read_bars_directory", with_events(f"SELECT {ALL} FROM events_bars"))
def read_bars_directory(spark, sf_dir):
    """Files with irregular names, some with other columns in another order; a table says which instrument each holds."""
    path = new_folder(spark, "bars-csv")
    bars = events_bars(spark, sf_dir).withColumn("body", F.col("close") - F.col("open"))
    bars = bars.withColumn("ts", F.date_format("ts", BAR_TS_FORMAT)).repartition("instrument")
    other = F.length("instrument") % 2 == 0
    for name, some, columns in (
        ("plain", ~other, ("ts", "open", "high", "low", "close", "volume", "oi")),
        ("other", other, ("ts", "close", "oi", "high", "body", "low", "open", "volume")),
    ):
        bars.filter(some).select("instrument", *columns).write.option("header", True).partitionBy("instrument").csv(f"{path}/{name}")
    files = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter="*.csv").load(path)
    names = files.select(
        F.col("_metadata.file_path").alias("file_path"), F.regexp_extract("path", FOLDER, 1).alias("instrument")
    )
    return B.read_bars_directory(spark, path, names, recursiveFileLookup=True).select(*ALL.split(", "))


@query("list_bar_files", with_events("SELECT 'part.csv' AS file_name FROM events_bars GROUP BY instrument"))
def list_bar_files(spark, sf_dir):
    """The CSV files below a folder, one for each instrument, beside files of another kind; Spark numbers the names."""
    path = _csv_folders(spark, sf_dir)
    events_bars(spark, sf_dir).limit(1).write.mode("append").parquet(path)
    found = list_files(spark, path, "*.csv", recursive=True)
    return found.select(F.regexp_replace("file_name", "^part-.*[.]csv$", "part.csv").alias("file_name"))


@query("bar_file_profile", with_events("""SELECT instrument, count(*) FILTER (close <> open) AS records,
  min(ts) FILTER (close <> open) AS min_ts, max(ts) FILTER (close <> open) AS max_ts,
  'ts,open,high,low,close,volume,oi' AS columns, true AS has_size,
  CASE WHEN count(*) FILTER (close = open) > 0 THEN count(*) FILTER (close = open) || ' lines without a valid time' END AS error
FROM events_bars GROUP BY 1"""))
def bar_file_profile(spark, sf_dir):
    """Files with damaged lines: bars that close where they opened have lost their time."""
    found = profile(spark, _csv_folders(spark, sf_dir, lost=F.col("close") == F.col("open")), recursiveFileLookup=True)
    return found.select(
        F.regexp_extract("file_path", FOLDER, 1).alias("instrument"), "records", "min_ts", "max_ts",
        F.array_join("columns", ",").alias("columns"), (F.col("size") > 0).alias("has_size"), "error",
    )


@query("write_bars", with_events("SELECT CAST(ts AS DATE) AS trading_day, * FROM events_bars"))
def write_bars(spark, sf_dir):
    """Written by trading day and read back."""
    path = new_folder(spark, "bars")
    B.write_bars(events_bars(spark, sf_dir), path)
    return spark.read.parquet(path)


@query("event_sink", recursive(with_events(f""", {walk('share_of_ma', 'events_bars')},
cl AS (SELECT * FROM trades WHERE exit_ts IS NOT NULL)
SELECT 'TRADE CLOSED' AS kind, instrument, exit_ts AS ts, NULL AS action, NULL::DOUBLE AS price, pnl,
  CASE WHEN pnl > 0 THEN 'PROFIT' ELSE 'LOSS' END AS status, epoch(exit_ts - entry_ts) / 60.0::DOUBLE AS minutes_held,
  trade_no, NULL::BIGINT AS quantity, exit_reason AS reason FROM cl
UNION ALL SELECT 'EXECUTION', instrument, entry_ts, 'BUY', entry_price, NULL, NULL, NULL, NULL, 1, NULL FROM trades
UNION ALL SELECT 'EXECUTION', instrument, exit_ts, 'SELL', exit_price, NULL, NULL, NULL, NULL, 1, NULL FROM cl
UNION ALL SELECT 'MARKET DATA', instrument, ts, NULL, close, NULL, NULL, NULL, NULL, NULL, NULL FROM events_bars""")))
def event_sink(spark, sf_dir):
    path = new_folder(spark, "events")
    bars = events_bars(spark, sf_dir)
    trades = all_trades(bars, spec=INTRADAY)  # an open trade has one execution
    E.write_events(E.trade_closed_events(trades).unionByName(E.execution_events(trades)), path, 0)
    E.write_events(E.market_data_events(bars), path, 1)
    columns = ("kind", "instrument", "ts", "action", "price", "pnl", "status", "minutes_held", "trade_no", "quantity", "reason")
    return spark.read.parquet(path).select(*columns)


@query("state_events", with_events("""
SELECT 'PORTFOLIO' AS kind, instrument, ts, close * volume AS total_value, close AS cash, volume AS positions,
  NULL AS action, NULL AS reason FROM events_bars
UNION ALL SELECT 'ERROR', instrument, ts, NULL, NULL, NULL, 'DATA', 'flat bar' FROM events_bars WHERE high = low"""))
def state_events(spark, sf_dir):
    """Account states and errors as records: a state for each bar, an error for each bar without a range."""
    bars = events_bars(spark, sf_dir)
    states = bars.withColumns({"total_value": F.col("close") * F.col("volume"), "cash": F.col("close"), "positions": F.col("volume")})
    flat = bars.filter("high = low").withColumns({"action": F.lit("DATA"), "reason": F.lit("flat bar")})
    path = new_folder(spark, "events")
    E.write_events(E.portfolio_events(states).unionByName(E.error_events(flat)), path, 0)
    return spark.read.parquet(path).select("kind", "instrument", "ts", "total_value", "cash", "positions", "action", "reason")


@query("order_events", with_events(f""", {LIVE.format(bars='events_bars')},
p AS (SELECT *, coalesce(last_value(CASE signal WHEN 'BUY' THEN 1 WHEN 'SELL' THEN 0 END IGNORE NULLS)
  OVER (PARTITION BY instrument ORDER BY ts ROWS UNBOUNDED PRECEDING), 0) AS pos FROM c),
q AS (SELECT *, coalesce(lag(pos) OVER (PARTITION BY instrument ORDER BY ts), 0) AS before FROM p)
SELECT 'ORDER' AS kind, instrument, ts, CASE WHEN pos = 1 THEN 'BUY' ELSE 'SELL' END AS action, close AS price,
  25::BIGINT AS quantity, reason FROM q WHERE pos <> before
UNION ALL SELECT 'SIGNAL', instrument, ts, signal, close, NULL, reason FROM c WHERE signal <> 'HOLD'"""))
def order_events(spark, sf_dir):
    bars = events_bars(spark, sf_dir)
    spec = INTRADAY.measured(bars)
    signals = classify_signal(bars, spec=spec)
    both = E.order_events(live_orders(signals, spec=spec)).unionByName(E.signal_events(signals))
    return both.select("kind", "instrument", "ts", "action", "price", "quantity", "reason")
