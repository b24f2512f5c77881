import datetime as dt

import pytest
from conftest import make_bars, noisy_rows
from helpers import assert_same, by_order
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.operators import trades as T
from tidemark.plans.storage import new_folder, shared_folder
from tidemark.sources import bars as B
from tidemark.sources import events as E
from tidemark.sources import files as L

ROW = "2024-10-28 09:15:00+05:30"


def write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)
    return str(folder / name)


def test_header_file_with_extra_column(spark, tmp_path):
    path = write(tmp_path, "a.csv", f"date,open,high,low,close,volume,oi,delta\n{ROW},1,2,0.5,1.5,10,100,0.25\n")
    row = B.read_bars_csv(spark, path).first()
    assert row.ts == dt.datetime(2024, 10, 28, 9, 15)
    assert (row.open, row.volume, row.oi, row.delta) == (1.0, 10, 100, 0.25)


def test_aliases_and_missing_oi(spark, tmp_path):
    path = write(tmp_path, "a.csv", f"datetime,o,High,l,Close,v\n{ROW},1,2,0.5,1.5,10\n")
    row = B.read_bars_csv(spark, path).first()
    assert (row.high, row.close, row.volume, row.oi) == (2.0, 1.5, 10, 0)


def test_openinterest_replaces_oi(spark, tmp_path):
    path = write(tmp_path, "a.csv", f"d,open,high,low,close,volume,oi,openinterest\n{ROW},1,2,0.5,1.5,10,5,7\n")
    row = B.read_bars_csv(spark, path).first()
    assert (row.oi, row.openinterest) == (7, 7)


def test_bad_input_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        B.read_bars_csv(spark, str(tmp_path / "none.csv"))
    missing = write(tmp_path, "m.csv", f"d,open,high,low\n{ROW},1,2,0.5\n")
    with pytest.raises(ValueError, match="close"):
        B.read_bars_csv(spark, missing)
    bad = write(tmp_path, "b.csv", "d,open,high,low,close,volume\nyesterday,1,2,0.5,1.5,10\n")
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|yesterday"):
        B.read_bars_csv(spark, bad).collect()


def test_positions_without_header(spark, tmp_path):
    path = write(tmp_path, "p.csv", f"{ROW},1,2,0.5,1.5,10\n")
    row = B.read_bars_positional(spark, path).first()
    assert (row.close, row.volume, row.oi) == (1.5, 10, 0)
    moved = write(tmp_path, "q.csv", f"x,{ROW},1,2,0.5,1.5,9,10\n")
    at = {"ts": 1, "open": 2, "high": 3, "low": 4, "close": 5, "volume": 7, "oi": 6}
    row = B.read_bars_positional(spark, moved, at).first()
    assert (row.ts, row.volume, row.oi) == (dt.datetime(2024, 10, 28, 9, 15), 10, 9)


def test_directory_names(spark, tmp_path):
    text = f"date,open,high,low,close,volume,oi\n{ROW},1,2,0.5,1.5,10,100\n"
    write(tmp_path, "24300ce.csv", text)
    write(tmp_path, "test.csv", text + ROW.replace("15:00+", "18:00+") + ",1,2,0.5,1.5,10,100\n")
    names = spark.createDataFrame([("test.csv", "27300PE")], "file_name string, instrument string")
    counts = {r.instrument: r["count"] for r in
              B.read_bars_directory(spark, str(tmp_path), names).groupBy("instrument").count().collect()}
    assert counts == {"24300ce": 1, "27300PE": 2}
    alone = {r.instrument for r in B.read_bars_directory(spark, str(tmp_path)).collect()}
    assert alone == {"24300ce", "test"}


def test_file_list_and_profile(spark, tmp_path):
    write(tmp_path, "b.csv", f"date,open,high,low,close,volume,oi\n{ROW},1,2,0.5,1.5,10,100\n")
    write(tmp_path, "a.csv", f"date,open\n{ROW},1\nrubbish,2\n")
    write(tmp_path, "c.txt", "x")
    assert [r[0] for r in L.list_bar_files(spark, str(tmp_path)).collect()] == ["a.csv", "b.csv"]
    assert L.list_bar_files(spark, str(tmp_path / "none")).count() == 0
    found = {r.file_path[-5:]: r for r in L.bar_file_profile(spark, str(tmp_path), pathGlobFilter="*.csv").collect()}
    assert found["b.csv"].records == 1 and found["b.csv"].error is None and found["b.csv"].size > 50
    assert found["b.csv"].columns == ["date", "open", "high", "low", "close", "volume", "oi"]
    assert found["b.csv"].min_ts == dt.datetime(2024, 10, 28, 9, 15)
    assert found["a.csv"].error == "1 lines without a valid time"


def test_written_bars_come_back(spark, skewed_bars):
    for fmt in ("csv", "parquet"):
        path = new_folder(spark, f"bars-{fmt}")
        B.write_bars(skewed_bars, path, fmt)
        if fmt == "csv":
            back = B.read_bars_csv(spark, path, extra_types={"instrument": "string", "trading_day": "date"})
        else:
            back = spark.read.parquet(path)
            pruned = back.filter(F.col("trading_day") == "2024-01-02")
            assert "PartitionFilters: [isnotnull(trading_day" in pruned._jdf.queryExecution().executedPlan().toString()
        assert_same(back.select(*skewed_bars.columns), skewed_bars)


def test_events_are_not_doubled_by_a_repeat(spark):
    bars = make_bars(spark, noisy_rows("X", 200, 3))
    trades = T.trade_ledger(bars, ma_period=5)
    path = new_folder(spark, "events")
    for _ in range(2):
        E.write_events(E.trade_closed_events(trades), path, 0)
    stored = spark.read.schema(E.EVENTS).parquet(path)
    assert stored.count() == trades.count() > 5
    assert {r.status for r in stored.select("status").distinct().collect()} <= {"PROFIT", "LOSS"}
    numbers = [r[0] for r in by_order(stored, "trade_no", order=("trade_no",))]
    assert numbers == list(range(1, len(numbers) + 1))


def test_event_kinds(spark, skewed_bars):
    assert E.market_data_events(skewed_bars).filter("kind = 'MARKET DATA'").count() == skewed_bars.count()
    state = spark.createDataFrame([(100.0, 40.0, 2)], "total_value double, cash double, positions bigint")
    assert E.portfolio_events(state).first().positions == 2
    error = spark.createDataFrame([("API", "down")], "action string, reason string")
    assert tuple(E.error_events(error).select("kind", "action", "reason").first()) == ("ERROR", "API", "down")


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_columns_go_by_each_files_header(spark, tmp_path):
    write(tmp_path, "a.csv", f"date,open,high,low,close,volume,oi\n{ROW},1,2,0.5,1.5,10,100\n")
    write(tmp_path, "b.csv", f"datetime,close,high,low,open,volume,oi,delta\n{ROW},7,9,5,6,20,200,0.25\n")
    write(tmp_path, "c.csv", f"d,c,h,l,o,v\n{ROW},70,90,50,60,30\n")
    rows = {r.file_name: r for r in B.read_bars_csv(spark, str(tmp_path), with_file=True).collect()}
    assert (rows["a.csv"].open, rows["a.csv"].close, rows["a.csv"].delta) == (1.0, 1.5, None)
    assert (rows["b.csv"].open, rows["b.csv"].close, rows["b.csv"].oi, rows["b.csv"].delta) == (6.0, 7.0, 200, 0.25)
    assert (rows["c.csv"].open, rows["c.csv"].close, rows["c.csv"].oi) == (60.0, 70.0, 0)
    named = {r.instrument: r.open for r in B.read_bars_directory(spark, str(tmp_path)).collect()}
    assert named == {"a": 1.0, "b": 6.0, "c": 60.0}


def test_a_day_is_written_by_few_tasks(spark, skewed_bars):
    path = new_folder(spark, "bars")
    B.write_bars(skewed_bars.repartition(16), path)
    files = spark.read.parquet(path).inputFiles()
    days = skewed_bars.select(F.to_date("ts")).distinct().count()
    assert len(files) <= 2 * days
