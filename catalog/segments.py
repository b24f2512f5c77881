"""Piecewise linear segmentation; the SQL walks every group row by row and refits the open segment each time."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.views import DAILY, INTRADAY, events_bars, lineitem_bars, with_events, with_lineitem
from tidemark.operators.segments import piecewise_segments as segments


def walk(bars: str, group: str, max_deviation: float, min_len: int) -> str:
    return f"""n AS MATERIALIZED (SELECT instrument, {group} AS grp, ts, oi::DOUBLE AS y,
  row_number() OVER (PARTITION BY instrument, {group} ORDER BY ts) - 1 AS i FROM {bars}),
walk AS (
  SELECT instrument, grp, 0::BIGINT AS i, 0::BIGINT AS first FROM n WHERE i = 0
  UNION ALL
  SELECT instrument, grp, i, CASE WHEN points >= {min_len} AND miss > {max_deviation}::DOUBLE THEN i ELSE first END FROM (
    SELECT f.instrument, f.grp, f.i, f.first, count(*) AS points, max(abs(p.y - (f.my + f.slope * (p.i - f.mx))) / p.y) AS miss
    FROM (
      SELECT st.instrument, st.grp, st.i + 1 AS i, st.first, avg(q.y) AS my, avg(q.i) AS mx, regr_slope(q.y, q.i) AS slope
      FROM walk st JOIN n q ON q.instrument = st.instrument AND q.grp = st.grp AND q.i BETWEEN st.first AND st.i + 1
      GROUP BY st.instrument, st.grp, st.i, st.first HAVING max(q.i) = st.i + 1) f
    JOIN n p ON p.instrument = f.instrument AND p.grp = f.grp AND p.i BETWEEN f.first AND f.i
    GROUP BY f.instrument, f.grp, f.i, f.first)),
seg AS (SELECT instrument, grp, first AS start_row, max(i) AS end_row FROM walk GROUP BY 1, 2, 3)
SELECT s.instrument, s.grp, s.start_row, s.end_row, a.ts AS start_ts, b.ts AS end_ts FROM seg s
JOIN n a ON a.instrument = s.instrument AND a.grp = s.grp AND a.i = s.start_row
JOIN n b ON b.instrument = s.instrument AND b.grp = s.grp AND b.i = s.end_row"""


@query("piecewise_segments", with_events(f", {walk('events_bars', 'CAST(ts AS DATE)', 0.05, 5)}")
       .replace("WITH ", "WITH RECURSIVE ", 1))
def piecewise_segments(spark, sf_dir):
    return segments(events_bars(spark, sf_dir), spec=INTRADAY).withColumnRenamed("day", "grp")


@query("piecewise_segments_yearly", with_lineitem(f", {walk('lineitem_bars', 'year(ts)::INTEGER', 0.2, 1)}")
       .replace("WITH ", "WITH RECURSIVE ", 1))
def piecewise_segments_yearly(spark, sf_dir):
    bars = lineitem_bars(spark, sf_dir).withColumn("grp", F.year("ts"))
    return segments(bars, max_deviation=0.2, min_segment_len=1, by=("instrument", "grp"), spec=DAILY)


@query("piecewise_segments_whole", with_lineitem(f", {walk('lineitem_bars', '0', 0.2, 5)}")
       .replace("WITH ", "WITH RECURSIVE ", 1).replace("SELECT s.instrument, s.grp,", "SELECT s.instrument,"))
def piecewise_segments_whole(spark, sf_dir):
    return segments(lineitem_bars(spark, sf_dir), max_deviation=0.2, by=("instrument",), spec=DAILY)
