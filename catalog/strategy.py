"""The flagship: bars to positions in one pass."""

from __future__ import annotations

from catalog.registry import query
from catalog.views import DAILY, INTRADAY, events_bars, lineitem_bars, rounded, with_events, with_lineitem
from tidemark.operators.clean import clean_bars
from tidemark.operators.signals import rule_positions

# derivatives, average, thresholds of the main rule
FLAGS_SQL = """d AS (
  SELECT *, row_number() OVER w AS nth, lag(oi, 1) OVER w AS b1, lag(oi, 2) OVER w AS b2,
    CASE WHEN count(oi) OVER (w ROWS 49 PRECEDING) >= 50 THEN avg(oi) OVER (w ROWS 49 PRECEDING) END AS oi_ma
  FROM {bars} WINDOW w AS (PARTITION BY instrument ORDER BY ts)),
s AS (
  SELECT *, CASE WHEN nth = 1 THEN 0.0::DOUBLE ELSE (oi - b1) / 3.0::DOUBLE END AS doi,
    CASE WHEN nth = 1 THEN 0.0::DOUBLE WHEN nth = 2 THEN (oi - b1) / 9.0::DOUBLE
         ELSE (oi + b2 - 2 * b1) / 9.0::DOUBLE END AS d2oi FROM d),
f AS (
  SELECT *, coalesce(doi < 0 AND d2oi < -0.005::DOUBLE * oi_ma, false) AS entry,
    coalesce(doi > -0.001::DOUBLE * oi_ma, false) AS exit1, coalesce(d2oi > -0.005::DOUBLE * oi_ma, false) AS exit2
  FROM s)"""

# the running position: last set value plus the flips since
POSITION_SQL = """p AS (
  SELECT *, exit1 OR exit2 AS exit,
    sum(CASE WHEN entry AND (exit1 OR exit2) THEN 1 ELSE 0 END) OVER w AS flips FROM f
  WINDOW w AS (PARTITION BY instrument ORDER BY ts ROWS UNBOUNDED PRECEDING)),
q AS (
  SELECT *, last_value(CASE WHEN entry AND NOT exit THEN 1 - flips WHEN exit AND NOT entry THEN 0 - flips END
    IGNORE NULLS) OVER w AS base FROM p
  WINDOW w AS (PARTITION BY instrument ORDER BY ts ROWS UNBOUNDED PRECEDING)),
r AS (SELECT *, CAST(((coalesce(base, 0) + flips) % 2 + 2) % 2 AS INTEGER) AS position FROM q)"""

COLUMNS = ["instrument", "ts", "close", "oi", "doi", "d2oi", "oi_ma", "entry", "exit", "position"]
SELECT = """SELECT instrument, ts, close, oi, round(doi, 6) AS doi, round(d2oi, 6) AS d2oi, round(oi_ma, 6) AS oi_ma,
  entry, exit, position FROM r"""


def positions_sql(bars: str) -> str:
    return f"{FLAGS_SQL.format(bars=bars)},\n{POSITION_SQL}"


@query("strategy_positions", with_events(f", {positions_sql('events_bars')}\n{SELECT}"))
def strategy_positions(spark, sf_dir):
    out = rule_positions(clean_bars(events_bars(spark, sf_dir)), "share_of_ma", INTRADAY)
    return rounded(out.select(*COLUMNS), "doi", "d2oi", "oi_ma")


@query("strategy_positions_daily", with_lineitem(f", {positions_sql('lineitem_bars')}\n{SELECT}"))
def strategy_positions_daily(spark, sf_dir):
    out = rule_positions(clean_bars(lineitem_bars(spark, sf_dir)), "share_of_ma", DAILY)
    return rounded(out.select(*COLUMNS), "doi", "d2oi", "oi_ma")
