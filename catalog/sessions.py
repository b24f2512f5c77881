"""Sessions."""

from __future__ import annotations

from catalog.registry import query
from catalog.views import INTRADAY, events_bars, with_events
from tidemark.operators import sessions as S

LABEL = """lb AS (SELECT *, hour(ts)::INTEGER AS hour, minute(ts)::INTEGER AS minute,
  (hour(ts) * 60 + minute(ts))::INTEGER AS time_minutes FROM events_bars),
la AS (SELECT *, CASE WHEN time_minutes >= 540 AND time_minutes < 555 THEN 'pre_market'
  WHEN time_minutes >= 555 AND time_minutes < 930 THEN 'normal'
  WHEN time_minutes >= 940 AND time_minutes < 960 THEN 'post_market' ELSE 'closed' END AS session FROM lb)"""
EDGES = f"""{LABEL},
ed AS (SELECT *, coalesce(session <> lag(session) OVER w, true) AS session_start,
  coalesce(session <> lead(session) OVER w, true) AS session_end FROM la
  WINDOW w AS (PARTITION BY instrument ORDER BY ts))"""


def runs(start: str) -> str:
    return f"""{EDGES},
ru AS (SELECT *, sum(CASE WHEN {start} THEN 1 ELSE 0 END) OVER (PARTITION BY instrument ORDER BY ts
  ROWS UNBOUNDED PRECEDING) AS run FROM nd),
co AS (SELECT *, row_number() OVER (PARTITION BY instrument, run ORDER BY ts) - 1 AS minutes_in_session FROM ru)"""


NEW_DAY = """nd AS (SELECT *, coalesce(CAST(ts AS DATE) <> lag(CAST(ts AS DATE)) OVER (PARTITION BY instrument ORDER BY ts),
  true) AS new_day FROM ed)"""
CONTINUOUS = runs("session_start").replace(",\nru", f",\n{NEW_DAY},\nru")
DAILY_RESET = runs("session_start OR new_day").replace(",\nru", f",\n{NEW_DAY},\nru")


@query("session_label", with_events(f", {LABEL} SELECT instrument, ts, hour, minute, time_minutes, session FROM la"))
def session_label(spark, sf_dir):
    out = S.session_label(events_bars(spark, sf_dir))
    return out.select("instrument", "ts", "hour", "minute", "time_minutes", "session")


@query("session_edges", with_events(f", {EDGES} SELECT instrument, ts, session, session_start, session_end FROM ed"))
def session_edges(spark, sf_dir):
    out = S.session_edges(S.session_label(events_bars(spark, sf_dir)), INTRADAY)
    return out.select("instrument", "ts", "session", "session_start", "session_end")


@query("session_bar_count", with_events(f", {DAILY_RESET} SELECT instrument, ts, session, minutes_in_session FROM co"))
def session_bar_count(spark, sf_dir):
    bars = events_bars(spark, sf_dir)
    spec = INTRADAY.measured(bars)
    edges = S.session_edges(S.session_label(bars), spec)
    out = S.session_bar_count(edges, reset_daily=True, spec=spec)
    return out.select("instrument", "ts", "session", "minutes_in_session")


@query("market_sessions", with_events(f""", {CONTINUOUS}
SELECT instrument, ts, hour, minute, time_minutes, session, session_start, session_end, minutes_in_session FROM co"""))
def market_sessions(spark, sf_dir):
    out = S.market_sessions(events_bars(spark, sf_dir), spec=INTRADAY)
    return out.drop("open", "high", "low", "close", "volume", "oi")
