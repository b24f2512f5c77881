"""Trade ledger and what follows from it. The SQL walks every series bar by bar with a recursive query."""

from __future__ import annotations

from catalog.registry import query
from catalog.signals import derived
from catalog.views import DAILY, INTRADAY, events_bars, lineitem_bars, rounded, with_events, with_lineitem
from tidemark.functions.rules import coarse_absolute
from tidemark.operators import analytics as A
from tidemark.operators import trades as T

# (variant, MA, entry, sure first exit, second exit, first exit inside a trade, stop, take)
WALKS = {
    "share_of_ma": ("indicator", 50, "doi < 0 AND d2oi < -0.005::DOUBLE * oi_ma", "doi > -0.001::DOUBLE * oi_ma",
                    "d2oi > -0.005::DOUBLE * oi_ma", True),
    "absolute_both": ("indicator", 30, "doi < 0 AND d2oi < -3000", "doi > -30000 AND d2oi > -3000", "false", False),
    "held_ma": ("indicator", 30, "doi < 0 AND d2oi < -0.002::DOUBLE * oi_ma", "doi > -0.01::DOUBLE * held",
                "d2oi > -0.001::DOUBLE * oi_ma", False),
    # no average: one of a single row is always there
    "absolute": ("rounded", 1, "doi < 0 AND d2oi < -3000", "doi > -30000", "d2oi > -3000", False),
    # sensitivity 0.5, as the default levels are beyond these tables' open interest
    "coarse_absolute": ("rounded", 1, "doi < 0 AND d2oi < -4500", "doi > -45000", "d2oi > -4500", False),
}


def walk(preset: str, bars: str, stops: bool | None = None, keys: str = "instrument", source: str | None = None) -> str:
    """Recursive CTE ``walk``: state after every bar; ``done``: all trades, closed and open."""
    variant, ma, entry, first, second, with_stops = WALKS[preset]
    stops = with_stops if stops is None else stops
    source = source or derived(bars, variant, ma)
    stop = "st.price <> 0 AND b.close <= st.price * (1 - 0.15::DOUBLE)" if stops else "false"
    take = "st.price <> 0 AND b.close >= st.price * (1 + 0.30::DOUBLE)" if stops else "false"
    first_b = first.replace("doi", "b.doi").replace("d2b.oi", "b.d2oi").replace("oi_ma", "b.oi_ma").replace("held", "st.held")
    second_b = second.replace("d2oi", "b.d2oi").replace("oi_ma", "b.oi_ma")
    on_keys = " AND ".join(f"b.{k.strip()} = st.{k.strip()}" for k in keys.split(","))
    key_list = ", ".join(f"b.{k.strip()}" for k in keys.split(","))
    return f"""{source},
b AS MATERIALIZED (SELECT *, lag(oi_ma) OVER w AS ma_before, lead(ts) OVER w AS fill_ts, lead(open) OVER w AS fill,
  oi_ma IS NOT NULL AS ready, coalesce({entry}, false) AS entry,
  row_number() OVER w AS seq FROM s WINDOW w AS (PARTITION BY {keys} ORDER BY ts)),
walk AS (
  SELECT {keys}, 0::BIGINT AS seq, NULL::TIMESTAMP AS signal_ts, NULL::TIMESTAMP AS entry_ts, NULL::DOUBLE AS price,
    NULL::DOUBLE AS held, NULL::VARCHAR AS reason, NULL::TIMESTAMP AS out_signal_ts, NULL::TIMESTAMP AS out_ts,
    NULL::DOUBLE AS out_price FROM b WHERE seq = 1
  UNION ALL
  SELECT {keys}, seq, CASE WHEN enters THEN ts ELSE signal_ts END,
    CASE WHEN enters THEN fill_ts ELSE entry_ts END, CASE WHEN enters THEN fill ELSE price END,
    CASE WHEN enters THEN ma_before ELSE held END, why,
    CASE WHEN why IS NOT NULL THEN ts END, CASE WHEN why IS NOT NULL THEN fill_ts END,
    CASE WHEN why IS NOT NULL THEN fill END
  FROM (
    SELECT {key_list}, b.seq, b.ts, b.fill_ts, b.fill, b.ma_before,
      CASE WHEN st.reason IS NULL THEN st.signal_ts END AS signal_ts, CASE WHEN st.reason IS NULL THEN st.entry_ts END AS entry_ts,
      CASE WHEN st.reason IS NULL THEN st.price END AS price, CASE WHEN st.reason IS NULL THEN st.held END AS held,
      (st.entry_ts IS NULL OR st.reason IS NOT NULL) AND b.ready AND b.entry AND b.fill_ts IS NOT NULL AS enters,
      CASE WHEN st.entry_ts IS NULL OR st.reason IS NOT NULL OR NOT b.ready OR b.fill_ts IS NULL THEN NULL
        WHEN {stop} THEN 'STOP LOSS' WHEN {take} THEN 'TAKE PROFIT'
        WHEN coalesce({first_b}, false) THEN 'First derivative exit'
        WHEN coalesce({second_b}, false) THEN 'Second derivative exit' END AS why
    FROM walk st JOIN b ON {on_keys} AND b.seq = st.seq + 1)),
last_seq AS (SELECT {keys}, max(seq) AS seq FROM walk GROUP BY {keys}),
done AS (SELECT {keys}, signal_ts AS entry_signal_ts, entry_ts, price AS entry_price, out_signal_ts AS exit_signal_ts,
    out_ts AS exit_ts, out_price AS exit_price, reason AS exit_reason,
    row_number() OVER (PARTITION BY {keys} ORDER BY entry_ts) AS trade_no,
    out_price - price AS pnl, (coalesce(out_price, 0) + price) * 0.001::DOUBLE AS commission
  FROM walk WHERE reason IS NOT NULL OR (entry_ts IS NOT NULL AND ({keys}, seq) IN (SELECT ({keys}, seq) FROM last_seq)
    )),
trades AS (SELECT *, 1 AS size, pnl - commission AS pnl_net FROM done)""".replace(
        f"({keys}, seq) IN (SELECT ({keys}, seq) FROM last_seq)",
        f"(SELECT x.seq FROM last_seq x WHERE {' AND '.join(f'x.{k.strip()} = walk.{k.strip()}' for k in keys.split(','))}) = walk.seq",
    )


def recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


LEDGER = """instrument, trade_no, entry_signal_ts, entry_ts, entry_price, exit_signal_ts, exit_ts, exit_price, size,
  pnl, commission, pnl_net, exit_reason"""
CLOSED = f"SELECT {LEDGER} FROM trades WHERE exit_ts IS NOT NULL"


def ledger(bars, spec, preset="share_of_ma"):
    return T.trade_ledger(bars, preset, spec=spec)


@query("trade_ledger", recursive(with_events(f", {walk('share_of_ma', 'events_bars')} {CLOSED}")))
def trade_ledger(spark, sf_dir):
    return ledger(events_bars(spark, sf_dir), INTRADAY)


@query("trade_ledger_daily", recursive(with_lineitem(f", {walk('share_of_ma', 'lineitem_bars')} {CLOSED}")))
def trade_ledger_daily(spark, sf_dir):
    return ledger(lineitem_bars(spark, sf_dir), DAILY)


@query("trade_ledger_both", recursive(with_lineitem(f", {walk('absolute_both', 'lineitem_bars')} {CLOSED}")))
def trade_ledger_both(spark, sf_dir):
    return ledger(lineitem_bars(spark, sf_dir), DAILY, "absolute_both")


@query("trade_ledger_held", recursive(with_lineitem(f", {walk('held_ma', 'lineitem_bars')} {CLOSED}")))
def trade_ledger_held(spark, sf_dir):
    return ledger(lineitem_bars(spark, sf_dir), DAILY, "held_ma")


@query("trade_ledger_absolute", recursive(with_lineitem(f", {walk('absolute', 'lineitem_bars')} {CLOSED}")))
def trade_ledger_absolute(spark, sf_dir):
    return ledger(lineitem_bars(spark, sf_dir), DAILY, "absolute")


@query("trade_ledger_coarse", recursive(with_lineitem(f", {walk('coarse_absolute', 'lineitem_bars')} {CLOSED}")))
def trade_ledger_coarse(spark, sf_dir):
    return ledger(lineitem_bars(spark, sf_dir), DAILY, coarse_absolute(sensitivity=0.5))


@query("round_trip_pnl", recursive(with_events(f""", {walk('share_of_ma', 'events_bars')}
SELECT instrument, trade_no, round((exit_price - entry_price) * 25, 6) AS lot_pnl,
  epoch(exit_ts - entry_ts) / 60.0::DOUBLE AS minutes_held FROM trades WHERE exit_ts IS NOT NULL""")))
def round_trip_pnl(spark, sf_dir):
    trades = T.round_trip_pnl(T.trade_ledger(events_bars(spark, sf_dir), spec=INTRADAY))
    return rounded(trades.select("instrument", "trade_no", "lot_pnl", "minutes_held"), "lot_pnl")


SUMMARY_SQL = """count(*) AS total_trades, count(*) FILTER (pnl > 0) AS winning_trades,
  count(*) FILTER (pnl <= 0) AS losing_trades, round(coalesce(avg(pnl) FILTER (pnl > 0), 0), 6) AS avg_win,
  coalesce(max(pnl) FILTER (pnl > 0), 0) AS max_win, round(coalesce(avg(pnl) FILTER (pnl <= 0), 0), 6) AS avg_loss,
  coalesce(min(pnl) FILTER (pnl <= 0), 0) AS max_loss,
  round(100.0::DOUBLE * count(*) FILTER (pnl > 0) / count(*), 6) AS win_rate_pct,
  round(coalesce(abs(avg(pnl) FILTER (pnl > 0) / nullif(avg(pnl) FILTER (pnl <= 0), 0)), 0), 6) AS profit_factor"""


@query("trade_summary", recursive(with_lineitem(f""", {walk('share_of_ma', 'lineitem_bars')}
SELECT instrument, {SUMMARY_SQL} FROM trades WHERE exit_ts IS NOT NULL GROUP BY 1""")))
def trade_summary(spark, sf_dir):
    out = A.trade_summary(T.trade_ledger(lineitem_bars(spark, sf_dir), spec=DAILY))
    return rounded(out, "avg_win", "avg_loss", "win_rate_pct", "profit_factor")


@query("running_win_rate", recursive(with_lineitem(f""", {walk('share_of_ma', 'lineitem_bars')}
SELECT instrument, trade_no, round(100.0::DOUBLE * sum(CASE WHEN pnl > 0 THEN 1 ELSE 0 END) OVER w / count(*) OVER w, 6)
  AS win_rate_pct FROM trades WHERE exit_ts IS NOT NULL
WINDOW w AS (PARTITION BY instrument ORDER BY trade_no ROWS UNBOUNDED PRECEDING)""")))
def running_win_rate(spark, sf_dir):
    bars = lineitem_bars(spark, sf_dir)
    spec = DAILY.measured(bars)
    out = A.running_win_rate(T.trade_ledger(bars, spec=spec), spec)
    return rounded(out.select("instrument", "trade_no", "win_rate_pct"), "win_rate_pct")


@query("portfolio_return", recursive(with_lineitem(f""", {walk('share_of_ma', 'lineitem_bars')},
last AS (SELECT instrument, arg_max(close, ts) AS last_close FROM lineitem_bars GROUP BY 1),
acc AS (SELECT instrument, 100000.0::DOUBLE + coalesce(sum(pnl_net), 0)
    + coalesce(sum(CASE WHEN t.entry_ts IS NOT NULL AND exit_ts IS NULL THEN last_close - entry_price - commission END), 0)
    AS final_value
  FROM last LEFT JOIN trades t USING (instrument) GROUP BY 1)
SELECT instrument, 100000.0::DOUBLE AS starting_value, round(final_value, 6) AS final_value,
  round(final_value - 100000, 6) AS total_return, round((final_value - 100000) / 100000 * 100, 6) AS total_return_pct
FROM acc""")))
def portfolio_return(spark, sf_dir):
    bars = lineitem_bars(spark, sf_dir)
    spec = DAILY.measured(bars)
    out = A.portfolio_return(T.all_trades(bars, spec=spec), bars, spec=spec)
    return rounded(out, "final_value", "total_return", "total_return_pct")
