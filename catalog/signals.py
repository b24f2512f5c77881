"""Signals and positions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.indicators import FIRST, LAGS, SECOND, W, mean, windows
from catalog.registry import query
from catalog.strategy import POSITION_SQL
from catalog.views import DAILY, INTRADAY, events_bars, lineitem_bars, rounded, with_events, with_lineitem
from tidemark.functions.rules import rule_of
from tidemark.operators import signals as S


def derived(bars: str, variant: str, ma: int) -> str:
    """doi, d2oi and oi_ma as columns of ``s``."""
    return f"""{LAGS.format(bars=bars)},
s AS (SELECT *, {FIRST[variant]} AS doi, {SECOND[variant]} AS d2oi, {mean('oi', ma)} AS oi_ma FROM l {windows(ma)})"""


MAIN = derived("{bars}", "indicator", 50)
LEVELS = """-0.005::DOUBLE * oi_ma AS entry_threshold, -0.001::DOUBLE * oi_ma AS exit_doi_threshold,
  -0.005::DOUBLE * oi_ma AS exit_d2oi_threshold"""

# entry, first exit, second exit of each preset, as SQL over doi, d2oi, oi_ma
PRESET_SQL = {
    "share_of_ma": ("doi < 0 AND d2oi < -0.005::DOUBLE * oi_ma", "doi > -0.001::DOUBLE * oi_ma",
                    "d2oi > -0.005::DOUBLE * oi_ma"),
    "absolute": ("doi < 0 AND d2oi < -3000", "doi > -30000", "d2oi > -3000"),
    "absolute_both": ("doi < 0 AND d2oi < -3000", "doi > -30000", "d2oi > -3000"),
    "held_ma": ("doi < 0 AND d2oi < -0.002::DOUBLE * oi_ma", None, "d2oi > -0.001::DOUBLE * oi_ma"),
    "coarse_absolute": ("doi < 0 AND d2oi < -63000", "doi > -630000", "d2oi > -63000"),
}
SHAPES = {"share_of_ma": ("indicator", 50), "absolute": ("rounded", 50), "absolute_both": ("indicator", 30),
          "held_ma": ("indicator", 30), "coarse_absolute": ("rounded", 50)}


def true(sql: str) -> str:
    return f"coalesce({sql}, false)"


@query("signal_thresholds", with_lineitem(f""", {MAIN.format(bars='lineitem_bars')},
t AS (SELECT *, {LEVELS} FROM s)
SELECT instrument, ts, close, round(doi, 6) AS doi, round(d2oi, 6) AS d2oi, round(oi_ma, 6) AS oi_ma,
  round(entry_threshold, 4) AS entry_threshold, round(exit_doi_threshold, 4) AS exit_doi_threshold,
  round(exit_d2oi_threshold, 4) AS exit_d2oi_threshold FROM t"""))
def signal_thresholds(spark, sf_dir):
    out = S.signal_thresholds(lineitem_bars(spark, sf_dir), spec=DAILY)
    levels = ("entry_threshold", "exit_doi_threshold", "exit_d2oi_threshold")
    out = out.select("instrument", "ts", "close", "doi", "d2oi", "oi_ma", *levels)
    return rounded(rounded(out, "doi", "d2oi", "oi_ma"), *levels, digits=4)


def _per_preset(build, presets, bars):
    """One table for several presets, told apart by ``preset``."""
    spec = DAILY.measured(bars)
    parts = [build(bars, p, spec).select(F.lit(p).alias("preset"), "*") for p in presets]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _preset_union(presets, body) -> str:
    ctes, selects = [], []
    for p in presets:
        variant, ma = SHAPES[p]
        ctes.append(derived("lineitem_bars", variant, ma).replace("l AS (", f"l_{p} AS (", 1)
                    .replace("\ns AS (", f"\ns_{p} AS (").replace("FROM l ", f"FROM l_{p} "))
        selects.append(body(p))
    return ", " + ",\n".join(ctes) + "\n" + "\nUNION ALL\n".join(selects)


@query("entry_signal", with_lineitem(_preset_union(
    PRESET_SQL, lambda p: f"SELECT '{p}' AS preset, instrument, ts, {true(PRESET_SQL[p][0])} AS entry FROM s_{p}")))
def entry_signal(spark, sf_dir):
    build = lambda bars, p, spec: S.entry_signal(bars, p, spec).select("instrument", "ts", "entry")
    return _per_preset(build, PRESET_SQL, lineitem_bars(spark, sf_dir))


def _exit_sql(p: str) -> str:
    _, first, second = PRESET_SQL[p]
    first, second = true(first), true(second)
    either = f"({first} AND {second})" if p == "absolute_both" else f"({first} OR {second})"
    return f"""SELECT '{p}' AS preset, instrument, ts, {either} AS exit, CASE WHEN {either} THEN
  CASE WHEN {first} THEN 'First derivative exit' ELSE 'Second derivative exit' END END AS exit_reason FROM s_{p}"""


STATELESS = [p for p in PRESET_SQL if p != "held_ma"]


@query("exit_signal", with_lineitem(_preset_union(STATELESS, _exit_sql)))
def exit_signal(spark, sf_dir):
    build = lambda bars, p, spec: S.exit_signal(bars, p, spec).select("instrument", "ts", "exit", "exit_reason")
    return _per_preset(build, STATELESS, lineitem_bars(spark, sf_dir))


LIVE = f"""{derived('{bars}', 'rounded', 50)},
c AS (SELECT *, CASE WHEN nth < 2 THEN 'HOLD' WHEN doi < 0 AND d2oi < -3000 THEN 'BUY'
    WHEN doi > -30000 OR d2oi > -3000 THEN 'SELL' ELSE 'HOLD' END AS signal,
  CASE WHEN nth < 2 THEN 'Insufficient data'
    WHEN doi < 0 AND d2oi < -3000
      THEN 'OI derivatives indicate selling pressure (doi: ' || printf('%.2f', doi) || ', d2oi: ' || printf('%.2f', d2oi) || ')'
    WHEN doi > -30000 THEN 'First derivative exit (doi: ' || printf('%.2f', doi) || ')'
    WHEN d2oi > -3000 THEN 'Second derivative exit (d2oi: ' || printf('%.2f', d2oi) || ')'
    ELSE 'No clear signal' END AS reason FROM s)"""
LIVE_COLUMNS = "instrument, ts, close, doi, d2oi, signal, reason"


@query("classify_signal", with_events(f", {LIVE.format(bars='events_bars')} SELECT {LIVE_COLUMNS} FROM c"))
def classify_signal(spark, sf_dir):
    return S.classify_signal(events_bars(spark, sf_dir), spec=INTRADAY).select(*LIVE_COLUMNS.split(", "))


@query("latest_signal", with_lineitem(f""", {LIVE.format(bars='lineitem_bars')} SELECT {LIVE_COLUMNS} FROM c
QUALIFY row_number() OVER (PARTITION BY instrument ORDER BY ts DESC) = 1"""))
def latest_signal(spark, sf_dir):
    return S.latest_signal(lineitem_bars(spark, sf_dir), spec=DAILY).select(*LIVE_COLUMNS.split(", "))


@query("latest_bar", with_lineitem("""SELECT * FROM lineitem_bars
QUALIFY row_number() OVER (PARTITION BY instrument ORDER BY ts DESC) = 1"""))
def latest_bar(spark, sf_dir):
    return S.latest_bar(lineitem_bars(spark, sf_dir), DAILY)


# flags that are independent of each other, so that all four cases occur often
FLAGGED = """f AS (SELECT *, volume % 3 = 0 AS entry, volume % 5 < 2 AS exit1, false AS exit2 FROM {bars})"""


@query("position_state", with_lineitem(f""", {FLAGGED.format(bars='lineitem_bars')}, {POSITION_SQL}
SELECT instrument, ts, entry, exit, position FROM r"""))
def position_state(spark, sf_dir):
    v = F.col("volume")
    flagged = lineitem_bars(spark, sf_dir).select("instrument", "ts", (v % 3 == 0).alias("entry"), (v % 5 < 2).alias("exit"))
    return S.position_state(flagged, spec=DAILY)


@query("position_state_live", with_events(f""", {LIVE.format(bars='events_bars')}
SELECT instrument, ts, signal, coalesce(last_value(CASE signal WHEN 'BUY' THEN 1 WHEN 'SELL' THEN 0 END IGNORE NULLS)
  OVER (PARTITION BY instrument ORDER BY ts ROWS UNBOUNDED PRECEDING), 0)::INTEGER AS position FROM c"""))
def position_state_live(spark, sf_dir):
    bars = events_bars(spark, sf_dir)
    spec = INTRADAY.measured(bars)
    signals = S.classify_signal(bars, spec=spec)
    return S.position_state_live(signals, spec=spec).select("instrument", "ts", "signal", "position")


@query("stop_take_check", with_lineitem(f""", x AS (SELECT instrument, ts, close, lag(open, 5) OVER w AS entry_price
  FROM lineitem_bars {W})
SELECT *, CASE WHEN entry_price <> 0 AND close <= entry_price * (1 - 0.15::DOUBLE) THEN 'STOP LOSS'
  WHEN entry_price <> 0 AND close >= entry_price * (1 + 0.30::DOUBLE) THEN 'TAKE PROFIT' END AS stop_take FROM x"""))
def stop_take_check(spark, sf_dir):
    from tidemark.plans.series import over_series

    bars = lineitem_bars(spark, sf_dir).select("instrument", "ts", "open", "close")
    held = over_series(bars, lambda d, w: d.withColumn("entry_price", F.lag("open", 5).over(w)), DAILY, lookback=5)
    return S.stop_take_check(held.drop("open"))


@query("signal_to_next_bar", with_lineitem(f"""SELECT instrument, ts, close, lead(ts) OVER w AS fill_ts,
  lead(open) OVER w AS fill_price FROM lineitem_bars {W}"""))
def signal_to_next_bar(spark, sf_dir):
    out = S.signal_to_next_bar(lineitem_bars(spark, sf_dir), DAILY)
    return out.select("instrument", "ts", "close", "fill_ts", "fill_price")


def _capped(per: str) -> str:
    day = ", CAST(ts AS DATE)" if per == "day" else ""
    return f"""SELECT '{per}' AS per, instrument, ts, entry_no FROM (SELECT instrument, ts,
  row_number() OVER (PARTITION BY instrument{day} ORDER BY ts) AS entry_no FROM f WHERE entry) WHERE entry_no <= 10"""


MAIN_FLAGS = """f AS (SELECT *, coalesce(doi < 0 AND d2oi < -0.005::DOUBLE * oi_ma, false) AS entry,
  coalesce(doi > -0.001::DOUBLE * oi_ma, false) OR coalesce(d2oi > -0.005::DOUBLE * oi_ma, false) AS exit FROM s)"""


@query("trade_cap", with_events(f""", {MAIN.format(bars='events_bars')}, {MAIN_FLAGS}
{_capped('run')} UNION ALL {_capped('day')}"""))
def trade_cap(spark, sf_dir):
    bars = events_bars(spark, sf_dir)
    spec = INTRADAY.measured(bars)
    flags = S.signal_flags(bars, spec=spec)
    parts = [
        S.trade_cap(flags, 10, per, spec=spec).select(F.lit(per).alias("per"), "instrument", "ts", "entry_no")
        for per in ("run", "day")
    ]
    return parts[0].unionByName(parts[1])


@query("trade_cap_across", with_events(f""", {MAIN.format(bars='events_bars')}, {MAIN_FLAGS}
SELECT instrument, ts, entry_no FROM (
  SELECT instrument, ts, row_number() OVER (ORDER BY ts, instrument) AS entry_no FROM f WHERE entry) WHERE entry_no <= 25"""))
def trade_cap_across(spark, sf_dir):
    """One counter for all instruments."""
    flags = S.signal_flags(events_bars(spark, sf_dir), spec=INTRADAY)
    return S.trade_cap(flags, 25, spec=INTRADAY, across=True).select("instrument", "ts", "entry_no")


def main_flags(bars, spec):
    """Bars with the main rule's columns and flags, and the measured spec."""
    spec = spec.measured(bars)
    return S.signal_flags(bars, rule_of("share_of_ma"), spec), spec
