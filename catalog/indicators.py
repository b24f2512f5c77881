"""Indicator columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.views import DAILY, INTRADAY, events_bars, lineitem_bars, rounded, with_events, with_lineitem
from tidemark.operators import indicators as I

W = "WINDOW w AS (PARTITION BY instrument ORDER BY ts)"


def rolling(agg: str, c: str, n: int) -> str:
    frame = f"(w ROWS {n - 1} PRECEDING)"
    return f"CASE WHEN count({c}) OVER {frame} >= {n} THEN {agg}({c}) OVER {frame} END"


def mean(c: str, n: int) -> str:
    return f"CASE WHEN count({c}) OVER w{n} >= {n} THEN avg({c}) OVER w{n} END"


def std(c: str, n: int) -> str:
    return f"CASE WHEN count({c}) OVER w{n} >= {n} THEN stddev_samp({c}) OVER w{n} END"


def windows(*lengths: int) -> str:
    frames = [f"w{n} AS (PARTITION BY instrument ORDER BY ts ROWS {n - 1} PRECEDING)" for n in lengths]
    return "WINDOW " + ", ".join(["w AS (PARTITION BY instrument ORDER BY ts)", *frames])


def ewm(c: str, span: int, taps: int) -> str:
    """Weighted sums over the last ``taps`` rows by folding a list, newest last."""
    d = f"({span - 1}::DOUBLE / {span + 1}::DOUBLE)"
    frame = f"(PARTITION BY instrument ORDER BY ts ROWS {taps - 1} PRECEDING)"
    return (f"list_reduce(list({c}) OVER {frame}, lambda s, v: s * {d} + v) / "
            f"list_reduce(list(1.0::DOUBLE) OVER {frame}, lambda s, v: s * {d} + v)")


def select(spark_df, *names):
    return rounded(spark_df.select("instrument", "ts", *names), *names)


def columns(*names: str) -> str:
    return ", ".join(["instrument", "ts", *[f"round({n}, 6) AS {n}" for n in names]])


SMA = ", ".join(f"{mean('close', n)} AS sma_{n}" for n in (5, 10, 20, 50))


@query("sma", with_lineitem(f""", x AS (SELECT *, {SMA} FROM lineitem_bars {windows(5, 10, 20, 50)})
SELECT {columns('sma_5', 'sma_10', 'sma_20', 'sma_50')} FROM x"""))
def sma(spark, sf_dir):
    out = I.sma(lineitem_bars(spark, sf_dir), spec=DAILY)
    return select(out, "sma_5", "sma_10", "sma_20", "sma_50")


EMA = f"{ewm('close', 12, 250)} AS ema_12, {ewm('close', 26, 550)} AS ema_26"


@query("ema", with_events(f""", x AS (SELECT *, {EMA} FROM events_bars)
SELECT {columns('ema_12', 'ema_26')} FROM x"""))
def ema(spark, sf_dir):
    return select(I.ema(events_bars(spark, sf_dir), spec=INTRADAY), "ema_12", "ema_26")


MACD = f"""x AS (SELECT *, {EMA} FROM events_bars),
y AS (SELECT *, ema_12 - ema_26 AS macd FROM x),
z AS (SELECT *, {ewm('macd', 9, 200)} AS macd_signal FROM y),
m AS (SELECT *, macd - macd_signal AS macd_histogram FROM z)"""


@query("macd", with_events(f""", {MACD}
SELECT {columns('ema_12', 'ema_26', 'macd', 'macd_signal', 'macd_histogram')} FROM m"""))
def macd(spark, sf_dir):
    out = I.macd(events_bars(spark, sf_dir), spec=INTRADAY)
    return select(out, "ema_12", "ema_26", "macd", "macd_signal", "macd_histogram")


RSI = f"""g AS (SELECT *, close - lag(close) OVER w AS change FROM {{bars}} {W}),
h AS (SELECT *, CASE WHEN change > 0 THEN change ELSE 0 END AS gain, CASE WHEN change < 0 THEN -change ELSE 0 END AS fall
  FROM g),
i AS (SELECT *, {mean('gain', 14)} AS mean_gain, {mean('fall', 14)} AS mean_fall FROM h {windows(14)}),
j AS (SELECT *, CASE WHEN mean_fall = 0 AND mean_gain > 0 THEN 100.0
    ELSE 100 - 100 / nullif(1 + mean_gain / nullif(mean_fall, 0), 0) END AS rsi FROM i)"""


@query("rsi", with_lineitem(f", {RSI.format(bars='lineitem_bars')} SELECT {columns('rsi')} FROM j"))
def rsi(spark, sf_dir):
    return select(I.rsi(lineitem_bars(spark, sf_dir), spec=DAILY), "rsi")


BOLLINGER = f"""b0 AS (SELECT *, {mean('close', 20)} AS bb_middle, {std('close', 20)} AS dev FROM {{bars}} {windows(20)}),
b1 AS (SELECT *, bb_middle + 2 * dev AS bb_upper, bb_middle - 2 * dev AS bb_lower FROM b0),
b2 AS (SELECT *, bb_upper - bb_lower AS bb_width, (close - bb_lower) / nullif(bb_upper - bb_lower, 0) AS bb_position FROM b1)"""
BB = ("bb_middle", "bb_upper", "bb_lower", "bb_width", "bb_position")


@query("bollinger", with_lineitem(f", {BOLLINGER.format(bars='lineitem_bars')} SELECT {columns(*BB)} FROM b2"))
def bollinger(spark, sf_dir):
    return select(I.bollinger(lineitem_bars(spark, sf_dir), spec=DAILY), *BB)


VOLUME = f"""v0 AS (SELECT *, {mean('volume', 20)} AS volume_sma FROM {{bars}} {windows(20)}),
v1 AS (SELECT *, volume / nullif(volume_sma, 0) AS volume_ratio FROM v0)"""


@query("volume_ratio", with_lineitem(f""", {VOLUME.format(bars='lineitem_bars')}
SELECT {columns('volume_sma', 'volume_ratio')} FROM v1"""))
def volume_ratio(spark, sf_dir):
    return select(I.volume_ratio(lineitem_bars(spark, sf_dir), spec=DAILY), "volume_sma", "volume_ratio")


ALL = ("sma_5", "sma_10", "sma_20", "sma_50", "ema_12", "ema_26", "macd", "macd_signal", "macd_histogram", "rsi", *BB,
       "volume_sma", "volume_ratio")


@query("technical_indicators", with_events(f""", {MACD},
t AS (SELECT *, {SMA} FROM m {windows(5, 10, 20, 50)}),
{RSI.format(bars='t')}, {BOLLINGER.format(bars='j')}, {VOLUME.format(bars='b2')}
SELECT {columns(*ALL)} FROM v1"""))
def technical_indicators(spark, sf_dir):
    return select(I.technical_indicators(events_bars(spark, sf_dir), spec=INTRADAY), *ALL)


# --- open interest -------------------------------------------------------------------------------

LAGS = f"""l AS (SELECT *, row_number() OVER w AS nth, lag(oi, 1) OVER w AS b1, lag(oi, 2) OVER w AS b2,
  lag(oi, 4) OVER w AS b4, lag(close) OVER w AS c1 FROM {{bars}} {W})"""
FIRST = {
    "indicator": "CASE WHEN nth = 1 THEN 0.0::DOUBLE ELSE (oi - b1) / 3.0::DOUBLE END",
    "frame": "(oi - b1) / 3.0::DOUBLE",
    "rounded": "round_even((oi - b1) / 3.0::DOUBLE, 0) + 0.0::DOUBLE",
}
SECOND = {
    "indicator": "CASE WHEN nth = 1 THEN 0.0::DOUBLE ELSE (oi + coalesce(b2, b1) - 2 * b1) / 9.0::DOUBLE END",
    "frame": "(oi + b2 - 2 * b1) / 9.0::DOUBLE",
    "rounded": "round_even((oi + b2 - 2 * b1) / 9.0::DOUBLE, 0) + 0.0::DOUBLE",
}


def all_variants(expressions: dict[str, str], name: str) -> str:
    return ", ".join(f"{e} AS {name}_{v}" for v, e in expressions.items())


@query("oi_sma_ratio", with_lineitem(f""", x AS (SELECT *, {mean('oi', 10)} AS oi_sma_10, {mean('oi', 30)} AS oi_sma_30
  FROM lineitem_bars {windows(10, 30)}), y AS (SELECT *, oi / nullif(oi_sma_30, 0) AS oi_ratio FROM x)
SELECT {columns('oi_sma_10', 'oi_sma_30', 'oi_ratio')} FROM y"""))
def oi_sma_ratio(spark, sf_dir):
    return select(I.oi_sma_ratio(lineitem_bars(spark, sf_dir), DAILY), "oi_sma_10", "oi_sma_30", "oi_ratio")


@query("oi_change", with_lineitem(f""", {LAGS.format(bars='lineitem_bars')}
SELECT instrument, ts, oi - b1 AS oi_change, round(oi / nullif(b1, 0)::DOUBLE - 1, 6) AS oi_pct_change FROM l"""))
def oi_change(spark, sf_dir):
    out = I.oi_change(lineitem_bars(spark, sf_dir), spec=DAILY)
    return rounded(out.select("instrument", "ts", "oi_change", "oi_pct_change"), "oi_pct_change")


@query("oi_change_filled", with_events(f""", holed AS (SELECT instrument, ts,
  CASE WHEN volume % 5 = 0 THEN NULL ELSE oi END AS oi FROM events_bars),
k AS (SELECT *, last_value(oi IGNORE NULLS) OVER (PARTITION BY instrument ORDER BY ts ROWS UNBOUNDED PRECEDING) AS known
  FROM holed)
SELECT instrument, ts, oi - lag(oi) OVER w AS oi_change,
  round(known / nullif(lag(known) OVER w, 0)::DOUBLE - 1, 6) AS oi_pct_change FROM k {W}"""))
def oi_change_filled(spark, sf_dir):
    from pyspark.sql import functions as F

    holed = events_bars(spark, sf_dir).withColumn("oi", F.when(F.col("volume") % 5 != 0, F.col("oi")))
    out = I.oi_change(holed, fill=True, spec=INTRADAY)
    return rounded(out.select("instrument", "ts", "oi_change", "oi_pct_change"), "oi_pct_change")


def _derivatives(op, name, spark, sf_dir):
    bars, spec = lineitem_bars(spark, sf_dir), DAILY.measured(lineitem_bars(spark, sf_dir))
    for v in FIRST:
        bars = op(bars, variant=v, spec=spec, out=f"{name}_{v}")
    return select(bars, *[f"{name}_{v}" for v in FIRST])


@query("oi_first_derivative", with_lineitem(f""", {LAGS.format(bars='lineitem_bars')},
x AS (SELECT *, {all_variants(FIRST, 'doi')} FROM l) SELECT {columns(*[f'doi_{v}' for v in FIRST])} FROM x"""))
def oi_first_derivative(spark, sf_dir):
    return _derivatives(I.oi_first_derivative, "doi", spark, sf_dir)


@query("oi_second_derivative", with_lineitem(f""", {LAGS.format(bars='lineitem_bars')},
x AS (SELECT *, {all_variants(SECOND, 'd2oi')} FROM l) SELECT {columns(*[f'd2oi_{v}' for v in SECOND])} FROM x"""))
def oi_second_derivative(spark, sf_dir):
    return _derivatives(I.oi_second_derivative, "d2oi", spark, sf_dir)


@query("oi_momentum", with_lineitem(f""", {LAGS.format(bars='lineitem_bars')}
SELECT instrument, ts, oi - b4 AS oi_momentum FROM l"""))
def oi_momentum(spark, sf_dir):
    return I.oi_momentum(lineitem_bars(spark, sf_dir), spec=DAILY).select("instrument", "ts", "oi_momentum")


DIVERGENCE = "close / nullif(c1, 0) - 1 - (oi / nullif(b1, 0)::DOUBLE - 1) AS price_oi_divergence"


@query("price_oi_divergence", with_lineitem(f""", {LAGS.format(bars='lineitem_bars')}, x AS (SELECT *, {DIVERGENCE} FROM l)
SELECT {columns('price_oi_divergence')} FROM x"""))
def price_oi_divergence(spark, sf_dir):
    return select(I.price_oi_divergence(lineitem_bars(spark, sf_dir), DAILY), "price_oi_divergence")


ANALYSIS = ("oi_sma_10", "oi_sma_30", "oi_ratio", "oi_pct_change", "oi_derivative", "oi_second_derivative",
            "price_oi_divergence")
ANALYSIS_SQL = f"""{LAGS}, oa AS (SELECT *, {mean('oi', 10)} AS oi_sma_10, {mean('oi', 30)} AS oi_sma_30,
  oi - b1 AS oi_change, oi / nullif(b1, 0)::DOUBLE - 1 AS oi_pct_change, {FIRST['frame']} AS oi_derivative,
  {SECOND['frame']} AS oi_second_derivative, oi - b4 AS oi_momentum, {DIVERGENCE} FROM l {windows(10, 30)}),
a AS (SELECT *, oi / nullif(oi_sma_30, 0) AS oi_ratio FROM oa)"""


@query("oi_analysis", with_lineitem(f""", {ANALYSIS_SQL.format(bars='lineitem_bars')}
SELECT {columns(*ANALYSIS)}, oi_change, oi_momentum FROM a"""))
def oi_analysis(spark, sf_dir):
    out = I.oi_analysis(lineitem_bars(spark, sf_dir), DAILY)
    return rounded(out.select("instrument", "ts", *ANALYSIS, "oi_change", "oi_momentum"), *ANALYSIS)


@query("oi_baseline_ma", with_lineitem(f""", x AS (SELECT *, {mean('oi', 50)} AS oi_ma FROM lineitem_bars {windows(50)})
SELECT {columns('oi_ma')} FROM x"""))
def oi_baseline_ma(spark, sf_dir):
    return select(I.oi_baseline_ma(lineitem_bars(spark, sf_dir), spec=DAILY), "oi_ma")


@query("oi_zscore", with_lineitem(f""", x AS (SELECT *, close / nullif(lag(close) OVER w, 0) - 1 AS price_change,
  {mean('volume', 20)} AS volume_ma, {mean('oi', 20)} AS m, {std('oi', 20)} AS s FROM lineitem_bars {windows(20)}),
y AS (SELECT *, (oi - m) / nullif(s, 0) AS oi_zscore FROM x)
SELECT {columns('price_change', 'volume_ma', 'oi_zscore')} FROM y"""))
def oi_zscore(spark, sf_dir):
    return select(I.oi_zscore(lineitem_bars(spark, sf_dir), spec=DAILY), "price_change", "volume_ma", "oi_zscore")


RETURNS = f"""rt0 AS (SELECT *, close / nullif(lag(close) OVER w, 0) - 1 AS returns,
  (close - lag(close, 19) OVER w) / nullif(lag(close, 19) OVER w, 0) AS trend FROM {{bars}} {W}),
rt AS (SELECT *, {std('returns', 20)} AS volatility FROM rt0 {windows(20)})"""


@query("returns_vol_trend", with_lineitem(f""", {RETURNS.format(bars='lineitem_bars')}
SELECT {columns('returns', 'volatility', 'trend')} FROM rt"""))
def returns_vol_trend(spark, sf_dir):
    return select(I.returns_vol_trend(lineitem_bars(spark, sf_dir), spec=DAILY), "returns", "volatility", "trend")


@query("next_return", with_lineitem(f""", x AS (SELECT *, lead(close) OVER w / nullif(close, 0) - 1 AS next_return
  FROM lineitem_bars {W}) SELECT {columns('next_return')} FROM x"""))
def next_return(spark, sf_dir):
    return select(I.next_return(lineitem_bars(spark, sf_dir), DAILY), "next_return")


@query("rolling_ols_forecast", with_lineitem(f""", n AS (SELECT *, (row_number() OVER w)::DOUBLE AS x, oi::DOUBLE AS y
  FROM lineitem_bars {W}),
o AS (SELECT *, CASE WHEN count(y) OVER f = 3 THEN regr_slope(y, x) OVER f END AS slope,
  CASE WHEN count(y) OVER f = 3 THEN avg(y) OVER f + regr_slope(y, x) OVER f * (x - avg(x) OVER f) END AS next_value FROM n
  WINDOW f AS (PARTITION BY instrument ORDER BY ts ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING))
SELECT {columns('slope', 'next_value')},
  coalesce(x > 4 AND abs((next_value - y) / nullif(y, 0)) > 0.05 AND next_value < y, false) AS deviates FROM o"""))
def rolling_ols_forecast(spark, sf_dir):
    out = I.rolling_ols_forecast(lineitem_bars(spark, sf_dir), spec=DAILY)
    return rounded(out.select("instrument", "ts", "slope", "next_value", "deviates"), "slope", "next_value")


DECAY = 1 - 2 / 27


@query("ema_holed", with_events(f""", holed AS (SELECT instrument, ts, CASE WHEN volume % 5 <> 0 THEN close END AS price,
  row_number() OVER (PARTITION BY instrument ORDER BY ts) AS n FROM events_bars)
SELECT a.instrument, a.ts, a.price, round(sum(b.price * power({DECAY!r}::DOUBLE, a.n - b.n))
  / sum(power({DECAY!r}::DOUBLE, a.n - b.n)), 6) AS ema_26
FROM holed a LEFT JOIN holed b ON a.instrument = b.instrument AND b.n <= a.n AND b.n > a.n - 600 AND b.price IS NOT NULL
GROUP BY 1, 2, 3"""))
def ema_holed(spark, sf_dir):
    """Averages over missing prices."""
    bars = events_bars(spark, sf_dir).withColumn("price", F.when(F.col("volume") % 5 != 0, F.col("close")))
    return I.ema(bars, (26,), "price", INTRADAY).select("instrument", "ts", "price", F.round("ema_26", 6).alias("ema_26"))
