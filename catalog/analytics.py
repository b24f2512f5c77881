"""Statistics over bars, signals and returns."""

from __future__ import annotations

from catalog.indicators import ANALYSIS_SQL, RETURNS, W
from catalog.registry import query
from catalog.signals import MAIN, MAIN_FLAGS, main_flags
from catalog.views import DAILY, INTRADAY, events_bars, lineitem_bars, rounded, with_events, with_lineitem
from tidemark.operators import analytics as A
from tidemark.operators import indicators as I

EQUITY = f"""{RETURNS},
e0 AS (SELECT *, product(1 + returns) OVER u AS equity FROM rt WHERE returns IS NOT NULL
  WINDOW u AS (PARTITION BY instrument ORDER BY ts ROWS UNBOUNDED PRECEDING)),
e1 AS (SELECT *, max(equity) OVER u AS running_max FROM e0
  WINDOW u AS (PARTITION BY instrument ORDER BY ts ROWS UNBOUNDED PRECEDING)),
e AS (SELECT *, (equity - running_max) / running_max AS drawdown FROM e1)"""


@query("equity_curve", with_lineitem(f""", {EQUITY.format(bars='lineitem_bars')}
SELECT instrument, ts, round(equity, 6) AS equity, round(running_max, 6) AS running_max, round(drawdown, 6) AS drawdown
FROM e"""))
def equity_curve(spark, sf_dir):
    bars = lineitem_bars(spark, sf_dir)
    spec = DAILY.measured(bars)
    out = A.equity_curve(I.returns_vol_trend(bars, spec=spec), spec=spec)
    names = ("equity", "running_max", "drawdown")
    return rounded(out.select("instrument", "ts", *names), *names)


METRICS = ("total_return", "annualized_return", "volatility", "sharpe_ratio", "max_drawdown", "win_rate", "avg_win",
           "avg_loss", "profit_factor")


@query("performance_metrics", with_lineitem(f""", {EQUITY.format(bars='lineitem_bars')},
m AS (SELECT instrument, product(1 + returns) - 1 AS total_return, count(*) AS total_trades,
  stddev_samp(returns) * sqrt(252) AS volatility, min(drawdown) AS max_drawdown,
  count(*) FILTER (returns > 0) / count(*)::DOUBLE AS win_rate,
  coalesce(avg(returns) FILTER (returns > 0), 0) AS avg_win, coalesce(avg(returns) FILTER (returns < 0), 0) AS avg_loss
  FROM e GROUP BY 1),
n AS (SELECT *, pow(1 + total_return, 252.0::DOUBLE / total_trades) - 1 AS annualized_return FROM m),
o AS (SELECT *, CASE WHEN volatility > 0 THEN annualized_return / volatility ELSE 0 END AS sharpe_ratio,
  coalesce(abs(avg_win / nullif(avg_loss, 0)), 0) AS profit_factor FROM n)
SELECT instrument, {', '.join(f'round({c}, 6) AS {c}' for c in METRICS)}, total_trades FROM o"""))
def performance_metrics(spark, sf_dir):
    bars = lineitem_bars(spark, sf_dir)
    spec = DAILY.measured(bars)
    return rounded(A.performance_metrics(I.returns_vol_trend(bars, spec=spec), spec=spec), *METRICS)


@query("oi_summary", with_lineitem("""SELECT instrument, min(oi) AS oi_min, max(oi) AS oi_max,
  round(avg(oi), 6) AS oi_mean, round(stddev_samp(oi), 6) AS oi_std FROM lineitem_bars GROUP BY 1"""))
def oi_summary(spark, sf_dir):
    return rounded(A.oi_summary(lineitem_bars(spark, sf_dir), DAILY), "oi_mean", "oi_std")


@query("correlations", with_lineitem(f""", x AS (SELECT *, close / nullif(lag(close) OVER w, 0) - 1 AS price_change,
  oi / nullif(lag(oi) OVER w, 0)::DOUBLE - 1 AS oi_pct_change FROM lineitem_bars {W})
SELECT instrument, round(corr(price_change, oi_pct_change), 6) AS corr_price_change_oi_pct_change,
  round(corr(volume, oi), 6) AS corr_volume_oi FROM x GROUP BY 1"""))
def correlations(spark, sf_dir):
    bars = lineitem_bars(spark, sf_dir)
    spec = DAILY.measured(bars)
    out = A.correlations(I.oi_zscore(I.oi_change(bars, spec=spec), spec=spec), spec=spec)
    return rounded(out, "corr_price_change_oi_pct_change", "corr_volume_oi")


FLAGS = f"{MAIN}, {MAIN_FLAGS}"


@query("signal_stats", with_events(f""", {FLAGS.format(bars='events_bars')},
g AS (SELECT *, epoch_us(ts) - epoch_us(lag(ts) OVER w) AS gap FROM f WHERE entry {W}),
c AS (SELECT instrument, count(*) AS bars FROM f GROUP BY 1)
SELECT instrument, count(g.ts) AS buy_signals, round(100.0::DOUBLE * count(g.ts) / any_value(bars), 6) AS buy_signal_pct,
  round(avg(gap / 60000000.0::DOUBLE), 6) AS mean_minutes, min(gap / 60000000.0::DOUBLE) AS min_minutes,
  max(gap / 60000000.0::DOUBLE) AS max_minutes FROM c LEFT JOIN g USING (instrument) GROUP BY 1"""))
def signal_stats(spark, sf_dir):
    flags, spec = main_flags(events_bars(spark, sf_dir), INTRADAY)
    return rounded(A.signal_stats(flags, spec=spec), "buy_signal_pct", "mean_minutes")


@query("signal_quality", with_lineitem(f""", {FLAGS.format(bars='lineitem_bars')},
x AS (SELECT *, lead(close) OVER w / nullif(close, 0) - 1 AS next_return FROM f {W})
SELECT instrument, count(*) AS signals, round(avg(next_return), 6) AS avg_next_return,
  round(avg(CASE WHEN next_return > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS win_rate
FROM x WHERE entry AND next_return IS NOT NULL AND oi_ma IS NOT NULL GROUP BY 1"""))
def signal_quality(spark, sf_dir):
    flags, spec = main_flags(lineitem_bars(spark, sf_dir), DAILY)
    return rounded(A.signal_quality(flags, spec=spec), "avg_next_return", "win_rate")


@query("oi_decline", with_lineitem("""SELECT instrument, arg_min(oi, ts) AS first_oi, arg_max(oi, ts) AS last_oi,
  round((arg_min(oi, ts) - arg_max(oi, ts)) / nullif(arg_min(oi, ts), 0)::DOUBLE * 100, 6) AS decline_pct
FROM lineitem_bars GROUP BY 1"""))
def oi_decline(spark, sf_dir):
    return rounded(A.oi_decline(lineitem_bars(spark, sf_dir), DAILY), "decline_pct")


@query("signal_counts", with_lineitem(f""", {FLAGS.format(bars='lineitem_bars')}
SELECT instrument, count(*) FILTER (entry) AS buy_signals, count(*) FILTER (exit) AS sell_signals FROM f GROUP BY 1"""))
def signal_counts(spark, sf_dir):
    flags, spec = main_flags(lineitem_bars(spark, sf_dir), DAILY)
    return A.signal_counts(flags, spec=spec)


@query("first_round_trip", with_lineitem(f""", {FLAGS.format(bars='lineitem_bars')},
b AS (SELECT instrument, min(ts) AS entry_ts, arg_min(close, ts) AS entry_price FROM f WHERE entry GROUP BY 1),
x AS (SELECT b.instrument, min(f.ts) AS exit_ts, arg_min(f.close, f.ts) AS exit_price
  FROM b JOIN f ON f.instrument = b.instrument AND f.exit AND f.ts > b.entry_ts GROUP BY 1)
SELECT instrument, entry_ts, entry_price, exit_ts, exit_price,
  round((exit_price - entry_price) / nullif(entry_price, 0) * 100, 6) AS return_pct FROM b LEFT JOIN x USING (instrument)"""))
def first_round_trip(spark, sf_dir):
    flags, spec = main_flags(lineitem_bars(spark, sf_dir), DAILY)
    return rounded(A.first_round_trip(flags, spec=spec), "return_pct")


REGIME = f"""{ANALYSIS_SQL}, {RETURNS.replace('{bars}', 'a')},
th AS (SELECT instrument, quantile_cont(volatility, 0.7) AS threshold FROM rt GROUP BY 1),
rg AS (SELECT rt.*, CASE WHEN volatility < threshold AND trend > 0.02 THEN 'Trending Up'
  WHEN volatility < threshold AND trend < -0.02 THEN 'Trending Down'
  WHEN volatility < threshold AND abs(trend) <= 0.02 THEN 'Sideways'
  WHEN volatility >= threshold THEN 'High Volatility' ELSE 'Unknown' END AS regime FROM rt LEFT JOIN th USING (instrument))"""


def regimes(spark, sf_dir):
    bars = lineitem_bars(spark, sf_dir)
    spec = DAILY.measured(bars)
    return A.regime_label(I.returns_vol_trend(I.oi_change(bars, spec=spec), spec=spec), spec=spec), spec


@query("regime_label", with_lineitem(f""", {REGIME.format(bars='lineitem_bars')}
SELECT instrument, ts, round(volatility, 6) AS volatility, round(trend, 6) AS trend, regime FROM rg"""))
def regime_label(spark, sf_dir):
    out, _ = regimes(spark, sf_dir)
    return rounded(out.select("instrument", "ts", "volatility", "trend", "regime"), "volatility", "trend")


@query("regime_distribution", with_lineitem(f""", {REGIME.format(bars='lineitem_bars')}
SELECT instrument, regime, count(*) AS periods,
  round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (PARTITION BY instrument), 6) AS pct FROM rg GROUP BY 1, 2"""))
def regime_distribution(spark, sf_dir):
    return rounded(A.regime_distribution(*regimes(spark, sf_dir)), "pct")


@query("oi_by_regime", with_lineitem(f""", {REGIME.format(bars='lineitem_bars')}
SELECT instrument, regime, round(avg(oi_pct_change), 6) AS avg_oi_change,
  round(stddev_samp(oi_pct_change), 6) AS oi_volatility FROM rg WHERE regime <> 'Unknown' GROUP BY 1, 2"""))
def oi_by_regime(spark, sf_dir):
    return rounded(A.oi_by_regime(*regimes(spark, sf_dir)), "avg_oi_change", "oi_volatility")


@query("derivative_histogram", with_events(f""", {ANALYSIS_SQL.format(bars='events_bars')},
ends AS (SELECT instrument, min(oi_derivative) AS a, max(oi_derivative) AS b FROM a GROUP BY 1),
cuts AS (SELECT instrument, CASE WHEN a = b THEN a - 0.5 ELSE a END AS lo,
  CASE WHEN a = b THEN 1.0 ELSE b - a END / 50::DOUBLE AS width FROM ends),
cnt AS (SELECT instrument, CAST(least(floor((oi_derivative - lo) / width), 49) AS INTEGER) AS bin, count(*) AS n
  FROM a JOIN cuts USING (instrument) WHERE oi_derivative IS NOT NULL GROUP BY 1, 2),
bins AS (SELECT instrument, lo, width, unnest(range(50))::INTEGER AS bin FROM cuts)
SELECT instrument, bin, round(lo + bin * width, 6) AS bin_from, round(lo + (bin + 1) * width, 6) AS bin_to,
  coalesce(n, 0) AS n FROM bins LEFT JOIN cnt USING (instrument, bin)"""))
def derivative_histogram(spark, sf_dir):
    bars = events_bars(spark, sf_dir)
    spec = INTRADAY.measured(bars)
    return rounded(A.derivative_histogram(I.oi_analysis(bars, spec), spec=spec), "bin_from", "bin_to")


@query("linear_fit", with_lineitem(f""", x AS (SELECT instrument, year(ts)::INTEGER AS year, oi::DOUBLE AS y,
  date_diff('day', DATE '1995-01-01', CAST(ts AS DATE))::DOUBLE AS x FROM lineitem_bars),
l AS (SELECT instrument, year, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept FROM x GROUP BY 1, 2)
SELECT instrument, year, CAST(x AS INTEGER) AS day_no, round(slope, 4) AS slope, round(intercept, 3) AS intercept,
  round(slope * x + intercept, 3) AS fitted FROM x JOIN l USING (instrument, year)"""))
def linear_fit(spark, sf_dir):
    from pyspark.sql import functions as F

    bars = lineitem_bars(spark, sf_dir).select(
        "instrument", F.year("ts").alias("year"), "oi",
        F.date_diff(F.to_date("ts"), F.lit("1995-01-01").cast("date")).alias("day_no"),
    )
    by = ("instrument", "year")
    fitted = A.fitted_values(bars, "day_no", "oi", by)
    lines = A.linear_fit(bars, "day_no", "oi", by).drop("n")
    out = fitted.join(lines, list(by)).select(*by, "day_no", "slope", "intercept", "fitted")
    return rounded(rounded(out, "slope", digits=4), "intercept", "fitted", digits=3)
