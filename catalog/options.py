"""Option chains, lookups and unions. Chains come from ``part``: a brand is an underlying, a retail price a strike."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.signals import MAIN, MAIN_FLAGS, main_flags
from catalog.views import DAILY, INTRADAY, events_bars, lineitem_bars, table, with_events, with_lineitem
from tidemark.operators import lookups as L
from tidemark.operators import options as O

EXPIRY = datetime(1998, 6, 25, 15, 30)

CHAIN = """chain AS (SELECT DISTINCT p_brand AS underlying, p_retailprice AS strike,
  CASE WHEN p_partkey % 2 = 0 THEN 'CE' ELSE 'PE' END AS option_type FROM part),
ladder AS (SELECT underlying, strike, row_number() OVER (PARTITION BY underlying ORDER BY strike)::INTEGER AS pos
  FROM (SELECT DISTINCT underlying, strike FROM chain))"""

# spot of a brand over time: the highest unit price of its shipments that day, folded into the range of the strikes
SPOT = """spot AS (SELECT p_brand AS underlying, l_shipdate AS ts,
  max(l_extendedprice / l_quantity) % 220 + 890 AS spot FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY 1, 2),
atm AS (SELECT * FROM (SELECT s.underlying, s.ts, s.spot, l.pos AS atm_pos, l.strike AS atm_strike,
    row_number() OVER (PARTITION BY s.underlying, s.ts ORDER BY abs(l.strike - s.spot), l.pos) AS near
  FROM spot s JOIN ladder l USING (underlying)) WHERE near = 1)"""


def chain(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("underlying"),
        F.col("p_retailprice").alias("strike"),
        F.when(F.col("p_partkey") % 2 == 0, "CE").otherwise("PE").alias("option_type"),
    ).distinct()


def spot(spark, sf_dir):
    brands = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("underlying"))
    price = F.max(F.col("l_extendedprice") / F.col("l_quantity")) % 220 + 890
    return (
        table(spark, sf_dir, "lineitem").join(brands, "l_partkey")
        .groupBy("underlying", F.col("l_shipdate").alias("ts"))
        .agg(price.alias("spot"))
    )


@query("atm_strike", f"WITH {CHAIN}, {SPOT} SELECT underlying, ts, spot, atm_pos, atm_strike FROM atm")
def atm_strike(spark, sf_dir):
    return O.atm_strike(chain(spark, sf_dir), spot(spark, sf_dir), keys=("underlying",))


def _selected(sign: str) -> str:
    return f"""WITH {CHAIN}, {SPOT} SELECT a.underlying, a.ts, a.spot, a.atm_strike, r.rank::INTEGER AS rank, l.strike
FROM atm a, (SELECT unnest(range(3)) AS rank) r, ladder l
WHERE l.underlying = a.underlying AND l.pos = a.atm_pos {sign} r.rank"""


def _select(spark, sf_dir, movement):
    out = O.select_strikes(chain(spark, sf_dir), spot(spark, sf_dir), movement, 3, keys=("underlying",))
    return out.select("underlying", "ts", "spot", "atm_strike", "rank", "strike")


@query("select_strikes", _selected("+"))
def select_strikes(spark, sf_dir):
    return _select(spark, sf_dir, O.SHORT_COVERING)


@query("select_strikes_down", _selected("-"))
def select_strikes_down(spark, sf_dir):
    return _select(spark, sf_dir, O.LONG_UNWINDING)


@query("option_side", f"""WITH {CHAIN} SELECT 'short_covering' AS movement, * FROM chain WHERE option_type = 'CE'
UNION ALL SELECT 'long_unwinding', * FROM chain WHERE option_type = 'PE'""")
def option_side(spark, sf_dir):
    c = chain(spark, sf_dir)
    parts = [O.option_side(c, m).select(F.lit(m).alias("movement"), "*") for m in (O.SHORT_COVERING, O.LONG_UNWINDING)]
    return parts[0].unionByName(parts[1])


# an order is an option bought at noon of its order date
DTE = "CAST(floor((epoch_us(TIMESTAMP '1998-06-25 15:30:00') - epoch_us(o_orderdate + INTERVAL 12 HOUR)) / 86400000000) AS BIGINT)"


def _orders(spark, sf_dir):
    at_noon = F.col("o_orderdate") + F.expr("INTERVAL 12 HOURS")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", at_noon.alias("ts"))
    return O.days_to_expiry(orders.withColumn("expiry", F.lit(EXPIRY).cast("timestamp_ntz")))


@query("days_to_expiry", f"SELECT o_orderkey, {DTE} AS dte FROM orders")
def days_to_expiry(spark, sf_dir):
    return _orders(spark, sf_dir).select("o_orderkey", "dte")


@query("dte_filter", f"SELECT o_orderkey, {DTE} AS dte FROM orders WHERE {DTE} BETWEEN 1 AND 4")
def dte_filter(spark, sf_dir):
    return O.dte_filter(_orders(spark, sf_dir)).select("o_orderkey", "dte")


# the volatility index: one reading per order date, scaled into the usual range
VIX = """vix AS (SELECT o_orderdate AS ts, round(avg(o_totalprice) / 10000, 4) AS vix FROM orders GROUP BY 1)"""


@query("environment_filter", with_lineitem(f""", {MAIN.format(bars='lineitem_bars')}, {MAIN_FLAGS}, {VIX}
SELECT f.instrument, f.ts, f.close, v.vix FROM f ASOF JOIN vix v ON f.ts >= v.ts
WHERE entry AND v.vix <= 25 AND f.close BETWEEN 1 AND 3000"""))
def environment_filter(spark, sf_dir):
    flags, _ = main_flags(lineitem_bars(spark, sf_dir), DAILY)
    vix = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderdate").alias("ts")).agg(F.round(F.avg("o_totalprice") / 10000, 4).alias("vix"))
    )
    entries = flags.filter("entry").select("instrument", "ts", "close")
    return O.environment_filter(entries, vix, price=(1.0, 3000.0))


# suppliers as instruments: the key is the token, the nation the exchange
INSTRUMENTS = """master AS (SELECT s_suppkey AS instrument_token, s_name AS tradingsymbol, n_name AS exchange
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""


def _instruments(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("exchange"))
    return table(spark, sf_dir, "supplier").join(nation, "s_nationkey").select(
        F.col("s_suppkey").alias("instrument_token"), F.col("s_name").alias("tradingsymbol"), "exchange"
    )


@query("instrument_master", f"WITH {INSTRUMENTS} SELECT * FROM master WHERE exchange = 'NATION_3'")
def instrument_master(spark, sf_dir):
    return L.instrument_master(_instruments(spark, sf_dir), "NATION_3")


@query("instrument_lookup", with_lineitem(f""", {INSTRUMENTS},
known AS (SELECT instrument_token, min(tradingsymbol) AS tradingsymbol FROM master GROUP BY 1),
listed AS (SELECT CASE WHEN instrument % 10 = 3 THEN -instrument ELSE instrument END AS instrument, ts FROM lineitem_bars)
SELECT instrument, ts, tradingsymbol, coalesce(tradingsymbol, 'Token-' || instrument) AS label
FROM listed LEFT JOIN known ON instrument = instrument_token"""))
def instrument_lookup(spark, sf_dir):
    """Some bars carry a token that the master lacks."""
    unknown = F.when(F.col("instrument") % 10 == 3, -F.col("instrument")).otherwise(F.col("instrument"))
    bars = lineitem_bars(spark, sf_dir).withColumn("instrument", unknown)
    out = L.instrument_lookup(bars, _instruments(spark, sf_dir))
    return out.select("instrument", "ts", "tradingsymbol", "label")


@query("history_slice", with_events("""SELECT instrument, ts, open, high, low, close, volume FROM events_bars
WHERE instrument = 'click' AND ts BETWEEN TIMESTAMP '2024-01-15 12:00:00' - INTERVAL 360 MINUTE
  AND TIMESTAMP '2024-01-15 12:00:00'"""))
def history_slice(spark, sf_dir):
    return L.history_slice(events_bars(spark, sf_dir), "click", datetime(2024, 1, 15, 12), 120, include_oi=False,
                           spec=INTRADAY)


@query("positions_union", """SELECT l_suppkey AS instrument, sum(l_quantity) AS quantity, NULL::TIMESTAMP AS day
FROM lineitem GROUP BY 1
UNION ALL SELECT l_suppkey, sum(l_quantity), l_shipdate FROM lineitem GROUP BY 1, 3""")
def positions_union(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").withColumnRenamed("l_suppkey", "instrument")
    net = items.groupBy("instrument").agg(F.sum("l_quantity").alias("quantity"))
    day = items.groupBy("instrument", F.col("l_shipdate").alias("day")).agg(F.sum("l_quantity").alias("quantity"))
    return L.positions_union(net, day)
