"""Typed event records (signals, orders, executions, closed trades, account states, errors, market data)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import minutes_between

# one table for all kinds; what does not apply to a kind is NULL
EVENT_FIELDS = {
    "kind": T.StringType(),
    "instrument": T.StringType(),
    "ts": T.TimestampNTZType(),
    "action": T.StringType(),
    "price": T.DoubleType(),
    "quantity": T.LongType(),
    "volume": T.LongType(),
    "oi": T.LongType(),
    "commission": T.DoubleType(),
    "pnl": T.DoubleType(),
    "status": T.StringType(),
    "minutes_held": T.DoubleType(),
    "trade_no": T.LongType(),
    "total_value": T.DoubleType(),
    "cash": T.DoubleType(),
    "positions": T.LongType(),
    "reason": T.StringType(),
}

EVENTS = T.StructType([T.StructField(n, t) for n, t in EVENT_FIELDS.items()])


def event_records(df: DataFrame, kind: str | None = None) -> DataFrame:
    """``df`` in the shape of the event table: same-named columns are kept, the others NULL."""
    values = {n: F.col(n) if n in df.columns else F.lit(None) for n in EVENT_FIELDS}
    if kind is not None:
        values["kind"] = F.lit(kind)
    return df.select(*[values[n].cast(t).alias(n) for n, t in EVENT_FIELDS.items()])


def signal_events(signals: DataFrame, include_hold: bool = False) -> DataFrame:
    """From bars with ``signal``, ``close`` and ``reason``."""
    acting = signals if include_hold else signals.filter(F.col("signal") != "HOLD")
    return event_records(acting.withColumns({"action": F.col("signal"), "price": F.col("close")}), "SIGNAL")


def order_events(orders: DataFrame, quantity: int = 25) -> DataFrame:
    """From bars with ``side`` and ``close``: the orders of the live position."""
    shaped = orders.withColumns({"action": F.col("side"), "price": F.col("close"), "quantity": F.lit(quantity)})
    return event_records(shaped, "ORDER")


def execution_events(trades: DataFrame, rate: float = 0.001) -> DataFrame:
    """Two fills per closed trade, one for an open one, each with its own commission."""
    fill = lambda action, ts, price: F.struct(F.lit(action).alias("action"), F.col(ts).alias("ts"),
                                              F.col(price).alias("price"))
    fills = trades.select(
        "instrument", F.col("size").alias("quantity"),
        F.inline(F.array(fill("BUY", "entry_ts", "entry_price"), fill("SELL", "exit_ts", "exit_price"))),
    ).filter(F.col("ts").isNotNull())
    return event_records(fills.withColumn("commission", F.col("price") * F.col("quantity") * F.lit(rate)), "EXECUTION")


def trade_closed_events(trades: DataFrame) -> DataFrame:
    """One record per closed trade: PROFIT above zero, else LOSS, and its running number."""
    closed = trades.filter(F.col("exit_ts").isNotNull())
    return event_records(
        closed.withColumns(
            {
                "ts": F.col("exit_ts"),
                "status": F.when(F.col("pnl") > 0, F.lit("PROFIT")).otherwise(F.lit("LOSS")),
                "minutes_held": minutes_between(F.col("exit_ts"), F.col("entry_ts")),
                "reason": F.col("exit_reason"),
            }
        ),
        "TRADE CLOSED",
    )


def market_data_events(bars: DataFrame) -> DataFrame:
    return event_records(bars.withColumn("price", F.col("close")), "MARKET DATA")


def portfolio_events(states: DataFrame) -> DataFrame:
    """From rows with ``total_value``, ``cash`` and ``positions``."""
    return event_records(states, "PORTFOLIO")


def error_events(errors: DataFrame) -> DataFrame:
    """From rows with ``action`` (the type of the error) and ``reason`` (its message)."""
    return event_records(errors, "ERROR")


def write_events(events: DataFrame, path: str, batch: int | str) -> None:
    """Append one batch of records. Writing the same batch again replaces it, so a repeated write adds nothing."""
    events.write.mode("overwrite").parquet(f"{path}/batch={batch}")
