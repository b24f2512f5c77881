"""Where streams end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources.events import event_records, write_events


def stream_event_sink(live: DataFrame, path: str, checkpoint: str, lot: int = 25, **trigger) -> StreamingQuery:
    """Append signal, order and trade records of the ``live_bars`` stream, one folder per batch.

    A batch repeated after a failure replaces its own folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_events(live_events(batch, lot), path, batch_id)

    return live.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def live_events(bars: DataFrame, lot: int = 25) -> DataFrame:
    """Records of live bars: the signal and the order of an acting bar, and the trade a SELL closes."""
    acting = bars.filter(F.col("action").isNotNull()).withColumns(
        {"ts": F.col("ts").cast("timestamp_ntz"), "price": F.col("close")}
    )
    text = lambda c: c.cast("string")
    none = F.lit(None)
    records = F.array(
        F.struct(F.lit("SIGNAL").alias("kind"), text(none).alias("status"), none.cast("bigint").alias("quantity")),
        F.struct(F.lit("ORDER").alias("kind"), text(none).alias("status"), F.lit(lot).cast("bigint").alias("quantity")),
        F.struct(
            F.lit("TRADE CLOSED").alias("kind"),
            text(F.when(F.col("pnl") > 0, F.lit("PROFIT")).otherwise(F.lit("LOSS"))).alias("status"),
            none.cast("bigint").alias("quantity"),
        ),
    )
    rows = acting.select("*", F.inline(records)).filter((F.col("kind") != "TRADE CLOSED") | (F.col("action") == "SELL"))
    only_trades = lambda c: F.when(F.col("kind") == "TRADE CLOSED", F.col(c))
    rows = rows.withColumns({"pnl": only_trades("pnl"), "minutes_held": only_trades("minutes_held")})
    return event_records(rows)


def write_table(stream: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append the stream to a parquet table."""
    writer = stream.writeStream.format("parquet").outputMode("append")
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start(path)
