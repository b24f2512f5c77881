"""Helpers the corpus operators share."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.plans.storage import checkpointed, shared_folder

#: Runs of characters other than white space, as a Java and Python pattern.
WORD = r"[^\x20\x09-\x0D]+"

#: Texts per Arrow batch.  Texts may be very long, so a batch holds few of them.
TEXTS_PER_BATCH = 256

__all__ = ["TEXTS_PER_BATCH", "WORD", "checkpointed", "partitions", "release", "running_total", "shared_folder", "short_batches"]


def short_batches(spark: SparkSession) -> None:
    """Sends at most ``TEXTS_PER_BATCH`` rows at a time to Python, which bounds what a Python worker holds."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > TEXTS_PER_BATCH:
        spark.conf.set(key, str(TEXTS_PER_BATCH))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def release(spark: SparkSession) -> None:
    """Gives back the shuffle files and checkpoints of frames that nothing refers to any more.

    Spark's cleaner deletes them when the driver collects its garbage, which a driver with a roomy heap may not do for long.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def running_total(df: DataFrame, order: list[Column], value: Column, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over all rows up to and including each, in a total ``order`` over the whole table.

    Rows are range-sorted into partitions, whose sums (one row for each partition) give each partition's start.
    No task sees more than one range.  ``order`` should be total; equal rows may come in either order.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(4 * partitions(spark), *order)
    ranged = checkpointed(ranged.withColumns({"__range": F.spark_partition_id(), "__value": value.cast("bigint")}))
    sums = ranged.groupBy("__range").agg(F.sum("__value").alias("__sum"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range partition
    starts = sums.select("__range", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__start"))
    within = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.join(F.broadcast(starts), "__range")  # as many rows as range partitions
        .withColumn(name, F.col("__start") + F.sum("__value").over(within))
        .drop("__range", "__value", "__start")
    )
