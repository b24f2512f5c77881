"""Exact quantile per group without gathering a group.

``percentile`` keeps every distinct value of a group in one buffer.  Here a mergeable sketch first brackets the
quantile; then values outside the bracket are only counted, and the few inside it are ranked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import join_on

ACCURACY = 100_000


def exact_quantile(
    df: DataFrame,
    c: str,
    q: float,
    keys: tuple[str, ...],
    out: str,
) -> DataFrame:
    """One row per group: the linearly interpolated ``q`` quantile of the non-null values of ``c``."""
    values = df.filter(F.col(c).isNotNull()).select(*keys, F.col(c).cast("double").alias("__v"))
    margin = 3.0 / ACCURACY
    levels = [max(0.0, q - margin), min(1.0, q + margin)]
    bracket = values.groupBy(*keys).agg(
        F.percentile_approx("__v", levels, ACCURACY).alias("__b"), F.count("*").alias("__n")
    )
    bracket = bracket.select(
        *keys, F.col("__b")[0].alias("__from"), F.col("__b")[1].alias("__to"), (F.lit(q) * (F.col("__n") - 1)).alias("__rank")
    )
    zone = F.when(F.col("__v") < F.col("__from"), -1).when(F.col("__v") > F.col("__to"), 1).otherwise(0)
    zoned = join_on(values, bracket, keys).withColumn("__zone", zone)
    counted = (
        zoned.withColumn("__inside", F.when(F.col("__zone") == 0, F.col("__v")))
        .groupBy(*keys, "__rank", "__zone", "__inside")
        .agg(F.count("*").alias("__n"), F.min("__v").alias("__min"), F.max("__v").alias("__max"))
    )
    ascending = Window.partitionBy(*keys).orderBy("__zone", "__inside")
    ranked = counted.withColumn(
        "__end", F.sum("__n").over(ascending.rowsBetween(Window.unboundedPreceding, 0))
    ).withColumn("__begin", F.col("__end") - F.col("__n"))

    def value_at(rank):
        """The value of 0-based rank: below the bracket only its largest value is known, above only its smallest."""
        holds = (F.col("__begin") <= rank) & (rank < F.col("__end"))
        known = (
            F.when(F.col("__zone") == 0, F.col("__inside"))
            .when((F.col("__zone") < 0) & (rank == F.col("__end") - 1), F.col("__max"))
            .when((F.col("__zone") > 0) & (rank == F.col("__begin")), F.col("__min"))
            .otherwise(F.raise_error(F.lit("quantile outside its bracket")).cast("double"))
        )
        return F.max(F.when(holds, known))

    low = F.floor("__rank")
    return (
        ranked.groupBy(*keys, "__rank")
        .agg(value_at(low).alias("__low"), value_at(low + 1).alias("__high"))
        .select(
            *keys,
            (
                F.col("__low")
                + (F.col("__rank") - F.floor("__rank")) * (F.coalesce("__high", "__low") - F.col("__low"))
            ).alias(out),
        )
    )
