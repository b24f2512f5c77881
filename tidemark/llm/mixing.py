"""Mixing sources to target weights by weighted fair queueing.

A source's documents are put in a shuffled order and pass twice.  A document's virtual finish time is the number of its
source's words up to and including it, divided by the source's target.  All passes of all documents are range-sorted by finish
time and cut where the words taken reach the total budget.  Since a source's words run at a rate in proportion to its target,
every source meets its target within about a document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, checkpointed, running_total

#: Hexadecimal digits of the shuffled order by which a source's documents are dealt to tasks: 16**3 parts.
PART_DIGITS = 3


def n_words(text: Column) -> Column:
    """Runs of characters that are no white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """(source, source_size, place, weight, target) from (source, source_size), one row a source.

    Weights repeat along the sources by code point, null last.  Targets share ``share`` of all sizes by weight; none exceeds
    ``most`` times its source's size, and what that leaves is shared again among the others until none is above.
    ``share`` must not exceed ``most``.  Each round of sharing is one aggregate over the sources.
    """
    if share > most:
        raise ValueError("share must not exceed most")
    order = [F.col("source").isNull(), F.col("source")]
    ranked = running_total(sizes, order, F.lit(1), "place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    ranked = checkpointed(ranked.withColumn("weight", weight).withColumn("__most", F.lit(float(most)) * F.col("source_size")))
    budget = share * float(ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0])
    rate, full = 0.0, -1
    while True:
        is_full = F.col("__most") <= F.lit(rate) * F.col("weight")
        row = ranked.agg(
            F.count(F.when(is_full, 1)).alias("full"),
            F.coalesce(F.sum(F.when(is_full, F.col("__most"))), F.lit(0.0)).alias("given"),
            F.coalesce(F.sum(F.when(~is_full, F.col("weight"))), F.lit(0.0)).alias("weights"),
        ).first()
        if row["full"] == full or row["weights"] == 0:
            break
        full, rate = row["full"], (budget - row["given"]) / row["weights"]
    target = F.least(F.col("__most"), F.lit(rate) * F.col("weight")) if row["weights"] else F.col("__most")
    return ranked.select("source", "source_size", "place", "weight", target.alias("target"))


def passes(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
           weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """(id, source, size, source_size, target, mark, times): how often the mix takes each row of ``df``.

    Rows of an equal id and size are equal; ties in the shuffled order (by a hash of the id, or of the text where there is
    no id) go to them in any order, which changes no result.  Null texts have size 0; a null source is a source, the last one; with no words at all every target
    is 0 and every row is taken once in each pass.  An empty table gives no rows.  Other columns are not read.
    """
    docs = df.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        n_words(F.col(text_col)).alias("size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("null "), F.xxhash64(text_col))).cast("binary")).alias("mark"),
        F.xxhash64(text_col).alias("content"),
    )
    docs = checkpointed(docs)  # texts are read once
    part = F.substring("mark", 1, PART_DIGITS)
    sums = docs.groupBy("source", part.alias("part")).agg(F.sum("size").alias("words"))
    sums = checkpointed(sums)
    wanted = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("start", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    starts = starts.join(wanted, starts["source"].eqNullSafe(wanted["source"])).select(
        starts["source"].alias("of"), F.col("part").alias("of_part"), "start", "source_size", "place", "target")
    order = Window.partitionBy("source", "part").orderBy("mark", "id", "size", "content")
    queued = (
        docs.withColumn("part", part)
        .withColumn("within", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("turn", F.row_number().over(order))
        .join(starts, F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("of_part")))
        .withColumn("round", F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(most)])))
    )
    words = F.col("round") * F.col("source_size") + F.col("start") + F.col("within")
    finish = F.when(F.col("target") > 0, words / F.col("target")).otherwise(F.lit(0.0))
    queued = queued.select("id", "source", "size", "source_size", "place", "target", "mark", "content", "turn", finish.alias("finish"))
    total = running_total(queued, [F.col(c) for c in ("finish", "place", "mark", "id", "size", "content", "turn")], F.col("size"), "total")
    budget = share * (wanted.agg(F.sum("source_size")).first()[0] or 0)
    taken = F.col("total") <= F.lit(float(budget))
    same = ["id", "source", "size", "source_size", "place", "target", "mark", "content", "turn"]
    return total.groupBy(*same).agg(F.sum(taken.cast("int")).alias("times")).drop("place")


def mixed(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **settings) -> DataFrame:
    """The mix itself: every row of ``df`` as often as it is taken, all columns as they were.

    Repeated rows (of an equal id, text and source) are taken as often together as ``passes`` counts them together.  Where the
    cut falls inside them, some are taken once more than the others; which ones is not fixed.
    """
    times = passes(df, id_col, source_col, text_col, **settings)
    counts = checkpointed(
        times.groupBy(F.col("id").alias("__id"), F.col("content").alias("__content"), F.col("source").alias("__source"))
        .agg(F.sum("times").alias("__sum"), F.count(F.lit(1)).alias("__copies"))
    )
    keyed = df.withColumn("__text", F.xxhash64(text_col))

    def matched(some: DataFrame) -> DataFrame:
        match = keyed[id_col].eqNullSafe(some["__id"]) & (keyed["__text"] == some["__content"]) & keyed[source_col].eqNullSafe(some["__source"])
        return keyed.join(some, match)

    even = F.col("__sum") % F.col("__copies") == 0
    out = matched(counts.where(even)).withColumn("__times", F.expr("__sum div __copies"))
    cut = counts.where(~even)  # about one group of repeated rows a source
    if not cut.isEmpty():
        out = out.unionByName(_dealt(matched(cut)))
    return (
        out.withColumn("__times", F.explode(F.expr("CASE WHEN __times > 0 THEN sequence(1L, __times) ELSE array() END")))
        .drop("__id", "__content", "__source", "__text", "__sum", "__copies", "__times")
    )


def _dealt(rows: DataFrame) -> DataFrame:
    """``rows`` with ``__times``, ``__sum`` of each group of repeated rows dealt evenly over its ``__copies`` rows.

    Rows are numbered in one order of all groups, so a large group is no single task.
    """
    group = ["__id", "__content", "__source"]
    rows = rows.withColumn("__salt", F.monotonically_increasing_id())
    order = [x for c in group for x in (F.col(c).isNull(), F.col(c))]
    turns = running_total(rows, [*order, F.col("__salt")], F.lit(1), "__turn")
    turns = checkpointed(turns)  # the numbers below must be those of one run
    first = turns.groupBy(*[F.col(c).alias(f"{c}_of") for c in group]).agg(F.min("__turn").alias("__first"))
    same = [F.col(c).eqNullSafe(F.col(f"{c}_of")) for c in group]
    extra = (F.col("__turn") - F.col("__first") < F.col("__sum") % F.col("__copies")).cast("bigint")
    return (
        turns.join(first, same[0] & same[1] & same[2])
        .withColumn("__times", F.expr("__sum div __copies") + extra)
        .drop("__salt", "__turn", "__first", *[f"{c}_of" for c in group])
    )
