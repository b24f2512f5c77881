"""Document fingerprints that add up: a homomorphic multiset hash of a text's paragraphs, in DataFrame expressions only.

A paragraph is hashed to a wide vector; a text's fingerprint is the sum of its paragraphs' vectors, lane by lane, modulo
2**48.  So the order of paragraphs does not matter, and paragraphs are inserted or deleted by adding or subtracting
their vectors.  Lanes: the number of paragraphs, four full hashes (equality), and 48 lanes that each count two bits of
the hash (24 bits a counter).  The counters are a linear sketch of the multiset: the squared length of a difference of two
fingerprints estimates how many paragraphs two texts do not share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import partitions

FULL, COUNTERS, BITS = 4, 48, 24
LANES = 1 + FULL + COUNTERS
MODULUS = (1 << 48) - 1
PAIR = (1 << BITS) | 1
LOW = (1 << BITS) - 1

#: Ranges of ids that the driver learns of, at most (two numbers each).
MAX_RANGES = 4096


def paragraphs(text: Column) -> Column:
    """The lines of a text that are not blank, without white space at their ends."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda p: F.trim(p)), lambda p: p != "")


def _vector(hashes: Column) -> Column:
    """The lanes of one paragraph from its four hashes."""
    full = [hashes[i].bitwiseAND(F.lit(MODULUS)) for i in range(FULL)]
    counted = [F.shiftrightunsigned(hashes[j // BITS], j % BITS).bitwiseAND(F.lit(PAIR)) for j in range(COUNTERS)]
    return F.array(F.lit(1).cast("bigint"), *full, *counted)


def added(a: Column, b: Column) -> Column:
    """The fingerprint of two texts' paragraphs together."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(F.lit(MODULUS)))


def removed(a: Column, b: Column) -> Column:
    """The fingerprint of what is left of ``a`` once the paragraphs of ``b`` are deleted."""
    return F.zip_with(a, b, lambda x, y: (x - y).bitwiseAND(F.lit(MODULUS)))


def fingerprint(text: Column) -> Column:
    """The lanes of ``text`` as an array of longs; null counts as empty, whose lanes are all 0."""
    hashes = F.transform(paragraphs(text), lambda p: F.array(*[F.xxhash64(F.lit(k), p) for k in range(FULL)]))
    return F.aggregate(hashes, F.array_repeat(F.lit(0).cast("bigint"), LANES), lambda sums, h: added(sums, _vector(h)))


def as_text(lanes: Column) -> Column:
    """Twelve hexadecimal digits a lane."""
    return F.lower(F.array_join(F.transform(lanes, lambda x: F.lpad(F.hex(x), 12, "0")), ""))


def _squared(lanes: Column) -> Column:
    """The estimated squared length of the paragraph multiset: each counter c of n paragraphs stands for 2c - n."""
    n = lanes[0]
    part = lambda x: (2 * x - n).cast("double") * (2 * x - n)
    return F.aggregate(
        F.slice(lanes, 2 + FULL, COUNTERS),
        F.lit(0.0),
        lambda total, x: total + part(x.bitwiseAND(F.lit(LOW))) + part(F.shiftrightunsigned(x, BITS)),
    ) / F.lit(2.0 * COUNTERS)


def _squared_difference(a: Column, b: Column) -> Column:
    def apart(x: Column, y: Column) -> Column:
        n = a[0] - b[0]
        low = x.bitwiseAND(F.lit(LOW)) - y.bitwiseAND(F.lit(LOW))
        high = F.shiftrightunsigned(x, BITS) - F.shiftrightunsigned(y, BITS)
        return (2 * low - n).cast("double") * (2 * low - n) + (2 * high - n).cast("double") * (2 * high - n)

    each = F.zip_with(F.slice(a, 2 + FULL, COUNTERS), F.slice(b, 2 + FULL, COUNTERS), apart)
    return F.aggregate(each, F.lit(0.0), lambda total, x: total + x) / F.lit(2.0 * COUNTERS)


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: the estimated share of paragraphs that two texts have in common; 1 for equal fingerprints.

    2<a,b> / (|a|**2 + |b|**2) over the two multisets, with a standard error of about 0.14.
    """
    both = _squared(a) + _squared(b)
    shared = F.when(both > 0, 1 - _squared_difference(a, b) / both).otherwise(F.lit(0.0))
    return F.when(a == b, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), shared)))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) for every row; null and empty texts have lanes of 0; equal rows stay; other columns are not read."""
    return df.select(F.col(id_col), fingerprint(F.col(text_col)).alias("fingerprint"))


def with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, next_text): every row with the text that follows in descending id order; the first follows the last.

    Null ids come last; rows of one id are ordered by text.  Null texts stay null; an empty table gives no rows; a
    single row follows itself.  Ids are cut into ranges of like size, and each range also gets a copy of the first row of the
    range below, so that texts move in one shuffle.  The driver learns a bound and a largest id for each range.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    ranges = min(MAX_RANGES, 4 * partitions(spark))
    cuts = rows.agg(F.percentile_approx("id", [i / ranges for i in range(1, ranges)], 20 * ranges).alias("cuts")).first()["cuts"]
    bounds = F.array(*[F.lit(c) for c in sorted(set(cuts or []))]).cast("array<bigint>")
    placed = rows.withColumn("range", F.coalesce(F.size(F.filter(bounds, lambda b: b <= F.col("id"))), F.lit(0)))
    first = placed.groupBy("range").agg(F.max("id").alias("first")).orderBy("range").collect()  # at most MAX_RANGES rows
    heads = [(r["range"], r["first"], first[(i + 1) % len(first)]["range"]) for i, r in enumerate(first)]
    heads = spark.createDataFrame(heads, "range int, first bigint, above int")
    own = F.struct(F.lit(0).alias("copy"), F.col("range").alias("at"))
    copy = F.struct(F.lit(1).alias("copy"), F.col("above").alias("at"))
    dealt = (
        placed.join(F.broadcast(heads), "range")  # at most MAX_RANGES rows
        .select("id", "text", F.inline(F.when(F.col("id").eqNullSafe(F.col("first")), F.array(own, copy)).otherwise(F.array(own))))
        .repartition(F.col("at"))
    )
    order = Window.partitionBy("at").orderBy("copy", F.col("id").desc_nulls_last(), F.col("text").asc_nulls_last())
    return (
        dealt.withColumn("next_text", F.lead("text").over(order))
        .where("copy = 0")
        .select(F.col("id").alias(id_col), F.col("text").alias(text_col), "next_text")
    )


def edited(text: Column, next_text: Column) -> Column:
    """``text`` with its last floor(n/2) characters replaced by as many of ``next_text`` (or all it has)."""
    text, next_text = F.coalesce(text, F.lit("")), F.coalesce(next_text, F.lit(""))
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(next_text, F.lit(1), half))


def fingerprint_edits(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next) for every row; see ``with_next``.

    Fingerprints are arrays of lanes.  Null texts count as empty; two empty texts are equal, so their likeness is 1.
    """
    pairs = with_next(df, id_col, text_col).withColumn("edited", edited(F.col(text_col), F.col("next_text")))
    own = pairs.select(
        id_col,
        F.length(F.coalesce(text_col, F.lit(""))).cast("bigint").alias("n_chars"),
        "edited",
        fingerprint(F.col(text_col)).alias("fingerprint"),
        fingerprint(F.col("edited")).alias("edited_fingerprint"),
        fingerprint(F.col("next_text")).alias("next_fingerprint"),
    )
    return own.select(
        id_col, "n_chars", "edited", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
