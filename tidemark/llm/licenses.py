"""Licence scans by diagonal voting, in DataFrame expressions only.

Every rolling group of words of every text is hashed and joined to the same hashes of the templates (phrases and
notices).  A match of text place p and template place t votes for the diagonal p - t.  Votes are counted per diagonal,
neighbouring diagonals (words put in or left out) are merged into bands, and a band with enough of the template's groups is
verified: a find is the best stretch of at most twice the template's length in which enough of them stand, word for word.  So what
stands beside a notice, and chains its band to others, does not hide it.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed
from tidemark.llm.license_texts import NOTICES, PHRASES

#: Words in a group: of the longest templates, of phrases and short notices.
LONG, SHORT = 4, 2
#: Diagonals of one template that differ by at most this many words belong together.
NEIGHBOURS = 4
#: Share of a notice's groups that must stand in a band.
COVERED = 0.7
#: Templates hold at most this many groups in all; they are sent to every executor.
MAX_GROUPS = 100_000

_APART = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text, in lower case as far as ASCII goes: runs of letters, digits and characters beyond ASCII.

    Beyond ASCII, case does not matter, as templates are ASCII.  Only the Kelvin sign and the dotted capital I have ASCII in their
    lower case; they are replaced first.
    """
    text = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("κ")), F.lit("İ"), F.lit("ι"))
    return F.filter(F.split(F.lower(text), _APART), lambda w: w != "")


def template_words(text: str) -> list[str]:
    return [w for w in re.split(_APART, text.lower()) if w]


def _templates(df: DataFrame, phrases: Mapping[str, str], notices: Sequence[tuple[str, str]]) -> DataFrame:
    """(hash, group, template, at, label, phrase, groups, length): a row for each group of words of each template."""
    rows = []
    listed = [(label, text, True) for text, label in phrases.items()] + [(label, text, False) for label, text in notices]
    for i, (label, text, phrase) in enumerate(listed):
        own = template_words(text)
        width = LONG if not phrase and len(own) > 2 * LONG else SHORT
        if len(own) < width:
            raise ValueError(f"a template needs {width} words at least: {text!r}")
        n = len(own) - width + 1
        rows += [(" ".join(own[k:k + width]), width, i, k, label, phrase, n, len(own)) for k in range(n)]
    if len(rows) > MAX_GROUPS:
        raise ValueError(f"the templates hold {len(rows)} groups of words; {MAX_GROUPS} are allowed")
    table = df.sparkSession.createDataFrame(
        rows, "group string, width int, template int, at int, label string, phrase boolean, groups int, length int")
    parts = F.split("group", " ")
    return table.withColumn(
        "hash",
        F.when(F.col("width") == LONG, F.xxhash64(*[F.get(parts, F.lit(i)) for i in range(LONG)]))
        .otherwise(F.xxhash64(*[F.get(parts, F.lit(i)) for i in range(SHORT)])),
    )


def _groups(own: Column, width: int) -> Column:
    """(at, hash, width) of every rolling group of ``width`` words."""
    def group(word: Column, at: Column) -> Column:
        rest = [F.get(own, at + i) for i in range(1, width)]
        return F.struct(at.alias("at"), F.xxhash64(word, *rest).alias("hash"), F.lit(width).alias("width"))

    return F.transform(F.slice(own, F.lit(1), F.greatest(F.size(own) - (width - 1), F.lit(0))), group)


def find_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: Mapping[str, str] = PHRASES,
                  notices: Sequence[tuple[str, str]] = NOTICES) -> DataFrame:
    """(id, n_words, found) for every row of ``df``.

    ``found`` lists label, phrase (whether a phrase or a notice), start and end (words from 0, end exclusive) and covered (share of
    the template's groups).  A phrase is found only in whole.  Null and empty texts have no words and an empty list.  Equal
    rows stay, each with the same result; a null id stays null; an empty table gives no rows; other columns are not read.
    """
    table = _templates(df, phrases, notices)
    hashes = [r["hash"] for r in table.select("hash").distinct().collect()]  # at most MAX_GROUPS
    docs = df.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("content"), words(F.col(text_col)).alias("words"))
    grouped = docs.select("id", "content", "words", F.concat(_groups(F.col("words"), SHORT), _groups(F.col("words"), LONG)).alias("all"))
    near = F.filter("all", lambda g: g["hash"].isin(hashes))  # a semi-join before its rows are made: the join drops all others
    own = F.struct(F.lit(None).cast("int").alias("at"), F.lit(None).cast("bigint").alias("hash"), F.lit(None).cast("string").alias("text"))
    kept = F.transform(near, lambda g: F.struct(
        g["at"].alias("at"), g["hash"].alias("hash"),
        F.array_join(F.slice(F.col("words"), g["at"] + 1, g["width"]), " ").alias("text")))
    rolled = grouped.select("id", "content", F.size("words").alias("n_words"), F.inline(F.concat(F.array(own), kept)))
    table = table.withColumnsRenamed({"at": "template_at", "hash": "template_hash", "group": "template_text"})
    votes = rolled.join(  # at most MAX_GROUPS rows
        F.broadcast(table), (F.col("hash") == F.col("template_hash")) & (F.col("text") == F.col("template_text")), "left")
    votes = votes.where("hash IS NULL OR template IS NOT NULL").withColumn("diagonal", F.col("at") - F.col("template_at"))

    doc = ["id", "content", "n_words"]
    template = ["template", "label", "phrase", "groups", "length"]
    # a row for each diagonal with votes, and one for the text itself, which counts equal rows
    diagonals = votes.groupBy(*doc, *template, "diagonal").agg(
        F.count("*").alias("rows"),
        F.collect_set("template_at").alias("places"),  # at most a template's length
        F.min("at").alias("first"),
        F.max("at").alias("last"),
    )
    by_diagonal = Window.partitionBy(*doc, *template).orderBy("diagonal")
    apart = F.col("phrase") | (F.col("diagonal") - F.lag("diagonal").over(by_diagonal) > NEIGHBOURS)
    bands = diagonals.withColumn("new", F.coalesce(apart, F.lit(True)).cast("int"))
    bands = bands.withColumn("band", F.sum("new").over(by_diagonal))
    width = F.when(~F.col("phrase") & (F.col("length") > 2 * LONG), LONG).otherwise(SHORT)
    covered = F.col("votes") / F.col("groups")

    def find(start: Column, end: Column) -> Column:
        return F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), "label", "phrase", covered.alias("covered"))

    # a phrase has one diagonal, which holds all of its groups
    sums = bands.groupBy(*doc, *template, "band").agg(
        F.sum("rows").alias("rows"), F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("votes"),
        F.collect_list(F.struct("diagonal", "places")).alias("diagonals"), F.min("first").alias("first"), F.max("last").alias("last"))
    sums = checkpointed(sums)  # texts are read once
    whole = sums.where("phrase AND votes = groups").select(*doc, find(F.col("first"), F.col("last") + width).alias("find"))
    likely = sums.where(~F.col("phrase") & (covered >= COVERED))
    longest = max((len(template_words(text)) for _, text in notices), default=0)
    found = whole.unionByName(_stretches(likely, doc, template, width, longest).where(covered >= COVERED).select(*doc, find(F.col("start"), F.col("end")).alias("find")))
    texts = sums.where("template IS NULL").select(*doc, F.lit(None).cast(found.schema["find"].dataType).alias("find"), "rows")
    return (
        found.withColumn("rows", F.lit(None).cast("bigint")).unionByName(texts).groupBy(*doc)
        .agg(F.max("rows").alias("rows"), F.array_sort(F.collect_list("find")).alias("found"))
        .withColumn("rows", F.explode(F.sequence(F.lit(1).cast("bigint"), "rows")))
        .select(F.col("id").alias(id_col), F.col("n_words").cast("bigint").alias("n_words"), "found")
    )


def _stretches(bands: DataFrame, doc: list[str], template: list[str], width: Column, longest: int) -> DataFrame:
    """(doc, template, start, end, votes) of the best stretch among those of a band that overlap.

    A stretch begins at a vote and holds the votes after it, up to twice the template's length.  The one with most of
    the template's groups counts, then the shortest, then the first.
    """
    votes = bands.select(*doc, *template, "band", F.inline("diagonals")).withColumn("place", F.explode("places"))
    votes = votes.withColumn("at", F.col("diagonal") + F.col("place")).drop("places", "diagonal")
    own = Window.partitionBy(*doc, *template, "band")
    ahead = own.orderBy("at").rangeBetween(0, 2 * longest)
    near = F.filter(F.collect_list(F.struct("at", "place")).over(ahead), lambda v: v["at"] - F.col("at") + width <= 2 * F.col("length"))
    votes = votes.withColumn("near", near)
    votes = votes.select(
        *doc, *template, "band", F.col("at").alias("start"), (F.array_max(F.transform("near", lambda v: v["at"])) + width).alias("end"),
        F.size(F.array_distinct(F.transform("near", lambda v: v["place"]))).alias("votes")).where(F.col("votes") / F.col("groups") >= COVERED)
    before = own.orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    votes = votes.withColumn("apart", F.coalesce(F.col("start") >= F.max("end").over(before), F.lit(True)).cast("int"))
    votes = votes.withColumn("group", F.sum("apart").over(own.orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)))
    best = F.max(F.struct("votes", (F.col("start") - F.col("end")).alias("shortness"), (-F.col("start")).alias("early")))
    return votes.groupBy(*doc, *template, "band", "group").agg(best.alias("best")).select(
        *doc, *template, F.col("best.votes").alias("votes"), (-F.col("best.early")).alias("start"),
        (-F.col("best.early") - F.col("best.shortness")).alias("end"))
