"""Near duplicates by MinHash with tensored banding.

A text is the set of its word shingles.  Two small collections, each of ``items`` keys of ``width`` minhashes, are computed for a
text; table keys are formed by combining every key of the one with every key of the other, so items * items tables
of 2 * width rows cost 2 * items * width minhashes, about the square root of what separate tables would take.

Equal sets are one text from then on.  A key that no other text has cannot make a table key that two texts share, so keys are
counted first and tables are formed from shared keys only.  Links are confirmed on full shingle sets, in two rounds that
lose none: first every text of a table against the table's smallest id, which joins groups of copies without all of
their pairs; then, in tables whose texts are still in several components, all pairs across components that pass an
exact bound on their intersection.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, checkpointed, release, short_batches
from tidemark.llm.components import components

#: 14 keys of 3 minhashes in each collection: two sets of likeness 0.8 share a table key with probability 0.9999.
ITEMS, WIDTH = 14, 3
SHINGLE, NUMERATOR, DENOMINATOR = 4, 80, 100

_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WORDS = re.compile(WORD).findall
#: White space to str.split that a word may hold.
_OTHER_SPACES = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]").search
#: Characters of distinct words whose hashes a Python worker remembers.
REMEMBERED = 2_000_000
#: What is sent to all executors to tell which texts are compared: 64 MiB at most.
BITS_PER_ID, MOST_BITMAPS = 64, 16_384


def split_words(text: str) -> list[str]:
    """What stands between ASCII white space."""
    return _WORDS(text) if _OTHER_SPACES(text) else text.split()


def words(text: str) -> list[str]:
    """The words of ``text`` with A-Z in lower case."""
    return split_words(text.lower() if text.isascii() else text.translate(_UPPER))


class Shingler:
    """Sets of hashed shingles; hashes of words are remembered for the next text."""

    def __init__(self, shingle: int):
        import xxhash

        self.hash = xxhash.xxh3_64_intdigest
        self.shingle = shingle
        self.known: dict[str, int] = {}
        self.held = 0

    def set_of(self, text: str | None) -> np.ndarray:
        """The distinct shingle hashes in ascending order; a text of fewer words is one shingle, one without words none."""
        own = words(text) if text else []
        if not own:
            return np.empty(0, np.uint64)
        if new := set(own).difference(self.known):
            for w in new:
                self.known[w] = self.hash(w.encode("utf-8", "surrogatepass"))
                self.held += len(w)
        hashes = np.fromiter(map(self.known.__getitem__, own), np.uint64, len(own))
        if self.held > REMEMBERED:
            self.known.clear()
            self.held = 0
        width = min(self.shingle, len(own))
        n = len(own) - width + 1
        out = np.full(n, np.uint64(len(own) if width < self.shingle else self.shingle), np.uint64)
        for i in range(width):
            out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i:i + n])
        return np.unique(out)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers (multiply and fold)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20240607)
    odd = draw.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return odd[:, None], draw.integers(0, 1 << 32, n, dtype=np.uint32)[:, None]


def min_hashes(found: np.ndarray, n: int) -> np.ndarray:
    """``n`` minhashes of a set: the smallest of its elements, folded to 32 bits, under n one-to-one maps."""
    odd, plus = _multipliers(n)
    folded = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(n, np.iinfo(np.uint32).max, np.uint32)
    for part in range(0, len(folded), 1024):  # what a cache holds
        x = folded[part:part + 1024] * odd
        x += plus
        np.minimum(least, x.min(axis=1), out=least)
    return least.view(np.int32)


def _sketch(shingle: int, n: int):
    def sketched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        shingler = Shingler(shingle)
        for batch in batches:
            rows = []
            for doc, text in zip(batch["id"], batch["text"]):
                own = shingler.set_of(text)
                mark = hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None
                rows.append((doc, len(own), mark, min_hashes(own, n) if len(own) else None))
            yield pd.DataFrame(rows, columns=["id", "n_shingles", "mark", "hashes"]).astype({"id": batch["id"].dtype})

    return sketched


def _sets(shingle: int):
    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(shingle)
        for batch in batches:
            yield pd.DataFrame({"node": batch["id"], "members": [shingler.set_of(t).view(np.int64) for t in batch["text"]]})

    return sets


def _linked(numerator: int, denominator: int):
    def linked(mine: pd.Series, theirs: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(mine, theirs):
            both = len(np.intersect1d(a, b, assume_unique=True))
            out.append(denominator * both >= numerator * (len(a) + len(b) - both))
        return pd.Series(out, dtype=bool)

    return linked


def _confirmed(pairs: DataFrame, sets: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """The pairs (a, b) whose full sets are alike enough."""
    check = F.pandas_udf(_linked(numerator, denominator), "boolean")
    mine = sets.select(F.col("node").alias("a"), F.col("members").alias("mine"))
    theirs = sets.select(F.col("node").alias("b"), F.col("members").alias("theirs"))
    return pairs.join(mine, "a").join(theirs, "b").where(check("mine", "theirs")).select("a", "b")


def _keys(items: int, width: int, at: int) -> Column:
    """The keys of a collection, the minhashes from place ``at`` on taken ``width`` at a time."""
    return F.array(*[
        F.xxhash64(F.lit(at + i), *[F.col("hashes")[(at + i) * width + k] for k in range(width)]) for i in range(items)])


def _shared_keys(texts: DataFrame, items: int, width: int) -> DataFrame:
    """(node, n, a, b): a text's keys of either collection that other texts have too, where both have some."""
    def told(first: bool) -> Column:
        return F.transform(_keys(items, width, 0 if first else items), lambda k: F.struct(F.lit(first).alias("first"), k.alias("key")))

    keys = texts.select("node", "n", F.inline(F.concat(told(True), told(False))))
    shared = keys.groupBy("key").count().where("count > 1").select("key")
    own = keys.join(shared, "key", "left_semi").groupBy("node", "n").agg(
        F.sort_array(F.collect_set(F.when(F.col("first"), F.col("key")))).alias("a"),  # at most ``items`` each
        F.sort_array(F.collect_set(F.when(~F.col("first"), F.col("key")))).alias("b"),
    )
    return own.where("size(a) > 0 AND size(b) > 0")


def _tables(own: DataFrame) -> DataFrame:
    """A row for each table key of each text: every first key combined with every second one."""
    return own.withColumn("x", F.explode("a")).withColumn("y", F.explode("b")).withColumn("key", F.xxhash64("x", "y")).drop("x", "y")


def _same_id(sketches: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between the different texts of one id, if there are such ids."""
    mark = F.xxhash64("mark")
    several = sketches.where("mark IS NOT NULL").groupBy("id").agg(F.min(mark).alias("low"), F.max(mark).alias("high"))
    several = several.where("low <> high").select("id")
    nodes = sketches.join(several, "id", "left_semi").join(texts.select("mark", "node"), "mark")
    first = nodes.groupBy("id").agg(F.min("node").alias("b"))
    return nodes.join(first, "id").select(F.col("node").alias("a"), "b").where("a <> b")


def _links_left(links: DataFrame, own: DataFrame, sets: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """The links between texts of one table that ``links`` leave in different components.

    The texts of tables that still hold several components put their shingles in order, rarest first; those that no
    other such text has come before all others.  If the first shingle that two texts share is at places i and j (from
    0), they share at most min(n - i, m - j), and a link needs 0.8 / 1.8 of n + m.  So only shingles early enough in both
    make a pair; in a group of copies, a text with many changes of its own makes few.  The bound is exact.  Of a
    shingle's texts, those of its largest component are compared with the others only.
    """
    names = components(links)
    tables = _tables(own.join(names, "node", "left").select("node", "a", "b", F.coalesce("component", "node").alias("component")))
    tables = tables.select("key", "node", "component")
    open_keys = tables.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    nodes = tables.join(open_keys.select("key"), "key", "left_semi").groupBy("node", "component").agg(F.lit(1).alias("one"))
    texts = sets.join(nodes, "node").select("node", "component", F.xxhash64("members").alias("set"), F.size("members").alias("n"), "members")
    texts = checkpointed(texts)
    members = texts.select("node", "set", F.explode("members").alias("member"))

    common = members.groupBy("member").agg(F.count("*").alias("times")).where("times > 1")
    shared = members.join(common, "member")
    text = Window.partitionBy("node", "set")
    early = (
        shared.withColumns({"held": F.count("*").over(text), "nth": F.row_number().over(text.orderBy("times", "member"))})
        .join(texts.drop("members"), ["node", "set"])
        .withColumn("at", F.col("n") - F.col("held") + F.col("nth") - 1)
        .where(denominator * F.col("at") <= (denominator - numerator) * F.col("n"))
        .select("member", "node", "component", "n", "at")
    )
    early = checkpointed(early)
    del members, common, shared, texts
    release(early.sparkSession)
    sizes = early.groupBy("member", "component").agg(F.count("*").alias("texts"))
    largest = sizes.groupBy("member").agg(
        F.max(F.struct("texts", "component"))["component"].alias("largest"), F.count("*").alias("several")).where("several > 1")
    few = early.join(largest, "member").where(F.col("component") != F.col("largest")).drop("largest", "several")
    others = early.withColumnsRenamed({c: f"{c}_b" for c in ("node", "component", "n", "at")})
    most = F.least(F.col("n") - F.col("at"), F.col("n_b") - F.col("at_b"))
    pairs = few.join(others, "member").where(
        (F.col("component") != F.col("component_b")) & ((numerator + denominator) * most >= numerator * (F.col("n") + F.col("n_b"))))
    ends = [F.least("node", "node_b").alias("a"), F.greatest("node", "node_b").alias("b")]
    pairs = checkpointed(pairs.groupBy(*ends).agg(F.lit(1).alias("one")))
    return _confirmed(pairs, sets, numerator, denominator)


def _perhaps_in(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows (id, text) whose id is among ``ids``, and a few others: texts stay where they are.

    Ids are hashed into bitmaps of some ``BITS_PER_ID`` bits for each, at most ``MOST_BITMAPS`` of 4 KiB, which are sent to all.
    """
    size = 32_768  # bits of a Spark bitmap
    bitmaps = min(MOST_BITMAPS, ids.count() * BITS_PER_ID // size + 1)
    mark = F.pmod(F.xxhash64("id"), F.lit(bitmaps * size))
    told = ids.select(mark.alias("mark")).selectExpr(f"mark div {size} AS part", f"mark % {size} AS bit")
    bits = told.groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits"))
    asked = rows.withColumn("mark", mark).selectExpr("id", "text", f"mark div {size} AS part", f"CAST(mark % {size} AS int) AS bit")
    held = "shiftright(CAST(conv(hex(substring(bits, CAST(bit div 8 AS int) + 1, 1)), 16, 10) AS int), bit % 8) & 1 = 1"
    return asked.join(F.broadcast(bits), "part").where(held).select("id", "text")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, numerator: int = NUMERATOR,
                    denominator: int = DENOMINATOR, items: int = ITEMS, width: int = WIDTH) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``df``.

    Texts with denominator * |intersection| >= numerator * |union| are linked; ``component_id`` is the smallest id that links
    reach, ``kept`` whether it is the row's own.  Texts without words (null, empty, white space) are linked with
    nothing.  Repeated rows stay and all carry the same values; different texts of one id are one document, so they are in
    one component.  A null id is in no component: its ``component_id`` is null and ``kept`` is true.  An empty table gives
    no rows; other columns are not read, whatever their names.
    """
    spark = df.sparkSession
    short_batches(spark)
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    sketches = checkpointed(rows.mapInPandas(
        _sketch(shingle, 2 * items * width), "id bigint, n_shingles bigint, mark binary, hashes array<int>"))
    texts = sketches.where("mark IS NOT NULL AND id IS NOT NULL").groupBy("mark").agg(
        F.min("id").alias("node"), F.first("n_shingles").alias("n"), F.first("hashes").alias("hashes"))
    texts = checkpointed(texts)
    own = checkpointed(_shared_keys(texts, items, width))
    sketches, texts = checkpointed(sketches.drop("hashes")), checkpointed(texts.drop("hashes"))
    release(spark)

    tables = _tables(own).select("key", "node", "n")
    centres = tables.groupBy("key").agg(F.min("node").alias("centre"), F.count("*").alias("members")).where("members > 1")
    met = checkpointed(tables.join(centres.select("key", "centre"), "key").groupBy("node", "n", "centre").agg(F.lit(1).alias("one")))
    sizes = texts.select(F.col("node").alias("centre"), F.col("n").alias("n_centre"))
    alike = denominator * F.least("n", "n_centre") >= numerator * F.greatest("n", "n_centre")
    stars = met.where("node <> centre").join(sizes, "centre").where(alike).select(F.col("node").alias("a"), F.col("centre").alias("b"))

    sets = _perhaps_in(rows, met.select(F.col("node").alias("id")).distinct()).mapInPandas(_sets(shingle), "node bigint, members array<bigint>")
    sets = checkpointed(sets.groupBy("node", F.xxhash64("members").alias("set")).agg(F.first("members").alias("members")).select("node", "members"))
    links = checkpointed(_confirmed(stars, sets, numerator, denominator).unionAll(_same_id(sketches, texts)))
    del tables, centres, met, sizes, stars
    release(spark)
    left = checkpointed(_links_left(links, own, sets, numerator, denominator))
    del own, sets
    release(spark)
    names = components(links.unionAll(left))
    release(spark)

    named = texts.join(names, "node", "left").select("mark", F.coalesce("component", "node").alias("component"))
    return (
        sketches.select("id", "n_shingles", "mark")
        .join(named, "mark", "left")
        .select(
            F.col("id").alias(id_col),
            "n_shingles",
            F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))
    )
