"""The corpus operators as registered queries over the given tables."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bit_slices, byte_bpe, fingerprints, language, licenses, mixing, near_duplicates, oracles, periodic, pii, prefix_trie, quality,
    secret_scan, token_files,
)
from tidemark.llm.common import WORD, short_batches

BYTE_VOCABULARY = "byte_bpe_50k.tiktoken"
PIECE_VOCABULARY = "piece_bpe_32k.model"
WORD_VOCABULARY, END = "word_bpe_49k.json", 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _listed(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _digests(spans: DataFrame, base: Callable[[Column], Column], kinds: tuple[str, ...]) -> DataFrame:
    own = F.filter("found", base)

    def count(kind: str) -> Column:
        return F.size(F.filter(own, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return spans.select(
        "doc_id", *map(count, kinds), F.sha2(_listed(own).cast("binary"), 256).alias("base_sha256"), _listed(F.col("found")).alias("spans"))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts are sources, paths their languages."""
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_slices.top_k(table(spark, sf_dir, "embeddings"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digests(secret_scan.find_secrets(table(spark, sf_dir, "documents")), lambda s: s["layer"] == 0, secret_scan.KINDS)


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digests(pii.find_personal_data(table(spark, sf_dir, "documents")), lambda s: ~s["disguised"], pii.KINDS)


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("fingerprint")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.passes(table(spark, sf_dir, "documents"))
    return taken.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("times") * F.col("size")).cast("bigint").alias("taken"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs, public_tokenizers.path(PIECE_VOCABULARY))
    return language.predict(docs, model).select("doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.find_licenses(table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda s: s["phrase"])
    places = F.transform(base, lambda s: s["start"])

    def labels(some: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(some, lambda s: s["label"]))), ",")

    return found.select(
        "doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"),
        F.array_min(places).cast("bigint").alias("first_word"), F.array_max(places).cast("bigint").alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda s: s["covered"])), F.lit(0.0)).alias("score"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    encoded = byte_bpe.encode_texts(docs, public_tokenizers.path(BYTE_VOCABULARY), public_tokenizers.PATTERN, with_ids=False)
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def _with_period(ids_and_texts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Texts, one in ten of which goes on periodically from some word on, as the query lays down."""
    words_of = re.compile(WORD).findall
    for ids, texts in ids_and_texts:
        out = []
        for doc, known, text in zip(ids.fillna(0).astype("int64"), ids.notna(), texts):
            h = zlib.crc32(str(doc).encode()) if known else 1
            words = words_of(text or "") if h % 10 == 0 else []
            if words:
                n, g = len(words), h // 10
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                text = " ".join(words[:a] + (words[a:a + p] * (1 + (n - a) // p))[:n - a])
            out.append(text)
        yield pd.Series(out, dtype=object)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    short_batches(spark)
    edited = F.pandas_udf(_with_period, "string")
    docs = table(spark, sf_dir, "documents").select("doc_id", edited("doc_id", "text").alias("text"))
    nothing = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    # runs come by start, then period, so the first of equal exponents stays
    best = F.aggregate("runs", nothing, lambda b, r: F.when(
        b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    told = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return periodic.periodic_runs(docs).withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.*",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(told.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY), END, with_ids=False)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = prefix_trie.turn_sequences(table(spark, sf_dir, "conversations"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % 6).cast("int")
    # of a hundred conversations one lends its first turns: at most five, to at most a hundred
    lenders = own.where("conv % 100 = 0").select(F.col("conv").alias("lender"), F.slice("turns", 1, 5).alias("lent"))
    both = own.join(lenders, F.col("conv") - F.col("conv") % 100 == F.col("lender"), "left")
    lent = F.coalesce(F.slice("lent", F.lit(1), h), F.slice("turns", 1, 0))
    return prefix_trie.trie(both.select("conv", F.concat(lent, F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))).alias("turns")))


QUERIES = {
    f.__name__: f
    for f in (op1_quality, op2_near_duplicates, op3_top_k, op4_secrets, op5_personal_data, op6_fingerprints, op7_mixing,
              op8_language, op9_licenses, op10_byte_bpe, op11_periodic_runs, op12_token_files, op13_prefix_trie)
}

SQL = {
    "op2_near_duplicates": oracles.NEAR_DUPLICATES,
    "op3_top_k": oracles.TOP_K,
    "op7_mixing": oracles.MIXING,
}
