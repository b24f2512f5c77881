"""A corpus from raw documents to token ids: language, near duplicates, secrets, mixing, encoding.

Every stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns a DataFrame.  All but the last return the
columns of the documents table.  ``run`` writes each stage's rows as Parquet in the shared folder and reads them again
for the next stage, so that lost executors never repeat an earlier stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, language, mixing, near_duplicates, secret_scan
from tidemark.llm.common import checkpointed, release
from tidemark.llm.queries import BYTE_VOCABULARY, PIECE_VOCABULARY
from tidemark.plans.series import free_name
from tidemark.plans.storage import new_folder

#: A language counts if its share of the probability is more than this.
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that the model gives a language: one that is likelier than all others together.  All columns stay as they are.

    Null texts and texts without a letter have no language; of the others those go whose score, the likeliest language's share, is
    ``LEAST_SCORE`` or less.  Where nothing can be learned (no learnable row has a ``lang``) there is no score, and
    texts are only asked for a letter.
    """
    model = language.fit(docs, public_tokenizers.path(PIECE_VOCABULARY))
    if not model.languages:
        return docs.where(language.has_letter(docs))
    said = free_name(docs, "__said")
    return docs.withColumn(said, language.prediction(docs, model)).where(F.col(said)["score"] > LEAST_SCORE).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near duplicates the document of the smallest id, and of repeated rows of an id one.

    The groups are those of ``op2_near_duplicates``, whose contract says four words to a shingle.  Rows without an id stay.
    """
    found = near_duplicates.near_duplicates(docs)
    times = found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n"), F.min("kept").alias("kept"))
    times = checkpointed(times)
    single, repeated = times.where("kept AND n = 1").select("doc_id"), times.where("kept AND n > 1").select("doc_id")
    once = docs.join(single, "doc_id", "left_semi").select(*docs.columns)
    # the rows of an id are reduced to one before they are dealt out, so that a frequent id weighs no more than others
    row = F.struct(F.xxhash64(*docs.columns).alias("mark"), F.struct(*docs.columns).alias("whole"))
    first = docs.join(repeated, "doc_id", "left_semi").groupBy(F.col("doc_id").alias("id")).agg(F.min(row).alias("row"))
    return once.unionByName(first.select("row.whole.*")).unionByName(docs.where("doc_id IS NULL"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by a mark; ``n_chars`` follows the new text.  No document goes."""
    return secret_scan.redact_secrets(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: not at all, once or twice."""
    return mixing.mixed(docs).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, ids_sha256, decoded_sha256, round_trip) of every row."""
    return byte_bpe.encode_texts(docs, public_tokenizers.path(BYTE_VOCABULARY), public_tokenizers.PATTERN)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

#: SQL can express neither the language model nor the encoding; tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``sf_dir``'s documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        folder = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        release(spark)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
