"""Every stage of the corpus pipeline against a plain version, and the pipeline as a whole."""

import random
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import byte_bpe, language, secret_scan
from tidemark.llm.queries import BYTE_VOCABULARY, PIECE_VOCABULARY
from test_llm_corpus import DOCS, plain_components, plain_mix, prose

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(77)
    kinds = {"en": ["the", "thing", "and", "over", "there", "token", "wind"], "de": ["und", "nicht", "über", "schön", "keit", "der"]}
    out = []
    for i in range(160):
        lang = rng.choice(list(kinds))
        text = prose(rng, rng.randrange(15, 60), [w + s for w in kinds[lang] for s in ("", "er", "en", "st", "e")])
        if i % 9 == 0:
            text += ' token = "abcdef0123456789abcdef0123456789"'
        out.append((i, text, lang, f"src{i % 4}", len(text)))
    out += [(200 + i, out[i][1] + " x", out[i][2], "src0", 1) for i in range(20)]  # near copies
    out += [out[3], out[3], (300, None, "en", "src1", None), (301, "", "en", "src1", 0), (302, "12 345 !!", "de", "src2", 9), (None, out[5][1], "en", None, 4)]
    return out


def stage(spark, name, rows):
    fn = dict(corpus_pipeline.STAGES)[name]
    out = fn(spark, spark.createDataFrame(rows, DOCS), "")
    return out.columns, sorted((tuple(r) for r in out.collect()), key=repr)


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "secrets", "mixing", "byte_bpe"]


def test_language_stage_keeps_texts_with_letters(spark, rows):
    columns, out = stage(spark, "language", rows)
    assert columns == COLUMNS
    assert out == sorted((r for r in rows if r[1] and any(c.isalpha() for c in r[1])), key=repr)


def test_language_stage_drops_what_no_language_is_likeliest_for(spark, monkeypatch, rows):
    df = spark.createDataFrame(rows, DOCS).withColumn("__said", F.lit(7))
    found = language.predict(df, language.fit(df, public_tokenizers.path(PIECE_VOCABULARY)))
    scores = sorted(r["score"] for r in found.collect() if r["score"] > 0)
    middle = scores[len(scores) // 2]
    monkeypatch.setattr(corpus_pipeline, "LEAST_SCORE", middle)
    out = corpus_pipeline.identify_language(spark, df, "")
    assert out.columns == [*COLUMNS, "__said"] and out.count() == sum(s > middle for s in scores) < len(scores)


@pytest.mark.parametrize("change", [
    lambda r: (r[0], r[1], None, *r[3:]),
    lambda r: (None, *r[1:]),
    lambda r: (*r[:2], r[2] if r[2] == "en" else "und", *r[3:]),
], ids=["no lang", "no id", "a lang und"])
def test_language_stage_keeps_texts_with_letters_whatever_is_learned(spark, rows, change):
    changed = [change(r) for r in rows]
    columns, out = stage(spark, "language", changed)
    assert columns == COLUMNS
    assert out == sorted((r for r in changed if r[1] and any(c.isalpha() for c in r[1])), key=repr)


def test_near_duplicate_stage_keeps_one_of_each_group(spark, rows):
    columns, out = stage(spark, "near_duplicates", rows)
    names = plain_components([(r[0], r[1]) for r in rows])
    want = {r for r in rows if r[0] is not None and names[r[0]] == r[0]}
    want = sorted([*want, *(r for r in rows if r[0] is None)], key=repr)
    assert columns == COLUMNS and out == want


def test_near_duplicate_stage_with_a_frequent_id(spark, rows):
    many = [(7, prose(random.Random(i % 3), 30), "en", "s", i % 3) for i in range(90)] + rows
    df = spark.createDataFrame(many, DOCS).withColumns({"mark": F.lit(1), "whole": F.lit("x"), "n": F.lit(2), "kept": F.lit(False)})
    out = corpus_pipeline.drop_near_duplicates(spark, df, "")
    assert out.columns == df.columns
    ids = Counter(r["doc_id"] for r in out.collect())
    names = plain_components([(r[0], r[1]) for r in many])
    assert {i for i in ids if i is not None} == {i for i in names if names[i] == i} and all(n == 1 for i, n in ids.items() if i is not None)
    assert ids[None] == 1


def test_secret_stage_redacts(spark, rows):
    columns, out = stage(spark, "secrets", rows)
    assert columns == COLUMNS
    want = []
    for i, text, lang, source, _ in rows:
        new = None if text is None else secret_scan.redacted_text(text)
        want.append((i, new, lang, source, None if new is None else len(new)))
    assert out == sorted(want, key=repr)
    assert not any("abcdef0123456789" in (r[1] or "") for r in out)


def test_mixing_stage_repeats(spark, rows):
    unique = list(dict.fromkeys(r for r in rows if r[0] is not None and r[1]))
    columns, out = stage(spark, "mixing", unique)
    assert columns == COLUMNS
    times = Counter(r[0] for r in out)
    for i, size, _, _, taken in plain_mix([(r[0], r[3], r[1]) for r in unique]):
        assert times[i] * size == taken
    assert set(out) <= set(unique)


def test_encoding_stage(spark, rows):
    columns, out = stage(spark, "byte_bpe", rows)
    ranks = byte_bpe.read_ranks(public_tokenizers.path(BYTE_VOCABULARY))
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted((r[0] is None, r[0] or 0, theirs.encode_ordinary(r[1] or "")) for r in rows)
    assert sorted((r[0] is None, r[0] or 0, list(r[1])) for r in out) == want


def test_run(spark, rows, tmp_path):
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    names = plain_components([(r[0], r[1]) for r in rows])
    assert out and all(r["doc_id"] is None or names[r["doc_id"]] == r["doc_id"] for r in out)
    assert all(r["round_trip"] and n <= 2 for r in out for n in [Counter(x["doc_id"] for x in out)[r["doc_id"]]])


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    for name, fn in corpus_pipeline.STAGES:
        assert fn(spark, docs, "").count() == 0, name
