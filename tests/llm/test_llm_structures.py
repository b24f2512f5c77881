"""Periodic runs, token files and the prefix trie against plain versions."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from tidemark.llm import periodic, prefix_trie, rans, token_files
from tidemark.llm.queries import END, QUERIES, WORD_VOCABULARY
from test_llm_corpus import DOCS, prose

TURNS = "conv_id long, turn long, role string, text string, place int"
WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall


def plain_runs(w):
    """Every lag at every place; the smallest period is looked for among all smaller ones."""
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            m = j + q - i
            if m >= max(6, 4 * q) and not any(all(w[i + x] == w[i + x + p] for x in range(m - p)) for p in range(1, q)):
                out.append((i, m, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def word_lists(rng, n):
    for _ in range(n):
        w = [rng.choice("abcdefghij"[:rng.choice([1, 2, 3, 10])]) for _ in range(rng.randrange(90))]
        for _ in range(rng.randrange(3)):
            if len(w) > 8:
                a, p = rng.randrange(len(w)), rng.randrange(1, 9)
                for i in range(a + p, min(len(w), a + rng.randrange(5, 60))):
                    w[i] = w[i - p]
        yield w


def test_runs_are_those_of_all_lags():
    for w in word_lists(random.Random(3), 2500):
        assert periodic.runs_of(w) == plain_runs(w), w


def test_runs_of_large_hits_are_read_in_parts(monkeypatch):
    monkeypatch.setattr(periodic, "AT_A_TIME", 4)
    for w in word_lists(random.Random(4), 300):
        assert periodic.runs_of(w) == plain_runs(w), w


def test_surviving_segments_keep_words_that_come_often():
    rng = random.Random(9)
    for w in word_lists(rng, 300):
        kept = periodic.surviving(w)
        for start, end in kept:
            assert all(w[start:end].count(x) >= 4 for x in w[start:end])
        for start, m, _ in plain_runs(w):
            assert any(a <= start and start + m <= b for a, b in kept)


def test_a_long_text_of_one_word_is_quick():
    assert periodic.runs_of(["a"] * 300_000) == [(0, 300_000, 1)]
    assert periodic.runs_of([str(i % 5000) for i in range(100_000)]) == [(0, 100_000, 5000)]


def plain_op11(doc, text):
    w = WORDS(text or "")
    n, h = len(w), zlib.crc32(str(doc).encode())
    if doc is not None and h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    drop = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = None
    for s, m, q in runs:
        if best is None or m * best[2] > best[1] * q:
            best = (s, m, q)
    told = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in drop)
    tail = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc, len(runs), *tail, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_op11(spark, tmp_path):
    rng = random.Random(6)
    rows = [(i, prose(rng, rng.randrange(0, 120)) + " na" * rng.choice([0, 0, 5, 9]), "en", "s", 1, 5) for i in range(150)]
    rows += [(200, None, None, None, None, None), (201, "", "en", "s", 0, 1), (202, " \t\n", "en", "s", 0, 1), (None, "x " * 20, "en", "s", 0, 1)]
    rows += [(203, "é b " * 9, "en", "s", 0, 1), (203, "é b " * 9, "en", "s", 0, 1), (204, "x y z " * 4000, "en", "s", 0, 1)]
    df = spark.createDataFrame(rows, DOCS + ", runs int")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["op11_periodic_runs"](spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {t for c, t in out.dtypes if not c.endswith("sha256")} == {"bigint"}
    want = [plain_op11(r[0], r[1]) for r in rows if r[0] != 204]
    found = sorted((tuple(r) for r in out.collect()), key=repr)
    assert [r for r in found if r[0] != 204] == sorted(want, key=repr)
    assert sum(r[1] for r in want) > 20
    assert periodic.periodic_runs(df.where("false")).count() == 0


def test_blocks_come_back():
    rng = np.random.default_rng(1)
    for n in (1, 31, 33, rans.SEGMENT, rans.SEGMENT + 1, rans.BLOCK - 1, rans.BLOCK + 1, 3 * rans.BLOCK):
        ids = np.minimum(rng.zipf(1.4, n), 60_000).astype(np.uint32)
        table = rans.Table.from_bytes(rans.table_of(np.bincount(ids)).to_bytes())
        assert int(table.frequencies.sum()) == 1 << table.bits
        blocks = [rans.Block(b) for b in rans.encode(ids, table)]
        assert (rans.decode(blocks, table) == ids).all()
        segments = sum(len(b.places) for b in blocks)
        for first in range(0, segments, 3):
            part = rans.decode(blocks, table, first, first + 2)
            assert (part == ids[first * rans.SEGMENT:(first + 2) * rans.SEGMENT]).all()


def test_blocks_are_near_the_entropy():
    ids = np.minimum(np.random.default_rng(2).zipf(1.5, 400_000), 5000).astype(np.uint32)
    p = np.bincount(ids) / len(ids)
    bits = -(p[p > 0] * np.log2(p[p > 0])).sum() * len(ids)
    size = 8 * sum(map(len, rans.encode(ids, rans.table_of(np.bincount(ids)))))
    assert bits < size < 1.1 * bits


def test_damage_is_noticed():
    ids = np.arange(5000, dtype=np.uint32) % 700
    table = rans.table_of(np.bincount(ids))
    raw = rans.encode(ids, table)[0]
    for at in (40, len(raw) // 2, len(raw) - 2):
        changed = bytearray(raw)
        changed[at] ^= 4
        with pytest.raises(ValueError):
            rans.decode([rans.Block(bytes(changed))], table)
    with pytest.raises(ValueError):
        rans.Table.from_bytes(table.to_bytes()[:-1])


def odd_texts(rng):
    some = ["the", "Straße", "don't", "it's,", "a b", "é", "́x", "İstanbul", "x1y2", "日本語テキスト", "<|endoftext|>", "a<|startoftext|>b",
            "3.14", "“quoted”", "naïve!?", "\x1c\x1d", "ﬁn", "𝔘nicode", "'s", "...", "O'Neil's;", " ", "ªº", "Ⅷ", "#"]
    for _ in range(60):
        yield rng.choice([" ", "\n", "\t ", "  "]).join(rng.choice(some) for _ in range(rng.randrange(1, 30)))


def token_rows():
    rng = random.Random(8)
    rows = [(i * 3 % 101, t, "en", "s", 1) for i, t in enumerate(odd_texts(rng))]
    rows += [(500 + i, prose(rng, rng.randrange(300)), "en", "s", 1) for i in range(60)]
    rows += [(700, None, None, None, None), (701, "", "en", "s", 0), (None, "no id", "en", "s", 1), (None, "no id", "en", "s", 1), (702, "same", "en", "s", 1),
             (702, "same", "en", "s", 1), (703, "word " * 150_000, "en", "s", 1), (-5, "first", "en", "s", 1)]
    rng.shuffle(rows)
    return rows


def test_op12(spark, tmp_path):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path(WORD_VOCABULARY))
    rows = token_rows()
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], DOCS + ", id int, n int")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["op12_token_files"](spark, str(tmp_path))
    assert out.dtypes == [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")]
    found = sorted((tuple(r) for r in out.collect()), key=lambda r: r[1])
    ids = {t: [*model.encode(t or "", add_special_tokens=False).ids, END] for _, t, *_ in rows}
    want = sorted(((i, len(ids[t]), zlib.crc32(np.array(ids[t], "<u4").tobytes())) for i, t, *_ in rows), key=repr)
    assert sorted(((i, n, c) for i, _, n, c in found), key=repr) == want
    at = 0
    for i, start, n, _ in found:
        assert start == at
        at += n
    order = [(i is not None, i or 0) for i, *_ in found]
    assert order == sorted(order)
    whole = token_files.round_trip(df, public_tokenizers.path(WORD_VOCABULARY), END)
    by = {r["doc_id"]: r["ids"] for r in whole.where("doc_id IN (701, 702, -5, 703)").collect()}
    assert by[701] == [END] and by[702] == ids["same"] and by[-5] == ids["first"] and by[703] == ids["word " * 150_000]
    assert token_files.round_trip(df.where("false"), public_tokenizers.path(WORD_VOCABULARY), END).count() == 0


def test_distinct_words_are_looked_up_once():
    from tokenizers import Tokenizer

    class Counted(dict):
        asked = 0

        def get(self, word):
            self.asked += 1
            return super().get(word)

        def __getitem__(self, word):
            self.asked += 1
            return super().__getitem__(word)

    path = public_tokenizers.path(WORD_VOCABULARY)
    own = token_files.Words(path, END)
    own.known = Counted(own.known)
    text = " the cat\x0bsat,  \x1c on\r\nthe\x85mat \t" + "and the cat " * 500
    first = own.encode([text, None, "", " \n"])
    own.known.asked = 0
    assert own.encode([text, None, "", " \n"]) == first
    assert own.known.asked <= 20
    ids = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(first[0], own.type).tolist() == [*ids, END]
    assert first[1] == first[2] == first[3] == own.end and own.encode([]) == []


def test_words_are_encoded_as_texts_are():
    from tokenizers import Tokenizer

    path = public_tokenizers.path(WORD_VOCABULARY)
    model, own = Tokenizer.from_file(path), token_files.Words(path, END)
    texts = [*odd_texts(random.Random(12)), "", None, *(f"word{e}" for e in token_files.ENDS), "a-b", "word-_=" * 3, "x)`", "y;;'s", "ǅ! ǆ ʰ?"]
    for t, raw in zip(texts, own.encode(texts)):
        assert np.frombuffer(raw, own.type).tolist() == [*model.encode(t or "", add_special_tokens=False).ids, END], t


def test_words_are_sent_once_whatever_their_case_and_signs():
    class Told:
        def __init__(self, model):
            self.model, self.words = model, []

        def encode_batch_fast(self, texts, **named):
            self.words += [w for t in texts for w in t.split()]
            return self.model.encode_batch_fast(texts, **named)

    own = token_files.Words(public_tokenizers.path(WORD_VOCABULARY), END)
    told = []
    for name in {"model", "plain"} & set(vars(own)):
        told.append(Told(getattr(own, name)))
        setattr(own, name, told[-1])
    first = own.encode(["Cat cat CAT, cat. cat?! Élan élan. c4T C4t"] * 2)
    assert first[0] == first[1]
    assert sorted(w for t in told for w in t.words) == sorted(["cat", ",", ".", "?!", "Élan", "élan", "c4t"])


def test_letters_signs_and_cases_of_all_scripts():
    from tokenizers import Tokenizer

    path = public_tokenizers.path(WORD_VOCABULARY)
    model, own = Tokenizer.from_file(path), token_files.Words(path, END)
    every = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts = [f"{c}# A{c}. {c}B?! {c}'S" for c in every]
    texts += ["H\u0331 h\u0331 H\u0331.", "<|ENDOFTEXT|> A<|endoftext|>B <|StartOfText|>", "İ. I\u0307. ẞ! \u212a\u212b.", "ΑΣ. ΑΣ ς"]
    for at in range(0, len(texts), 10_000):
        some = texts[at:at + 10_000]
        found = [np.frombuffer(r, own.type).tolist() for r in own.encode(some)]
        want = [[*e.ids, END] for e in model.encode_batch_fast(some, add_special_tokens=False)]
        assert found == want, [t for t, f, w in zip(some, found, want) if f != w][:5]


def test_a_file_is_read_from_any_place(tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "PIECE", 5000)
    monkeypatch.setattr(token_files, "AT_A_TIME", 2 * rans.BLOCK)
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 900, n).astype(np.uint16) for n in (0, 7, 90_000, 1, 300_000, 5000, 20)]
    every = np.concatenate(docs)
    table = rans.table_of(np.bincount(every))
    writer = token_files._Writer(str(tmp_path), 0, table)
    for i, d in enumerate(docs):
        writer.add(i if i != 3 else None, d)
    manifest = writer.close()
    assert manifest["n_tokens"].sum() == len(every) and manifest["n_docs"].sum() == len(docs) and len(manifest) > 2
    with token_files.File(str(tmp_path), manifest["path"][0], table) as file:
        for start, stop in ((0, len(every)), (5, 6), (rans.SEGMENT, rans.SEGMENT + 1), (65_000, 200_000), (390_000, len(every)), (9, 9)):
            found = np.concatenate([np.empty(0, np.uint32), *file.ids(start, stop)])
            assert (found == every[start:stop]).all() and len(found) == stop - start
        assert file.lengths.tolist() == [len(d) for d in docs] and file.known.tolist() == [i != 3 for i in range(len(docs))]


def plain_trie(sequences):
    """Every prefix of every conversation: {id: [(role, text), ...]}."""
    members, ends, below = defaultdict(set), defaultdict(list), defaultdict(set)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
            if d:
                below[tuple(turns[:d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)
    rows = []

    def leaves(p):
        return sum(map(leaves, below[p])) if below[p] else 1

    def saved(p):
        return (len(members[p]) - 1) * (len(p[-1][1]) if p else 0) + sum(map(saved, below[p]))

    for p, m in list(members.items()):
        told = ",".join(map(str, sorted(ends.get(p, [])))).encode()
        rows.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(below[p]), leaves(p), saved(p), hashlib.sha256(told).hexdigest()))
    return sorted(rows, key=repr)


def plain_sequences(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns, key=lambda t: t[:2])] for c, turns in own.items()}


def plain_rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def turn_rows(rng, n):
    rows = []
    for c in range(0, n):
        kind = rng.random()
        said = ["alpha", "beta", "gamma"] if kind < 0.6 else ["same"]
        rows += [(c, t, rng.choice(["user", "bot"]) if kind < 0.5 else "user", rng.choice(said) * rng.randrange(1, 3) if kind < 0.9 else "same", 1)
                 for t in range(rng.randrange(1, 9))]
    rows += [(n + 1, None, None, None, 1), (n + 1, 0, "user", "", 1), (n + 2, 3, None, "ünï", 1), (n + 3, 0, "us", "erx", 1), (n + 4, 0, "user", "x", 1),
             (None, 0, "user", "nobody", 1)]
    return rows


@pytest.mark.parametrize("spread", [1, 2, 7, 40])
def test_trie_over_partitions(spark, spread):
    rows = turn_rows(random.Random(spread), 330)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(spread))
    try:
        out = prefix_trie.conversation_trie(spark.createDataFrame(rows, TURNS))
        assert out.columns == list(prefix_trie.OUT)
        found = sorted((tuple(r) for r in out.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found == plain_trie(plain_sequences(rows))


def test_trie_of_copies_and_of_nested_conversations(spark):
    rows = [(c, t, "user", "again", 0) for c in range(60) for t in range(5)] + [(100 + c, t, "user", "again", 0) for c in range(30) for t in range(c + 1)]
    found = sorted((tuple(r) for r in prefix_trie.conversation_trie(spark.createDataFrame(rows, TURNS)).collect()), key=repr)
    assert found == plain_trie(plain_sequences(rows))


def test_op13(spark, tmp_path):
    rows = turn_rows(random.Random(2), 420)
    rows = [r for r in rows if r[0] != 300]  # a hundred without the conversation that lends
    spark.createDataFrame(rows, TURNS).repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    found = sorted((tuple(r) for r in QUERIES["op13_prefix_trie"](spark, str(tmp_path)).collect()), key=repr)
    rebuilt = plain_rebuilt(plain_sequences(rows))
    assert any(not turns for turns in rebuilt.values())
    assert found == plain_trie(rebuilt)


def test_trie_of_nothing(spark):
    df = spark.createDataFrame([], TURNS)
    assert prefix_trie.conversation_trie(df).count() == 0
    assert prefix_trie.conversation_trie(spark.createDataFrame([(None, 1, "a", "b", 1)], TURNS)).count() == 0
