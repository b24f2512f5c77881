"""Near duplicates, top-k, fingerprints, mixing, language, licences and quality against plain versions."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash

from tidemark.llm import bit_slices, fingerprints, language, licenses, mixing, near_duplicates, quality
from tidemark.llm.common import running_total
from tidemark.llm.components import components
from tidemark.llm.queries import PIECE_VOCABULARY, QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, words=None):
    return " ".join(rng.choice(words or VOCABULARY) for _ in range(n))


VOCABULARY = [a + b + c for a in ("th", "an", "er", "ou", "in") for b in ("a", "on", "ti", "re") for c in ("", "s", "ed", "ly", "ble")]


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    k = min(4, len(words))
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) if words else frozenset()


def plain_components(rows):
    """Component of each (id, text), by comparing all pairs."""
    name = {i: i for i, _ in rows if i is not None}

    def root(x):
        while name[x] != x:
            x = name[x]
        return x

    sets = [(i, plain_set(t)) for i, t in rows if i is not None]
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((root(i), root(j)))
                name[y] = x
    return {i: root(i) for i in name}


def near_rows():
    rng = random.Random(5)
    rows, n = [], 100
    for size in (60, 40, 200, 12):  # groups of copies, edited more and more
        first = prose(rng, size).split()
        for step in range(14):
            words = list(first)
            for _ in range(rng.randrange(0, 1 + size // 12)):
                words[rng.randrange(size)] = f"new{rng.randrange(10**6)}"
            rows.append((n, " ".join(words)))
            n += 1
            if step % 4 == 0:
                first = words  # drifts, so that links make chains
    passage = prose(rng, 30)
    for _ in range(25):  # a passage that many texts share
        rows.append((n, prose(rng, 30) + " " + passage))
        n += 1
    for _ in range(40):
        rows.append((n, prose(rng, rng.randrange(1, 80))))
        n += 1
    rows += [(n, "Same Text Here"), (n + 1, "same  text\there"), (n + 2, ""), (n + 3, None), (n + 4, " \n"), (n + 5, "one"), (n + 6, "ONE"), (n + 7, "É one"),
             (n + 8, "é one")]
    rows += [(n + 9, "repeated row of some words here")] * 30
    rng.shuffle(rows)
    return rows


def test_near_duplicates(spark):
    rows = near_rows()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, component_id string, node int")
    out = near_duplicates.near_duplicates(df).collect()
    want = plain_components(rows)
    assert len(out) == len(rows)
    sizes = defaultdict(set)
    for i, t in rows:
        sizes[i].add(len(plain_set(t)))
    for r in out:
        assert r["component_id"] == want[r["doc_id"]], r
        assert r["kept"] == (r["doc_id"] == r["component_id"]) and r["n_shingles"] in sizes[r["doc_id"]]
    assert len(set(want.values())) < len(want) - 20


def test_near_duplicates_of_odd_ids(spark):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    df = spark.createDataFrame([(None, a), (None, b), (5, a), (7, a), (7, b), (9, b)], "doc_id long, text string")
    got = {(r["doc_id"], r["component_id"], r["kept"]) for r in near_duplicates.near_duplicates(df).collect()}
    assert got == {(None, None, True), (5, 5, True), (7, 5, False), (9, 5, False)}
    assert near_duplicates.near_duplicates(df.where("false")).count() == 0
    assert near_duplicates.near_duplicates(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).count() == 2


def test_links_that_stars_miss(spark):
    """Texts whose only link is not to the smallest id of their table."""
    rng = random.Random(9)
    words = prose(rng, 100).split()
    rows = []
    for i in range(60):  # a chain: neighbours are alike, far ones are not
        words = list(words)
        for _ in range(2):
            words[rng.randrange(100)] = f"w{rng.randrange(10**6)}"
        rows.append((1000 - i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_components(rows)
    assert {r["doc_id"]: r["component_id"] for r in near_duplicates.near_duplicates(df).collect()} == want


def test_minhash_agrees_with_likeness():
    rng = random.Random(3)
    shingler = near_duplicates.Shingler(4)
    words = prose(rng, 400, [f"w{i}" for i in range(5000)]).split()
    other = words[:360] + prose(rng, 40).split()
    a, b = shingler.set_of(" ".join(words)), shingler.set_of(" ".join(other))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    agree = (near_duplicates.min_hashes(a, 512) == near_duplicates.min_hashes(b, 512)).mean()
    assert abs(agree - true) < 0.08


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(60)]
    name = {}

    def root(x):
        name.setdefault(x, x)
        while name[x] != x:
            x = name[x]
        return x

    for a, b in pairs:
        x, y = sorted((root(a), root(b)))
        name[y] = x
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: root(x) for x in name}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_running_total(spark):
    rng = random.Random(4)
    rows = [(i, rng.randrange(50), rng.randrange(9)) for i in range(500)]
    df = spark.createDataFrame(rows, "i long, k long, v long")
    total, want = 0, {}
    for i, k, v in sorted(rows, key=lambda r: (r[1], r[0])):
        total += v
        want[i] = total
    got = running_total(df, [df["k"], df["i"]], df["v"], "total").collect()
    assert {r["i"]: r["total"] for r in got} == want


def plain_top(rows, every, k):
    good = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in good if i % every == 0}):
        vector = min(v for i, v in good if i == q)
        scored = sorted((-sum(a * b for a, b in zip(vector, v)), i) for i, v in good if i != q)
        out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored[:k])]
    return out


@pytest.mark.parametrize("block_rows,block_queries", [(1 << 16, 512), (70, 3)])
def test_top_k(spark, block_rows, block_queries):
    rng = random.Random(6)
    rows = [(i, [rng.choice([0.0, 0.25, -0.5, rng.gauss(0, 0.4)]) for _ in range(9)]) for i in range(230)]
    rows += [(300 + i, [0.5] * 9) for i in range(40)]  # ties at the boundary
    rows += [(400, None), (401, [1.0, None]), (402, [float("nan")] * 9), (403, [float("inf")] * 9), (None, [9.0] * 9), (405, [5000.0, -3.5]), (406, [])]
    rows += [rows[7], rows[20], (-50, [0.1] * 9)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, rank int")
    got = bit_slices.top_k(df, every=10, k=7, block_rows=block_rows, block_queries=block_queries)
    assert sorted(tuple(r) for r in got.collect()) == plain_top(rows, 10, 7)


def test_top_k_of_little(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in bit_slices.top_k(df).collect()] == [(0, 1, 1, 1024 * 2048)]
    assert bit_slices.top_k(df.where("false")).count() == 0
    assert bit_slices.top_k(df.where("vec_id = 0")).count() == 0


def plain_lanes(text):
    lanes = [0] * fingerprints.LANES
    for p in (text or "").split("\n"):
        p = p.strip(" ")
        if not p:
            continue
        hashes = [xxhash.xxh64_intdigest(p.encode(), seed=xxhash.xxh64_intdigest(struct.pack("<i", k), seed=42)) for k in range(4)]
        vector = [1, *[h & fingerprints.MODULUS for h in hashes]]
        vector += [hashes[j // 24] >> j % 24 & fingerprints.PAIR for j in range(48)]
        lanes = [(a + b) & fingerprints.MODULUS for a, b in zip(lanes, vector)]
    return lanes


def plain_edits(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is None, r[1] or ""))
    out = []
    for n, (i, t) in enumerate(order):
        t, after = t or "", order[(n + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), plain_lanes(t), plain_lanes(edited)))
    return sorted(out, key=repr)


def test_fingerprints(spark):
    rng = random.Random(8)
    rows = [(7 * i, "\n".join(prose(rng, 5) for _ in range(rng.randrange(1, 12)))) for i in range(60)]
    rows += [(3, "𝔘nicode é\nx"), (4, ""), (5, None), (None, "no id"), (8, "a\nb\nc"), (9, "c\n\n a\nb "), (11, "x" * 30_000), (11, "x" * 30_000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, fingerprint string")
    out = fingerprints.fingerprint_edits(df).collect()
    got = sorted(((r["doc_id"], r["n_chars"], hashlib.sha256(r["edited"].encode()).hexdigest(), list(r["fingerprint"]), list(r["edited_fingerprint"]))
                  for r in out), key=repr)
    assert got == plain_edits(rows)
    by = {r["doc_id"]: r for r in out}
    assert by[8]["fingerprint"] == by[9]["fingerprint"]  # the order of paragraphs does not matter
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in out)
    assert by[9]["near_next"] == 1.0
    long = [r for r in out if (r["n_chars"] or 0) > 200 and r["doc_id"] != 11]
    assert sum(r["near_edited"] for r in long) / len(long) > 2 * sum(r["near_next"] for r in long) / len(long)


def test_fingerprints_add_up(spark):
    df = spark.createDataFrame([("a\nb", "b\nc c", "a\nb\nb\nc c")], "x string, y string, z string")
    f = fingerprints.fingerprint
    row = df.select(f(df.x).alias("x"), fingerprints.added(f(df.x), f(df.y)).alias("sum"), f(df.z).alias("z"),
                    fingerprints.removed(f(df.z), f(df.y)).alias("less")).first()
    assert row["sum"] == row["z"] and row["less"] == row["x"] and row["x"] != row["z"]


def test_fingerprints_of_little(spark):
    df = spark.createDataFrame([(1, "ab")], "doc_id long, text string")
    row = fingerprints.fingerprint_edits(df).first()
    assert row["edited"] == "aa" and row["near_next"] == 1.0
    assert fingerprints.fingerprint_edits(df.where("false")).count() == 0
    assert fingerprints.fingerprint_edits(spark.createDataFrame([(None, None)], "doc_id long, text string")).count() == 1


def plain_mix(rows, weights=(5, 2, 1), share=1.5, most=2):
    size = {n: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for n, (_, _, t) in enumerate(rows)}
    sources = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size[n] for n, r in enumerate(rows) if r[1] == s) for s in sources}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    full, target = set(), {}
    while True:
        rest = [s for s in sources if s not in full]
        if not rest:
            break
        rate = (share * sum(total.values()) - sum(most * total[s] for s in full)) / sum(weight[s] for s in rest)
        target = {s: float(most * total[s]) if s in full else rate * weight[s] for s in sources}
        new = {s for s in rest if target[s] >= most * total[s]}
        if not new:
            break
        full |= new
    target = {s: min(target.get(s, 0.0), most * total[s]) if s not in full else float(most * total[s]) for s in sources}
    queue = []
    for s in sources:
        own = sorted((n for n, r in enumerate(rows) if r[1] == s), key=lambda n: hashlib.md5(str(rows[n][0]).encode()).hexdigest())
        passed = 0
        for turn in range(most):
            for n in own:
                passed += size[n]
                queue.append((passed / target[s] if target[s] else 0.0, sources.index(s), hashlib.md5(str(rows[n][0]).encode()).hexdigest(), turn, n))
    taken, words = Counter(), 0
    for *_, n in sorted(queue):
        words += size[n]
        if words <= share * sum(total.values()):
            taken[n] += 1
    return sorted((rows[n][0], size[n], total[rows[n][1]], target[rows[n][1]], taken[n] * size[n]) for n in range(len(rows)))


def test_mixing(spark):
    rng = random.Random(12)
    rows = [(i, rng.choice(["hot", "hot", "hot", "a", "b", "c", "Z", None, "é"]), prose(rng, rng.randrange(0, 60))) for i in range(300)]
    rows += [(900, "tiny", "one"), (901, "void", ""), (902, "void", None), (903, "big", prose(rng, 3000))]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, source string, text string, size int")
    out = mixing.passes(df)
    got = sorted((r["id"], r["size"], r["source_size"], r["target"], r["times"] * r["size"]) for r in out.collect())
    want = plain_mix(rows)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(math.isclose(g[3], w[3], rel_tol=1e-12) for g, w in zip(got, want))
    assert [g[4] for g in got] == [w[4] for w in want]
    copies = Counter(r["doc_id"] for r in mixing.mixed(df).collect())
    times = {r["id"]: r["times"] for r in out.collect()}
    assert all(copies[i] == n for i, n in times.items())
    assert mixing.mixed(df).columns == df.columns


def test_mixing_of_odd_tables(spark):
    kind = "doc_id long, source string, text string"
    df = spark.createDataFrame([(1, "a", None), (2, None, " ")], kind)
    assert [(r["size"], r["target"], r["times"]) for r in mixing.passes(df).collect()] == [(0, 0.0, 2)] * 2
    assert mixing.passes(df.where("false")).count() == 0
    same = spark.createDataFrame([(1, "a", "x y")] * 4 + [(None, "a", "z")], kind)
    out = mixing.passes(same)
    assert out.count() == 5 and sum(r["times"] * r["size"] for r in out.collect()) <= 13
    assert mixing.mixed(same).columns == ["doc_id", "source", "text"]


@pytest.mark.parametrize("i", [7, None])
def test_mixing_deals_repeated_rows_over_the_cut(spark, i):
    rng = random.Random(5)
    rows = [(n, "a", prose(rng, rng.randrange(1, 9)), n) for n in range(100, 130)]
    rows += [(i, "a", "one two three", n) for n in range(200)]  # more than half of all words, so the cut falls inside them
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, size int").repartition(5)
    want = Counter()
    for r in mixing.passes(df).collect():
        want[r["id"]] += r["times"]
    assert want[i] % 200
    out = mixing.mixed(df)
    assert out.columns == df.columns
    by_row = Counter(tuple(r) for r in out.collect())
    assert set(by_row) <= set(rows)
    got = Counter()
    for r in rows:
        got[r[0]] += by_row[r]
    assert +got == +want
    assert {by_row[r] for r in rows if r[0] == i} == {want[i] // 200, want[i] // 200 + 1}


def test_mixing_marks_rows_without_id_by_text(spark):
    df = spark.createDataFrame([(None, "a", f"text {n}") for n in range(50)] + [(3, "a", "x")], "doc_id long, source string, text string")
    out = mixing.passes(df).collect()
    assert len({r["mark"] for r in out if r["id"] is None}) == 50
    assert [r["mark"] for r in out if r["id"] == 3] == [hashlib.md5(b"3").hexdigest()]


def plain_forward(word, pieces, probability):
    """The sum over all segmentations, one by one."""
    def walk(rest):
        if not rest:
            return 1.0
        total = 0.0
        for n in range(1, len(rest) + 1):
            if rest[:n] in pieces:
                total += probability[pieces[rest[:n]]] * walk(rest[n:])
            elif n == 1:
                total += language.UNSEEN * walk(rest[1:])
        return total

    return math.log(walk("▁" + word))


def test_forward_sums_all_segmentations():
    path = public_tokenizers.path(PIECE_VOCABULARY)
    pieces = language.vocabulary(path)
    rng = np.random.default_rng(1)
    table = rng.random((len(pieces) + 2, 3)) / len(pieces)
    table[-2:] = [[language.UNSEEN] * 3, [0.0] * 3]
    model = language.Model(path, ["a", "b", "c"], table, np.ones(3) / 3)
    some = ["a", "the", "thering", "élan", "straße", "中x", "q", "ouaition"]
    got = model.forward(some)
    for i, w in enumerate(some):
        for k in range(3):
            assert math.isclose(got[i, k], plain_forward(w, pieces, table[:, k]), rel_tol=1e-9)
    long = "thering" * 40
    pair = model.forward([long, long + "s"])
    assert np.isfinite(pair).all() and (pair[1] < pair[0] + 5).all()
    short = model.forward(["thering" * 3])  # with and without rescaling
    limit, language.SHORT_WORD = language.SHORT_WORD, 4
    try:
        assert np.allclose(model.forward(["thering" * 3]), short)
    finally:
        language.SHORT_WORD = limit


def test_language(spark):
    rng = random.Random(21)
    kinds = {"en": ["the", "thing", "and", "over", "there"], "de": ["und", "nicht", "über", "schön", "keit"], "fr": ["être", "queue", "le", "voix", "çà"]}
    rows = [(i, prose(rng, rng.randrange(2, 30), kinds[lang]), lang, "s", 1) for i, lang in enumerate(rng.choices(list(kinds), k=300))]
    rows += [(1000, None, "en", "s", 1), (1001, "123 --- 45", "de", "s", 1), (1002, "", None, None, None), (None, "und nicht über", None, None, None),
             (1003, "the " * 50_000, None, "s", 1), (1004, "thering" * 3000, "xx", "s", 1), (1005, "½ Ⅷ ² 5", "de", "s", 1)]
    df = spark.createDataFrame(rows, DOCS)
    model = language.fit(df, public_tokenizers.path(PIECE_VOCABULARY))
    got = {r["doc_id"]: r for r in language.predict(df, model).collect()}
    held = [r for r in rows if r[0] is not None and r[0] < 1000 and zlib.crc32(str(r[0]).encode()) % 3 == 1]
    assert len(held) > 50 and sum(got[i]["lang_pred"] == lang for i, _, lang, *_ in held) >= 0.97 * len(held)
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (1000, 1001, 1002, 1005))
    assert got[1003]["lang_pred"] == "en" and got[None]["lang_pred"] == "de"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    only = {r[0] for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 != 1}
    assert set(model.languages) <= {r[2] for r in rows if r[0] in only}
    assert language.predict(df.where("false"), model).count() == 0


def test_language_without_labels(spark):
    df = spark.createDataFrame([(1, "text", None, None, None)], DOCS)
    model = language.fit(df, public_tokenizers.path(PIECE_VOCABULARY))
    assert [tuple(r) for r in language.predict(df, model).collect()] == [(1, "und", 0.0)]


def plain_licenses(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places = []
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        own = phrase.split()
        places += [(i, label) for i in range(len(words) - len(own) + 1) if words[i:i + len(own)] == own]
    return len(words), sorted(places)


def test_licenses(spark, tmp_path):
    rng = random.Random(31)
    some = ["MIT License", "the mit-license", "Apache\nLicense", "general public LICENSE", "general license", "public license", "é", "K mit licenſe", "x1"]
    notice = licenses.NOTICES[1][1]
    rows = [(i, " ".join(rng.choice(some) for _ in range(rng.randrange(0, 12)))) for i in range(150)]
    rows += [(500, notice), (501, notice.replace("limitation", "any limitation")), (502, None), (503, ""), (None, "mit license"), (504, "mit license")]
    rows += [(504, "mit license"), (505, "mit"), (506, "word " * 100_000 + "apache license"), (507, "mit License mIT Kelvin lİcense"),
             (508, "mit mit license license mit license"), (509, "the " + "CC BY " * 40 + ". Licensed under CC BY-NC 4.0. " + "BY NC " * 30),
             (510, "Licensed under CC BY-NC 4.0."), (511, "CC BY " * 3000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, template int")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["op9_licenses"](spark, str(tmp_path)).collect()
    want = []
    for i, t in rows:
        n, places = plain_licenses(t)
        starts = [p for p, _ in places]
        want.append((i, n, len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in places}))))
    assert sorted((tuple(r)[:6] for r in out), key=repr) == sorted(want, key=repr)
    by = {r["doc_id"]: r for r in out}
    assert by[500]["labels"] == "mit" and by[501]["labels"] == "mit" and by[501]["score"] >= 0.7
    assert by[509]["labels"] == "cc-by-nc" and by[509]["score"] == 1.0 and by[510]["labels"] == "cc-by-nc" and by[511]["labels"] == ""
    assert all(set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) or not r["base_labels"] for r in out)
    assert by[505]["score"] == 0.0 and by[505]["labels"] == ""
    assert licenses.find_licenses(df.where("false")).count() == 0


def plain_notices(text):
    """The labels of notices whose groups stand in a window of twice their length, on diagonals that are neighbours, by trying all windows."""
    words, out = licenses.template_words(text), set()
    for label, notice in licenses.NOTICES:
        own = licenses.template_words(notice)
        width = licenses.LONG if len(own) > 2 * licenses.LONG else licenses.SHORT
        n = len(own) - width + 1
        votes = [(a, k) for a in range(len(words) - width + 1) for k in range(n) if words[a:a + width] == own[k:k + width]]
        diagonals = sorted({a - k for a, k in votes})
        bands = []
        for d in diagonals:
            if not bands or d - bands[-1][-1] > licenses.NEIGHBOURS:
                bands.append([])
            bands[-1].append(d)
        for band in bands:
            here = [(a, k) for a, k in votes if band[0] <= a - k <= band[-1]]
            for first, _ in here:
                held = {k for a, k in here if first <= a and a + width - first <= 2 * len(own)}
                if len(held) >= licenses.COVERED * n:
                    out.add(label)
    return out


def test_notices_beside_noise(spark):
    rng, rows = random.Random(17), []
    for i in range(120):
        label, notice = rng.choice(licenses.NOTICES)
        own = notice.split()
        if rng.random() < 0.6:  # words changed, put in or left out
            for _ in range(rng.randrange(4)):
                k = rng.randrange(len(own))
                own[k:k + rng.randrange(2)] = [rng.choice(["other", own[rng.randrange(len(own))]])]
        parts = [" ".join(own)] + [" ".join(rng.choice(notice.split()) for _ in range(rng.randrange(40))) for _ in range(3)]
        parts += [" ".join(notice.split()[:rng.randrange(1, 4)] * rng.randrange(20))]
        rng.shuffle(parts)
        rows.append((i, " ".join(parts)))
    out = licenses.find_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {r["doc_id"]: {f["label"] for f in r["found"] if not f["phrase"]} for r in out}
    for i, text in rows:
        assert found[i] == plain_notices(text), (text, found[i], plain_notices(text))


def plain_strength(groups, prior):
    """p(1 - p) over the variance between groups, by moments; groups: {name: (good, n)}."""
    n = sum(k for _, k in groups.values())
    apart = sum(k * (g / k - prior[name]) ** 2 for name, (g, k) in groups.items())
    within = sum(prior[name] * (1 - prior[name]) for name in groups)
    scale = sum(k * prior[name] * (1 - prior[name]) for name, (_, k) in groups.items())
    between = max(0.0, apart - within) / n
    return min(1e6, max(1.0, scale / n / between if between > 0 else 1e6))


def plain_quality(evidence, hosts, paths, good):
    """(host_share, path_share, posterior) of every row, by going over all rows."""
    def sums(names):
        out = defaultdict(lambda: (0.0, 0))
        for e, name in zip(evidence, names):
            out[name] = (out[name][0] + e, out[name][1] + 1)
        return out

    both = list(zip(hosts, paths))
    of_host, of_path = sums(hosts), sums(both)
    overall = (sum(evidence) + 1) / (len(evidence) + 2)
    strength = plain_strength(of_host, dict.fromkeys(of_host, overall))
    host = {h: (g + strength * overall) / (n + strength) for h, (g, n) in of_host.items()}
    strength = plain_strength(of_path, {p: host[p[0]] for p in of_path})
    out = []
    for e, p in zip(evidence, both):
        g, n = of_path[p]
        start = strength * host[p[0]]
        others = min(1 - 1e-6, max(1e-6, (g - e + start) / (n - 1 + strength)))
        z = math.log(e / (1 - e)) - math.log(good / (1 - good)) + math.log(others / (1 - others))
        out.append((host[p[0]], (g + start) / (n + strength), 1 / (1 + math.exp(-z))))
    return out


def quality_rows(rng, n):
    docs, labels = [], []
    for i in range(n):
        good = rng.random() < (0.9 if i % 3 else 0.4)
        words = prose(rng, rng.randrange(20, 80)).split()
        text = " ".join(words) + "." if good else " ".join(w.upper() + "!!" for w in words)
        docs.append((i, text, "en" if i % 2 else "de", f"host{i % 3}", 1))
        labels.append((i, int(good), 0))
    return docs, labels


def test_quality(spark):
    docs, labels = quality_rows(random.Random(41), 240)
    docs += [(1000, None, None, None, None), (1001, "", "en", "host0", 0), (None, "no id here.", "en", "rare", 3)]
    labels += [(None, 1, 1), (5, None, 0), (7000, 1, 0)]
    df, told = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels[: 120] + labels[-3:], "doc_id long, quality int, toxic int")
    out = quality.quality(df, told).collect()
    assert len(out) == len(docs) and all(0 <= r[c] <= 1 for r in out for c in ("evidence", "host_share", "path_share", "posterior"))
    by = {r["doc_id"]: r for r in out}
    held = [(i, good) for i, good, _ in labels[120:-3] if i is not None and i < 240]
    assert sum(by[i]["kept"] == bool(good) for i, good in held) >= 0.97 * len(held)
    hosts = defaultdict(list)
    for i, _, lang, source, _ in docs:
        hosts[source].append(by[i]["evidence"])
    overall = (sum(map(sum, hosts.values())) + 1) / (sum(map(len, hosts.values())) + 2)
    assert by[0]["host_share"] < overall < by[1]["host_share"]  # a poor host and a good one
    rare = by[None]["host_share"]
    assert abs(rare - overall) < abs(sum(hosts["rare"]) / 1 - overall) + 1e-9  # a sparse host stays near the whole
    for r in out:
        g = [x for x in docs if x[0] == r["doc_id"]][0]
        own = [by[x[0]]["evidence"] for x in docs if x[2:4] == g[2:4]]
        assert min(min(own), r["host_share"]) - 1e-9 <= r["path_share"] <= max(max(own), r["host_share"]) + 1e-9
    values = df.select("doc_id", quality.measured(df).alias("measures"))
    good = quality.fit(values, told).good
    place = {(d[0], d[1]): d for d in docs}
    order = sorted(out, key=lambda r: repr(r["doc_id"]))
    kept = [next(d for d in docs if d[0] == r["doc_id"]) for r in order]
    assert len(place) == len(docs)
    plain = plain_quality([r["evidence"] for r in order], [d[3] for d in kept], [d[2] for d in kept], good)
    for r, (host, path, posterior) in zip(order, plain):
        assert r["host_share"] == pytest.approx(host) and r["path_share"] == pytest.approx(path) and r["posterior"] == pytest.approx(posterior)
        assert r["kept"] == (r["posterior"] >= 0.5)
    assert quality.quality(df.where("false"), told).count() == 0
    blank = quality.quality(df, told.where("false")).collect()
    assert {round(r["evidence"], 9) for r in blank} == {0.5}


def test_logistic_fit_separates():
    rng = np.random.default_rng(2)
    x = np.zeros((400, quality.MEASURES))
    x[:, 0], x[:, 1:] = 1.0, rng.normal(size=(400, quality.MEASURES - 1))
    y = (x[:, 1] + 0.3 * x[:, 2] > 0).astype(float)
    model = quality.fitted(x, y)
    score = ((x - model.mean) / model.spread) @ model.weights
    assert ((score > 0) == (y > 0)).mean() > 0.95
    assert quality.fitted(x[:0], y[:0]).good == 0.5
