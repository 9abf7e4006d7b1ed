"""Alignment of tokenizers, language identification and periodic runs on small fixtures, against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from headway.llm import language_id, periodic_runs, queries, token_alignment
from headway.llm.text_arrays import Texts

FOLDER = "/root/testdata/sf0.001"
ODD = [None, "", " ", "  ", "a", "é", "a é😀 x  \x00<0x41> <s>漢\U0001F9FF\n\t", "▁x", "日本語 テキスト" * 5, "<|endoftext|> hi", "\U0001F9FF\U0001F9FF\U0001FAE8é",
       "﷽ ﬁ Ⅷ ", "tail \n\n", "x" * 3000 + " y", "w " * 2000, "the same text twice", "the same text twice", "12 34 !?"]


def of_file(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def odd_docs(spark):
    rows = [(i, t, "own", 3, "p") for i, t in enumerate(ODD)] + [(15, ODD[15], "own", 3, "p"), (None, "no id", None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, block string, n_words int, runs string").repartition(3)


# ---- 11 -----------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def pair():
    return token_alignment.read_tokenizers()


def plain_links(pair, text):
    """Ids of both sides, the pairs that share a byte, and the groups, all by going over the bytes; nothing where bytes differ."""
    a, of_a, b, of_b = pair.tools
    ids = [], []
    if text:
        ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    raw = [[bytes(d.bytes[d.begins[i]:d.begins[i] + d.sizes[i]]) for i in side] for d, side in zip((of_a, of_b), ids)]
    if not text or any(b"".join(r) != (" " + text).encode() for r in raw):
        return [], [], [], ""
    owners = [[k for k, x in enumerate(r) for _ in x] for r in raw]
    links = [(ids[0][i], ids[1][j]) for i, j in dict.fromkeys(zip(*owners))]
    groups, n = [([], [])], len(owners[0])
    for p, (i, j) in enumerate(zip(*owners)):
        ends = [p + 1 == n or owner[p + 1] != k for owner, k in zip(owners, (i, j))]
        for side, k, ended, group in zip(ids, (i, j), ends, groups[-1]):
            if ended:
                group.append(str(side[k]))
        if all(ends) and p + 1 < n:
            groups.append(([], []))
    return ids[0], ids[1], links, ";".join("|".join(map(",".join, g)) for g in groups)


def plain_alignment(pair, docs):
    rows = [(doc, plain_links(pair, text)) for doc, text in docs]
    counts = Counter(link for _, r in rows for link in r[2])
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return sorted(((doc, len(a), len(b), len([g for g in text.split(";") if g]), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), text)
                   for doc, (a, b, links, text) in rows), key=repr)


def test_alignment_of_odd_texts(odd_docs, pair):
    got = sorted((tuple(r) for r in token_alignment.align(odd_docs, pair).collect()), key=repr)
    want = plain_alignment(pair, [(r.doc_id, r.text) for r in odd_docs.collect()])
    assert got == want
    assert any(r[1] == 0 and r[0] == ODD.index("▁x") for r in got)
    empty = token_alignment.align(odd_docs.limit(0), pair)
    assert empty.count() == 0 and empty.columns[:2] == ["doc_id", "n_a"]


def test_alignment_does_not_depend_on_blocks(odd_docs, pair, monkeypatch):
    whole = sorted((tuple(r) for r in token_alignment.align(odd_docs.coalesce(1), pair).collect()), key=repr)
    monkeypatch.setattr(token_alignment, "BLOCK_BYTES", 200)
    blocks = token_alignment.token_blocks(odd_docs.coalesce(1), pair)
    assert blocks.select("block").distinct().count() > 3
    parts = sorted((tuple(r) for r in token_alignment.align(odd_docs.coalesce(1), pair).collect()), key=repr)
    assert parts == whole


def test_alignment_query(spark, pair):
    docs = of_file(spark)
    want = [(*r[:7], hashlib.sha256(r[7].encode()).hexdigest() if r[7] else "") for r in plain_alignment(pair, docs)]
    got = sorted((tuple(r) for r in queries.QUERIES["op11_token_alignment"](spark, FOLDER).collect()), key=repr)
    assert got == sorted(want, key=repr)


def test_refined_ends_of_split_characters(pair):
    _, of_a, _, of_b = pair.tools
    text = "漢\U0001F9FF x \U0001F9FF"
    a, b, sizes = token_alignment.tokenise(pair, [text])
    for side, decoded in ((a, of_a), (b, of_b)):
        assert side.ends.tolist() == np.cumsum(decoded.sizes[side.ids]).tolist() and side.ends[-1] == sizes[0] == len((" " + text).encode())
    # A span that doesn't come out at a cut is not sound.
    ends, sound = token_alignment.refined_ends(np.array([3, 5]), np.array([2, 2]), np.array([True, False]), np.array([0, 0]))
    assert not sound[0] or not sound[1]


def test_packed_units_and_equal_hashes(monkeypatch):
    for n in (1, 300, 1 << 16, (1 << 16) + 1, (1 << 24) + 1):
        units = np.array([0, n // 2, n - 1])
        width = token_alignment._unit_width(n)
        assert token_alignment._unpacked_units(token_alignment._packed_units(units, width), width).tolist() == units.tolist()
    raw = " aa bb aa cc".encode()
    data = np.frombuffer(raw, np.uint8)
    starts = token_alignment.split_units(data, np.array([0]))
    assert starts.tolist() == [0, 3, 6, 9]
    # With every hash the same, units are still told apart by their bytes.
    monkeypatch.setattr(token_alignment, "mix", lambda x: np.zeros(len(x), np.uint64))
    first, back = token_alignment.distinct_units(data, starts)
    assert [raw[starts[first[b]]:starts[first[b]] + 3] for b in back] == [b" aa", b" bb", b" aa", b" cc"]


@pytest.mark.parametrize("room", [0, 40, 1 << 20])
def test_units_of_earlier_blocks_are_not_encoded_again(pair, monkeypatch, room):
    monkeypatch.setattr(token_alignment, "KNOWN_BYTES", room)
    asked, plain = [], token_alignment.tokenise_units

    def counted(pair, raw, starts, stops):
        asked.append([raw[i:j] for i, j in zip(starts.tolist(), stops.tolist())])
        return plain(pair, raw, starts, stops)

    monkeypatch.setattr(token_alignment, "tokenise_units", counted)
    known = token_alignment.KnownUnits()
    texts = [t for t in ODD if t and "▁" not in t]
    for block in (texts, texts[::-1], ["the same text", "twice new", "the 🧿 é"], ["▁x", "the ▁x"]):
        rows, sheet, codes, n = token_alignment._block(pair, block, known)
        alone = token_alignment._block(pair, block, token_alignment.KnownUnits())
        assert (rows, sheet) == alone[:2] and codes.tolist() == alone[2].tolist() and n.tolist() == alone[3].tolist()
        assert sum(map(len, known.place)) <= room
    first, again, more = set(asked[0]), set(asked[2]), set(asked[-4])
    if room == 1 << 20:
        # Each block is followed by one on its own; the second block of the shared units asks for nothing.
        assert asked[1] == asked[0] and again == set(asked[1]) and not more & first
    if room == 0:
        assert len(asked) == 8


# ---- 12 -----------------------------------------------------------------------------------------------------------


def labelled(spark, n=60, seed=1):
    """Four invented languages, two of them close relatives by family."""
    rng = random.Random(seed)
    stems = {"de": ["der", "und", "schaft", "ung", "nicht", "ein"], "en": ["the", "and", "ship", "ing", "not", "an"],
             "fr": ["les", "et", "eaux", "ment", "pas", "une"], "es": ["los", "y", "cion", "mente", "no", "una"], "xx": ["qzk", "vvq", "zz", "kq", "qv"]}
    rows = []
    for k in range(n * len(stems)):
        lang = sorted(stems)[k % len(stems)]
        rows.append((k, " ".join(rng.choice(stems[lang]) + rng.choice(["", rng.choice(stems[lang])]) for _ in range(40)), lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_family_then_languages(spark):
    docs = labelled(spark)
    model = language_id.fit(docs.where("doc_id % 3 != 0"))
    assert model.members == {"germanic": ("de", "en"), "romance": ("es", "fr"), "xx": ("xx",)}
    assert sorted(model.machines) == [("", "germanic", "romance"), ("", "germanic", "xx"), ("", "romance", "xx"), ("germanic", "de", "en"), ("romance", "es", "fr")]
    out = language_id.predict(docs.where("doc_id % 3 = 0"), model)
    assert out.where("lang = lang_pred").count() == out.count()
    assert out.where("score < 0 or score > 1").count() == 0
    again = language_id.fit(docs.where("doc_id % 3 != 0").repartition(5))
    assert all((again.machines[k] == w).all() for k, w in model.machines.items())


def test_machine_reaches_the_minimum():
    rng = np.random.default_rng(2)
    rows = language_id.weighted(rng.integers(0, 5, (40, language_id.WIDTH)) * (rng.random((40, language_id.WIDTH)) < 0.02))
    sign = np.where(np.arange(40) < 15, 1, -1).astype(np.float32)

    def loss(w):
        share = np.where(sign > 0, 0.5 / 15, 0.5 / 25)
        return language_id.NORM / 2 * (w @ w) + (share * np.maximum(0, 1 - sign * (rows @ w[:-1] + w[-1])) ** 2).sum()

    w = language_id.fit_machine(rows, sign).astype(np.float64)
    best = language_id.fit_machine(rows, sign, steps=5000).astype(np.float64)
    # All weights zero cost 1.
    assert loss(w) <= loss(best) + 0.002
    assert all(loss(best) <= loss(best + 0.01 * rng.standard_normal(len(best))) for _ in range(20))


def test_votes_are_pairwise():
    rng = np.random.default_rng(3)
    rows = language_id.weighted(rng.integers(0, 3, (30, language_id.WIDTH)))
    machines = [rng.standard_normal(language_id.WIDTH + 1).astype(np.float32) for _ in range(6)]
    won, score = language_id._vote(rows, ("a", "b", "c", "d"), machines)
    for k in range(30):
        votes, sums = [0] * 4, [0.0] * 4
        for (i, j), w in zip([(0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3)], machines):
            m = float(rows[k] @ w[:-1] + w[-1])
            p = 1 / (1 + np.exp(-language_id.SLOPE * m))
            votes[i if m >= 0 else j] += 1
            sums[i] += p
            sums[j] += 1 - p
        best = max(range(4), key=lambda c: (votes[c], sums[c]))
        assert won[k] == best and abs(score[k] - sums[best] / 3) < 1e-5


def test_language_corner_cases(spark, odd_docs):
    docs = labelled(spark)
    model = language_id.fit(docs)
    clash = odd_docs.withColumn("lang_pred", F.lit("old")).withColumn("score", F.lit("old"))
    out = language_id.predict(clash, model)
    assert out.columns == ["doc_id", "text", "block", "n_words", "runs", "lang_pred", "score"] and out.count() == odd_docs.count()
    rows = out.collect()
    silent = {None, "", " ", "  ", "12 34 !?"}
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in rows if r.text in silent)
    assert all(r.lang_pred in {"de", "en", "es", "fr", "xx"} and 0 <= r.score <= 1 for r in rows if r.text not in silent)
    assert len({(r.lang_pred, r.score) for r in rows if r.text == "the same text twice"}) == 1
    nothing = language_id.fit(docs.limit(0))
    assert {r.lang_pred for r in language_id.predict(docs, nothing).collect()} == {"und"}
    assert language_id.predict(docs.limit(0), model).count() == 0
    one = language_id.fit(docs.where("lang = 'de'").union(docs.select("doc_id", "text", F.lit(None).cast("string"))))
    assert {r.lang_pred for r in language_id.predict(docs, one).collect()} == {"de"}
    # A label without a letter in its texts fits nothing and harms nothing.
    odd = docs.union(spark.createDataFrame([(9999, "123", "zz"), (9998, None, "zz")], docs.schema))
    assert language_id.predict(docs, language_id.fit(odd)).where("lang = lang_pred").count() > 0.6 * docs.count()
    with pytest.raises(ValueError):
        language_id.fit(spark.range(300).select(F.col("id").alias("doc_id"), F.lit("a").alias("text"), F.col("id").cast("string").alias("lang")))


def test_trigram_counts():
    texts = ["Abc abc", "", None, "é!", "..", "ab"]
    got = language_id.trigram_counts(Texts(pa.array(texts)))
    for text, row in zip(texts, got):
        raw = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in (text or "").lower().encode())
        want = Counter()
        for i in range(len(raw) - 2):
            if raw[i:i + 3] != b"   ":
                code = raw[i] | raw[i + 1] << 8 | raw[i + 2] << 16
                want[(code * 0x9E3779B1 & 0xFFFFFFFF) >> 20] += 1
        assert {int(k): int(row[k]) for k in np.flatnonzero(row)} == dict(want)


@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.01"])
def test_language_query_held_out(spark, folder):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    rows = queries.QUERIES["op12_language_id"](spark, folder).collect()
    assert len(rows) == len(langs) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out and langs[r.doc_id]]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.97 * len(held)


# ---- 13 -----------------------------------------------------------------------------------------------------------


def plain_runs(words, least=12):
    """Maximal stretches for every distance by comparing all words; the smallest distance of those with the same ends is the period."""
    found, codes = {}, np.unique(words, return_inverse=True)[1] if words else np.zeros(0, int)
    for q in range(1, len(words) // 2 + 1):
        same = np.concatenate([[False], codes[:-q] == codes[q:], [False]])
        change = np.flatnonzero(same[1:] != same[:-1])
        for begin, end in zip(change[::2].tolist(), change[1::2].tolist()):
            if end + q - begin >= max(least, 2 * q):
                found.setdefault((begin, end + q), q)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def without_repeats(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_of(text):
    return [w for w in (text or "").translate({i: " " for i in range(9, 14)}).split(" ") if w]


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_of_random_words(least):
    rng = random.Random(least)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 6)):
            n, kinds = rng.choice([0, 1, 5, 30, 80]), rng.choice([1, 2, 3, 6])
            words = [rng.choice("abcdef"[:kinds]) for _ in range(n)]
            if n and rng.random() < 0.5:
                p, a = rng.randint(1, n), rng.randint(0, n - 1)
                words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            texts.append(rng.choice([" ", "\n", " \t"]).join(words))
        n, runs, collapsed = periodic_runs.runs_of_texts(Texts(pa.array(texts)), least)
        for text, size, found, left in zip(texts, n, runs.to_pylist(), collapsed.to_pylist()):
            words = words_of(text)
            want = plain_runs(words, least)
            assert size == len(words) and [(r["start"], r["length"], r["period"]) for r in found] == want and left == without_repeats(words, want)


def test_runs_of_structured_words():
    """Fibonacci and Thue-Morse words, squares of squares, and texts that share words with their neighbours."""
    fib = ["a", "ab"]
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    morse = "".join("ab"[bin(i).count("1") % 2] for i in range(256))
    texts = [" ".join(t) for t in (fib[-1], morse, morse * 2, "ab" * 40 + "c" + "ab" * 40, "a" * 200, ("x" * 9 + "y") * 9)]
    for least in (2, 12):
        _, runs, _ = periodic_runs.runs_of_texts(Texts(pa.array(texts)), least)
        for text, found in zip(texts, runs.to_pylist()):
            assert [(r["start"], r["length"], r["period"]) for r in found] == plain_runs(text.split(), least)


def test_many_tested_suffixes_in_blocks(monkeypatch):
    texts = [" ".join("ab" * 200 + "c" * 100), " ".join("abc" * 90)]
    whole = periodic_runs.runs_of_texts(Texts(pa.array(texts)))[1].to_pylist()
    monkeypatch.setattr(periodic_runs, "TESTED", 7)
    assert periodic_runs.runs_of_texts(Texts(pa.array(texts)))[1].to_pylist() == whole


def test_collapse_corner_cases(spark, odd_docs):
    out = periodic_runs.collapse_runs(odd_docs.withColumn("collapsed", F.lit(1)))
    assert out.columns == ["doc_id", "text", "block", "n_words", "runs", "collapsed"] and out.count() == odd_docs.count()
    for r in out.collect():
        words = words_of(r.text)
        want = plain_runs(words)
        assert r.n_words == len(words) and [tuple(x) for x in r.runs] == want and r.collapsed == without_repeats(words, want)
    assert periodic_runs.collapse_runs(odd_docs.limit(0)).count() == 0
    assert periodic_runs.collapse_runs(spark.createDataFrame([(None,), ("",)], "text string")).where("collapsed = '' and n_words = 0").count() == 2


def test_runs_query(spark):
    want = []
    for doc, text in of_file(spark):
        h = zlib.crc32(str(doc).encode())
        words, g = words_of(text), h // 10
        n = len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        lines = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
        want.append((doc, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                     hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(without_repeats(words, runs).encode()).hexdigest()))
    got = sorted((tuple(r) for r in queries.QUERIES["op13_periodic_runs"](spark, FOLDER).collect()), key=repr)
    assert got == sorted(want, key=repr)
    assert sum(r[1] > 0 for r in got) >= 10
