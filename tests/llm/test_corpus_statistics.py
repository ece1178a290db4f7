"""Divergence audit, piece encoding and importance resampling against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from pathlight.llm import divergence, pieces, resampling
from pathlight.llm.common import ALNUM, LETTERS, byte_words

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, source string")


@pytest.fixture(scope="module")
def docs(spark):
    """Null ids, texts, langs and sources, repeated rows, a long text, a term with many sources, and clashing names."""
    rng = random.Random(4)
    stock = ["".join(rng.choice("abcdeÉñ漢") for _ in range(rng.randint(1, 4))) for _ in range(40)]
    rows = []
    for i in range(300):
        text = " ".join(rng.choice(stock) if rng.random() < 0.8 else rng.choice("THE The 12 x9y ß-ß a_b".split()) for _ in range(rng.randint(0, 60)))
        rows.append((i if i % 50 else None, text, rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s1", "s1", "S2", "é", None, ""])))
    rows += [(900, None, "en", "s1"), (901, "", "xx", "only"), (902, "rare", "xx", "other"), (903, "12 34 !", "yy", "single"), (904, " ".join(stock * 2000), "en", "long")]
    rows += [rows[3], rows[3], rows[-1]]
    out = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    return out.select("*", *(F.lit(i).alias(c) for i, c in enumerate("term n x p row ids decoded rank place weight feature item".split())))


# Words of bytes


def test_byte_words():
    import pyarrow as pa

    rng = random.Random(1)
    texts = [None, "", "abc", "ABC d9é", "A", "a"] + ["".join(rng.choice("aB9 é-漢_😀") for _ in range(rng.randint(0, 12))) for _ in range(500)]
    for array in (pa.array(texts), pa.array(texts).slice(3, 100), pa.array([], pa.string()), pa.array([None, ""], pa.string())):
        for kept, pattern in ((LETTERS, r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"), (ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
            words, counts = byte_words(array, kept)
            want = [[w.translate(LOWER) for w in re.findall(pattern, (t or "") if kept is LETTERS else (t or "").translate(LOWER))] for t in array.to_pylist()]
            assert counts.tolist() == list(map(len, want)) and [w.decode() for w in words.to_pylist()] == [w for x in want for w in x]


# 11 Divergence


def brute_audit(rows, least=3, top=200):
    count, docs_with = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = [t.translate(LOWER) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        count[lang or "", source or ""].update(terms)
        docs_with[lang or ""].update(set(terms))
    out = []
    for lang in docs_with:
        kept = [t for t, n in docs_with[lang].items() if n >= least]
        groups = {s: c for (own, s), c in count.items() if own == lang}
        total = Counter()
        for c in groups.values():
            total.update({t: c[t] for t in kept})

        def shares(c):
            n = sum(c[t] for t in kept) + len(kept)
            return {t: 1 + 1000000000 * (c[t] + 1) // n for t in kept}

        p, q = {s: shares(c) for s, c in groups.items()}, shares(total)
        f = lambda a, b: (a - b) * (a - b) // b
        for s in groups:
            pairs = sorted(((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in groups if o != s))
            terms = sorted((-f(p[s][t], q[t]), t.encode()) for t in kept if groups[s][t] > 0 and p[s][t] > q[t])[:top]
            out += [(lang, s, part, i.decode(), -v, k) for part, found in (("pair", pairs), ("term", terms)) for k, (v, i) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("block, pairs, sums, batch", [(divergence.BLOCK, divergence.PAIRS, divergence.SUMS, 10_000), (500, 10, 7, 3)])
def test_audit(spark, docs, monkeypatch, block, pairs, sums, batch):
    """Also with runs over many batches, pairs of rows in parts, and sums that are handed on early."""
    run = divergence.pairs_and_terms
    monkeypatch.setattr(divergence, "pairs_and_terms", lambda groups: run(groups, pairs, sums))
    sliced = divergence.slices
    monkeypatch.setattr(divergence, "slices", lambda b, column, rows, size: sliced(b, column, 7 if block == 500 else rows, block))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = sorted(tuple(r) for r in divergence.audit(docs).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute_audit([(r.text, r.lang, r.source) for r in docs.collect()])


def test_audit_edges(empty, docs):
    assert divergence.audit(empty).collect() == []
    got = {tuple(r) for r in divergence.audit(docs).where("lang in ('xx', 'yy')").collect()}  # no term in three documents
    assert got == {("xx", "only", "pair", "other", 0, 1), ("xx", "other", "pair", "only", 0, 1)}
    top = divergence.audit(docs, top=2).where("part = 'term'").groupBy("lang", "source").count().agg(F.max("count")).first()[0]
    assert top == 2


def test_audit_sql(docs):
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "lang", "source").toArrow())
    assert sorted(con.execute(divergence.SQL).fetchall()) == sorted(tuple(r) for r in divergence.audit(docs).collect())


def test_shares_are_exact(spark):
    big = 9_100_000_000_000_000_000
    row = spark.createDataFrame([(big - 2, big, 0)], "n bigint, total bigint, none bigint").select(divergence.share("n", "total").alias("a"), divergence.share("n", "none").alias("b")).first()
    assert row.a == 1 + 1000000000 * (big - 1) // big and row.b is None


def test_neighbours():
    start = np.array([0, 1, 4, 9])
    want = [(i, j) for a, b in ((0, 1), (1, 4), (4, 9), (9, 11)) for i in range(a, b) for j in range(a, b) if i != j]
    for most in (1, 7, 1000):
        assert [(int(a), int(b)) for i, j in divergence.neighbours(start, 11, most) for a, b in zip(i, j)] == want


# 12 Pieces


def library():
    return pieces.encoder(None).vocabulary.library


def encoded(texts):
    return [np.frombuffer(x, "<u4").tolist() for x in pieces.encoder(None).encode(texts)]


ALPHABETS = ["ab ", "abcdefghijklmnopqrstuvwxyz", "  \t\n▁a", "漢字かなカナ的一是 ", "0123456789.,-= ", "eéèêëñößüœ ", "th e i n o s ", "=-_#*/ ", "😀👍🏽é́ ", "\x00\x01a ﬁİ �"]


@pytest.mark.parametrize("alphabet", ALPHABETS)
def test_encoding_is_the_library_s(alphabet):
    rng = random.Random(1)
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    assert encoded(texts) == library().encode(texts)


@pytest.mark.parametrize("rounds", [0, 1, 3, pieces.ROUNDS])
def test_encoding_of_merges_that_depend_on_each_other(monkeypatch, rounds):
    """Runs of one character, words of pieces side by side, and what a heap finishes after few rounds."""
    monkeypatch.setattr(pieces, "ROUNDS", rounds)
    rng = random.Random(2)
    stock = "th he in ▁ er an re on at en nd ti es or te of ed is it al ar st to nt bcb ana".split()
    texts = ["".join(rng.choice(stock) for _ in range(rng.randint(0, 80))) for _ in range(600)]
    texts += [c * n for c in "=a -" for n in range(0, 90, 7)] + ["<s>", "</s>", "<unk>", "<0x41>"]
    monkeypatch.setattr(pieces, "_encoders", {})
    assert encoded(texts) == library().encode(texts)


def test_long_words_and_forgetting(monkeypatch):
    rng = random.Random(3)
    blob = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(60_000))
    texts = [blob, "a" * 40_000, " " * 5000 + "x", "漢" * 20_000, blob[:300] + " " + blob[:300]]
    assert encoded(texts) == library().encode(texts)
    monkeypatch.setattr(pieces, "CACHE", 1000)
    own = pieces.Encoder(pieces.encoder(None).vocabulary)
    for _ in range(5):
        some = [" ".join("".join(rng.choice("abcde") for _ in range(rng.randint(1, 200))) for _ in range(20))]
        assert np.frombuffer(own.encode(some)[0], "<u4").tolist() == library().encode(some)[0]
        assert max(map(len, own.words)) <= pieces.LONG and len(own.words) <= 50


def test_decoding_is_the_library_s():
    """Any ids: bytes that are no text, controls, the unknown, spaces in front."""
    rng, own = random.Random(4), pieces.encoder(None)
    odd = [0, 1, 2, 259, 28705, 29871, 3 + 0xE6, 3 + 0xBC, 3 + 0xA2, 3 + 0x20]
    lists = [[rng.choice([*odd, rng.randrange(3, 259), rng.randrange(259, 32000)]) for _ in range(rng.randint(0, 9))] for _ in range(3000)]
    got = own.decode(np.array([i for x in lists for i in x]), np.array(list(map(len, lists))))
    assert got == [library().decode(x) for x in lists]
    with pytest.raises(ValueError):
        own.decode(np.array([32000]), np.array([1]))


def test_pieces_of_documents(spark, docs, empty):
    got = pieces.decode(pieces.encode(docs))
    assert set(got.columns) == set(docs.columns) - {"text"}  # ids and decoded take the place of the old ones
    texts = Counter((r.doc_id, r.lang, r.source, r.text or "") for r in docs.collect())
    rows = got.collect()
    assert Counter((r.doc_id, r.lang, r.source, library().decode(r.ids)) for r in rows) == texts and all(library().encode(r.decoded) == r.ids for r in rows)
    assert pieces.encode(empty).collect() == [] and pieces.decode(pieces.encode(empty)).collect() == []
    assert [r.decoded for r in pieces.decode(spark.createDataFrame([(None,), ([],)], "ids array<int>")).collect()] == [None, ""]


# 13 Importance resampling


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def brute_ranks(rows, target, percent=25, least=20, buckets=10_000):
    def count(texts):
        c = Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in features(t)[1])
        return [c[i] for i in range(buckets)]

    s, t = count([t for _, t in rows]), count(target)
    size, wanted = sum(s), sum(t)
    gains = [math.floor(1000 * math.log((t[i] + 1) * (size + buckets) / ((s[i] + 1) * (wanted + buckets)))) for i in range(buckets)]
    out = []
    for doc, text in rows:
        words, own = features(text)
        weight = sum(gains[zlib.crc32(x.encode()) % buckets] for x in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    order = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    for i, r in enumerate(order[: percent * len(order) // 100]):
        r[4] = i + 1
    return [tuple(r[:5]) for r in out]


@pytest.mark.parametrize("block", [resampling.BLOCK, 300])
def test_resampling(spark, docs, monkeypatch, block):
    monkeypatch.setattr(resampling, "BLOCK", block)
    monkeypatch.setattr(resampling, "ROWS", 50 if block == 300 else resampling.ROWS)
    target = spark.createDataFrame([("THE abc ß-ß the 12",), (None,), ("",), ("The éa",)], "text string")
    want = brute_ranks([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()])
    got = [tuple(r) for r in resampling.ranked(docs, target).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    drawn = resampling.resampled(docs, target, percent=40)
    assert drawn.columns == docs.columns and drawn.count() == 40 * sum(len(features(r.text)[0]) >= 20 for r in docs.collect()) // 100


def test_resampling_edges(spark, docs, empty):
    assert resampling.ranked(empty, docs).collect() == [] and resampling.resampled(empty, empty).collect() == []
    want = brute_ranks([(r.doc_id, r.text) for r in docs.collect()], [])
    assert sorted(map(tuple, resampling.ranked(docs, empty).collect()), key=repr) == sorted(want, key=repr)


def test_drawn_documents_look_like_the_target(spark):
    """One document of ten is of the target's kind, and they are drawn four times as often at least (the noise is as strong as the weights)."""
    rng = random.Random(6)
    kinds = [[f"{c}{i}" for i in range(300)] for c in "ab"]
    text = lambda k: " ".join(rng.choice(kinds[k]) for _ in range(60))
    rows = [(i, text(i % 10 == 0)) for i in range(1000)]
    drawn = resampling.resampled(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame([(text(1),) for _ in range(50)], "text string"), percent=8).collect()
    assert len(drawn) == 80 and sum(r.doc_id % 10 == 0 for r in drawn) >= 4 * 8


def test_dictionary(spark):
    got = {r.feature: r.n for r in resampling.dictionary(spark.createDataFrame([("A b a",), ("b A",), (None,)], "text string")).collect()}
    assert got == {"a": 3, "b": 2, "a b": 1, "b a": 2}
