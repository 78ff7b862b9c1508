import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from logloom.llm import language, period_runs, search

from . import helpers as h

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ------------------------------------------------------------ periodic runs --

def runs_brute(w, least=12):
    """Every stretch with a smallest period, by trying each period from each place."""
    out, n = set(), len(w)
    for q in range(1, n // 2 + 1):
        s = 0
        while s < n:
            e = s
            while e + q < n and w[e] == w[e + q]:
                e += 1
            whole = e + q - s
            if e > s and whole >= max(least, 2 * q) and not any(
                    all(w[i] == w[i + d] for i in range(s, s + whole - d)) for d in range(1, q)):
                out.add((s, s + whole, q))
            s = e + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def numbers(words):
    last = {w: i for i, w in enumerate(words)}
    return np.array([last[w] for w in words] + [len(words)], dtype=np.int64)


def test_runs_brute():
    r = random.Random(5)
    for _ in range(600):
        n, k = r.randrange(60), r.randrange(1, 4)
        w = [r.randrange(k) for _ in range(n)]
        if n and r.random() < .4:
            a = r.randrange(n)
            p = 1 + (n - a) // (3 + r.randrange(8))
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        for least in (2, 3, 12):
            assert period_runs.runs(numbers(w), least) == runs_brute(w, least), (w, least)


@pytest.mark.parametrize("words,found", [
    ([1] * 60_000, [(0, 60_000, 1)]),
    ([int(b) for b in bin(123456789)[2:]] * 2000, [(0, 54_000, 27)]),
    (list(range(20_000)) * 3, [(0, 60_000, 20_000)]),
])
def test_runs_long(words, found):
    assert period_runs.runs(numbers(words), 30) == found


def test_runs_fibonacci_word():
    a, b = [0], [0, 1]
    while len(b) < 3000:
        a, b = b, b + a
    got = period_runs.runs(numbers(b[:400]))
    assert got == runs_brute(b[:400])
    assert len(period_runs.runs(numbers(b))) > len(got)


def test_positions_in_blocks():
    r = random.Random(2)
    places = r.sample(range(100_000), 5000)
    s, own = period_runs.Positions(places[0]), {places[0]}
    for x in places[1:]:
        before, after = s.add(x)
        assert before == max((y for y in own if y < x), default=None)
        assert after == min((y for y in own if y > x), default=None)
        own.add(x)
        if len(own) > 1500 and len(own) % 7:
            continue
    assert list(s) == sorted(own)


def digest_brute(doc_id, text):
    words = WORD.findall(text or "")
    n, crc = len(words), zlib.crc32(str(doc_id).encode())
    if crc % 10 == 0 and n:
        g = crc // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    # periods up to half the text; long texts only where a period can start
    found = runs_brute(words) if n <= 700 else period_runs.runs(numbers(words))
    gone = {i for s, e, q in found for i in range(s + q, e)}
    top = min(found, key=lambda r: (r[0] - r[1], r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *((top[0], top[1] - top[0], top[2], 1000 * (top[1] - top[0]) // top[2]) if top else (None,) * 4),
            sha("".join(f"{s},{e - s},{q}\n" for s, e, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_period_runs_query_brute(spark):
    got = period_runs.op13_period_runs(spark, h.SF)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rows = sorted(tuple(r) for r in got.collect())
    assert rows == [digest_brute(i, t) for i, t in h.docs_of()]
    assert any(r[1] for r in rows)


def test_period_runs_edges(spark):
    said = "a b c " * 6 + "tail"
    docs = spark.createDataFrame([(1, said, 1, 2), (1, said, 1, 2), (None, None, 3, 4), (2, "", 5, 6), (3, " \t\n", 7, 8),
                                  (4, "é " * 14, 9, 10), (5, h.LONG, 0, 0)], "doc_id long, text string, runs int, `_top` int")
    rows = {(r["doc_id"], r["_top"]): r for r in period_runs.find_runs(docs).collect()}
    assert [tuple(x) for x in rows[1, 2]["runs"]] == [(0, 18, 3)] and rows[1, 2]["collapsed"] == "a b c tail"
    assert rows[None, 4]["runs"] == [] and rows[None, 4]["collapsed"] == "" == rows[2, 6]["collapsed"] == rows[3, 8]["collapsed"]
    assert rows[4, 10]["collapsed"] == "é"
    assert [tuple(x) for x in rows[5, 0]["runs"]] == [(0, 60_000, 10_007)]
    assert period_runs.find_runs(docs).count() == 7
    assert len(period_runs.find_runs(h.edge(spark)).collect()) == len(h.EDGE)
    assert period_runs.find_runs(h.empty(spark)).collect() == []


# ------------------------------------------------------------------- search --

def search_brute(docs, items, k):
    docs = [(i, collections.Counter(search.terms(t))) for i, t in docs if search.terms(t)]
    n_docs, n_terms = len(docs), sum(sum(c.values()) for _, c in docs)
    df = collections.Counter(t for _, c in docs for t in c)
    out = []
    for item, text in sorted({x for x in items if x[1] is not None}, key=repr):
        many = collections.Counter(search.terms(text))
        scored = []
        for i, c in docs:
            m = 100 - 25 + 25 * sum(c.values()) * n_docs // n_terms
            s = sum(n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                    for t, n in many.items() if t in c)
            if s > 0:
                scored.append((-s, -1 if i is None else i, i, s))
        out += [(item, rank, x[2], x[3]) for rank, x in enumerate(sorted(scored, key=lambda x: x[:2])[:k], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_search_query_equals_sql(spark):
    got = h.rows(search.op12_lexical_search(spark, h.SF).toPandas())
    assert got == h.rows(h.duck().execute(search.ORACLE).df()) and got


def test_search_blocks_passes_and_brute(spark):
    r = random.Random(3)
    words = [f"w{int(r.paretovariate(0.7))}" for _ in range(20_000)]
    docs, at = [], 0
    for i in range(300):
        n = r.choice((0, 1, 2, 5, 40, 200))
        docs.append((r.randrange(250), " ".join(words[at % 18_000:at % 18_000 + n])))
        at += n
    docs += [(None, "w1 w2 w3"), (7, None), (7, "W1-w2.W3"), (7, "w1 w2 w3"), (8, "w1 w2 w3")]
    items = [(i, " ".join(r.choices(words, k=r.randrange(1, 30)))) for i in range(25)]
    items += [(1, "w1 w2"), (1, "w1 w2"), (None, "w3 w3 w1"), (90, ""), (91, None), (92, "nothing of it"), (93, "?!")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    expected = search_brute(docs, items, 7)
    for block, size in ((1 << 24, 1 << 25), (500, 200)):
        got = found(search.search(search.build_index(frame, block=block), asked, k=7, pass_bytes=size))
        assert got == expected


def test_search_stops_early():
    """Strata below the k-th best score are not read: their postings may even be missing."""
    ids = np.arange(40)
    texts = [b"a" + b" x" * (i * 5) for i in range(40)]
    table = search.index_block(0, texts, ids)
    import pyarrow as pa
    n_terms = sum(1 + 5 * i for i in range(40))
    block = search.Stratified(pa.Table.from_batches([table]).filter(pa.compute.is_in(table["term"], pa.array(["", "a"]))), {"a": 0}, 40, n_terms)
    block.doc = block.doc.copy()
    worst = block.strata.argmax()
    block.first[block.stratum == worst] = 1 << 40  # reading it would fail
    docs, scores = block.best(np.array([0]), np.array([1000]), 3)
    assert docs.tolist() == [0, 1, 2] and (np.diff(scores) <= 0).all()


def test_search_edges(spark):
    items = spark.createDataFrame([(1, "word7919 tail"), (2, "plain words"), (3, "x"), (4, "é 漢字")], "item_id long, text string")
    got = found(search.search(search.build_index(h.edge(spark)), items, k=20))
    assert got == search_brute([(i, t) for i, t, _ in h.EDGE], items.collect(), 20) and got
    assert found(search.search(search.build_index(h.empty(spark)), items)) == []
    assert found(search.search(search.build_index(h.edge(spark)), items.limit(0))) == []


# ----------------------------------------------------------------- language --

def path_brute(score, switch):
    """Best total of a labelling, one word after the other."""
    v = np.zeros(score.shape[1], dtype=np.int64)
    for row in score:
        v = np.maximum(v, v.max() - switch) + row
    return v.max()


def test_viterbi_brute():
    r = np.random.default_rng(4)
    for _ in range(60):
        n_texts, labels = int(r.integers(1, 6)), int(r.integers(1, 5))
        size = r.integers(0, 400, n_texts)
        text = np.repeat(np.arange(n_texts), size)
        score = r.integers(-900, 0, (len(text), labels))
        switch = int(r.integers(0, 1500))
        label = language.viterbi(score, text, n_texts, switch)
        for t in range(n_texts):
            own, mine = score[text == t], label[text == t]
            if len(mine):
                total = own[np.arange(len(mine)), mine].sum() - switch * int((mine[1:] != mine[:-1]).sum())
                assert total == path_brute(own, switch)


def test_words_of_scripts():
    tables = language.letter_tables()
    texts = ["Über42 Москва2London ét", "", "漢字かな x", "7 ́ -"]
    w = language.Words(texts, tables)
    got = [(int(t), texts[t][a - w.base[t]:z - w.base[t]]) for t, a, z in zip(w.text, w.start, w.end)]
    assert got == [(0, "Über"), (0, "Москва"), (0, "London"), (0, "ét"), (2, "漢字"), (2, "かな"), (2, "x")]
    names = [s[0] for s in language.SCRIPTS]
    assert [names[s - 1] for s in w.script] == ["latin", "cyrillic", "latin", "latin", "han", "kana", "latin"]


def test_grams_of_words():
    w = language.Words(["la la A", "a"], language.letter_tables())
    owner, _ = w.grams()
    # "la": 3 two-, 2 three-, 1 four-gram; "a": 2, 1, 0 (ends taken along)
    assert sorted(np.bincount(owner).tolist()) == [3, 6]


def test_language_held_out(spark):
    got = {r["doc_id"]: r for r in language.op11_language_id(spark, "/root/testdata/sf0.01").collect()}
    truth = h.duck("/root/testdata/sf0.01").execute("select doc_id, lang from documents").fetchall()
    assert len(got) == len(truth)
    held = [(got[i]["lang_pred"], lang) for i, lang in truth if got[i]["held_out"]]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _ in truth)
    assert len(held) > 100 and sum(a == b for a, b in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_held_out_rows_teach_nothing(spark):
    docs = spark.read.parquet(f"{h.SF}/documents.parquet")
    swapped = docs.withColumn("lang", F.when(language.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    a = language.learn(docs.where(~language.held_out()))
    b = language.learn(swapped.where(~language.held_out()))
    assert [m[0] for m in a] == [m[0] for m in b] and all((x[1] == y[1]).all() for x, y in zip(a, b))


def _mixed(spark):
    r = random.Random(9)
    parts = {"en": ("the", "ing", "th", "ed", "wh"), "fr": ("que", "eau", "ou", "ment", "è"), "ru": ("ко", "про", "ный", "что", "ть")}
    say = lambda lang, n: " ".join("".join(r.choices(parts[lang], k=r.randrange(1, 4))) for _ in range(n))
    rows = [(i, say(lang, 60), lang) for i, lang in enumerate(list(parts) * 20)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), say


def test_language_spans_of_mixed_texts(spark):
    docs, say = _mixed(spark)
    model = language.learn(docs)
    assert [m[0] for m in model] == ["en", "fr", "ru"]
    a, b, z = say("en", 300), say("fr", 200), say("ru", 20)
    texts = [(1, f"{a}. {b}"), (2, f"{z}! {say('fr', 90)}"), (3, "..., 12"), (4, None), (5, ""), (6, "ко"), (7, say("en", 4000))]
    got = {r["doc_id"]: r for r in language.label_languages(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()}
    spans = [tuple(s) for s in got[1]["lang_spans"]]
    assert [s[2] for s in spans] == ["en", "fr"] and abs(spans[0][1] - len(a)) <= 12 and got[1]["lang_pred"] == "en"
    assert 0.3 < got[1]["score"] < 0.8
    assert [s["lang"] for s in got[2]["lang_spans"]] == ["ru", "fr"] and got[2]["lang_pred"] == "fr"
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 and got[i]["lang_spans"] == [] for i in (3, 4, 5))
    assert got[6]["lang_pred"] == "ru" and len(got[7]["lang_spans"]) == 1


def test_language_edges(spark):
    docs, _ = _mixed(spark)
    model = language.learn(docs)
    rows = language.label_languages(h.edge(spark), model).collect()
    assert len(rows) == len(h.EDGE) and {r["lang_pred"] for r in rows} <= {"en", "fr", "ru", "und"}
    assert language.label_languages(h.empty(spark), model).collect() == []
    assert language.learn(docs.limit(0)) == []
    assert {r["lang_pred"] for r in language.label_languages(h.edge(spark), []).collect()} == {"und"}
