import random

import pytest

from logloom.llm import components, decontaminate, near, suffixes

from . import helpers as h


def near_rows(spark, docs, **params):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    return near.link_classes(df, **params).select("no_id", "id", "label", "n_links", "size").collect()


def copies(r, n=60):
    """Random texts with near copies at various distances, and exact ones."""
    words = [f"w{i}" for i in range(400)]
    base = [[r.choice(words) for _ in range(r.randrange(30, 120))] for _ in range(12)]
    out = []
    for i in range(n):
        t = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 1, 2, 5])):
            t[r.randrange(len(t))] = "changed"
        out.append((i, " ".join(t)))
    return out


@pytest.mark.parametrize("block", [4, 128])
def test_near_brute(spark, block):
    docs = copies(random.Random(block))
    want = h.near_brute(docs)
    got = {r["id"]: (r["label"]["id"], r["n_links"]) for r in near_rows(spark, docs, block=block)}
    assert got == want


def test_near_query_brute(spark):
    docs = h.docs_of()
    want = h.near_brute(docs)
    got = {r["doc_id"]: r for r in near.op3_ngram_jaccard_join(spark, h.SF).collect()}
    assert {docs[i][0]: (docs[a][0], n) for i, (a, n) in want.items()} == {k: (r["class_id"], r["n_links"]) for k, r in got.items()}


def test_near_edges(spark):
    got = near.link_classes(h.edge(spark))
    assert got.count() == len(h.EDGE)
    by = {(r["no_id"], r["id"], r["size"]): r for r in got.collect()}
    body = len(h.shingles(h.BODY))
    assert by[(False, 1, body)]["n_links"] == 4 and by[(True, 0, body)]["label"]["id"] == 1
    assert by[(False, 3, 0)]["n_links"] == 0 and by[(False, 4, 0)]["label"]["id"] == 4
    assert by[(False, 7, len(h.shingles(h.LONG + " tail")))]["label"]["id"] == 6
    assert near.link_classes(h.empty(spark)).count() == 0
    kept = near.keep_one(h.edge(spark))
    assert kept.columns == h.edge(spark).columns
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] is None) for r in kept.collect())
    assert ids == [(False, 1, False), (False, 3, True), (False, 4, False), (False, 5, False), (False, 6, False), (False, 8, False),
                   (False, 9, False), (False, 10, False), (False, 10, False), (True, 0, True)]


def test_prefix_is_shortened_until_the_recall():
    k = near.prefix_length()
    met = lambda n: 1 - (1 - near.THRESHOLD ** n) ** near.TREES
    assert met(k) >= near.RECALL > met(k + 1)


def test_recall_is_judged_by_the_links_found():
    done = lambda k, links, low: near.reached(k, links, low, near.THRESHOLD, near.TREES, near.RECALL)
    assert not done(8, 0, None) and not done(8, 5, 0.95)  # too few links to tell
    assert done(8, 1000, 0.95) and not done(8, 1000, 0.83)  # weak links: shorter prefixes are needed
    assert done(7, 1000, 0.83) and not done(7, 1000, 0.81) and done(6, 1000, 0.8)


def levels_used(spark, docs):
    from pathlib import Path

    from logloom.llm import common
    folder = Path(common.shared_dir(spark).removeprefix("file:"))
    before = set(folder.glob("pairs-*"))
    got = near_rows(spark, docs)
    return got, len(set(folder.glob("pairs-*")) - before)


def test_prefixes_are_shortened_only_as_far_as_needed(spark):
    r = random.Random(5)
    close, weak = [], []
    for i in range(60):
        t = [f"u{r.randrange(10**6)}" for _ in range(200)]
        close += [(2 * i, " ".join(t)), (2 * i + 1, " ".join(t[:-1] + ["changed"]))]
        weak += [(2 * i, " ".join(t)), (2 * i + 1, " ".join(t[:178] + [f"v{i}_{j}" for j in range(22)]))]  # 174 of 218 windows
    for docs, levels in ((close, 1), (weak, 3)):
        got, used = levels_used(spark, docs)
        assert used == levels
        assert {x["id"]: (x["label"]["id"], x["n_links"]) for x in got} == h.near_brute(docs)


def test_measured_recall_at_the_threshold(spark):
    r = random.Random(6)
    docs = []
    for i in range(400):
        t = [f"u{r.randrange(10**6)}" for _ in range(49)]
        docs += [(2 * i, " ".join(t)), (2 * i + 1, " ".join(t[:44] + [f"v{i}_{j}" for j in range(5)]))]  # 40 of 50 windows
    linked = sum(x["n_links"] for x in near_rows(spark, docs))
    assert sum(n for _, n in h.near_brute(docs).values()) == 800 and linked >= 0.99 * 800


def near_group(n, words=200):
    """Texts that differ in one word: all are linked, with 191 of 201 windows."""
    t = [f"w{i}" for i in range(words)]
    return [(i, " ".join(t[:90] + [f"c{i}"] + t[91:])) for i in range(n)]


def test_rows_sent_for_a_near_group_grow_slower_than_its_square(spark):
    from pathlib import Path

    from logloom.llm import common
    folder = Path(common.shared_dir(spark).removeprefix("file:"))
    sent = []
    for n in (128, 512):
        before = set(folder.glob("pairs-*"))
        assert all(x["n_links"] == n - 1 and x["label"]["id"] == 0 for x in near_rows(spark, near_group(n), block=8))
        sent.append(sum(spark.read.parquet(str(p)).count() for p in set(folder.glob("pairs-*")) - before))
    assert sent[1] <= 12 * sent[0]  # 4 ** 1.5 is 8, 4 ** 2 is 16; trees share little


def test_tiles_and_window_bound_lose_no_pair(spark, monkeypatch):
    docs = copies(random.Random(3))
    want = h.near_brute(docs)
    monkeypatch.setattr(near, "WINDOWS", 1000)  # many blocks, as texts are long for it
    assert {r["id"]: (r["label"]["id"], r["n_links"]) for r in near_rows(spark, docs)} == want
    docs = near_group(700)
    assert {x["n_links"] for x in near_rows(spark, docs)} == {699}


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 102), (101, 103)]
    got = dict(components.components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 104)}}


def test_suffix_brute(spark):
    docs = h.docs_of()
    got = [tuple(r) for r in suffixes.op6_suffix_dedup(spark, h.SF).collect()]
    assert sorted(got) == sorted(h.suffix_brute(docs))


def test_suffix_edges(spark):
    from pyspark.sql import functions as F
    edge = [r for r in h.EDGE if r[1] is None or len(r[1]) < 10_000]
    df = spark.createDataFrame(edge, h.EDGE_SCHEMA).withColumn("uid", F.lit(1)).withColumn("docs", F.lit("x"))
    got = suffixes.remove_repeats(df).withColumn("kept", F.sha2("kept", 256)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(h.suffix_brute([r[:2] for r in edge]), key=repr)
    assert suffixes.remove_repeats(h.empty(spark)).count() == 0


def test_suffix_random_small_alphabet(spark):
    r = random.Random(8)
    parts = ["".join(r.choice("abé \n") for _ in range(r.randrange(20, 90))) for _ in range(25)]
    docs = [(i // 2, "".join(r.choice(parts) for _ in range(r.randrange(6)))) for i in range(120)]
    from pyspark.sql import functions as F
    got = suffixes.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).withColumn("kept", F.sha2("kept", 256))
    assert sorted(map(tuple, got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect())) == sorted(h.suffix_brute(docs))


def test_suffix_anchor_alone_sends_no_range(spark):
    from pathlib import Path

    from pyspark.sql import functions as F

    from logloom.llm import common
    r = random.Random(5)
    some = lambda n: "".join(r.choice("abcdefghij") for _ in range(n))
    phrase, shared = some(30), some(51)
    docs = [(i, some(40) + phrase + some(40)) for i in range(200)]
    docs += [(300 + i, some(5 * i) + shared[:49 + i] + "#" + some(60)) for i in range(3)]  # 49, 50 and 51 bytes
    docs += [(400 + i, some(60) + "#" + shared[-49 - i:] + some(7 * i)) for i in range(3)]
    folder = Path(common.shared_dir(spark).removeprefix("file:"))
    before = set(folder.glob("ends-*"))
    got = suffixes.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).withColumn("kept", F.sha2("kept", 256))
    assert sorted(map(tuple, got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect())) == sorted(h.suffix_brute(docs))
    new, = set(folder.glob("ends-*")) - before
    sent = [x for row in spark.read.parquet(str(new)).where("bucket >= 0").collect() for x in suffixes._unpack(row["ranges"])["doc"].to_pylist()]
    assert sent and min(sent) >= 300  # the phrase makes common anchors, but is too short for a common string


def test_suffixes_of_a_repeated_text_are_indexed_once(monkeypatch):
    import numpy as np
    import pyarrow as pa
    added, add = [], suffixes.Levels.add
    monkeypatch.setattr(suffixes.Levels, "add", lambda self, s, d: added.append(len(s)) or add(self, s, d))
    rows = [suffixes._pack(p=np.array(p, dtype=np.uint32), doc=np.array(doc), text=pa.array(text, pa.binary()))
            for p, doc, text in (([0, 9, 40], [4, 4, 4], [b"abcd", b"abcd", b"bcde"]), ([7], [6], [b"xbcd"]))]
    got = suffixes._index(3)(pa.table({"uid": [1, 2], "ranges": pa.array(rows, pa.binary())}))
    assert [suffixes._numbers(x)["p"].tolist() for x in got.column("ranges").to_pylist()] == [[], [8]]
    assert sum(added) == 6  # of eight: the document's second "abcd" is its first


def test_levels_merge_geometrically():
    import numpy as np
    index, r = suffixes.Levels(), np.random.default_rng(1)
    first: dict = {}
    for doc in range(40):
        s = r.integers(0, 500, 64).astype("S4")
        seen = index.add(s, np.full(64, doc))
        assert seen.tolist() == [x in first for x in s.tolist()]
        for x in s.tolist():
            first.setdefault(x, doc)
        sizes = [len(k) for k, _ in index.levels]
        assert all(a > 2 * b for a, b in zip(sizes, sizes[1:]))


def test_leaks_query_brute(spark):
    con = h.duck()
    items = con.execute("select item_id, text from benchmark").fetchall()
    got = {r["doc_id"]: r for r in decontaminate.op4_decontamination(spark, h.SF).collect()}
    for i, t in h.docs_of():
        want = h.leaked_items(t, items)
        assert {x["item_id"] for x in got[i]["items"] or ()} == want and got[i]["contaminated"] == bool(want)


@pytest.mark.parametrize("filter_bits", [7, 26])  # a full filter and a sparse one
def test_leaks_with_substitutions_and_edges(spark, filter_bits):
    r = random.Random(3)
    items = [(1, " ".join(f"q{i}" for i in range(20))), (2, " ".join(f"z{i}" for i in range(7))), (3, "too short item"),
             (4, None), (None, "Null, item! with (enough) words to be found 1 2 3 4 5"), (5, " ".join(f"q{i}" for i in range(20)))]
    docs = list(h.EDGE)
    for i in range(60):
        t = [f"q{j}" for j in range(20)]
        for _ in range(r.randrange(8)):
            t[r.randrange(20)] = "sub"
        docs.append((100 + i, " ".join(["pad"] * r.randrange(4) + t[r.randrange(6):]), "a"))
    docs += [(200, "a " + items[1][1].upper() + " b", "a"), (201, items[1][1].replace("z3", "x"), "a"), (202, "null item with enough words to be found 1 2 3 4 5", "a")]
    df = spark.createDataFrame(docs, h.EDGE_SCHEMA)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.flag_leaks(df, bench, filter_bits=filter_bits).collect()
    assert len(got) == len(docs)
    plain = [(i, t) for i, t in items if i != 5 and t]
    texts = {d[0]: d[1] for d in docs}
    for row in got:
        if row["doc_id"] is not None and row["doc_id"] >= 100:
            assert {x["item_id"] for x in row["items"] or ()} == h.leaked_items(texts[row["doc_id"]], plain), row
        else:
            assert not row["contaminated"]
    left = decontaminate.remove_leaks(h.edge(spark), bench, filter_bits=filter_bits)
    assert left.count() == len(h.EDGE) and left.columns == h.edge(spark).columns
    assert decontaminate.flag_leaks(h.empty(spark), bench).count() == 0
    assert decontaminate.remove_leaks(h.edge(spark), bench.limit(0)).count() == len(h.EDGE)
