"""Small tables and plain versions that the operators are held against."""

import collections
import hashlib
import os
import re

import duckdb

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


def duck(sf=SF, **frames):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    for name, frame in frames.items():
        con.register(f"{name}_rows", frame)
        con.execute(f"create or replace view {name} as select * from {name}_rows")
    return con


def rows(frame):
    """Rows of a pandas frame, columns by name, in a canonical order."""
    frame = frame[sorted(frame.columns)].astype(object)
    plain = lambda v: None if v is None or v != v else v
    return sorted((tuple(map(plain, r)) for r in frame.values.tolist()), key=repr)


def docs_of(sf=SF):
    return duck(sf).execute("select doc_id, text from documents order by doc_id").fetchall()


LINE = "one line of plain words that stands in several documents here"
BODY = "\n".join(f"{LINE} number {i} and then some more words to make it long" for i in range(8))
LONG = " ".join(f"word{i * 7919 % 10007}" for i in range(60_000))

#: (doc_id, text, source): nulls, empty and very long texts, ties and repeats.
EDGE = [
    (1, BODY, "a"), (2, BODY, "a"), (2, BODY, "a"), (3, None, None), (4, "", "b"), (5, " \n\t\n ", "b"), (None, BODY, None),
    (None, None, None), (None, BODY, None), (6, LONG, "c"), (7, LONG + " tail", "c"), (8, "short", "a"), (9, "x\x00y é z 漢字", ""),
    (10, BODY.upper(), "a"), (10, "the same id with other words entirely, quite a few of them in fact, yes", "a"),
]
EDGE_SCHEMA = "doc_id long, text string, source string"


def edge(spark, extra=True):
    """The edge table, with extra columns whose names clash with working and output columns."""
    df = spark.createDataFrame(EDGE, EDGE_SCHEMA)
    if extra:
        for i, name in enumerate(("_text", "_words", "kept", "n_words", "id", "dk", "node", "Size", "row", "items", "n_links")):
            df = df.selectExpr("*", f"{i} as `{name}`")
    return df


def empty(spark):
    return edge(spark).limit(0)


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n=5):
    w = WORD.findall(text or "")
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def near_brute(docs, threshold=0.8):
    """{row number: (label row number, links)} for (id, text) rows."""
    sets = [shingles(t) for _, t in docs]
    where = collections.defaultdict(set)
    for i, s in enumerate(sets):
        for g in s:
            where[g].add(i)
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    links = collections.Counter()
    for i, s in enumerate(sets):
        shared = collections.Counter(j for g in s for j in where[g] if j != i)
        for j, k in shared.items():
            if k >= threshold * (len(s) + len(sets[j]) - k) - 1e-9:
                links[i] += 1
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (find(i), links[i]) for i in range(len(docs))}


def suffix_brute(docs, length=50):
    """[(id, n_bytes, n_removed, n_spans, sha256)] for (id, text) rows."""
    key = lambda i: (1 << 63) - 1 if i is None else i
    first = {}
    for i, t in docs:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            g = b[p:p + length]
            first[g] = min(first.get(g, key(i)), key(i))
    out = []
    for i, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < key(i):
                gone[p:p + length] = b"\1" * length
        spans = sum(1 for j, g in enumerate(gone) if g and (j == 0 or not gone[j - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def leaked_items(text, items, window=13, agree=11, short=5):
    tokens = lambda x: re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (x or "").lower())
    own, out = tokens(text), set()
    for item, words in items:
        words = tokens(words)
        w = min(window, len(words))
        if len(words) < short:
            continue
        for d in range(-len(words) + 1, len(own)):
            same = [0 <= d + j < len(own) and own[d + j] == x for j, x in enumerate(words)]
            if sum(same) >= min(agree, w) and any(sum(same[j:j + w]) >= (agree if w == window else w) for j in range(len(words) - w + 1)):
                out.add(item)
                break
    return out
