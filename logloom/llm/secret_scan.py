"""Secret scan: wide candidates, false positives removed by a random forest.

Generators propose the values of assignments to secret-like names, tokens of
known issuers and any long token of mixed characters. A random forest scores
them by length, character classes and transitions between them, entropy, cover
by a dictionary, the document's path and the neighbouring words.

The dictionary is the set of character trigrams that the words of ordinary
text have, counted over all documents: those on five places or more and on at
least the share ``RARE`` of all places, so never over 1 / ``RARE`` trigrams.
The forest is trained from labelled findings. With ``findings`` (doc_id, start,
end, label) those are used; without, candidates are labelled by strict rules:
issuer formats and random-looking assigned values are secrets, and so, as a
training row of the token kind, is each of them that is a token without its
context; placeholders, UUIDs, paths, plain numbers and words of the dictionary
are not; others are not used. About ``SAMPLE`` findings of each label at most, chosen by a hash,
are taken. The threshold is set on a held-out third.

Defined cases: a null text is empty; a null path is an empty one; without both
labels in the sample, or with too few held-out rows to show the precision, the
strict rules decide alone; repeated rows get one
result each; an empty table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c
from .trees import Forest, predict, threshold

SAMPLE = 10_000
RARE = 2e-7
PRECISION = 0.95
KINDS = ("assigned", "issued", "token")

NAMES = "password passwd pwd passphrase secret token apikey api_key api-key access_key access-key private_key auth credential bearer"
_ASSIGNED = re.compile(rf"(?i)(?:{NAMES.replace(' ', '|')})[\w.-]{{0,20}}[\"']?(?:\s*(?::=|=>|[=:])\s*|\s+)[\"'`]?([^\s\"'`,;<>()\[\]{{}}]{{6,}})")
#: Public formats of issued tokens.
_ISSUED = re.compile(
    r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[0-9A-Z]{16}(?![0-9A-Za-z])|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}"
    r"|sk_(?:live|test)_[A-Za-z0-9]{16,}|AIza[0-9A-Za-z_-]{35}|glpat-[A-Za-z0-9_-]{20,}"
    r"|eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})"
    r"|-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+(?:-----END [A-Z ]*PRIVATE KEY-----)?")
_TOKEN = re.compile(r"[A-Za-z0-9+/_=.-]{16,}")
_UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
_PLACE = re.compile(r"(?i)example|sample|dummy|changeme|placeholder|your[_-]|xxxx|\*\*\*\*|\.\.\.|12345|(.)\1{5,}")
_PATHY = re.compile(r"(?i)(?:test|example|fixture|doc|mock|sample)")


def entropy(s: str) -> float:
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values()) if s else 0.0


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end); each place once, by the first generator that has it."""
    found: dict[tuple[int, int], int] = {}
    for m in _ISSUED.finditer(text):
        found.setdefault(m.span(), 1)
    for m in _ASSIGNED.finditer(text):
        found.setdefault(m.span(1), 0)
    for m in _TOKEN.finditer(text):
        s = m.group()
        if any(ch.isdigit() for ch in s) and any(ch.isalpha() for ch in s) and m.span() not in found:
            found[m.span()] = 2
    out: list[tuple[int, int, int]] = []
    taken = c.Spans()
    for (a, z), k in sorted(found.items(), key=lambda x: (x[1] != 1, x[1], x[0])):
        if not taken.meets(a, z):
            taken.add(a, z)
            out.append((k, a, z))
    return sorted(out, key=lambda x: x[1])


def cover(s: str, trigrams: frozenset) -> float:
    """Share of the trigrams of letters that are the dictionary's."""
    grams = [s[i:i + 3].lower() for i in range(len(s) - 2) if s[i:i + 3].isalpha()]
    return (sum(g in trigrams for g in grams) / len(grams)) if grams else 0.0


def strict(kind: int, s: str, trigrams: frozenset) -> int:
    """1 secret, 0 not, -1 undecided."""
    if kind == 1:
        return 1
    letters = sum(ch.isalpha() for ch in s)
    if _PLACE.search(s) or _UUID.fullmatch(s) or s.isdigit() or s.count("/") >= 3 or letters == len(s) or len(s) > 12 and letters > 0.8 * len(s) and cover(s, trigrams) > 0.8:
        return 0
    if kind == 0 and len(s) >= 12 and entropy(s) >= 3.0 and any(ch.isdigit() for ch in s):
        return 1
    return 0 if kind == 2 and entropy(s) < 2.5 else -1


def features(text: str, kind: int, start: int, end: int, path: str, trigrams: frozenset) -> list[float]:
    s = text[start:end]
    group = ["d" if ch.isdigit() else "u" if ch.isupper() else "l" if ch.islower() else "s" for ch in s]
    n = len(s)
    moves = Counter(zip(group, group[1:]))
    before, after = text[max(0, start - 40):start].lower(), text[end:end + 20].lower()
    named = any(x in before for x in NAMES.split(" "))
    return [
        *(float(kind == k) for k in range(3)), float(n), entropy(s), *(group.count(g) / n for g in "duls"),
        *(moves[a, b] / n for a in "dul" for b in "dul"), float(len(set(s))) / n,
        cover(s, trigrams), float(all(ch in "0123456789abcdef" for ch in s)), float(n in (20, 32, 36, 40, 64)),
        float(named), float(before[-1:] in ("=", ":", '"', "'")), float(before.rstrip("\"' ")[-1:] in ("=", ":")),
        float(after[:1] in ("\"", "'")), float("http" in before or "://" in s), float(bool(_PLACE.search(s))),
        float(bool(_PATHY.search(path))), float(path.count("/")), float(s.count("/") + s.count(".")),
    ]


_FOUND = "array<struct<kind:int,start:int,end:int,label:int,x:array<double>>>"
_TYPE = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("label", pa.int32()), ("x", pa.list_(pa.float64()))]))


def _scan(trigrams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = trigrams.value
        for batch in batches:
            out = []
            for text, path in zip(batch.column("text").to_pylist(), batch.column("path").to_pylist()):
                text, path = text or "", path or ""
                rows = []
                for k, a, z in candidates(text):
                    s, label = text[a:z], strict(k, text[a:z], known)
                    rows.append({"kind": k, "start": a, "end": z, "label": label, "x": features(text, k, a, z, path, known)})
                    if label == 1 and _TOKEN.fullmatch(s) and any(ch.isdigit() for ch in s) and any(ch.isalpha() for ch in s):  # label 2: for training only
                        rows.append({"kind": 2, "start": a, "end": z, "label": 2, "x": features(s, 2, 0, len(s), path, known)})
                out.append(rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, _TYPE)], names=["doc_id", "found"])
    return run


def _trigrams(rows: DataFrame) -> frozenset:
    """Trigrams of the words of all documents that are not rare."""
    words = rows.select(F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("w")).where("length(w) >= 3").groupBy("w").count()
    grams = words.select("count", F.explode(F.expr("transform(sequence(1, length(w) - 2), i -> substr(w, i, 3))")).alias("g"))
    grams = c.stage(grams.groupBy("g").agg(F.sum("count").alias("n")), "trigrams")
    total = grams.agg(F.sum("n").alias("n")).first()["n"] or 0
    return frozenset(r["g"] for r in grams.where(F.col("n") >= max(5, total * RARE)).select("g").collect())


def _train(scanned: DataFrame, findings: DataFrame | None, sample: int, precision: float):
    rows = scanned.select("doc_id", F.explode("found").alias("f")).select("doc_id", "f.start", "f.end", "f.label", "f.x")
    if findings is not None:
        known = findings.groupBy("doc_id", "start", "end").agg(F.max("label").cast("int").alias("label"))
        rows = rows.where("label < 2").drop("label").join(known, ["doc_id", "start", "end"])
    rows = rows.withColumn("hash", F.xxhash64("doc_id", "start", "x"))
    got = [r for label in (0, 1, 2) for r in sorted(c.bounded_sample(rows.where(F.col("label") == label), sample, "hash").select(
        "label", "x", "hash").collect(), key=lambda r: r["hash"])]
    y = np.array([r["label"] > 0 for r in got], dtype=float)
    held = np.array([r["hash"] % 3 == 0 for r in got], dtype=bool)
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        return None, 1.01
    x = np.array([r["x"] for r in got], dtype=float)
    model = Forest(x[~held], y[~held])
    least = threshold(model.score(x[held]), y[held], precision)
    return (model.plain() if least <= 1 else None), least


def _decide(trained):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, least = trained.value
        out = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            found = [[f for f in own if f["label"] < 2] for own in batch.column("found").to_pylist()]
            flat = [f for own in found for f in own]
            if model and flat:
                good = predict(model, np.array([f["x"] for f in flat], dtype=float)) >= least
            else:
                good = np.array([f["label"] == 1 for f in flat], dtype=bool)
            it = iter(good)
            kept = [[{"kind": KINDS[f["kind"]], "start": f["start"], "end": f["end"]} for f in own if next(it)] for own in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(own) for own in found], pa.int64()), pa.array([len(k) for k in kept], pa.int64()), pa.array(kept, out)],
                names=["doc_id", "n_candidates", "n_secrets", "secrets"])
    return run


def find_secrets(docs: DataFrame, findings: DataFrame | None = None, text: str = "text", doc_id: str = "doc_id", path: str = "source",
                 sample: int = SAMPLE, precision: float = PRECISION) -> DataFrame:
    """``doc_id, n_candidates, n_secrets, secrets`` (kind, start, end in code
    points, by start) of each row."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.col(f"`{path}`").cast("string").alias("path"))
    context = docs.sparkSession.sparkContext
    trigrams = context.broadcast(_trigrams(rows))
    scanned = c.stage(rows.mapInArrow(_scan(trigrams), f"doc_id bigint, found {_FOUND}"), "findings")
    trained = context.broadcast(_train(scanned, findings, sample, precision))
    return scanned.mapInArrow(_decide(trained), "doc_id bigint, n_candidates bigint, n_secrets bigint, secrets array<struct<kind:string,start:int,end:int>>")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(c.table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
