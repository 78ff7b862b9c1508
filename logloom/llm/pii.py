"""Personal data: base patterns, and candidates scored by boosted trees.

The base finds email addresses, IPv4 addresses, card and phone numbers by fixed
patterns with checks; its spans always stay. Wider generators propose further,
overlapping spans: addresses written with ``at`` and ``dot``, and every run of
neighbouring digit groups, with any usual separators, whose digits fit a kind,
so that numbers side by side are proposed one by one too. Gradient boosted trees score them by format (digits,
groups, separators, checksum, ...) and by context (the words before, what the
span touches). The trees learn from base spans, from base spans rewritten in
the wider forms (plus sign or separators changed, ``@`` spelled out) and from
the candidates that are no base span (but for those that pass the base's check
alone and are written like a base span), over a bounded sample: of each kind
and label (candidate, base span, rewritten) all rows up to a quarter of
``SAMPLE``, and beyond that about as many, chosen by a hash; so a rare kind
keeps its rows whatever else the table holds. A threshold for each kind is set
on the held-out third of the sample, each row weighted by the rows it stands for, so that ``PRECISION`` of what it selects
there is right; selected spans that overlap a base span or a better one (of
equals, a longer one) go. The texts are read three times: to count, to sample
and to select, so nothing but the sample is kept.

Defined cases: a null text is empty; a null id stays null; repeated rows get
one result each; without a positive candidate in the sample nothing is added;
an empty table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c
from .trees import Boosted, predict, threshold

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 20_000
PRECISION = 0.95
#: Candidates scored, or rows sent on, together.
CHUNK = 4096
CONTEXT = {
    "email": ("mail", "email", "e-mail", "contact", "write", "reach"),
    "ip": ("ip", "server", "host", "address", "client", "ping", "from"),
    "card": ("card", "visa", "mastercard", "credit", "debit", "payment", "cc"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "cell", "number", "dial"),
}

# A match can only begin at the first digit of a run, so looking behind changes no result.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
_DIGITS = re.compile(r"[+(]{0,2}[0-9](?:[\x20().:/-]{0,3}[0-9]){6,}")
_GROUP = re.compile(r"[0-9]+")
_QUAD = re.compile(r"[0-9]+(?:[.:][0-9]+){3}")
_SIGN = re.compile(r"@|at", re.I)
_DOT = r"(?:\.|\s*+[\[({]\s*+dot\s*+[\])}]\s*+|\s++dot\s++)"
_NAME = re.compile(rf"[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)+", re.I)
_MAYBE = re.compile(r"@|[\[({]\s*+at\s*+[\])}]|\sdot\s|[\[({]\s*+dot\s*+[\])}]", re.I)
_BLANKS = re.compile(r"\s*")


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _only_digits(s: str) -> str:
    return "".join(ch for ch in s if "0" <= ch <= "9")


def _local_start(text: str, at: int, least: int) -> int:
    """Start of the run of address characters that ends at ``at``."""
    lo = at
    while lo > least and not _NOT_LOCAL.match(text, lo - 1):
        lo -= 1
    return lo


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end), by kind and start."""
    out, last = [], 0
    at = text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at)
        lo = _local_start(text, at, last)
        if m and lo < at:
            out.append((0, lo, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _only_digits(m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_only_digits(m.group())) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def candidates(text: str) -> Iterator[tuple[int, int, int]]:
    """Proposals of the wider generators; a run of digit groups may have two
    kinds. Runs end with their 19th digit, so there are no more than 19 for a
    group."""
    for m in _DIGITS.finditer(text):
        groups = [g.span() for g in _GROUP.finditer(text, m.start(), m.end())]
        for i, (a, _) in enumerate(groups):
            lo = a if i else m.start()
            while i and lo > groups[i - 1][1] and text[lo - 1] == "(":
                lo -= 1
            n = 0
            for j in range(i, len(groups)):
                z = groups[j][1]
                n += z - groups[j][0]
                if j == i + 3 and _QUAD.fullmatch(text, a, z):
                    yield 1, a, z
                if 13 <= n <= 19:
                    yield 2, a, z
                if 7 <= n <= 15:
                    yield 3, lo, z
                if n > 19 and j >= i + 3:
                    break
    if _MAYBE.search(text):
        yield from _addresses(text)


def _before(text: str, at: int) -> int:
    """Start of the blanks that end at ``at``."""
    while at and text[at - 1].isspace():
        at -= 1
    return at


def _addresses(text: str) -> Iterator[tuple[int, int, int]]:
    """Addresses around each sign: ``@``, ``[at]`` in any brackets, or the word
    ``at``, blanks around it. Blanks are looked at from the sign only, so a run
    of them is read by its two neighbours at most."""
    last = 0
    for m in _SIGN.finditer(text):
        a, z = m.span()
        if a < last:
            continue
        lo, hi = _before(text, a), _BLANKS.match(text, z).end()
        if m.group() != "@":
            if lo and text[lo - 1] in "[({" and text[hi:hi + 1] in tuple("])}"):
                lo, hi = _before(text, lo - 1), _BLANKS.match(text, hi + 1).end()
            elif lo == a or hi == z:
                continue
        lo = max(lo, last)
        name = _NAME.match(text, hi)
        start = _local_start(text, lo, 0) if name else lo
        if name:
            last = name.end()
        if start < lo:
            yield 0, start, name.end()


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    s = text[start:end]
    groups = [len(g) for g in re.findall(r"[0-9]+", s)] or [0]
    digits = _only_digits(s)
    before = text[max(0, start - 60):start].lower()
    words = set(re.findall(r"[a-z-]+", before)[-5:])
    sep = [s.count(ch) for ch in " -./:("]
    tail = re.split(r"[^A-Za-z]+", s)[-1]
    return [
        *(float(kind == k) for k in range(4)), len(digits), len(groups), max(groups), min(groups), *sep,
        float("+" in s[:3]), float(bool(digits) and luhn(digits)), float(groups[-1]),
        float(sum(p.isdigit() and int(p) <= 255 for p in s.split(".")[:8])),
        float("@" in s), float(bool(re.search(r"\bat\b", s, re.I))), float(bool(re.search(r"\bdot\b", s, re.I))),
        float(bool(re.search(r"[\[({]", s))), float(len(tail)), float(tail.islower()), float("\n" in s),
        *(float(bool(words & set(CONTEXT[k]))) for k in KINDS),
        float(start > 0 and text[start - 1].isalnum()), float(end < len(text) and text[end].isalnum()),
        float(before[-1:] in ("$", "#", "=", "/")),
    ]


def rewritten(kind: int, s: str) -> list[str]:
    """A base span in wider forms of its kind."""
    if kind == 0:
        name, _, domain = s.partition("@")
        return [f"{name} at {domain.replace('.', ' dot ')}", f"{name}[at]{domain.replace('.', '[dot]')}", f"{name} (at) {domain}"]
    if kind == 2:
        d = _only_digits(s)
        return [".".join(d[i:i + 4] for i in range(0, len(d), 4))]
    if kind == 3:
        return [s[1:], re.sub(r"[ ()]+", "-", s[1:]).strip("-"), re.sub(r"[ ()-]+", ".", s[1:]).strip(".")]
    return []


def shape(s: str) -> str:
    """Digits as 9, runs of letters as a."""
    return re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]", "9", s))


def labelled(text: str) -> Iterator[tuple[int, int, int, int, str]]:
    """(kind, start, end, label, form) for training: candidates with label 1
    (a base span) or 0, and with label 2 base spans in a wider form."""
    found = base_spans(text)
    known, taken = set(found), c.Spans((a, z) for _, a, z in found)
    for k, a, z in candidates(text):
        if (k, a, z) in known:
            yield k, a, z, 1, text[a:z]
        elif not taken.meets(a, z):
            yield k, a, z, 0, text[a:z]
    for k, a, z in found:
        for form in rewritten(k, text[a:z]):
            yield k, a, z, 2, form


_SPAN = "array<struct<kind:int,start:int,end:int>>"
_ROW = pa.schema([("kind", pa.int32()), ("label", pa.int32()), ("shape", pa.string()), ("alone", pa.bool_()), ("x", pa.list_(pa.float64())), ("hash", pa.int64())])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = Counter((k, label) for text in batch.column("text").to_pylist() for k, _, _, label, _ in labelled(text or ""))
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in n], pa.int32()), pa.array([x for _, x in n], pa.int32()), pa.array(list(n.values()), pa.int64())],
            names=["kind", "label", "n"])


def _rows(shares: dict[tuple[int, int], float]):
    """Rows for training, those whose hash falls under the share."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for batch in batches:
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                text = text or ""
                for k, a, z, label, form in labelled(text):
                    h = int.from_bytes(hashlib.blake2b(f"{i} {a} {k} {label} {form}".encode(errors="surrogatepass"), digest_size=8).digest()) >> 1
                    if h % (1 << 30) >= shares.get((k, label), 0) * (1 << 30):
                        continue
                    near = text[max(0, a - 60):a]
                    x = features(near + form + text[z:z + 1], k, len(near), len(near) + len(form)) if label == 2 else features(text, k, a, z)
                    out.append({"kind": k, "label": label, "shape": shape(form), "alone": base_spans(form) == [(k, 0, len(form))], "x": x, "hash": h >> 30})
                    if len(out) >= CHUNK:
                        yield pa.RecordBatch.from_pylist(out, _ROW)
                        out = []
        yield pa.RecordBatch.from_pylist(out, _ROW)
    return run


def _train(docs: DataFrame, sample: int, precision: float):
    """Trees (plain arrays) and a threshold for each kind, from the bounded sample."""
    counts = {(r["kind"], r["label"]): r["n"] for r in docs.mapInArrow(_count, "kind int, label int, n bigint").groupBy("kind", "label").agg(F.sum("n").alias("n")).collect()}
    shares = {x: min(1.0, sample / 4 / n) for x, n in counts.items()}
    got = docs.mapInArrow(_rows(shares), "kind int, label int, shape string, alone boolean, x array<double>, hash bigint").limit(6 * sample).collect()
    got.sort(key=lambda r: (r["hash"], r["label"], r["kind"]))
    open_ = {r["shape"] for r in got if r["label"] == 2}
    plain = {(r["kind"], r["shape"]) for r in got if r["label"] == 1}
    got = [r for r in got if r["label"] or r["shape"] not in open_ and not (r["alone"] and (r["kind"], r["shape"]) in plain)]
    kind = np.array([r["kind"] for r in got])
    y = np.array([r["label"] > 0 for r in got], dtype=float)
    if not y.any():
        return None, [1.01] * len(KINDS)
    x = np.array([r["x"] for r in got], dtype=float)
    held = np.array([r["hash"] % 3 == 0 for r in got])
    if not held.any() or not y[~held].any():
        return None, [1.01] * len(KINDS)
    model = Boosted(x[~held], y[~held])
    score = model.score(x[held])
    weight = np.array([1 / shares[r["kind"], r["label"]] for r in got])[held]
    own = [kind[held] == k for k in range(len(KINDS))]
    return model.plain(), [threshold(score[at], y[held][at], precision, weight[at]) for at in own]


def _select(trained):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, least = trained.value
        span = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
        plain = lambda spans: pa.array([[dict(zip(("kind", "start", "end"), s)) for s in own] for own in spans], span)
        for batch in batches:
            base, good, open_, x = [], [], [], []

            def score():
                for p, (i, k, a, z) in zip(predict(model, np.array(x, dtype=float)) if x else (), open_):
                    if p >= least[k]:
                        good[i].append((-p, a - z, a, k))
                open_.clear(), x.clear()

            for i, text in enumerate(batch.column("text").to_pylist()):
                base.append(base_spans(text or "")), good.append([])
                taken = c.Spans((a, z) for _, a, z in base[-1])
                for k, a, z in candidates(text or "") if model else ():
                    if not taken.meets(a, z):
                        open_.append((i, k, a, z)), x.append(features(text, k, a, z))
                        if len(x) >= CHUNK:
                            score()
            score()
            out = []
            for own, more in zip(base, good):
                taken, spans = c.Spans((a, z) for _, a, z in own), list(own)
                for _, size, a, k in sorted(more):
                    if not taken.meets(a, a - size):
                        taken.add(a, a - size)
                        spans.append((k, a, a - size))
                out.append(sorted(spans))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), plain(base), plain(out)], names=["doc_id", "base", "spans"])
    return run


def find_personal_data(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", sample: int = SAMPLE,
                       precision: float = PRECISION) -> DataFrame:
    """``doc_id``, ``base`` and ``spans`` (all) of each row: arrays of
    (kind number, start, end), by kind and start, in code points."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    trained = docs.sparkSession.sparkContext.broadcast(_train(rows, sample, precision))
    return rows.mapInArrow(_select(trained), f"doc_id bigint, base {_SPAN}, spans {_SPAN}")


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(c.table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = F.array(*map(F.lit, KINDS))
    joined = lambda col: F.array_join(F.transform(col, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    of = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    count = [of(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *count, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
