"""Exact substring deduplication by a logarithmic family of suffix arrays.

A byte goes if a string of ``LENGTH`` bytes over it also starts in a document
with a smaller id. Every such string has an anchor, its smallest hash among its
grams of ``GRAM`` bytes, so equal strings have equal anchors at equal offsets.
The strings of an anchor that follow each other form a range, about one for 15
bytes of text, and only ranges are shuffled:

1. Documents are packed into batches, one row each, in a table bucketed by the
   batch's number, so that what later steps find out joins without moving text.
2. Each batch sends its distinct ranges (hashes of the anchor, of the whole
   range and of its bytes next to the anchor, smallest document) to the anchor's
   bucket. The bucket answers, per range, whether an earlier document has the
   same one, and whether another range of its anchor can have a string of it: of
   the bytes around the anchor in a string, half or more lie on one side, so
   that many have to be equal on one side at least. Copies inside a batch are
   sent once, so a passage that many documents share costs a batch one row.
3. First ranges that others can share a string with, the ends of repeated
   passages, are sent with their bytes, once for each document and text. A
   bucket takes them by document, in batches: each gets the
   sorted array of its suffixes (their first ``LENGTH`` bytes), is scanned
   against the levels of the index for suffixes that an earlier document has,
   and becomes a level; levels of equal size are merged, so the index has
   logarithmically many and each suffix is merged logarithmically often.
4. Covered bytes are cut from the batches.

Defined cases: a null text is empty; a null id is larger than all others; rows
with equal ids do not remove from each other; texts under ``LENGTH`` bytes stay
whole; an empty table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c
from . import hashing as hs

LENGTH = 50
GRAM = 20
#: Bytes of text in a batch (up to WIDE with many buckets, so that a batch has
#: ranges enough for each), in a bucket, and bytes hashed together.
BATCH = 2 << 20
WIDE = 8 << 20
BUCKET = 16 << 20
SLICE = 1 << 20
#: Strings whose anchors are found together.
BLOCK = 1 << 14
#: Suffixes in a new level of the index.
LEVEL = 1 << 18
LAST = (1 << 63) - 1
_48 = np.uint64((1 << 48) - 1)
_16 = np.uint64((1 << 16) - 1)
_UPPER, _LOWER = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)


def _pack(**columns) -> bytes:
    batch = pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns.values()], names=list(columns))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(raw: bytes) -> dict:
    table = pa.ipc.open_stream(raw).read_all()
    return {n: table.column(n).combine_chunks() for n in table.column_names}


def _numbers(raw: bytes) -> dict:
    return {k: v.to_numpy(zero_copy_only=False) for k, v in _unpack(raw).items()}


def _batches(least: int):
    """Rows of documents to rows of packed batches of about ``least`` bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, ids, texts, size = TaskContext.get().partitionId(), 0, [], [], 0

        def row():
            raw = _pack(doc_id=pa.array(ids, pa.int64()), text=pa.array(texts, pa.binary()))
            return pa.RecordBatch.from_arrays([pa.array([(part << 32) + number], pa.int64()), pa.array([raw], pa.binary())], names=["uid", "docs"])
        for batch in batches:
            for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                ids.append(i), texts.append(t or b"")
                size += len(texts[-1]) + 1
                if size >= least:
                    yield row()
                    number, ids, texts, size = number + 1, [], [], 0
        if ids:
            yield row()
    return run


def _anchors(data: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Where the anchor of each string of ``data`` begins: the first of the
    grams in it with the smallest (upper half of the) hash. Block by block, so
    that the steps between stay in the processor's cache."""
    width, out = length - gram + 1, np.empty(len(data) - length + 1, dtype=np.int32)
    powers, inverse = hs.powers(hs.P, BLOCK + length), hs.powers(hs.P_INVERSE, BLOCK + length)
    place = np.arange(BLOCK + width, dtype=np.uint64)
    for lo in range(0, len(out), BLOCK):
        part = data[lo:lo + BLOCK + length - 1]
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum((part + np.uint64(1)) * powers[:len(part)], out=sums[1:])
        n = len(part) - gram + 1
        low = hs.mix((sums[gram:] - sums[:-gram]) * inverse[:n])
        low &= _UPPER
        low |= place[:n]
        span = 1
        while span < width:
            step = min(span, width - span)
            low = np.minimum(low[:-step], low[step:])
            span += step
        out[lo:lo + BLOCK] = (low & _LOWER).astype(np.int32) + lo
    return out


class _Text:
    """A batch's texts one after the other, each followed by a zero byte."""

    def __init__(self, raw: bytes):
        docs = _unpack(raw)
        self.ids = docs["doc_id"]
        self.texts = docs["text"].to_pylist()
        self.order = self.ids.fill_null(LAST).to_numpy(zero_copy_only=False)
        self.data = np.frombuffer(b"\0".join([*self.texts, b""]), dtype=np.uint8)
        self.sizes = np.array([len(t) for t in self.texts], dtype=np.int64)
        self.ends = np.cumsum(self.sizes + 1) - 1

    def ranges(self, length: int, gram: int):
        """Start, count of strings, anchor's hash, range's hash, hashes of the
        bytes left and right of the anchor (0 where a range has fewer than a
        string must have on one side), document."""
        width, found = length - gram + 1, []
        half = width // 2
        # where a string starts: not at the last bytes of a text
        several = np.maximum(self.sizes - length + 1, 0)
        starts = np.repeat(np.tile([True, False], len(self.sizes)), np.stack((several, self.sizes + 1 - several), axis=1).ravel())
        for lo in range(0, len(self.data), SLICE):
            part = self.data[lo:lo + SLICE + length - 1]
            if len(part) < length:
                break
            sums, anchor = hs.prefix(part), _anchors(part, length, gram)
            at = starts[lo:lo + len(anchor)]
            new = anchor[1:] != anchor[:-1]
            first, last = at.copy(), at.copy()
            first[1:] &= new | ~at[:-1]
            last[:-1] &= new | ~at[1:]
            p = np.flatnonzero(first)
            if not len(p):
                continue
            count, a = np.flatnonzero(last) - p + 1, anchor[p].astype(np.int64)
            grams = hs.mix((sums[a + gram] - sums[a]) * hs.powers(hs.P_INVERSE, len(sums))[a])
            whole = hs.substrings(sums, p, p + count + length - 1) + (a - p).astype(np.uint64)
            stop, beside = p + count + length - 1, []
            for x, y, has in ((a - half, a, a - p >= half), (a + gram, a + gram + half, stop - a - gram >= half)):
                side = np.zeros(len(a), dtype=np.uint64)
                side[has] = np.maximum(hs.substrings(sums, x[has], y[has]) & _16, np.uint64(1))
                beside.append(side)
            found.append((p + lo, count, grams & _48, hs.mix(whole) & _48, *beside))
        if not found:
            z = np.zeros(0, dtype=np.int64)
            return z, z, *[z.astype(np.uint64)] * 4, z
        p, count, h, s, left, right = map(np.concatenate, zip(*found))
        return p, count, h, s, left, right, np.searchsorted(self.ends, p, side="right")

    def classes(self, length: int, gram: int):
        """The ranges with the class of each, and for the classes, sorted:
        anchor, range, bytes beside the anchor, smallest document."""
        p, count, h, s, left, right, doc = self.ranges(length, gram)
        key = hs.mix(h * np.uint64(hs.P) + s)
        by = np.argsort(key)
        new = np.ones(len(key), dtype=bool)
        new[1:] = key[by[1:]] != key[by[:-1]]
        at, order = np.flatnonzero(new), self.order[doc]
        one, which = by[at], np.empty(len(key), dtype=np.int64)
        which[by] = np.cumsum(new) - 1
        least = np.minimum.reduceat(order[by], at) if len(at) else order
        return p, count, order, which, h[one], s[one], left[one], right[one], least


def _describe(length: int, gram: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uid, raw in zip(batch.column("uid").to_pylist(), batch.column("docs").to_pylist()):
                _, _, _, _, h, s, left, right, least = _Text(raw).classes(length, gram)
                order, cut = _dealt(h, least, buckets)
                local = np.ones(len(order), dtype=np.int64)  # whether a document is new in its bucket, then its number there
                local[1:] = least[order[1:]] != least[order[:-1]]
                local[cut[:-1][np.diff(cut) > 0]] = 1
                ids, at = least[order[local > 0]], np.concatenate(([0], np.cumsum(local)))
                columns = [_low(x[order], k) for x, k in ((h, 6), (s, 6), (left, 2), (right, 2))]
                rows = []
                for b in np.flatnonzero(np.diff(cut)).tolist():  # buckets that the batch has ranges for
                    lo, hi = cut[b], cut[b + 1]
                    few = at[hi] - at[lo] < 65536
                    rows.append((b, *(x[lo:hi].tobytes() for x in columns), ids[at[lo]:at[hi]].tobytes(),
                                 (at[lo + 1:hi + 1] - at[lo] - 1).astype(np.uint16 if few else np.uint32).tobytes()))
                b, *sent = zip(*rows) if rows else ((),) * 7
                yield pa.RecordBatch.from_arrays(
                    [pa.array(b, pa.int32()), pa.array([uid] * len(rows), pa.int64()), *(pa.array(x, pa.binary()) for x in sent)],
                    names=["bucket", "uid", "h", "s", "left", "right", "ids", "row"])
    return run


def _dealt(h: np.ndarray, least: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The classes in order of their anchor's bucket and smallest document, and
    where each bucket begins."""
    bucket = (h % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((least, bucket))
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _low(x: np.ndarray, k: int) -> np.ndarray:
    """The low ``k`` bytes of each number."""
    return x.view(np.uint8).reshape(-1, 8)[:, :k]


def _eight(raw: bytes, k: int) -> np.ndarray:
    out = np.zeros((len(raw) // k, 8), dtype=np.uint8)
    out[:, :k] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, k)
    return out.reshape(-1).view(np.uint64)


def _shared(key: np.ndarray) -> np.ndarray:
    """Which numbers occur more than once?"""
    order = np.argsort(key)
    again = np.zeros(len(key) + 1, dtype=bool)
    again[1:-1] = key[order[1:]] == key[order[:-1]]
    out = np.empty(len(key), dtype=bool)
    out[order] = again[1:] | again[:-1]
    return out


def _answer(group: pa.Table) -> pa.Table:
    """For each range sent: 1 if an earlier document has it, plus 2 if another
    range of its anchor has the same bytes on a side of it."""
    h, s, left, right = (np.concatenate([_eight(x, k) for x in group.column(n).to_pylist()])
                         for n, k in (("h", 6), ("s", 6), ("left", 2), ("right", 2)))
    doc = np.concatenate([np.frombuffer(ids, dtype=np.int64)[np.frombuffer(row, dtype=np.uint16 if len(ids) < 8 * 65536 else np.uint32)]
                          for ids, row in zip(group.column("ids").to_pylist(), group.column("row").to_pylist())])
    cut = np.cumsum([len(x) // 6 for x in group.column("h").to_pylist()])[:-1]
    order = np.lexsort((s, h))
    hh, ss, dd = h[order], s[order], doc[order]
    new_h = np.ones(len(h), dtype=bool)
    new_h[1:] = hh[1:] != hh[:-1]
    new_s = new_h.copy()
    new_s[1:] |= ss[1:] != ss[:-1]
    at = np.flatnonzero(new_s)
    anchor, which = np.cumsum(new_h)[at] - 1, np.cumsum(new_s) - 1
    share = np.zeros(len(at), dtype=bool)
    some = np.flatnonzero(np.bincount(anchor)[anchor] > 1) if len(at) else at
    for side in (left, right):
        beside = side[order[at[some]]]
        share[some] |= _shared((anchor[some].astype(np.uint64) << np.uint64(16)) | beside) & (beside > 0)
    code = np.empty(len(h), dtype=np.uint8)
    if len(at):
        code[order] = (np.minimum.reduceat(dd, at)[which] < dd) + 2 * share[which]
    return pa.table({"uid": group.column("uid"), "bucket": group.column("bucket"),
                     "codes": pa.array([x.tobytes() for x in np.split(code, cut)], pa.binary())})


def _ends(length: int, gram: int, buckets: int):
    """Covered ranges of each batch (bucket -1), and the ranges to compare."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uid, raw, answers in zip(*(batch.column(x).to_pylist() for x in ("uid", "docs", "answers"))):
                text = _Text(raw)
                p, count, order, which, h, _, _, _, least = text.classes(length, gram)
                by, _ = _dealt(h, least, buckets)
                code = np.zeros(len(h), dtype=np.uint8)
                if len(h):
                    code[by] = np.frombuffer(b"".join(a["codes"] for a in sorted(answers, key=lambda a: a["bucket"])), dtype=np.uint8)
                gone = (code[which] & 1).astype(bool) | (order > least[which])
                out_bucket, out = [-1], [_pack(p=p[gone].astype(np.uint32), n=(count[gone] + length - 1).astype(np.uint16))]
                ask = np.flatnonzero(~gone & (code[which] == 2))
                bucket = (h % np.uint64(buckets)).astype(np.int64)
                ask = ask[np.argsort(bucket[which[ask]], kind="stable")]
                cut = np.searchsorted(bucket[which[ask]], np.arange(buckets + 1))
                flat = text.data.tobytes()
                for b in np.flatnonzero(np.diff(cut)):
                    at = ask[cut[b]:cut[b + 1]]
                    out_bucket.append(int(b))
                    out.append(_pack(p=p[at].astype(np.uint32), doc=order[at], text=pa.array(
                        [flat[x:x + n] for x, n in zip(p[at].tolist(), (count[at] + length - 1).tolist())], pa.binary())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out_bucket, pa.int32()), pa.array([uid] * len(out), pa.int64()), pa.array(out, pa.binary())],
                    names=["bucket", "uid", "ranges"])
    return run


class Levels:
    """Sorted arrays of suffixes with the smallest document of each."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    @staticmethod
    def _merged(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two sorted arrays as one, a suffix of both with the smaller document."""
        at = np.searchsorted(a, b)
        twice = a[np.minimum(at, len(a) - 1)] == b
        x[at[twice]] = np.minimum(x[at[twice]], y[twice])
        new = at[~twice] + np.arange(len(b) - np.count_nonzero(twice))
        old = np.ones(len(a) + len(new), dtype=bool)
        old[new] = False
        keys, docs = np.empty(len(old), dtype=a.dtype), np.empty(len(old), dtype=x.dtype)
        keys[new], keys[old], docs[new], docs[old] = b[~twice], a, y[~twice], x
        return keys, docs

    def add(self, suffix: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Add a batch; which of its suffixes start in an earlier document,
        of this batch or one before?"""
        order = np.argsort(suffix, kind="stable")
        keys = suffix[order]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = keys[1:] != keys[:-1]
        at = np.flatnonzero(new)
        keys, docs = keys[at], np.minimum.reduceat(doc[order], at)
        least = docs.copy()
        for have, theirs in self.levels:  # sorted keys are looked up in order
            place = np.minimum(np.searchsorted(have, keys), len(have) - 1)
            least = np.where(have[place] == keys, np.minimum(least, theirs[place]), least)
        seen = np.empty(len(suffix), dtype=bool)
        seen[order] = least[np.cumsum(new) - 1] < doc[order]
        self.levels.append((keys, docs))
        while len(self.levels) > 1 and len(self.levels[-2][0]) <= 2 * len(self.levels[-1][0]):
            b, a = self.levels.pop(), self.levels.pop()
            self.levels.append(self._merged(*a, *b))
        return seen


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``first``, ``first`` + 1, ... of each, ``count`` numbers."""
    return np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())


def _index(length: int):
    def run(group: pa.Table) -> pa.Table:
        parts = [_unpack(x) for x in group.column("ranges").to_pylist()]
        known: dict = {}  # a document repeats some texts
        own = [np.array([known.setdefault(k, len(known)) for k in zip(x["doc"].to_pylist(), x["text"].to_pylist())], dtype=np.int64) for x in parts]
        texts = [t for _, t in known]
        doc = np.fromiter((d for d, _ in known), dtype=np.int64, count=len(known))
        count = np.array([len(t) - length + 1 for t in texts], dtype=np.int64)
        first = np.cumsum(count) - count
        order = np.argsort(doc, kind="stable")
        ends = np.cumsum(count[order])
        seen = np.zeros(count.sum(), dtype=bool)
        index, lo = Levels(), 0
        while lo < len(order):
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + LEVEL)))
            rows = order[lo:hi]
            data = np.frombuffer(b"".join([texts[i] for i in rows]), dtype=np.uint8)
            size = count[rows] + length - 1
            at = _spread(np.cumsum(size) - size, count[rows])
            # every suffix has exactly this many bytes, so equal means equal bytes
            suffix = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, length)[at]).view(f"S{length}").ravel()
            seen[_spread(first[rows], count[rows])] = index.add(suffix, np.repeat(doc[rows], count[rows]))
            lo = hi
        out = []
        for x, i in zip(parts, own):
            at = _spread(x["p"].to_numpy().astype(np.int64), count[i])[seen[_spread(first[i], count[i])]]
            out.append(_pack(p=at.astype(np.uint32), n=np.full(len(at), length, dtype=np.uint16)))
        return pa.table({"uid": group.column("uid"), "ranges": pa.array(out, pa.binary())})
    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for raw, covers in zip(batch.column("docs").to_pylist(), batch.column("covers").to_pylist()):
            text = _Text(raw)
            edge = np.zeros(len(text.data) + 1, dtype=np.int64)
            for cover in covers or ():
                x = _numbers(cover)
                p = x["p"].astype(np.int64)
                np.add.at(edge, p, 1)
                np.add.at(edge, p + x["n"], -1)
            gone = np.cumsum(edge)[:-1] > 0
            start, _ = hs.runs(gone)
            spans = np.bincount(np.searchsorted(text.ends, start, side="right"), minlength=len(text.texts))
            begin = text.ends - text.sizes
            total = np.concatenate(([0], np.cumsum(gone)))
            kept = [text.data[a:z][~gone[a:z]].tobytes() for a, z in zip(begin, text.ends)]
            yield pa.RecordBatch.from_arrays(
                [text.ids, pa.array(kept, pa.binary()), pa.array(text.sizes), pa.array(total[text.ends] - total[begin]), pa.array(spans)],
                names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id``, ``kept`` (the remaining bytes), ``n_bytes``, ``n_removed``
    and ``n_spans`` (maximal removed runs) of each row."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets = max(8, -(-size // BUCKET))
    name = f"batches_{uuid.uuid4().hex}"
    least = min(WIDE, max(BATCH, 8192 * buckets))
    rows.mapInArrow(_batches(least), "uid bigint, docs binary").write.bucketBy(buckets, "uid").option(
        "path", f"{c.shared_dir(spark).rstrip('/')}/{name}").option("compression", "none").saveAsTable(name)
    packed = spark.table(name)
    sent = packed.mapInArrow(_describe(length, gram, buckets), "bucket int, uid bigint, h binary, s binary, left binary, right binary, ids binary, row binary")
    told = sent.groupBy("bucket").applyInArrow(_answer, "uid bigint, bucket int, codes binary")
    told = c.stage(told.groupBy("uid").agg(F.collect_list(F.struct("bucket", "codes")).alias("answers")), "answers")
    ends = c.stage(packed.join(told, "uid").mapInArrow(_ends(length, gram, buckets), "bucket int, uid bigint, ranges binary"), "ends")
    found = ends.where("bucket >= 0").groupBy("bucket").applyInArrow(_index(length), "uid bigint, ranges binary")
    covers = found.unionByName(ends.where("bucket < 0").select("uid", "ranges")).groupBy("uid").agg(F.collect_list("ranges").alias("covers"))
    return packed.join(covers, "uid", "left").mapInArrow(
        _cut, "doc_id bigint, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(c.table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
