"""Benchmark decontamination by spaced-seed hashing.

Texts are lower-cased token sequences (runs of ASCII letters and digits and of
any other non-ASCII characters). Each mask looks at six token positions of a
span and ignores the others, so a seed still matches when a token at an ignored
position was substituted. A passage is leaked if ``WINDOW`` tokens in a row of
a benchmark item stand in a document with at least ``AGREE`` of them equal at
their places; with the two masks here every such pair has a seed in common.
Items with fewer tokens, down to ``SHORT``, must occur as a whole; they have a
contiguous seed. Items with fewer than ``SHORT`` tokens are no evidence.

Seeds of benchmark and documents are joined on their hash. The hits name an
item and a diagonal; the document's tokens along the diagonal are compared
with the item's. A Bloom filter of the benchmark's seeds, of fixed size
whatever the benchmark (``FILTER_BITS``), goes to the tasks, which emit only
the seeds that may join; the join decides.

Defined cases: null and empty texts have no tokens and match nothing; repeated
items count once, under the smallest id; a null item id is reported as null;
rows with equal document id and text are judged alike; empty tables give no
match; extra columns pass through in :func:`remove_leaks`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c
from . import hashing as hs

#: Token positions that a mask looks at.
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 3, 6, 7, 8))
SHORT = 5
WINDOW = 13
AGREE = 11
#: Bits of the Bloom filter, as a power of 2: 8 MB on the driver and in each task.
FILTER_BITS = 26
_TOKEN = np.array([i >= 128 or bytes([i]).isalnum() for i in range(256)])


def _tokens(texts: list) -> tuple[np.ndarray, np.ndarray]:
    return hs.words([(t or "").lower().encode() for t in texts], _TOKEN)


def _seeds(hashes: np.ndarray, first: np.ndarray, short: bool | None):
    """(hash, text, place) for all masks. ``short``: True or False for the
    contiguous seed of short texts only, None for all seeds of all texts."""
    count = np.diff(first)
    owner = np.repeat(np.arange(len(count)), count)
    place = np.arange(len(hashes)) - first[:-1][owner]
    for number, mask in enumerate((*MASKS, tuple(range(SHORT)))):
        span = mask[-1] + 1
        ok = place + span <= count[owner]
        if short is not None:
            ok &= (count[owner] < WINDOW) == (number == len(MASKS))
        at = np.flatnonzero(ok)
        value = np.full(len(at), number + 1, dtype=np.uint64)
        for k in mask:
            value = value * np.uint64(hs.P) + hashes[at + k]
        yield hs.mix(value).view(np.int64), owner[at], place[at]


def _bloom(marks: DataFrame, bits: int) -> np.ndarray:
    """Words of a Bloom filter of the seeds, two bits for each. The words are
    put together by the shuffle, so what the driver gets is bounded by the
    filter's size."""
    places = F.explode(F.array(F.col("seed"), F.shiftrightunsigned("seed", 32)))
    at = marks.select(places.alias("s")).select(F.col("s").bitwiseAND(F.lit((1 << bits) - 1)).alias("i"))
    words = at.groupBy(F.shiftright("i", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(i & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.uint64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out


def _maybe(filter_: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether each seed may be in the filter."""
    low, v = np.uint64((len(filter_) << 6) - 1), value.view(np.uint64)
    found = np.ones(len(v), dtype=bool)
    for i in (v & low, (v >> np.uint64(32)) & low):
        found &= (filter_[i >> np.uint64(6)] >> (i & np.uint64(63))) & np.uint64(1) > 0
    return found


def _seeder(keys: list[str], benchmark: bool, known):
    """Seeds of each text; ``known``: a broadcast filter of the wanted ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for lo, hi in hs.chunks([t or "" for t in texts]):
                hashes, first = _tokens(texts[lo:hi])
                for value, owner, place in _seeds(hashes, first, False if benchmark else None):
                    if known is not None:
                        ok = np.flatnonzero(_maybe(known.value, value))
                        value, owner, place = value[ok], owner[ok], place[ok]
                    rows = pa.array(owner + lo)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(k).take(rows) for k in keys] + [pa.array(value), pa.array(place.astype(np.int32))],
                        names=[*keys, "seed", "place"])
    return run


def _itemiser(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        hashes, first = _tokens(texts)
        raw = [hashes[first[i]:first[i + 1]].tobytes() for i in range(len(texts))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("item"), pa.array(raw, pa.binary()), pa.array(np.diff(first).astype(np.int32))],
            names=["item", "tokens", "length"])


def _aligner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The document's tokens along each diagonal, 0 outside the document."""
    for batch in batches:
        texts = batch.column("text").to_pylist()
        hits = batch.column("hits").to_pylist()
        row, item, diagonal, raw = [], [], [], []
        for lo, hi in hs.chunks([t or "" for t in texts]):
            hashes, first = _tokens(texts[lo:hi])
            for i in range(lo, hi):
                own = hashes[first[i - lo]:first[i - lo + 1]]
                for h in hits[i]:
                    d, n = h["diagonal"], h["length"]
                    part = np.zeros(n, dtype=np.uint64)
                    a, z = max(d, 0), min(d + n, len(own))
                    part[a - d:z - d] = own[a:z]
                    row.append(i), item.append(h["item"]), diagonal.append(d), raw.append(part.tobytes())
        rows = pa.array(row, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(k).take(rows) for k in ("no_id", "id", "dk")]
            + [pa.array(item, pa.int64()), pa.array(diagonal, pa.int32()), pa.array(raw, pa.binary())],
            names=["no_id", "id", "dk", "item", "diagonal", "aligned"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose alignment is a leak, with its first and last token."""
    for batch in batches:
        keep, start, end, equal = [], [], [], []
        for i, (a, b) in enumerate(zip(batch.column("aligned").to_pylist(), batch.column("tokens").to_pylist())):
            same = np.frombuffer(a, dtype=np.uint64) == np.frombuffer(b, dtype=np.uint64)
            w = min(WINDOW, len(same))
            agree = np.convolve(same.astype(np.int32), np.ones(w, dtype=np.int32), "valid")
            good = np.flatnonzero(agree >= (AGREE if w == WINDOW else w))
            if len(good):
                keep.append(i), start.append(good[0]), end.append(good[-1] + w)
                equal.append(int(same[good[0]:good[-1] + w].sum()))
        part = batch.take(pa.array(keep, pa.int64()))
        d = part.column("diagonal").to_numpy(zero_copy_only=False).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [part.column(k) for k in ("no_id", "id", "dk", "item")]
            + [pa.array(d + np.array(start, dtype=np.int64)), pa.array(d + np.array(end, dtype=np.int64)), pa.array(equal, pa.int64())],
            names=["no_id", "id", "dk", "item", "start", "end", "equal"])


def leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id",
          item_id: str = "item_id", item_text: str = "text", filter_bits: int = FILTER_BITS) -> DataFrame:
    """One row per leaked alignment: ``no_id, id, dk`` (the document), the item
    (``item_id``), ``start`` and ``end`` of the leak in tokens, ``equal``."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(f"`{item_id}`").cast("long").alias("item_id"), F.col(f"`{item_text}`").alias("text"))
    items = items.where("text is not null").groupBy("text").agg(F.min("item_id").alias("item_id"))
    items = items.select(F.xxhash64("text").alias("item"), "item_id", "text")
    tokens = c.stage(items.mapInArrow(_itemiser, "item bigint, tokens binary, length int"), "items")
    marks = c.stage(items.mapInArrow(_seeder(["item"], True, None), "item bigint, seed bigint, place int").join(
        tokens.select("item", "length"), "item"), "seeds")
    known = spark.sparkContext.broadcast(_bloom(marks, filter_bits))
    rows = docs.select(F.col(f"`{doc_id}`").isNull().alias("no_id"),
                       F.coalesce(F.col(f"`{doc_id}`"), F.lit(0)).cast("long").alias("id"),
                       c.text_key(F.col(f"`{text}`")).alias("dk"), F.col(f"`{text}`").alias("text"))
    keys = ["no_id", "id", "dk"]
    hits = rows.mapInArrow(_seeder(keys, False, known), "no_id boolean, id bigint, dk bigint, seed bigint, place int")
    hits = hits.join(marks.withColumnRenamed("place", "item_place"), "seed").select(
        *keys, F.struct("item", (F.col("place") - F.col("item_place")).alias("diagonal"), "length").alias("hit"))
    hits = c.stage(hits.groupBy(*keys).agg(F.collect_set("hit").alias("hits")), "hits")
    aligned = rows.join(hits, keys).mapInArrow(
        _aligner, "no_id boolean, id bigint, dk bigint, item bigint, diagonal int, aligned binary")
    found = aligned.join(tokens, "item").mapInArrow(
        _compare, "no_id boolean, id bigint, dk bigint, item bigint, start bigint, end bigint, equal bigint")
    return found.distinct().join(items.select("item", "item_id"), "item").drop("item")


def _join(docs: DataFrame, side: DataFrame, text: str, doc_id: str, how: str) -> DataFrame:
    names = c.fresh(docs, "_no_id", "_id", "_dk", "_key")
    side = side.withColumnsRenamed(dict(zip(("no_id", "id", "dk"), names)))
    df = docs.withColumn(names[3], c.text_key(F.col(f"`{text}`")))
    at = ((F.col(names[3]) == F.col(names[2])) & (F.col(f"`{doc_id}`").isNull() == F.col(names[0]))
          & (F.coalesce(F.col(f"`{doc_id}`"), F.lit(0)) == F.col(names[1])))
    return df.join(side, at, how).drop(*names)


def flag_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", **params) -> DataFrame:
    """``docs`` without the text, with ``contaminated``, ``n_items`` (long) and
    ``items``: an array of (item_id, start, end, equal), sorted."""
    out = ["contaminated", "n_items", "items"]
    docs = c.without(docs, [x for x in out if x.lower() not in (text.lower(), doc_id.lower())])
    found = leaks(docs, benchmark, text, doc_id, **params).groupBy("no_id", "id", "dk").agg(
        F.count_distinct(F.coalesce("item_id", F.lit(-1))).alias("n_items"),
        F.sort_array(F.collect_set(F.struct("item_id", "start", "end", "equal"))).alias("items"))
    kept = [F.col(f"`{x}`") for x in docs.columns if x != text]
    return _join(docs, found, text, doc_id, "left").select(
        *kept, F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), "items")


def remove_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", **params) -> DataFrame:
    """``docs`` without the documents that hold a benchmark passage."""
    found = c.stage(leaks(docs, benchmark, text, doc_id, **params).select("no_id", "id", "dk").distinct(), "leaks")
    return _join(docs, found, text, doc_id, "left_anti")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = c.table(spark, sf_dir, "documents").select("doc_id", "text")
    return flag_leaks(docs, c.table(spark, sf_dir, "benchmark"))
