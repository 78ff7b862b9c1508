"""Ranked lexical search with a length-stratified index.

A document's score for an item sums, over the item's terms with repeats, the
term's weight times its impact, which depends only on the term's occurrences
tf and on the document's normaliser m. The index groups documents by m: in such
a stratum the postings of a term are ordered by tf, and the impact of a tf is
worked out once for all documents that share it. The largest tf of a term in a
stratum bounds what the stratum can give; a search visits the strata by
decreasing bound and stops when the next bound is below the k-th best score.

The index is a table in the shared folder, written once and in blocks of
documents: a row holds one term of a block with the length, tf and place in the
block of each posting; the row of the empty term (no term is empty) holds the
lengths and ids of the block's documents. Lengths become normalisers at search
time, when the corpus's totals are known. Blocks hold about ``BLOCK`` bytes of text or one
longer document, so no task grows with the corpus, and each is searched by
itself: only the rows of the items' terms move, to their block's task, and each
block answers with at most k documents an item.

Items are taken in passes of about ``PASS`` bytes of text: that much reaches
the driver and is sent to the tasks at a time, however many items there are.

Defined cases: null texts and texts without a term are no documents of the
search and, as items, give no rows. Every row is a document of its own, also
with a repeated id; equal scores rank by ascending id, a null id first. Equal
rows of the items are one item; rows with one item id and different texts are
ranked each for itself. Empty tables give an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from . import common as c
from . import hashing as hs

#: Text bytes of an index block, and item bytes of a pass.
BLOCK = 8 << 20
PASS = 32 << 20
TOP = 20

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}
_IS_TERM = np.array([i >= 128 or chr(i).isalnum() for i in range(256)])
_LOW = np.array([i + 32 if 65 <= i <= 90 else i for i in range(256)], dtype=np.uint8)
#: Stands for a null document id inside the index; sorts first.
_NULL = -(1 << 63)

INDEX = StructType([StructField("block", LongType()), StructField("term", StringType()),
                    StructField("lengths", ArrayType(IntegerType())), StructField("tfs", ArrayType(IntegerType())),
                    StructField("docs", ArrayType(LongType()))])


def terms(text: str | None) -> list[str]:
    """The terms of a text, A-Z lower-cased, with repeats."""
    return _TERM.findall((text or "").translate(_LOWER))


def _strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """data[start:end] of each term as Arrow strings."""
    size = end - start
    at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(data[at]))


def _lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.astype(kind.to_pandas_dtype()), type=kind))


def index_block(number: int, texts: list[bytes], ids: np.ndarray) -> pa.RecordBatch | None:
    """The index rows of one block."""
    data = _LOW[np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)]
    start, end = hs.runs(_IS_TERM[data])
    if not len(start):
        return None
    bounds = np.cumsum([len(t) + 1 for t in texts])
    doc = np.searchsorted(bounds, start, side="right")
    length = np.bincount(doc, minlength=len(texts))
    hashes = np.empty(len(start), dtype=np.uint64)
    for lo, hi in hs.chunks(texts):  # the sums of a slice take some 40 times its bytes
        a, z = bounds[lo - 1] if lo else 0, bounds[hi - 1]
        i, j = np.searchsorted(start, (a, z))
        hashes[i:j] = hs.substrings(hs.prefix(data[a:z]), start[i:j] - a, end[i:j] - a)
    _, one, which = np.unique(hashes, return_index=True, return_inverse=True)
    del hashes
    pair, tf = np.unique(which * len(texts) + doc, return_counts=True)
    own = np.flatnonzero(length)
    place = np.cumsum(length > 0) - 1
    term, doc = pair // len(texts), pair % len(texts)
    by = np.lexsort((doc, tf, length[doc], term))  # by stratum and tf within a term
    term, doc, tf = term[by], doc[by], tf[by]
    bounds = np.concatenate(([0], len(own) + np.searchsorted(term, np.arange(len(one) + 1))))
    name = pa.concat_arrays([pa.array([""]), _strings(data, start[one], end[one])])
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(one) + 1, number)), name,
         _lists(np.concatenate((length[own], length[doc])), bounds, pa.int32()),
         _lists(np.concatenate((np.zeros(len(own), dtype=np.int64), tf)), bounds, pa.int32()),
         _lists(np.concatenate((ids[own], place[doc])), bounds, pa.int64())], names=INDEX.names)


def build_index(docs: DataFrame, text: str = "text", key: str = "doc_id", block: int = BLOCK) -> DataFrame:
    """The index of all rows of ``docs``, as a table in the shared folder."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        texts, ids, size = [], [], 0

        def flush():
            out = index_block(number, texts, np.array(ids, dtype=np.int64))
            for at in range(0, out.num_rows if out else 0, 1 << 16):
                yield out.slice(at, 1 << 16)

        for batch in batches:
            for t, i in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("id").to_pylist()):
                if texts and size + len(t) > block:
                    yield from flush()
                    number, texts, ids, size = number + 1, [], [], 0
                texts.append(t), ids.append(_NULL if i is None else i)
                size += len(t) + 1
        yield from flush()

    rows = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{key}`").cast("long").alias("id")).where("text IS NOT NULL")
    return c.stage(rows.mapInArrow(run, INDEX), "index")


class Stratified:
    """One block's postings of the items' terms, in strata."""

    def __init__(self, table: pa.Table, number: dict[str, int], n_docs: int, n_terms: int):
        is_doc = pc.equal(table["term"], "")
        header = table.filter(is_doc)
        self.ids = header["docs"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        rest = table.filter(pc.invert(is_doc))
        count = pc.list_value_length(rest["lengths"]).to_numpy()
        flat = lambda name: rest[name].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        term = np.repeat(np.array([number[t] for t in rest["term"].to_pylist()], dtype=np.int64), count)
        m = 75 + 25 * flat("lengths") * n_docs // n_terms
        tf, doc = flat("tfs"), flat("docs")
        by = np.lexsort((tf, m, term))
        term, m, tf, self.doc = term[by], m[by], tf[by], doc[by]
        # the impact of a tf, once in a stratum
        above = int(tf.max(initial=0)) + 1
        levels, which = np.unique(m * above + tf, return_inverse=True)
        self.impact = (10**9 * (levels % above) // (1000 * (levels % above) + 12 * (levels // above)))[which]
        self.strata, stratum = np.unique(m, return_inverse=True)
        # postings of one term in one stratum lie together, the largest tf last
        edge = (term[1:] != term[:-1]) | (stratum[1:] != stratum[:-1])
        head = np.concatenate((np.zeros(min(len(term), 1), dtype=np.int64), np.flatnonzero(edge) + 1))
        self.first, self.last = head, np.append(head[1:], len(term))[:len(head)]
        self.stratum = stratum[head]
        self.most = self.impact[self.last - 1]
        self.by_term = np.searchsorted(term[head], np.arange(len(number) + 1))

    def best(self, wanted: np.ndarray, value: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best documents for the terms ``wanted``
        (distinct numbers) worth ``value`` (weight times repeats)."""
        lo, hi = self.by_term[wanted], self.by_term[wanted + 1]
        many = hi - lo
        group = np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        worth = np.repeat(value, many)
        bound = np.zeros(len(self.strata), dtype=np.int64)
        np.add.at(bound, self.stratum[group], worth * self.most[group])
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        turn = np.zeros(len(self.strata), dtype=np.int64)
        turn[order] = np.arange(len(order))
        by = np.argsort(turn[self.stratum[group]], kind="stable")
        group, worth = group[by], worth[by]
        turns = turn[self.stratum[group]]
        docs, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        at, step = 0, 1
        while at < len(order):
            if len(scores) >= k and bound[order[at]] < scores[-1]:
                break
            a, z = np.searchsorted(turns, (at, at + step))
            size = self.last[group[a:z]] - self.first[group[a:z]]
            place = np.repeat(self.first[group[a:z]] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            doc, own = np.unique(self.doc[place], return_inverse=True)
            total = np.zeros(len(doc), dtype=np.int64)
            np.add.at(total, own, np.repeat(worth[a:z], size) * self.impact[place])
            docs, scores = np.concatenate((docs, doc)), np.concatenate((scores, total))
            top = np.lexsort((self.ids[docs], -scores))[:k]
            docs, scores = docs[top], scores[top]
            at, step = at + step, 2 * step
        some = scores > 0
        return self.ids[docs[some]], scores[some]


_FOUND = StructType([StructField("query", LongType()), StructField("doc", LongType()), StructField("score", LongType())])


def _searcher(share, k: int):
    def run(table: pa.Table) -> pa.Table:
        number, items, n_docs, n_terms = share.value
        block = Stratified(table, number, n_docs, n_terms)
        query, doc, score = [], [], []
        for q, wanted, value in items:
            ids, scores = block.best(wanted, value, k)
            query.append(np.full(len(ids), q)), doc.append(ids), score.append(scores)
        none = [np.zeros(0, dtype=np.int64)]
        return pa.table([pa.array(np.concatenate(x or none).astype(np.int64)) for x in (query, doc, score)], names=_FOUND.names)
    return run


def search(index: DataFrame, items: DataFrame, text: str = "text", key: str = "item_id", k: int = TOP, pass_bytes: int = PASS) -> DataFrame:
    """``key, rank, doc_id, score``: the ``k`` best documents with a score
    above 0 for each row of ``items``."""
    spark = index.sparkSession
    n_docs, n_terms = index.where("term = ''").agg(
        F.sum(F.size("docs")), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n))).first()
    rows = items.select(F.col(f"`{key}`").alias("item"), F.col(f"`{text}`").alias("text")).where("text IS NOT NULL").distinct()
    rows = rows.withColumn("query", F.xxhash64(F.col("item").isNull(), "item", "text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = -(-size // pass_bytes)
    found = spark.createDataFrame([], _FOUND)
    for i in range(passes if n_docs else 0):
        part = [(r["query"], Counter(terms(r["text"]))) for r in
                rows.where(F.pmod(F.xxhash64("query"), F.lit(passes)) == i).select("query", "text").collect()]
        number = {t: j for j, t in enumerate(sorted({t for _, m in part for t in m}))}
        if not number:
            continue
        words = spark.createDataFrame([("",), *((t,) for t in number)], "term string")
        mine = index.join(F.broadcast(words), "term", "left_semi")  # no larger than the pass
        df = dict(mine.where("term != ''").groupBy("term").agg(F.sum(F.size("docs")).alias("df")).collect())
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
        asked = []
        for q, many in part:
            held = sorted((number[t], weight[t] * n) for t, n in many.items() if weight.get(t, 0) > 0)
            if held:
                asked.append((q, np.array([a for a, _ in held]), np.array([b for _, b in held], dtype=np.int64)))
        share = spark.sparkContext.broadcast((number, asked, n_docs, n_terms))
        found = found.unionByName(mine.groupBy("block").applyInArrow(_searcher(share, k), _FOUND))
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    found = found.withColumn("doc_id", F.when(F.col("doc") != _NULL, F.col("doc"))).drop("doc")
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.join(rows.select("query", "item"), "query").select(F.col("item").alias(key), "rank", "doc_id", "score")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(build_index(c.table(spark, sf_dir, "documents")), c.table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH words AS (
    SELECT doc_id, row_number() OVER () AS d,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents),
docs AS (SELECT doc_id, d, terms, len(terms) AS n FROM words WHERE len(terms) > 0),
totals AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM docs),
asked AS (
    SELECT item_id, term, count(*) AS times
    FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
    GROUP BY ALL),
postings AS (
    SELECT d, doc_id, n, term, count(*) AS tf
    FROM (SELECT d, doc_id, n, unnest(terms) AS term FROM docs)
    WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM postings, totals GROUP BY term, n_docs),
scored AS (
    SELECT item_id, d, doc_id,
           sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN postings USING (term), totals GROUP BY ALL)
SELECT item_id, rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scored WHERE score > 0)
WHERE rank <= 20
"""
