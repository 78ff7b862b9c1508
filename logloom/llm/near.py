"""N-gram Jaccard join by a MinHash LSH forest with exact verification.

A document is the set of its windows of five words (a shorter one is a single
window). Documents with equal sets form a class of copies, and one
representative each goes on. Its signature is cut into ``TREES`` ordered
sequences of ``DEPTH`` minima, each a path in a prefix trie. A trie is stored
sorted by path, without what stands alone: a row for each path that shares its
shortest usable prefix (:func:`prefix_length`) with another one.

Two documents meet in a tree if their paths share a prefix. Prefixes of full
length are matched first and their pairs verified exactly, on the full sets;
then all are shortened by one and the pairs that meet only now are verified,
until the links found show the target recall (:func:`reached`): pairs as weak as
the weakest link seen meet with probability ``RECALL``, and one link as weak as
the threshold that stayed unseen would not pull the share of links found under
it. The shortest prefix is the one at which any pair at the threshold meets with
that probability, whatever was found; there it ends in any case.

A node with many documents is cut into blocks, and each pair of blocks is a
group of its own. Blocks grow with the root of the node's documents, up to a
bound on their windows, so the rows sent grow with the power 1.5 of a node up
to there; a group goes through its pairs in tiles, and no pair is emitted: it
returns, per document, the number of its links and one edge towards the
component's smallest member. A pair counts where it meets first (longest
prefix, then first tree); documents of a group without such a pair are left out
before the sets are sent, and nodes with the members of an earlier one are
dropped.

Defined cases: a null text has no words; documents without a word are linked
to nothing and are a class of their own; a null id comes after all others;
rows with equal id and text are one place and count as copies; an empty table
gives an empty result; extra columns pass through in :func:`keep_one`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c
from . import hashing as hs
from .components import components

N = 5
THRESHOLD = 0.8
TREES = 24
DEPTH = 8
RECALL = 0.999
#: Documents of a trie node that stay one block; ``m`` documents make
#: sqrt(m / BLOCK) blocks, more if a block would have over ``WINDOWS`` windows.
BLOCK = 128
WINDOWS = 1 << 21
#: Documents on each side of the pairs looked at together.
TILE = 256

PLACE = "no_id boolean, id bigint, dk bigint"


def prefix_length(threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix at which a pair at the threshold meets in one of the
    trees with the target probability."""
    k = depth
    while k > 1 and meeting(threshold, k, trees) < recall:
        k -= 1
    return k


def meeting(similarity: float, k: int, trees: int) -> float:
    """Probability that a pair of this similarity shares a prefix of ``k``
    minima in one of the trees."""
    return 1 - (1 - similarity ** k) ** trees


def reached(k: int, links: int, weakest: float | None, threshold: float, trees: int, recall: float) -> bool:
    """Whether prefixes of ``k`` minima have the target recall, judged by the
    links found so far: their number and the weakest one's similarity."""
    if not links:
        return False
    unseen = 1 - meeting(threshold, k, trees)
    return meeting(weakest, k, trees) >= recall and unseen <= (1 - recall) * links


def shingle_sets(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct windows of all texts, text by text and sorted, and the
    index of each text's first one."""
    grams, first = hs.windows(*hs.words(texts, hs.NOT_SPACE), n)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), dtype=bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    return grams[new], np.searchsorted(owner[new], np.arange(len(texts) + 1))


def _sketcher(n: int, trees: int, shortest: int, depth: int):
    """The path of each tree: 64 bits of its shortest prefix, the root, and 16
    bits for each turn taken below it. Paths that share them by chance meet as if
    they had equal minima, which costs a verification at most."""
    rng = np.random.default_rng(20)
    a = rng.integers(1, 1 << 63, trees * depth, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 63, trees * depth, dtype=np.uint64)
    turns = depth - shortest

    def paths(texts: list[bytes]) -> tuple:
        sets, first = shingle_sets(texts, n)
        size = np.diff(first)
        has = size > 0
        roots = np.zeros((len(texts), trees), dtype=np.uint64)
        below = np.zeros((len(texts), trees, turns), dtype=np.int16)
        sums = np.zeros((2, len(texts)), dtype=np.uint64)
        if has.any():
            at = first[:-1][has]
            for i, mult in enumerate((0xA0761D6478BD642F, 0xE7037ED1A0B428DB)):
                sums[i, has] = np.add.reduceat(hs.mix(sets * np.uint64(mult)), at)
            for t in range(trees):
                key = np.zeros(len(at), dtype=np.uint64)
                for d in range(depth):
                    j = t * depth + d
                    low = np.minimum.reduceat((sets * a[j] + b[j]) >> np.uint64(32), at)
                    key = hs.mix(key * np.uint64(hs.P) + low + np.uint64(1))
                    if d + 1 == shortest:
                        roots[has, t] = key
                    elif d + 1 > shortest:
                        below[has, t, d - shortest] = (key >> np.uint64(48)).astype(np.uint16).view(np.int16)
        return size, sums.view(np.int64), roots.view(np.int64), below

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            for lo, hi in hs.chunks(texts):
                size, sums, roots, below = paths(texts[lo:hi])
                part = batch.slice(lo, hi - lo)
                lists = [pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1) * w, pa.int32()), pa.array(x.ravel()))
                         for x, w in ((roots, trees), (below, trees * turns))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(x) for x in ("no_id", "id", "dk")]
                    + [pa.array(size.astype(np.int64)), pa.array(sums[0]), pa.array(sums[1]), *lists],
                    names=["no_id", "id", "dk", "size", "sa", "sb", "roots", "turns"])
    return run


def _shingler(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            for lo, hi in hs.chunks(texts):
                sets, first = shingle_sets(texts[lo:hi], n)
                raw = [sets[first[i]:first[i + 1]].tobytes() for i in range(hi - lo)]
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(x) for x in ("node", "copies", "roots", "turns")), pa.array(np.diff(first)), pa.array(raw, pa.binary())],
                    names=["node", "copies", "roots", "turns", "size", "grams"])
    return run


def _shared(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets at ``left`` with those at ``right``."""
    if len(left) * 8 < len(sets):
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(left, right)], dtype=np.int64)
    value, which = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    often = np.bincount(which, minlength=len(value)) > 1
    column = np.cumsum(often) - 1
    keep = often[which]
    owner, which = owner[keep], column[which[keep]]
    order = np.argsort(which, kind="stable")
    owner, which = owner[order], which[order]
    both = np.zeros((len(sets), len(sets)), dtype=np.float32)
    slab = 8192  # columns of the incidence matrix at a time
    for lo in range(0, int(which[-1]) + 1 if len(which) else 0, slab):
        a, z = np.searchsorted(which, (lo, lo + slab))
        m = np.zeros((len(sets), slab), dtype=np.float32)
        m[owner[a:z], which[a:z] - lo] = 1
        both += m @ m.T
    return both[left, right].astype(np.int64)


def _tiles(group: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of a group, ``TILE`` x ``TILE`` at a time: inside its block,
    or between its two blocks."""
    bi, bj = (group.column(x)[0].as_py() for x in ("bi", "bj"))
    block = group.column("block").to_numpy()
    pieces = [[at[i:i + TILE] for i in range(0, len(at), TILE)] for at in (np.flatnonzero(block == x) for x in (bi, bj))]
    for i, a in enumerate(pieces[0]):
        for b in pieces[1][i + 1:] if bi == bj else pieces[1]:
            yield np.repeat(a, len(b)), np.tile(b, len(a))
        if bi == bj:
            left, right = np.triu_indices(len(a), 1)
            yield a[left], a[right]


def _new_pairs(group: pa.Table, threshold: float, trees: int, level: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of a group, tile by tile, that meet here first and whose sizes
    allow a link. ``level`` is the place of the prefix among the stored ones."""
    tree = group.column("tree")[0].as_py()
    size = group.column("size").to_numpy()
    flat = lambda x: group.column(x).combine_chunks().flatten().to_numpy()
    paths = [flat("roots").view(np.uint64).reshape(len(size), trees)]
    for turn in np.moveaxis(flat("turns").reshape(len(size), trees, -1), 2, 0):
        paths.append(hs.mix(paths[-1] * np.uint64(hs.P) + turn.view(np.uint16)))
    before = [(t, level + 1) for t in range(trees)] if level + 1 < len(paths) else []
    for left, right in _tiles(group):
        ok = np.minimum(size[left], size[right]) >= threshold * np.maximum(size[left], size[right])
        left, right = left[ok], right[ok]
        for t, at in before + [(t, level) for t in range(tree)]:
            if not len(left):
                break
            new = paths[at][left, t] != paths[at][right, t]
            left, right = left[new], right[new]
        if len(left):
            yield left, right


def _screener(threshold: float, trees: int, level: int):
    """The documents of a group that have a pair to verify in it."""
    def run(group: pa.Table) -> pa.Table:
        has = np.zeros(group.num_rows, dtype=bool)
        for left, right in _new_pairs(group, threshold, trees, level):
            has[left] = has[right] = True
        return group.select(["tree", "key", "bi", "bj", "block", "node"]).take(pa.array(np.flatnonzero(has)))
    return run


def _joined(root: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest index in each local component, with these links added."""
    while True:
        a, b = root[left], root[right]
        if (a == b).all():
            return root
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            low = root[root]
            if (low == root).all():
                break
            root = low


def _verifier(threshold: float, trees: int, level: int):
    def run(group: pa.Table) -> pa.Table:
        grams = group.column("grams").combine_chunks()
        size = group.column("size").to_numpy()
        copies = group.column("copies").to_numpy()
        weakest = np.ones(len(size))
        links = np.zeros(len(size), dtype=np.int64)
        root = np.arange(len(size))
        for left, right in _new_pairs(group, threshold, trees, level):
            own, at = np.unique(np.concatenate((left, right)), return_inverse=True)
            sets = [np.frombuffer(grams[i].as_buffer(), dtype=np.uint64) for i in own.tolist()]
            shared = _shared(sets, at[:len(left)], at[len(left):])
            # shared / union >= threshold, without rounding below it
            ok = shared >= threshold * (size[left] + size[right] - shared) - 1e-9
            left, right, shared = left[ok], right[ok], shared[ok]
            alike = shared / (size[left] + size[right] - shared)
            np.minimum.at(weakest, left, alike)
            np.minimum.at(weakest, right, alike)
            np.add.at(links, left, copies[right])
            np.add.at(links, right, copies[left])
            root = _joined(root, left, right)
        at = np.flatnonzero(links)
        node = group.column("node")
        return pa.table({"u": node.take(pa.array(at)), "v": node.take(pa.array(root[at])), "links": pa.array(links[at]), "weakest": pa.array(weakest[at])})
    return run


def link_classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", n: int = N, threshold: float = THRESHOLD,
                 trees: int = TREES, depth: int = DEPTH, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """One row per place (``no_id, id, dk``): ``node`` (the first place with the
    same set of windows), ``label`` (the first place of its component) and
    ``n_links`` (rows linked to it, its own copies included)."""
    k = prefix_length(threshold, trees, depth, recall)
    rows = docs.select(F.col(f"`{doc_id}`").isNull().alias("no_id"),
                       F.coalesce(F.col(f"`{doc_id}`"), F.lit(0)).cast("long").alias("id"),
                       c.text_key(F.col(f"`{text}`")).alias("dk"), F.col(f"`{text}`").alias("text"))
    sketch = c.stage(rows.mapInArrow(_sketcher(n, trees, k, depth), f"{PLACE}, size bigint, sa bigint, sb bigint, roots array<bigint>, turns array<smallint>"), "sketch")
    place = F.struct("no_id", "id", "dk")
    classes = c.stage(sketch.where("size > 0").groupBy("sa", "sb").agg(
        F.min(place).alias("node"), F.count("*").alias("copies"), *[F.first(x).alias(x) for x in ("size", "roots", "turns")]), "classes")
    # The tries: dealt out once by the shortest prefix, for the count of its documents and for themselves.
    levels = depth - k + 1
    walks = classes.select("node", "size", "turns", F.posexplode("roots").alias("tree", "root")).select(
        "node", F.col("size").cast("int").alias("size"), "tree", "root", F.slice("turns", F.col("tree") * (levels - 1) + 1, levels - 1).alias("turns")).repartition("tree", "root")
    shared = walks.groupBy("tree", "root").agg(F.count("*").alias("m")).where("m > 1").select("tree", "root")
    tries = c.stage(walks.join(shared, ["tree", "root"], "left_semi").sortWithinPartitions("tree", "root", "turns"), "tries")
    prefix = lambda x: F.xxhash64("root", F.slice("turns", F.lit(1), x))
    h = F.xxhash64("node")
    nodes = tries.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels - 1)))).withColumn("key", prefix(F.col("level"))).groupBy("level", "tree", "key").agg(
        F.count("*").alias("m"), F.sum("size").alias("windows"), F.bit_xor(h).alias("x"), F.bit_xor(F.xxhash64(h)).alias("y")).where("m > 1")
    nodes = nodes.groupBy("m", "windows", "x", "y").agg(F.min(F.struct((-F.col("level")).alias("up"), "tree", "key")).alias("n"))
    nodes = c.stage(nodes.select((-F.col("n.up")).alias("level"), "n.tree", "n.key", "m", "windows"), "nodes")
    # The sets of the representatives in the tries, from their texts. A shuffle join at every size.
    keys = ["no_id", "id", "dk"]
    struct = f"struct<{PLACE.replace(' ', ':').replace(',:', ',')}>"
    wanted = tries.select("node").distinct().join(classes.select("node", "copies", "roots", "turns").hint("merge"), "node").select(
        "node", "copies", "roots", "turns", *[F.col(f"node.{x}").alias(x) for x in keys])
    texts = rows.join(wanted.hint("merge"), keys).dropDuplicates(keys).select("node", "copies", "roots", "turns", "text")
    sets = c.stage(texts.mapInArrow(_shingler(n), f"node {struct}, copies bigint, roots array<bigint>, turns array<smallint>, size bigint, grams binary"), "sets")
    blocks = F.greatest(F.ceil(F.sqrt(F.col("m") / block)), F.ceil(F.col("windows") / WINDOWS)).cast("int").alias("blocks")
    found, seen, weakest = None, 0, None
    for level in reversed(range(levels)):
        at = tries.select("tree", prefix(F.lit(level)).alias("key"), "node").join(
            nodes.where(F.col("level") == level).select("tree", "key", blocks).hint("merge"), ["tree", "key"])
        at = at.join(sets.select("node", "roots", "turns", "size").hint("merge"), "node")  # before it is dealt to blocks
        at = at.withColumn("block", F.pmod(F.xxhash64("node", "tree"), "blocks").cast("int"))
        at = at.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        at = at.select("tree", "key", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"), "block", "node", "roots", "turns", "size")
        pair = ["tree", "key", "bi", "bj"]
        new = c.stage(at.groupBy(*pair).applyInArrow(
            _screener(threshold, trees, level), f"tree int, key bigint, bi int, bj int, block int, node {struct}"), "pairs")
        # Each document meets its set once, then goes to all of its groups.
        own = new.groupBy("node").agg(F.collect_list(F.struct(*pair, "block")).alias("at")).join(sets.hint("merge"), "node")
        links = c.stage(own.withColumn("at", F.explode("at")).select("at.*", *sets.columns).groupBy(*pair).applyInArrow(
            _verifier(threshold, trees, level), f"u {struct}, v {struct}, links bigint, weakest double"), "found")
        found = links if found is None else found.unionByName(links)
        told = links.agg(F.sum("links").alias("n"), F.min("weakest").alias("low")).first()
        if told["n"]:
            seen, weakest = seen + told["n"], min(told["low"], weakest or 1.0)
        if reached(k + level, seen, weakest, threshold, trees, recall):
            break
    labels = components(found.select("u", "v"))
    links = found.groupBy("u").agg(F.sum("links").alias("links"))
    per_class = classes.select("sa", "sb", "node", "copies").join(labels.withColumnRenamed("u", "node"), "node", "left").join(
        links.withColumnRenamed("u", "node"), "node", "left").select(
        "sa", "sb", "node", F.coalesce("label", "node").alias("label"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = sketch.drop("roots", "turns").join(per_class, ["sa", "sb"], "left")
    lone = F.col("size") == 0
    return out.select("no_id", "id", "dk", "size", *[F.when(lone, place).otherwise(F.col(x)).alias(x) for x in ("node", "label")],
                      F.when(lone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"))


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **params) -> DataFrame:
    """``docs`` with one row of each component: the first place's. Documents
    without a word are in no component and stay."""
    names = c.fresh(docs, "_no_id", "_id", "_dk", "_key")
    linked = link_classes(docs, text, doc_id, **params).where("size > 0")
    first = linked.select("label.*").distinct().toDF(*names[:3])
    key = names[3]
    df = docs.withColumn(key, c.text_key(F.col(f"`{text}`")))
    at = ((F.col(key) == F.col(names[2])) & (F.col(f"`{doc_id}`").isNull() == F.col(names[0]))
          & (F.coalesce(F.col(f"`{doc_id}`"), F.lit(0)) == F.col(names[1])))
    has_word = F.coalesce(F.col(f"`{text}`"), F.lit("")).rlike(c.WORD)
    return df.where(has_word).join(first, at, "left_semi").dropDuplicates([doc_id, key]).select(*docs.columns).unionByName(
        docs.where(~has_word))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = c.table(spark, sf_dir, "documents").select("doc_id", "text")
    ident = lambda x: F.when(~F.col(f"{x}.no_id"), F.col(f"{x}.id"))
    return link_classes(docs).select(
        F.when(~F.col("no_id"), F.col("id")).alias("doc_id"), ident("node").alias("copy_of"),
        ident("label").alias("class_id"), "n_links")
