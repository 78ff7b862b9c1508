"""Main text of web pages: host suffix arrays, with markup to protect articles.

Scripts, styles, comments, menus, headers, footers, sidebars, notices, adverts,
forms and reader comments are left out by element or by class, id and role.
The host's suffix array then decides on every page: the token streams of all
pages of the host, zones left out included, are put together, and a run of
``RUN`` tokens or more that stands on ``PAGES`` distinct pages, and on the share
``SHARE`` of the host's distinct pages, is repeated. Equal pages count once.

* On a page without an ``article`` or ``main`` element, tokens in repeated runs
  are boilerplate and go; the unique runs are the main text.
* Inside such an element a repeated run alone proves nothing, as several
  articles may share a passage. A block there goes if it lies as a whole in runs
  that stand inside the element on the share ``MOST`` of the host's distinct
  pages and outside of it on as many: a notice or menu without a mark of its
  own. If nothing but such blocks is there, all are kept.

The array is spread over tasks, any host over any number of them:

1. Pages are packed into batches in a table bucketed by the batch's number, so
   that answers join without moving texts.
2. Each batch sends, of every ``RUN`` tokens, the smallest hash of a seed of
   half that length. A run on enough pages has its seed on enough pages, so only
   suffixes with such a seed are looked at further.
3. Each batch sorts these suffixes by host and first ``RUN`` tokens; neighbours
   with a common prefix that long are one interval. Buckets put the intervals of
   all batches together and answer which are repeated, and where.

Defined cases: null html or url counts as empty; a page without main text gets
an empty string; truncated tags, comments and scripts end with the page;
unknown references stay as they are; repeated rows get one result each; an
empty table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

import hashlib
import html
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c
from . import hashing as hs
from . import suffixes as sa

RUN = 12
PAGES = 3
SHARE = 0.1
MOST = 0.5
#: Bytes of html in a batch (up to WIDE with many buckets) and in a bucket.
BATCH = 2 << 20
WIDE = 4 << 20
BUCKET = 16 << 20

RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
OUT = RAW | frozenset("nav header footer aside form menu dialog button select option datalist svg canvas object audio video head".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
MAIN = frozenset(("article", "main"))
#: Words at either end of a class, id or role that mark a zone left out.
ZONES = ("ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies dialog disqus "
         "footer gdpr header masthead menu modal nav navbar navigation newsletter notice notification popup promo related replies "
         "respond search share sharing sidebar social sponsor sponsored subscribe toolbar widget")

# A quote opens a value only after "="; elsewhere, and inside an unquoted value, it is a character like others.
_VALUE = r"(?:\s*+=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>]*+))?+"
_TAG = re.compile(rf"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>=]++{_VALUE}|=)*+)(?:>|\Z)|<[!?][^>]*+(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s/>=]++)(?:\s*+=\s*+(?:\"([^\"]*+)(?:\"|\Z)|'([^']*+)(?:'|\Z)|([^\s>]*+)))?+")
_NAMED = frozenset(("class", "id", "role"))
#: What follows a zone word in the name of a zone ("search-box", not "search-results" or "share-price").
PARTS = ("ad ads area banner bar block body bottom box btn button buttons card cell close container content count dialog feed field "
         "footer form group head header icon icons inner input item items label left link links list main menu message modal module "
         "nav navigation notice outer overlay panel popup posts articles stories right row section sidebar slot space text title "
         "toggle top unit widget widgets wrap wrapper zone")
_ZONE = re.compile(rf"^(?:{ZONES.replace(' ', '|')})(?:[-_](?:{PARTS.replace(' ', '|')}|{ZONES.replace(' ', '|')}|[0-9]+))*$"
                   rf"|^(?!(?:has|with|no|without)[-_])(?:.*[-_])(?:{ZONES.replace(' ', '|')})$", re.I)


def _left_out(attributes: str) -> bool:
    named: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(attributes):
        named.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")  # of equal attributes the first counts
    return any(_ZONE.match(name) for key in _NAMED & named.keys() for name in named[key].split())


def blocks(page: str) -> tuple[bool, list[str]]:
    """Whether the page has a main element, and the blocks inside it (without
    one, all blocks) that are in no zone left out; references decoded, white
    space made single."""
    seen, own = zoned(page)
    return seen, [text for text, kept in own if kept]


def zoned(page: str) -> tuple[bool, list[tuple[str, bool]]]:
    """As :func:`blocks`, with all blocks of the page in order, zones left out
    too, and whether each is kept."""
    found: list[tuple[str, bool, bool]] = []  # text, left out, in main
    pieces: tuple[list[str], list[str]] = [], []  # of a block: kept, in an inline zone or in a zone
    stack: list[tuple[str, bool, bool]] = []  # element, left out, in main
    open_: Counter[str] = Counter()  # elements of the stack: an end tag without one is passed over at once
    skip = main = seen = False
    at, end = 0, len(page)

    def close():
        for out, piece in enumerate(pieces):
            text = " ".join(html.unescape("".join(piece)).split())
            piece.clear()
            if text:
                found.append((text, bool(out), main))

    while at < end:
        m = _TAG.search(page, at)
        stop = m.start() if m else end
        if stop > at:
            pieces[skip].append(page[at:stop])
        if m is None:
            break
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if name not in INLINE:
            close()
        if m[1]:
            if open_[name]:
                while True:
                    gone = stack.pop()[0]
                    open_[gone] -= 1
                    if gone == name:
                        break
                _, skip, main = stack[-1] if stack else ("", False, False)
            continue
        if name in VOID or m[3].endswith("/") and name in ("path", "use"):
            continue
        if name in RAW:  # the content has no markup
            tail = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = tail.end() if tail else end
            continue
        if name not in INLINE and stack and stack[-1][0] == "p" or name == "li" and stack and stack[-1][0] == "li":
            open_[stack.pop()[0]] -= 1
            _, skip, main = stack[-1] if stack else ("", False, False)
        skip = skip or name in OUT or bool(m[3]) and name not in ("html", "body") and _left_out(m[3])
        main = main or name in MAIN and not skip
        seen = seen or main
        stack.append((name, skip, main))
        open_[name] += 1
    close()
    return seen, [(text, not out and inside == seen) for text, out, inside in found]


def host_of(url: str) -> str:
    m = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little")


def _parse(least: int):
    """Rows of pages to rows of packed batches of about ``least`` bytes of html."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, ids, urls, pages, size = TaskContext.get().partitionId(), 0, [], [], [], 0

        def row():
            raw = sa._pack(
                page_id=pa.array(ids, pa.int64()), url=pa.array(urls, pa.string()), decided=pa.array([d for d, _ in pages], pa.bool_()),
                blocks=pa.array([[t for t, _ in own] for _, own in pages], pa.list_(pa.string())),
                kept=pa.array([[k for _, k in own] for _, own in pages], pa.list_(pa.bool_())))
            return pa.RecordBatch.from_arrays([pa.array([(part << 32) + number], pa.int64()), pa.array([raw], pa.binary())], names=["uid", "pages"])
        for batch in batches:
            for i, u, x in zip(*(batch.column(k).to_pylist() for k in ("page_id", "url", "html"))):
                ids.append(i), urls.append(u), pages.append(zoned(x or ""))
                size += len(x or "") + 1
                if size >= least:
                    yield row()
                    number, ids, urls, pages, size = number + 1, [], [], [], 0
        if ids:
            yield row()
    return run


class _Batch:
    """The pages of a batch, with their streams: the tokens of all blocks."""

    def __init__(self, raw: bytes):
        x = sa._unpack(raw)
        self.page_id, self.url, self.decided = x["page_id"], x["url"], x["decided"].to_numpy(zero_copy_only=False).astype(bool)
        self.blocks, self.kept = x["blocks"].to_pylist(), x["kept"].to_pylist()
        self.texts = [" ".join(own) for own in self.blocks]
        self.hosts = [host_of(u) for u in self.url.to_pylist()]

    def tokens(self):
        """Hashes of the tokens, and the first one of each page."""
        raw = [t.encode() for t in self.texts]
        parts = [hs.words(raw[lo:hi], hs.NOT_SPACE) for lo, hi in hs.chunks(raw)]
        base = np.cumsum([0] + [len(h) for h, _ in parts])
        first = np.concatenate([f[:-1] + b for (_, f), b in zip(parts, base)] + [base[-1:]])
        return np.concatenate([h for h, _ in parts] or [np.zeros(0, np.uint64)]), first

    def blocks_of(self):
        """First token of each block, whether it is kept, and its page."""
        size = np.array([t.count(" ") + 1 for own in self.blocks for t in own], dtype=np.int64)
        kept = np.array([k for own in self.kept for k in own], dtype=bool)
        return np.concatenate(([0], np.cumsum(size))), kept, np.repeat(np.arange(len(self.blocks)), [len(own) for own in self.blocks])


class _Suffixes:
    """Suffixes of a batch with ``n`` tokens or more on hosts with pages enough."""

    def __init__(self, batch: _Batch, told: list, firsts: list | None, n: int, least: int):
        self.n = n
        pages = {x["host"]: x["pages"] for x in told}
        ids = np.array([_hash(x) for x in batch.hosts], dtype=np.uint64)
        self.size = np.array([pages[x] for x in batch.hosts], dtype=np.int64)  # distinct pages of a page's host
        self.counts = np.zeros(len(ids), dtype=bool)  # of equal pages one counts
        self.counts[firsts or []] = True
        self.hashes, first = batch.tokens()
        here = np.where(self.size >= least, np.maximum(np.diff(first) - n + 1, 0), 0)
        self.page = np.repeat(np.arange(len(ids)), here)
        self.at = first[:-1][self.page] + np.arange(len(self.page)) - (np.cumsum(here) - here)[self.page]
        self.host = ids[self.page]

    def seeds(self) -> np.ndarray:
        """For each suffix, the smallest hash of a seed in its first tokens."""
        q = (self.n + 1) // 2
        low = self._grams(np.arange(max(len(self.hashes) - q + 1, 0)), q)
        span, width = 1, self.n - q + 1
        while span < width and len(self.at):
            step = min(span, width - span)
            low = np.minimum(low[:-step], low[step:])
            span += step
        return hs.mix(low[self.at] ^ self.host)

    def _grams(self, at: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros(len(at), dtype=np.uint64)
        for k in range(n):
            out = hs.mix(out * np.uint64(hs.P) + self.hashes[at + k] + np.uint64(k + 1))
        return out

    def only(self, rows: np.ndarray) -> None:
        self.page, self.at, self.host = self.page[rows], self.at[rows], self.host[rows]

    def sorted(self) -> np.ndarray:
        """Sort by host and first tokens; the key of each suffix's interval, that
        is of all suffixes of the host with which it shares these tokens."""
        columns = [self.host, *(self.hashes[self.at + k] for k in range(self.n))]
        order = np.lexsort(columns[::-1])
        new = np.ones(len(order), dtype=bool)
        if len(order):
            new[1:] = False
            for x in columns:
                new[1:] |= x[order[1:]] != x[order[:-1]]  # the common prefix is shorter
        self.only(order)
        head = np.flatnonzero(new)
        keys = hs.mix(self._grams(self.at[head], self.n) ^ self.host[head])
        return keys[np.cumsum(new) - 1]


class _Entries:
    """Distinct keys of a batch by bucket, with the number of distinct pages
    that have each: all, inside a main element, and outside of it."""

    def __init__(self, s: _Suffixes, key: np.ndarray, buckets: int, inside: np.ndarray | None = None, outside: np.ndarray | None = None):
        self.keys, which = np.unique(key, return_inverse=True)
        pairs, pair = np.unique(which * len(s.size) + s.page, return_inverse=True)
        of, page = np.divmod(pairs, max(len(s.size), 1))
        count = s.counts[page]
        self.size = np.zeros(len(self.keys), dtype=np.int64)
        self.size[of] = s.size[page]

        def pages(flag):
            if flag is None:
                return np.zeros(len(self.keys), dtype=np.int64)
            return np.bincount(of, (np.bincount(pair, flag, len(pairs)) > 0) & count, len(self.keys)).astype(np.int64)
        columns = [pages(np.ones(len(key))), pages(inside), pages(outside), self.size]
        bucket = (self.keys % np.uint64(buckets)).astype(np.int64)
        self.order = np.lexsort((self.keys, self.size, bucket))
        self.which = which
        cut = np.searchsorted(bucket[self.order], np.arange(buckets + 1))
        self.rows = []
        for b in np.flatnonzero(np.diff(cut)).tolist():
            at = self.order[cut[b]:cut[b + 1]]
            self.rows.append((b, self.keys[at].tobytes(), *(x[at].astype(np.uint32).tobytes() for x in columns)))

    def codes(self, answers: list | None) -> np.ndarray:
        """The buckets' answers, one for each key passed in."""
        code = np.zeros(len(self.keys), dtype=np.uint8)
        if len(code):
            code[self.order] = np.frombuffer(b"".join(a["codes"] for a in sorted(answers, key=lambda a: a["bucket"])), dtype=np.uint8)
        return code[self.which]


def _answer(least: int, share: float, most: float):
    """For each key sent: 1 if it is repeated on its host, plus 2 if on most
    pages both inside and outside of main elements."""
    def run(group: pa.Table) -> pa.Table:
        raw = {k: group.column(k).to_pylist() for k in ("keys", "n", "inside", "outside", "size")}
        keys = np.frombuffer(b"".join(raw["keys"]), dtype=np.uint64)
        n, inside, outside, size = (np.frombuffer(b"".join(raw[k]), dtype=np.uint32) for k in ("n", "inside", "outside", "size"))
        order = np.argsort(keys, kind="stable")
        new = np.ones(len(keys), dtype=bool)
        new[1:] = keys[order[1:]] != keys[order[:-1]]
        start = np.flatnonzero(new)
        total = lambda x: np.add.reduceat(x[order].astype(np.int64), start)
        n, inside, outside, size = total(n), total(inside), total(outside), size[order][start]
        often = (n >= least) & (n >= share * size)
        template = often & (np.minimum(inside, outside) >= np.maximum(least, most * size))
        code = np.empty(len(keys), dtype=np.uint8)
        code[order] = (often + 2 * template)[np.cumsum(new) - 1]
        cut = np.cumsum([len(x) // 8 for x in raw["keys"]])[:-1]
        return pa.table({"uid": group.column("uid"), "bucket": group.column("bucket"),
                         "codes": pa.array([x.tobytes() for x in np.split(code, cut)], pa.binary())})
    return run


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Host and hash of the stream of each page."""
    for batch in batches:
        for uid, raw in zip(batch.column("uid").to_pylist(), batch.column("pages").to_pylist()):
            own = _Batch(raw)
            same = np.array([_hash(t) for t in own.texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([uid] * len(same), pa.int64()), pa.array(range(len(same)), pa.int32()), pa.array(own.hosts, pa.string()), pa.array(same)],
                names=["uid", "place", "host", "same"])


_SENT = "bucket int, uid bigint, keys binary, n binary, inside binary, outside binary, size binary"


def _send(uid: int, entries: _Entries) -> pa.RecordBatch:
    columns = list(zip(*entries.rows)) or [()] * 6
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int32()), pa.array([uid] * len(entries.rows), pa.int64()), *(pa.array(x, pa.binary()) for x in columns[1:])],
        names=["bucket", "uid", "keys", "n", "inside", "outside", "size"])


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _seeds(run_length: int, least: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in _rows(batch):
                s = _Suffixes(_Batch(x["pages"]), x["hosts"], x["firsts"], run_length, least)
                yield _send(x["uid"], _Entries(s, s.seeds(), buckets))
    return run


def _intervals(x: dict, run_length: int, least: int, buckets: int):
    """The batch, its suffixes with a repeated seed, sorted, and their intervals."""
    own = _Batch(x["pages"])
    s = _Suffixes(own, x["hosts"], x["firsts"], run_length, least)
    seeds = s.seeds()
    s.only(np.flatnonzero(_Entries(s, seeds, buckets).codes(x["seeds"]) & 1))
    key = s.sorted()
    first, kept, page = own.blocks_of()
    main = kept & own.decided[page]
    total = lambda flag: np.concatenate(([0], np.cumsum(np.repeat(flag, np.diff(first)))))
    whole = lambda flag: np.subtract(*(total(flag)[s.at + k] for k in (run_length, 0))) == run_length
    return own, s, _Entries(s, key, buckets, whole(main), whole(~kept))


def _suffixes(run_length: int, least: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in _rows(batch):
                yield _send(x["uid"], _intervals(x, run_length, least, buckets)[2])
    return run


def _keep(run_length: int, least: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in _rows(batch):
                own, s, entries = _intervals(x, run_length, least, buckets)
                code = entries.codes(x["runs"])

                def covered(flag):
                    edge = np.zeros(len(s.hashes) + 1, dtype=np.int64)
                    at = s.at[(code & flag) > 0]
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + run_length, -1)
                    return np.cumsum(edge)[:-1] > 0
                first, kept, page = own.blocks_of()
                often, template = covered(1), np.concatenate(([0], np.cumsum(covered(2))))
                template = template[first[1:]] - template[first[:-1]] == np.diff(first)  # blocks as a whole
                block, out = np.searchsorted(page, np.arange(len(own.blocks) + 1)), []
                for i, texts in enumerate(own.blocks):
                    lo, hi = block[i], block[i + 1]
                    if own.decided[i]:
                        left = kept[lo:hi] & ~template[lo:hi]
                        out.append(" ".join(texts[j] for j in np.flatnonzero(left if left.any() else kept[lo:hi])))
                    else:
                        left = np.repeat(kept[lo:hi], np.diff(first[lo:hi + 1])) & ~often[first[lo]:first[hi]]
                        words = own.texts[i].split(" ")
                        out.append(" ".join(words[j] for j in np.flatnonzero(left)))
                yield pa.RecordBatch.from_arrays([own.page_id, own.url, pa.array(out, pa.string())], names=["page_id", "url", "text"])
    return run


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html",
              run_length: int = RUN, least_pages: int = PAGES, least_share: float = SHARE, most: float = MOST) -> DataFrame:
    """``page_id, url, text`` of each page."""
    spark = pages.sparkSession
    rows = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{source}`").alias("html"))
    size = rows.agg(F.sum(F.octet_length("html")).alias("n")).first()["n"] or 0
    buckets = max(2, -(-size // BUCKET))
    name = f"pages_{uuid.uuid4().hex}"
    rows.mapInArrow(_parse(min(WIDE, max(BATCH, 8192 * buckets))), "uid bigint, pages binary").write.bucketBy(buckets, "uid").option(
        "path", f"{c.shared_dir(spark).rstrip('/')}/{name}").option("compression", "none").saveAsTable(name)
    packed = spark.table(name)
    streams = c.stage(packed.mapInArrow(_streams, "uid bigint, place int, host string, same bigint"), "streams")
    distinct = c.stage(streams.groupBy("host", "same").agg(F.min(F.struct("uid", "place")).alias("at")), "distinct")
    sizes = distinct.groupBy("host").agg(F.count("*").alias("pages"))
    hosts = streams.select("uid", "host").distinct().join(sizes, "host").groupBy("uid").agg(F.collect_list(F.struct("host", "pages")).alias("hosts"))
    firsts = distinct.groupBy(F.col("at.uid").alias("uid")).agg(F.collect_list("at.place").alias("firsts"))
    # the answers move to the batches by number at every size, the texts stay
    own = packed.join(c.stage(hosts.join(firsts, "uid", "left"), "hosts").hint("merge"), "uid")

    def told(sent: DataFrame, name: str) -> DataFrame:
        answers = sent.groupBy("bucket").applyInArrow(_answer(least_pages, least_share, most), "uid bigint, bucket int, codes binary")
        return c.stage(answers.groupBy("uid").agg(F.collect_list(F.struct("bucket", "codes")).alias(name)), name)
    args = run_length, least_pages, buckets
    own = own.join(told(own.mapInArrow(_seeds(*args), _SENT), "seeds").hint("merge"), "uid", "left")
    own = own.join(told(own.mapInArrow(_suffixes(*args), _SENT), "runs").hint("merge"), "uid", "left")
    return own.mapInArrow(_keep(*args), "page_id bigint, url string, text string")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(c.table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))
