"""Token counts by a linear longest-match automaton.

The vocabulary is a byte trie. A node has a failure link and the number of
pieces that are popped on the way to it: at a node whose string is a piece,
one piece is popped and matching goes on from the root; at any other node the
pieces of its parent are popped and the parent's links are followed until the
last byte fits. Reading a word thus takes a number of steps linear in its
length and gives the number of greedy longest-match pieces without building
one. A word is matched with a space before it, the word-initial form of
byte-level vocabularies. Every single byte should be a piece; a byte that no
piece starts with counts as one piece.

The automaton is built once on the driver from the vocabulary file (a
parameter, at most ``MOST_PIECES`` pieces) and broadcast. Tasks run it over the
distinct words of about a megabyte of text at a time, all words in step and
long words in segments.

Defined cases: null and empty texts have no words and no tokens; repeated rows
are counted each; an empty table gives an empty result; extra columns pass
through, one named like an output column is replaced.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from . import common as c
from . import hashing as hs

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MOST_PIECES = 1_000_000
#: Bytes of a word that are read one after the other.
SEGMENT = 512


def read_pieces(path: str) -> list[bytes]:
    """Pieces of a rank file: base64 of the bytes, then the rank."""
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f if line.strip()]


def automaton(pieces: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``row`` of each node in ``child`` (row 0: no children), ``child``
    (0: none), ``fail`` and ``pops``. Node 0 is the root."""
    pieces = [p for p in pieces if p]
    if len(pieces) > MOST_PIECES:
        raise ValueError(f"over {MOST_PIECES} pieces")
    edges: list[dict[int, int]] = [{}]
    whole = {0: False}
    for piece in [*pieces, *(bytes([b]) for b in range(256))]:
        at = 0
        for b in piece:
            nxt = edges[at].get(b)
            if nxt is None:
                nxt = edges[at][b] = len(edges)
                edges.append({})
            at = nxt
        whole[at] = True
    fail = np.zeros(len(edges), dtype=np.int32)
    pops = np.zeros(len(edges), dtype=np.int32)
    level = [0]
    while level:  # by depth: a link leads to a smaller depth
        below = []
        for u in level:
            for b, v in edges[u].items():
                below.append(v)
                if whole.get(v):
                    pops[v] = 1
                    continue
                n, z = pops[u], fail[u]
                while b not in edges[z]:
                    n, z = n + pops[z], fail[z]
                pops[v], fail[v] = n, edges[z][b]
        level = below
    inner = [i for i, e in enumerate(edges) if e]
    row = np.zeros(len(edges), dtype=np.int32)
    row[inner] = np.arange(1, len(inner) + 1)
    child = np.zeros((len(inner) + 1, 256), dtype=np.int32)
    for i in inner:
        child[row[i], list(edges[i])] = list(edges[i].values())
    return row, child, fail, pops


def _step(machine: tuple, at: np.ndarray, byte: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The next nodes; popped pieces are added to ``count``."""
    row, child, fail, pops = machine
    to = child[row[at], byte]
    miss = np.flatnonzero(to == 0)
    at = at.copy() if len(miss) else at
    while len(miss):
        stuck = at[miss]
        count[miss] += pops[stuck]
        at[miss] = fail[stuck]
        to[miss] = child[row[at[miss]], byte[miss]]
        miss = miss[to[miss] == 0]
    return to


def _mend(machine: tuple, data: np.ndarray, lo, size, number, todo, last, total):
    """Read the segments ``todo``, whose predecessors end elsewhere than they
    were read from, and on from there while the ends change: one byte after
    the other, equal segments from equal nodes only once."""
    row, child, fail, pops = map(memoryview, machine)
    known: dict[tuple[bytes, int], tuple[int, int]] = {}
    done = -1
    for s in todo.tolist():
        while done < s < len(number) and number[s] > 0:
            done = s
            key = data[lo[s]:lo[s] + size[s]].tobytes(), int(last[s - 1])
            if key not in known:
                n, at = 0, key[1]
                for b in key[0]:
                    to = child[row[at], b]
                    while to == 0:
                        n, at = n + pops[at], fail[at]
                        to = child[row[at], b]
                    at = to
                known[key] = at, n
            end, total[s] = known[key]
            if end == last[s]:
                break
            last[s] = end
            s += 1


def piece_counts(machine: tuple, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Pieces of each word data[start:end] after a space.

    Words are read in step, a byte of each at a time. A long word is cut into
    segments of ``SEGMENT`` bytes that are read side by side, as if each began
    at the root. Then every segment is read again from the node that its
    predecessor really ended at, until it meets the first reading at the same
    byte, from where on both are one, a few bytes nearly always; what does not
    meet is read one after the other."""
    row, child, fail, pops = machine
    length = end - start
    many = np.maximum(-(-length // SEGMENT), 1)
    word = np.repeat(np.arange(len(start)), many)
    number = np.arange(len(word)) - np.repeat(np.cumsum(many) - many, many)
    lo = start[word] + number * SEGMENT
    size = np.minimum(end[word] - lo, SEGMENT)
    order = np.argsort(-size, kind="stable")  # a step takes a prefix
    n_at = [int(np.searchsorted(-size[order], -j, side="left")) for j in range(int(size.max()) if len(size) else 0)]
    state = np.where(number[order] == 0, child[row[0], 32], 0).astype(np.int32)
    count = np.zeros(len(word), dtype=np.int64)
    several = bool((many > 1).any())
    seen: list[tuple[np.ndarray, np.ndarray]] = []  # nodes and counts after each byte
    for j, n in enumerate(n_at):
        state[:n] = _step(machine, state[:n], data[lo[order[:n]] + j], count[:n])
        if several:
            seen.append((state[:n].copy(), count[:n].copy()))
    last, total = np.empty_like(state), np.empty_like(count)
    last[order], total[order] = state, count
    if several:
        place = np.empty(len(word), dtype=np.int64)
        place[order] = np.arange(len(word))
        whole = total.copy()
        todo = np.flatnonzero(number > 0)
        at, extra = last[todo - 1].copy(), np.zeros(len(todo), dtype=np.int64)
        before = last[todo].copy()
        open_ = np.flatnonzero(at != 0)  # the first reading began at the root
        for j in range(SEGMENT):
            over = open_[size[todo[open_]] <= j]
            total[todo[over]], last[todo[over]] = extra[over], at[over]
            open_ = open_[size[todo[open_]] > j]
            if not len(open_):
                break
            own, more = todo[open_], extra[open_]
            at[open_] = _step(machine, at[open_], data[lo[own] + j], more)
            extra[open_] = more
            nodes, counts = seen[j]
            met = nodes[place[own]] == at[open_]
            total[own[met]] = extra[open_[met]] + whole[own[met]] - counts[place[own[met]]]
            open_ = open_[~met]
        total[todo[open_]], last[todo[open_]] = extra[open_], at[open_]
        _mend(machine, data, lo, size, number, todo[last[todo] != before] + 1, last, total)
    out = np.bincount(word, weights=total, minlength=len(start)).astype(np.int64)
    state = last[np.cumsum(many) - 1]
    left = np.flatnonzero(state)
    while len(left):
        out[left] += pops[state[left]]
        state[left] = fail[state[left]]
        left = left[state[left] != 0]
    return out


def _counter(machine, keep: list[str], text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(text).cast(pa.binary()).to_pylist()]
            n_words, n_tokens = np.zeros((2, len(texts)), dtype=np.int64)
            for lo, hi in hs.chunks(texts):
                data = np.frombuffer(b" ".join(texts[lo:hi]) + b" ", dtype=np.uint8)
                start, end = hs.runs(hs.NOT_SPACE[data])
                _, one, which = np.unique(hs.substrings(hs.prefix(data), start, end), return_index=True, return_inverse=True)
                pieces = piece_counts(machine.value, data, start[one], end[one])[which]
                bounds = np.cumsum([0] + [len(t) + 1 for t in texts[lo:hi]])
                owner = np.searchsorted(bounds, start, side="right") - 1
                n_words[lo:hi] = np.bincount(owner, minlength=hi - lo)
                n_tokens[lo:hi] = np.bincount(owner, weights=pieces, minlength=hi - lo)
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in keep] + [pa.array(n_words), pa.array(n_tokens)],
                                             names=[*keep, "n_words", "n_tokens"])
    return run


def count_tokens(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all but the text) with ``n_words`` and ``n_tokens``."""
    machine = docs.sparkSession.sparkContext.broadcast(automaton(read_pieces(vocabulary)))
    keep = [x for x in (docs.columns if keep is None else keep) if x != text and x.lower() not in ("n_words", "n_tokens")]
    fields = [docs.schema[k] for k in keep]
    out = StructType([*fields, StructField("n_words", LongType()), StructField("n_tokens", LongType())])
    return docs.select(*[F.col(f"`{x}`") for x in [*keep, text]]).mapInArrow(_counter(machine, keep, text), out)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(c.table(spark, sf_dir, "documents"), keep=["doc_id"])
