"""Language of texts: scripts narrow the candidates, Viterbi labels the words.

A word is a run of letters (and marks) of one script. Its script leaves the
languages whose labelled texts use that script; a letter-gram model gives each
of them a score: the logarithms, in thousandths and whole numbers, of the
shares that the word's 2-, 3- and 4-grams (the word's ends are part of them)
have in the language. Viterbi with a penalty for each switch then labels the
words of a text, so a text in several languages comes out as spans. A text's
language is the one with most letters in its spans.

Learning counts the grams of all labelled rows: each task counts its distinct
words into ``GRAMS`` hashed bins of each language, the counts are summed by a
shuffle, and one row of ``GRAMS`` scores a language reaches the driver and the
tasks: its size is bounded by the number of languages (at most
``MOST_LANGUAGES``), whatever the corpus.

Texts are labelled in chunks of about a megabyte, all in step: a text is cut
into segments, the best scores from every label to every label of a segment
give the scores at its start (max-plus products), and the segments are then
labelled side by side. The result is that of one pass over the whole text.

Defined cases: null texts and texts without a letter give ``und``, score 0 and
no spans; without any labelled row every text does. Ties go to the language
that sorts first. Repeated rows count each, in learning too. Extra columns
pass through unless an output column has their name.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from . import common as c
from . import hashing as hs

#: Lengths of the grams, and hashed bins for each length.
LENGTHS = (2, 3, 4)
BINS = 1 << 15
GRAMS = BINS * len(LENGTHS)
#: Added to each gram's count.
SMOOTH = 0.5
#: Thousandths of a logarithm that a switch costs.
SWITCH = 10_000
#: A script's languages hold at least this share of their own letters in it.
SCRIPT_SHARE = 0.02
#: A word's score in a language that does not use its script, below its worst candidate.
STRANGE = 20_000
MOST_LANGUAGES = 1000
#: Words of a segment.
SEGMENT = 128
NONE = "und"

# Code point ranges of scripts (Unicode blocks). Letters outside form one more script.
SCRIPTS = (
    ("latin", (0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)),
    ("greek", (0x370, 0x3FF), (0x1F00, 0x1FFF)),
    ("cyrillic", (0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)),
    ("armenian", (0x530, 0x58F)),
    ("hebrew", (0x590, 0x5FF)),
    ("arabic", (0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)),
    ("devanagari", (0x900, 0x97F)),
    ("bengali", (0x980, 0x9FF)),
    ("gurmukhi", (0xA00, 0xA7F)),
    ("gujarati", (0xA80, 0xAFF)),
    ("tamil", (0xB80, 0xBFF)),
    ("telugu", (0xC00, 0xC7F)),
    ("kannada", (0xC80, 0xCFF)),
    ("malayalam", (0xD00, 0xD7F)),
    ("thai", (0xE00, 0xE7F)),
    ("georgian", (0x10A0, 0x10FF)),
    ("hangul", (0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)),
    ("ethiopic", (0x1200, 0x137F)),
    ("khmer", (0x1780, 0x17FF)),
    ("kana", (0x3040, 0x30FF), (0x31F0, 0x31FF)),
    ("han", (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)),
)
OTHER = len(SCRIPTS) + 1
_MARK = 255


def letter_tables() -> tuple[np.ndarray, np.ndarray]:
    """For each code point its script (0: no letter, 255: a mark, which goes
    with the letter before it), and its lower-case code point."""
    n = 0x110000
    script, lower = np.zeros(n, dtype=np.uint8), np.arange(n, dtype=np.uint32)
    for i in range(n):
        kind = unicodedata.category(chr(i))
        if kind[0] == "L":
            script[i] = OTHER
            low = chr(i).lower()
            if len(low) == 1:
                lower[i] = ord(low)
        elif kind[0] == "M":
            script[i] = _MARK
    for k, (_, *ranges) in enumerate(SCRIPTS, 1):
        for a, z in ranges:
            part = script[a:z + 1]
            part[part == OTHER] = k
    return script, lower


class Words:
    """The words of a chunk of texts."""

    def __init__(self, texts: list[str], tables: tuple[np.ndarray, np.ndarray]):
        script, lower = tables
        points = np.frombuffer("\n".join(texts).encode("utf-32-le"), dtype=np.uint32)
        kind = script[points]
        # a mark takes the kind of what stands before it
        at = np.maximum.accumulate(np.where(kind == _MARK, 0, np.arange(len(kind)))) if len(kind) else np.zeros(0, dtype=np.int64)
        kind = np.where(kind[at] == _MARK, 0, kind[at]) if len(kind) else kind
        edge = np.flatnonzero(np.diff(np.concatenate(([0], kind, [0])).astype(np.int16)))
        start, end = edge[:-1], edge[1:]
        mine = kind[start] > 0 if len(start) else np.zeros(0, dtype=bool)
        self.start, self.end = start[mine], end[mine]
        self.script = kind[self.start].astype(np.int64)
        self.base = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
        self.text = np.searchsorted(self.base, self.start, side="right") - 1
        points = lower[points]
        key = hs.substrings(hs.prefix(points), self.start, self.end)
        _, self.one, self.which = np.unique(key, return_index=True, return_inverse=True)
        self._points = points

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """(distinct word, bin) of every gram of every distinct word."""
        s, n = self.start[self.one], (self.end - self.start)[self.one]
        to = np.cumsum(n + 1) - n  # places after a leading 0, words apart by one 0
        flat = np.zeros(int((n + 1).sum()) + 1, dtype=np.uint64)
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        flat[np.repeat(to, n) + step] = self._points[np.repeat(s, n) + step]
        owner = np.cumsum(flat == 0) - 1
        words, bins = [], []
        for k, length in enumerate(LENGTHS):
            m = len(flat) - length + 1
            if m <= 0:
                continue
            code, whole = np.zeros(m, dtype=np.uint64), np.ones(m, dtype=bool)
            for j in range(length):
                code = code * np.uint64(hs.P) + flat[j:j + m] + np.uint64(1)
                if 0 < j < length - 1:
                    whole &= flat[j:j + m] != 0
            words.append(owner[:m][whole])
            bins.append((hs.mix(code[whole]) >> np.uint64(49)).astype(np.int64) + k * BINS)
        none = np.zeros(0, dtype=np.int64)
        return np.concatenate(words or [none]), np.concatenate(bins or [none])


def _chunks(batch: pa.RecordBatch, text: str) -> Iterator[tuple[int, int, list[str]]]:
    texts = [t or "" for t in batch.column(text).to_pylist()]
    for lo, hi in hs.chunks(texts):
        yield lo, hi, texts[lo:hi]


_COUNT = StructType([StructField("lang", StringType()), StructField("bin", LongType()), StructField("n", LongType())])
_ROW = StructType([StructField("lang", StringType()), StructField("scores", ArrayType(LongType())),
                   StructField("letters", ArrayType(LongType()))])


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(language, scores of its grams, its letters by script) of the rows with
    a text and a language, in the order of languages."""
    sc = docs.sparkSession.sparkContext
    tables = sc.broadcast(letter_tables())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            for lo, hi, texts in _chunks(batch, "text"):
                words = Words(texts, tables.value)
                owner, bins = words.grams()
                own = langs[lo:hi][words.text] if len(words.text) else np.zeros(0, dtype=object)
                for name in set(own.tolist()):
                    mine = own == name
                    times = np.bincount(words.which[mine], minlength=len(words.one))
                    got = seen.setdefault(name, np.zeros(GRAMS + OTHER + 1, dtype=np.int64))
                    got[:GRAMS] += np.bincount(bins, weights=times[owner], minlength=GRAMS).astype(np.int64)
                    got[GRAMS:] += np.bincount(words.script[mine], weights=(words.end - words.start)[mine],
                                               minlength=OTHER + 1).astype(np.int64)
        for name, counts in seen.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(counts[at])],
                                             names=["lang", "bin", "n"])

    def scores(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros(GRAMS + OTHER + 1)
        counts[rows["bin"].to_numpy()] = rows["n"].to_numpy()
        grams = counts[:GRAMS].reshape(len(LENGTHS), BINS) + SMOOTH
        logs = np.log(grams / grams.sum(axis=1, keepdims=True)) * 1000 / len(LENGTHS)
        return pd.DataFrame({"lang": [key[0]], "scores": [np.rint(logs).astype(np.int64).ravel()],
                             "letters": [counts[GRAMS:].astype(np.int64)]})

    rows = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang")).where(
        "text IS NOT NULL AND lang IS NOT NULL").mapInArrow(count, _COUNT)
    model = rows.groupBy("lang", "bin").agg(F.sum("n").alias("n")).groupBy("lang").applyInPandas(scores, _ROW)
    out = model.limit(MOST_LANGUAGES + 1).collect()
    if len(out) > MOST_LANGUAGES:
        raise ValueError(f"over {MOST_LANGUAGES} languages")
    return sorted(((r["lang"], np.array(r["scores"]), np.array(r["letters"])) for r in out), key=lambda r: r[0])


def segments(text: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word, words and number within the text of every segment, in
    order; ``text`` is the (sorted) text of each word."""
    first = np.searchsorted(text, np.arange(n_texts + 1))
    many = -(-np.diff(first) // SEGMENT)
    owner = np.repeat(np.arange(n_texts), many)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    start = first[:-1][owner] + number * SEGMENT
    return owner, start, np.minimum(first[1:][owner] - start, SEGMENT), number


def viterbi(score: np.ndarray, text: np.ndarray, n_texts: int, switch: int = SWITCH) -> np.ndarray:
    """The best label of each word: ``score`` (words x labels, whole numbers),
    ``text`` the text of each word, in order."""
    n_labels = score.shape[1]
    owner, start, length, number = segments(text, n_texts)
    label = np.zeros(len(text), dtype=np.int64)
    if not len(owner):
        return label
    by = np.argsort(-length, kind="stable")  # long ones first: a step takes a prefix
    steps = [int(np.searchsorted(-length[by], -j, side="left")) for j in range(int(length.max()))]
    # best scores from each label before a segment to each label of its last word
    far = np.full((len(by), n_labels, n_labels), -(1 << 60), dtype=np.int64)
    far[:, np.arange(n_labels), np.arange(n_labels)] = 0
    for j, n in enumerate(steps):
        v = far[:n]
        np.maximum(v, v.max(axis=2, keepdims=True) - switch, out=v)
        v += score[start[by[:n]] + j][:, None, :]
    through = np.empty_like(far)
    through[by] = far
    # scores before each segment, one segment of each text at a time
    before = np.zeros((len(owner), n_labels), dtype=np.int64)
    after = np.empty_like(before)
    for k in range(int(number.max()) + 1):
        at = np.flatnonzero(number == k) if k == 0 else at[number[np.minimum(at + 1, len(owner) - 1)] == k] + 1
        if k:
            before[at] = after[at - 1]
        after[at] = (before[at][:, :, None] + through[at]).max(axis=1)
    # inside the segments: the label before each word, given the word's label
    back = np.empty((len(steps), len(by), n_labels), dtype=np.int32)
    v = before[by].copy()
    own = np.arange(n_labels)
    for j, n in enumerate(steps):
        best = v[:n].argmax(axis=1)[:, None]
        jump = np.take_along_axis(v[:n], best, axis=1) - switch
        stay = v[:n] >= jump
        back[j, :n] = np.where(stay, own, best)
        v[:n] = np.where(stay, v[:n], jump) + score[start[by[:n]] + j]
    # labels of each word by the label that its segment ends with
    path = np.empty((len(steps), len(by), n_labels), dtype=np.int32)
    now = np.broadcast_to(own.astype(np.int32), (len(by), n_labels)).copy()
    for j in range(len(steps) - 1, -1, -1):
        n = steps[j]
        path[j, :n] = now[:n]
        now[:n] = np.take_along_axis(back[j, :n], now[:n], axis=1)
    entry = np.empty_like(now)
    entry[by] = now
    place = np.empty(len(by), dtype=np.int64)
    place[by] = np.arange(len(by))
    # the last segment ends with its best label, each other one with the label that the next one starts from
    last = np.flatnonzero(np.append(owner[1:] != owner[:-1], True))
    ends = np.zeros(len(owner), dtype=np.int64)
    ends[last] = after[last].argmax(axis=1)
    at = last
    while True:
        at = at[number[at] > 0]
        if not len(at):
            break
        ends[at - 1] = entry[at, ends[at]]
        at = at - 1
    which = np.repeat(np.arange(len(owner)), length)
    step = np.arange(len(text)) - np.repeat(start, length)
    return path[step, place[which], ends[which]].astype(np.int64)


def _speaker(keep: list[str], text: str, tables, model, switch: int):
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])

    def chunk(texts: list[str]):
        langs, scores, letters = model.value
        words = Words(texts, tables.value)
        share = letters / np.maximum(letters.sum(axis=1, keepdims=True), 1)
        spoken = share >= SCRIPT_SHARE                       # language x script
        here = np.unique(words.script)
        lang = np.flatnonzero(spoken[:, here].any(axis=1)) if len(here) else np.zeros(0, dtype=np.int64)
        if not len(lang) and len(langs):
            lang = np.arange(len(langs))
        names = [langs[i] for i in lang]
        letter = np.bincount(words.text, weights=words.end - words.start, minlength=len(texts))
        if not len(lang) or not len(words.text):
            return [NONE] * len(texts), np.zeros(len(texts)), [[] for _ in texts]
        owner, bins = words.grams()
        each = np.stack([np.bincount(owner, weights=scores[i][bins], minlength=len(words.one)) for i in lang], axis=1)
        known = spoken[lang][:, words.script[words.one]].T   # distinct word x language
        worst = np.where(known, each, np.inf).min(axis=1, keepdims=True)
        each = np.where(known, each, np.where(np.isfinite(worst), worst - STRANGE, 0))
        score = each.astype(np.int64)[words.which]
        label = viterbi(score, words.text, len(texts), switch)
        size = (words.end - words.start).astype(np.float64)
        held = np.bincount(words.text * len(lang) + label, weights=size, minlength=len(texts) * len(lang)).reshape(len(texts), -1)
        best = held.argmax(axis=1)
        # certainty of the whole text's scores, times the share of its letters
        total = np.stack([np.bincount(words.text, weights=score[:, i], minlength=len(texts)) for i in range(len(lang))], axis=1)
        total = np.exp((total - total.max(axis=1, keepdims=True)) / 1000)
        sure = total / total.sum(axis=1, keepdims=True)
        row = np.arange(len(texts))
        own = held[row, best] / np.maximum(letter, 1)
        several = (held > 0).sum(axis=1) > 1  # the shares of a mixed text are its certainty
        value = np.where(several, own, sure[row, best])
        pred = [names[b] if n else NONE for b, n in zip(best.tolist(), letter.tolist())]
        # neighbouring words with one label form a span
        head = np.concatenate(([True], (label[1:] != label[:-1]) | (words.text[1:] != words.text[:-1])))
        tail = np.append(head[1:], True)
        t = words.text[head]
        spans: list[list] = [[] for _ in texts]
        for i, a, z, b in zip(t.tolist(), (words.start[head] - words.base[t]).tolist(),
                              (words.end[tail] - words.base[t]).tolist(), label[head].tolist()):
            spans[i].append({"start": a, "end": z, "lang": names[b]})
        return pred, np.where(letter > 0, value, 0.0), spans

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in _chunks(batch, text):
                pred, value, spans = chunk(texts)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k).slice(lo, hi - lo) for k in keep], pa.array(pred, pa.string()),
                     pa.array(value, pa.float64()), pa.array(spans, type=pa.list_(span))],
                    names=[*keep, "lang_pred", "score", "lang_spans"])
    return run


SPAN = StructType([StructField("start", LongType()), StructField("end", LongType()), StructField("lang", StringType())])


def label_languages(docs: DataFrame, model: list[tuple[str, np.ndarray, np.ndarray]], text: str = "text",
                    keep: list[str] | None = None, switch: int = SWITCH) -> DataFrame:
    """The columns ``keep`` (all but the text) with ``lang_pred``, ``score`` (0
    to 1) and ``lang_spans``: code points (end exclusive) and language of each
    stretch of words in one language."""
    sc = docs.sparkSession.sparkContext
    names = [m[0] for m in model]
    arrays = sc.broadcast((names, np.stack([m[1] for m in model]).astype(np.int32) if model else np.zeros((0, GRAMS), dtype=np.int32),
                           np.stack([m[2] for m in model]).astype(np.float64) if model else np.zeros((0, OTHER + 1))))
    tables = sc.broadcast(letter_tables())
    keep = [x for x in (docs.columns if keep is None else keep) if x != text and x.lower() not in ("lang_pred", "score", "lang_spans")]
    out = StructType([*[docs.schema[k] for k in keep], StructField("lang_pred", StringType()), StructField("score", DoubleType()),
                      StructField("lang_spans", ArrayType(SPAN))])
    return docs.select(*[F.col(f"`{x}`") for x in [*keep, text]]).mapInArrow(_speaker(keep, text, tables, arrays, switch), out)


def held_out(doc_id: str = "doc_id"):
    """One document in five by the checksum of its id's text (null: of the empty text)."""
    return F.crc32(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))) % 5 == 0


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = c.table(spark, sf_dir, "documents")
    model = learn(docs.where(~held_out()))
    return label_languages(docs, model, keep=["doc_id"]).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", F.size("lang_spans").cast("long").alias("n_spans"))
