"""Line deduplication by winnowed line hashes (native DataFrame functions only).

The lines of a document that have a word are hashed in order. A run of lines
that stands in two places goes where it stands later in corpus order (document
id, then text, then line), if it has ``min_run`` lines or ``min_words`` words:
a single long line is a run too. Such a run is covered by windows of
``min_run`` lines, or by a window of fewer lines that has ``min_words`` words.

Winnowing: a line is a fingerprint if it has the smallest hash (the last one of
equals) of some window, so equal runs share a fingerprint at the same offset,
and each selected line is one row, with the hashes of the windows it is the
minimum of. Fingerprints that occur in one place only are dropped. From the
others the match is extended to both sides: over each of the line's windows,
whose hashes are compared with the earliest place that has the same, never with
all of them. As windows overlap, a run of any length is followed to its ends.

Defined cases: null texts and lines without a word are kept as they are and
take no part; documents without a window lose nothing; a null document id comes
after all others; rows with equal id and text are one document and get one
result each; an empty table gives an empty result; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

MIN_RUN = 3
MIN_WORDS = 50


def _minima(docs: DataFrame, text: str, doc_id: str, w: int, words: int) -> DataFrame:
    """A row for each selected line: its place, its hash ``fp``, the windows it
    is the minimum of (offset in the window, length, two hashes) and the
    numbers of the lines around it."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    df = docs.select(
        F.col(f"`{doc_id}`").isNull().alias("no_id"), F.coalesce(F.col(f"`{doc_id}`"), F.lit(0)).alias("id"),
        c.text_key(F.col(f"`{text}`")).alias("dk"), F.split(body, "\n").alias("lines"))
    df = df.withColumn("lines", F.filter(
        F.transform(F.col("lines"), lambda x, j: F.struct(j.alias("n"), x.alias("s"))),
        lambda x: x["s"].rlike(c.WORD)))
    df = df.where(F.size("lines") > 0).withColumn("lines", F.transform("lines", lambda x: F.struct(
        x["n"].alias("n"), F.xxhash64(x["s"]).alias("h"), F.xxhash64(x["s"], F.lit(w)).alias("g"), F.size(c.word_array(x["s"])).alias("k"))))
    df = df.select("no_id", "id", "dk", "lines", F.posexplode(F.col("lines")).alias("i", "line"))
    near = {d: F.get("lines", F.col("i") + d) for d in range(1 - w, w)}
    df = df.select("no_id", "id", "dk", "i", F.size("lines").alias("size"), *[x.alias(f"l{d + w}") for d, x in near.items()])
    line = {d: F.col(f"l{d + w}") for d in near}
    mine = []
    for length in range(1, w + 1):
        for off in range(length):
            own = [line[d] for d in range(-off, length - off)]
            inside = (F.col("i") >= off) & (F.col("i") + (length - off) <= F.col("size"))
            least = [line[0]["h"] <= x["h"] for x in own[:off]] + [line[0]["h"] < x["h"] for x in own[off + 1:]]
            for test in least:
                inside = inside & test
            if length < w:
                total = own[0]["k"]
                for x in own[1:]:
                    total = total + x["k"]
                inside = inside & (total >= words)
            mine.append(F.when(inside, F.struct(F.lit(off).alias("off"), F.lit(length).alias("len"),
                                                F.xxhash64(*[x["h"] for x in own]).alias("w1"), F.xxhash64(*[x["g"] for x in own]).alias("w2"))))
    return df.select(
        F.struct("no_id", "id", "dk", "i").alias("place"), line[0]["h"].alias("fp"), F.array_compact(F.array(*mine)).alias("windows"),
        F.array(*[line[d]["n"] for d in sorted(line)]).alias("n")).where(F.size("windows") > 0)


def repeated_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                   min_run: int = MIN_RUN, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document that loses lines: ``no_id, id, dk`` (see
    :func:`remove_repeats`) and ``gone``, the numbers of those lines."""
    picked = c.stage(_minima(docs, text, doc_id, min_run, min_words), "minima")
    seeds = picked.groupBy("fp").agg(F.min("place").alias("a"), F.max("place").alias("z")).where("a < z").select("fp")
    met = picked.join(seeds, "fp", "left_semi").select("fp", "place", "n", F.inline("windows"))
    first = met.groupBy("fp", "off", "len", "w1", "w2").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    first = first.where("first < last").drop("last")
    later = met.join(first, ["fp", "off", "len", "w1", "w2"]).where(F.col("place") > F.col("first"))
    lines = F.slice("n", F.lit(min_run) - F.col("off"), F.col("len"))
    return later.select("place.no_id", "place.id", "place.dk", F.explode(lines).alias("n")).groupBy(
        "no_id", "id", "dk").agg(F.collect_set("n").alias("gone"))


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_run: int = MIN_RUN,
                   min_words: int = MIN_WORDS, counts: bool = False) -> DataFrame:
    """``docs`` with the later repeated runs of lines taken out of ``text``;
    with ``counts``, also ``n_lines`` and ``n_removed`` (long)."""
    if counts:
        docs = c.without(docs, ["n_lines", "n_removed"])
    gone = repeated_lines(docs, text, doc_id, min_run, min_words)
    names = c.fresh(docs, "_no_id", "_id", "_dk", "_gone", "_lines")
    gone = gone.toDF(*names[:4])
    t, (no_id, id_, dk, g, ls) = F.col(f"`{text}`"), names
    df = docs.withColumn(ls, c.text_key(t))
    df = df.join(gone, (F.col(ls) == F.col(dk)) & (F.col(f"`{doc_id}`").isNull() == F.col(no_id))
                 & (F.coalesce(F.col(f"`{doc_id}`"), F.lit(0)) == F.col(id_)), "left")
    df = df.withColumn(ls, F.split(t, "\n"))
    left = F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col(g))
    cut = F.array_join(F.transform(left, lambda i: F.get(F.col(ls), i)), "\n")
    out = [F.when(F.col(g).isNull(), t).otherwise(cut).alias(text) if x == text else F.col(f"`{x}`") for x in docs.columns]
    if counts:
        out += [F.when(t.isNull(), 0).otherwise(F.size(ls)).cast("long").alias("n_lines"),
                F.when(F.col(g).isNull(), 0).otherwise(F.size(g)).cast("long").alias("n_removed")]
    return df.select(*out)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = c.table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, counts=True).select("doc_id", "n_lines", "n_removed", "text")


ORACLE = r"""
WITH a AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS s, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS n FROM documents),
l AS (SELECT doc_id, n, s, row_number() OVER (PARTITION BY doc_id ORDER BY n) AS i FROM a WHERE regexp_matches(s, '[^\x20\x09-\x0D]')),
w AS (SELECT doc_id, i, s AS s0, lead(s, 1) OVER p AS s1, lead(s, 2) OVER p AS s2, k AS k0, lead(k, 1) OVER p AS k1
      FROM (SELECT *, len(regexp_extract_all(s, '[^\x20\x09-\x0D]+')) AS k FROM l) WINDOW p AS (PARTITION BY doc_id ORDER BY n)),
r AS (SELECT doc_id, i, 3 AS m, row_number() OVER (PARTITION BY s0, s1, s2 ORDER BY doc_id, i) AS k FROM w WHERE s2 IS NOT NULL
      UNION ALL SELECT doc_id, i, 2, row_number() OVER (PARTITION BY s0, s1 ORDER BY doc_id, i) FROM w WHERE k0 + k1 >= 50
      UNION ALL SELECT doc_id, i, 1, row_number() OVER (PARTITION BY s0 ORDER BY doc_id, i) FROM w WHERE k0 >= 50),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + m)) AS i FROM r WHERE k > 1),
gone AS (SELECT l.doc_id, l.n FROM g JOIN l ON g.doc_id = l.doc_id AND g.i = l.i),
kept AS (SELECT a.doc_id, string_agg(s, chr(10) ORDER BY a.n) AS t, count(*) AS k FROM a ANTI JOIN gone ON a.doc_id = gone.doc_id AND a.n = gone.n GROUP BY a.doc_id)
SELECT d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines,
       (coalesce(len(string_split(d.text, chr(10))), 0) - coalesce(k, 0))::BIGINT AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(t, '') END AS text
FROM documents d LEFT JOIN kept ON kept.doc_id = d.doc_id
"""
