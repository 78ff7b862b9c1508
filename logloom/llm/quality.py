"""Quality rules at document and host level (native DataFrame functions only).

Every document gets its statistics in one pass over its text. Rule failures are
added up by host, each host's failure rate is shrunk towards the corpus rate by
a beta prior fitted to the hosts themselves (method of moments, in whole
millionths so that every engine and every partitioning gives the same figures),
and the hosts judged bad go back to the documents by a join. Only one row per
host is shuffled, whatever the size of a host.

Defined cases: a null text counts as empty (no words, so it fails the base
rule); a null host is a host of its own; repeated rows are judged alike, each
row by itself; an empty table gives an empty result; an input column with the
name of an output column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
OUTPUT = [*STATS, "base_failed", "rule_failed", "host_rejected", "kept"]

SYMBOLS = r"[^#*$%&|<>]+"
#: Words in one window of the repetition rule.
WINDOW = 5
#: A document fails a rule of its own with more symbols than words, or with
#: over half of its lines repeated (at least MIN_DUP_LINES of them).
MIN_DUP_LINES = 4
#: A host goes if its shrunk failure rate is at least this many millionths.
HOST_LIMIT = 500_000
#: Bounds of the prior's strength, in documents.
STRENGTH = (1.0, 1000.0)
MILLION = 1_000_000


def _window_hashes(hashes: Column) -> Column:
    """A hash of each window of five words, from the hashes of the words."""
    starts = F.sequence(F.lit(1), F.size(hashes) - (WINDOW - 1))
    out = F.transform(starts, lambda i: F.xxhash64(*[F.element_at(hashes, i + k) for k in range(WINDOW)]))
    return F.when(F.size(hashes) > WINDOW, out).otherwise(F.array().cast("array<bigint>"))


def _marked(windows: Column) -> Column:
    """Window hashes with their places, sorted; empty (and not computed) for
    the texts without a repeated window."""
    marked = F.sort_array(F.transform(windows, lambda h, j: F.struct(h.alias("h"), (j + 1).alias("p"))))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), marked).otherwise(
        F.array().cast("array<struct<h:bigint,p:int>>"))


def _repeated(marked: Column) -> Column:
    """Places of the windows that have an equal one: equal neighbours when sorted."""
    hit = F.filter(marked, lambda x, j: (
        ((j > 0) & (F.get(marked, j - 1)["h"] == x["h"])) | (F.get(marked, j + 1)["h"] == x["h"])))
    return F.sort_array(F.transform(hit, lambda x: x["p"]))


def _covered(places: Column) -> Column:
    """Words that windows at these sorted places cover: each adds the words up
    to the next place, five at most."""
    return F.aggregate(
        places, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(p - a["last"], F.lit(WINDOW))).alias("n"), p.alias("last")),
        lambda a: a["n"])


def with_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the statistics of :data:`STATS` (long)."""
    docs = c.without(docs, [n for n in STATS if n.lower() != text.lower()])
    t, words, lines, marked = c.fresh(docs, "_text", "_words", "_lines", "_marked")
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    df = docs.withColumn(t, body).withColumn(words, c.word_array(F.col(t)))
    df = df.withColumn(lines, F.filter(F.split(F.col(t), "\n"), lambda x: x.rlike(c.WORD)))
    # One projection for each step: a column that several expressions use is computed once.
    df = df.withColumn(marked, F.transform(words, lambda w: F.xxhash64(w)))
    df = df.withColumn(marked, _window_hashes(F.col(marked)))
    df = df.withColumn(marked, _marked(F.col(marked)))
    df = df.withColumn(marked, _repeated(F.col(marked)))
    return df.select(
        *docs.columns,
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(t, SYMBOLS, "")).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.size(lines).cast("long").alias("_n_lines"),
        _covered(F.col(marked)).alias("n_repeat_words"),
    )


def host_rates(judged: DataFrame, host: str) -> DataFrame:
    """One row per host: documents, failures and the shrunk failure rate."""
    failed = (F.col("base_failed") | F.col("rule_failed")).cast("long")
    hosts = c.stage(judged.groupBy(F.col(f"`{host}`").alias("host")).agg(
        F.count("*").alias("n"), F.sum(failed).alias("failures")), "hosts")
    dec = "decimal(38,0)"
    # Two rows of totals at most, whatever the number of hosts.
    total = hosts.agg(F.sum("n").alias("all_n"), F.sum("failures").alias("all_f")).select(
        "all_n", F.floor(F.lit(MILLION) * F.col("all_f") / F.col("all_n")).cast("long").alias("mean"))
    rated = hosts.withColumn("rate", F.floor(F.lit(MILLION) * F.col("failures") / F.col("n")).cast("long"))
    moments = rated.join(F.broadcast(total)).agg(
        F.max("mean").alias("mean"), F.max("all_n").alias("all_n"), F.count("*").alias("hosts"),
        F.sum(F.col("n").cast(dec) * ((F.col("rate") - F.col("mean")) * (F.col("rate") - F.col("mean")))).alias("spread"))
    # n documents at the mean rate spread by mean * (1 - mean) / n, which weighs n: the same for each host
    chance = F.col("hosts").cast(dec) * (F.col("mean") * (F.lit(MILLION) - F.col("mean")))
    moments = moments.withColumn("spread", F.col("spread") - chance)
    variance = F.col("spread").cast("double") / F.col("all_n").cast("double")
    mean = F.col("mean").cast("double")
    prior = moments.select(
        "mean", F.when(F.col("spread") > 0, F.greatest(F.lit(STRENGTH[0]), F.least(
            F.lit(STRENGTH[1]), mean * (F.lit(float(MILLION)) - mean) / variance - 1.0)))
        .otherwise(F.lit(STRENGTH[1])).alias("strength"))
    return rated.join(F.broadcast(prior)).select(
        "host", "n", "failures",
        F.floor((F.col("failures").cast("double") * float(MILLION) + mean * F.col("strength"))
                / (F.col("n").cast("double") + F.col("strength"))).cast("long").alias("shrunk_rate"))


def judge(docs: DataFrame, text: str = "text", host: str = "source", keep_text: bool = True) -> DataFrame:
    """``docs`` with statistics, rule results and the verdict ``kept``;
    without the text column unless ``keep_text``. The statistics are computed
    once and staged, since both the hosts and the documents need them."""
    docs = c.without(docs, [n for n in OUTPUT if n.lower() not in (text.lower(), host.lower())])
    df = with_stats(docs, text)
    df = df.withColumn("base_failed", (F.col("n_words") < 10)
                       | (F.lit(100) * F.col("n_repeat_words") > F.lit(20) * F.col("n_words")))
    df = df.withColumn("rule_failed", (F.col("n_symbols") > F.col("n_words"))
                       | ((F.col("n_dup_lines") >= MIN_DUP_LINES)
                          & (F.lit(2) * F.col("n_dup_lines") > F.col("_n_lines")))).drop("_n_lines")
    df = c.stage(df if keep_text else df.drop(text), "judged")
    (bad_host,) = c.fresh(df, "_bad_host")
    bad = host_rates(df, host).where(F.col("shrunk_rate") >= HOST_LIMIT).select(
        F.col("host").alias(bad_host), F.lit(True).alias("host_rejected"))
    out = df.join(bad, F.col(f"`{host}`").eqNullSafe(F.col(bad_host)), "left").drop(bad_host)
    rejected = F.coalesce(F.col("host_rejected"), F.lit(False))
    return out.withColumn("host_rejected", rejected).withColumn(
        "kept", ~(F.col("base_failed") | F.col("rule_failed") | F.col("host_rejected")))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = c.table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return judge(docs, keep_text=False).select("doc_id", *OUTPUT)


ORACLE = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT doc_id, i, ws[i:i+4] AS win FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 4)) AS i FROM w WHERE len(ws) >= 5)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS k FROM g) WHERE k > 1),
cov AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + 4)) AS j FROM r) GROUP BY doc_id),
s AS (SELECT w.doc_id, source, len(ws)::BIGINT AS n_words, coalesce(length(array_to_string(ws, '')), 0)::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN cov ON w.doc_id = cov.doc_id),
f AS (SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
             (n_symbols > n_words OR (n_dup_lines >= 4 AND 2 * n_dup_lines > n_lines)) AS rule_failed FROM s),
h AS (SELECT source AS host, count(*) AS n, sum((base_failed OR rule_failed)::INT)::BIGINT AS k FROM f GROUP BY source),
tot AS (SELECT sum(n) AS all_n, floor(1000000 * sum(k) / sum(n))::BIGINT AS mean FROM h),
hr AS (SELECT h.*, floor(1000000 * k / n)::BIGINT AS rate, tot.mean, tot.all_n FROM h, tot),
mo AS (SELECT max(mean)::DOUBLE AS mean, max(all_n)::DOUBLE AS all_n,
              (sum(n::HUGEINT * (rate - mean) * (rate - mean)) - count(*)::HUGEINT * max(mean) * (1000000 - max(mean)))::DOUBLE AS spread FROM hr),
pr AS (SELECT mean, CASE WHEN spread > 0 THEN greatest(1.0, least(1000.0, mean * (1000000.0 - mean) / (spread / all_n) - 1.0)) ELSE 1000.0 END AS strength FROM mo),
bad AS (SELECT host FROM hr, pr WHERE floor((k::DOUBLE * 1000000.0 + pr.mean * strength) / (n::DOUBLE + strength)) >= 500000)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, rule_failed,
       EXISTS (SELECT 1 FROM bad WHERE bad.host IS NOT DISTINCT FROM f.source) AS host_rejected,
       NOT (base_failed OR rule_failed OR EXISTS (SELECT 1 FROM bad WHERE bad.host IS NOT DISTINCT FROM f.source)) AS kept
FROM f
"""
