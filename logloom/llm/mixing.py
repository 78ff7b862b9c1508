"""Mixing sources to target weights (native DataFrame functions only).

Every source gets a word budget: its weight's share of all words, stopped at
``cap`` times its own words, the excess going to the others by weight
(water-filling, solved in closed form over one row per source). Each document
then gets an Efraimidis-Spirakis key: an exponential variate, from a hash of
its id and text, divided by its quality weight. A budget takes whole epochs of
its source first; the rest is filled in the order of the keys, by a prefix sum
of sizes, and the last document is cut at the budget. The prefix sum runs in
two steps, over bins of the key within a source and then inside each bin, so
that a source with a third of all rows is still spread over many tasks.

Defined cases: a null text has size 0; the null source is a source of its own,
ordered last; documents without a quality label weigh 1; rows with equal id
and text have equal keys and are taken in any order, so the same sizes are
taken; sources without a word get target 0; an empty table gives an empty
result; extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as c

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = "mix-1"
#: Bins of the key within a source.
BINS = 1024
#: Quality weight of documents labelled good, labelled poor and not labelled.
GOOD, POOR, PLAIN = 2.0, 0.5, 1.0


def sized(docs: DataFrame, quality: DataFrame | None = None, text: str = "text", source: str = "source",
          doc_id: str = "doc_id", seed: str = SEED) -> DataFrame:
    """``doc_id, source, size, key, bin``; ``quality`` has doc_id and weight."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    # A word starts at each non-space that is first or follows a space.
    size = F.regexp_count(t, F.lit(c.WORD)).cast("long")
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")), F.md5(t)))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2 ** 52))
    df = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"),
                     size.alias("size"), u.alias("u"), digest.alias("digest"))
    if quality is None:
        df = df.withColumn("weight", F.lit(PLAIN))
    else:
        q = quality.where("doc_id is not null and weight is not null").groupBy("doc_id").agg(F.max("weight").alias("weight"))
        df = df.join(q, "doc_id", "left").withColumn("weight", F.coalesce("weight", F.lit(PLAIN)))
    df = df.withColumn("key", -F.log("u") / F.col("weight"))
    return df.select("doc_id", "source", "size", "key", "digest",
                     F.least(F.lit(BINS - 1), F.floor((1.0 - F.exp(-F.col("key"))) * BINS)).cast("int").alias("bin"))


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``sources`` (source, source_size: one row per source) with ``target``.
    The windows here run over that one row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = sources.withColumn("w", F.element_at(F.array(*map(F.lit, weights)),
                                             ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")).cast("long"))
    s = s.withColumn("most", F.col("source_size") * F.lit(cap)).withColumn("ratio", F.col("most").cast("double") / F.col("w"))
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    s = s.withColumn("level", (F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0))).cast("double")
                     / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0))))
    # The first source, by ratio, that its share does not fill sets the level for all from it on.
    s = s.withColumn("level", F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "level"))).over(every)["level"])
    return s.select("source", "source_size", F.least(F.col("most").cast("double"), F.col("w") * F.col("level")).alias("target"))


def mix(docs: DataFrame, quality: DataFrame | None = None, weights: Sequence[int] = WEIGHTS, cap: int = CAP,
        text: str = "text", source: str = "source", doc_id: str = "doc_id", seed: str = SEED) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken``: the words that the
    mix takes from each document, repeats counted."""
    df = c.stage(sized(docs, quality, text, source, doc_id, seed), "sized")
    bins = c.stage(df.groupBy("source", "bin").agg(F.sum("size").alias("bin_size")), "bins")
    goal = targets(bins.groupBy("source").agg(F.sum("bin_size").alias("source_size")), weights, cap)
    prior = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("start", F.coalesce(F.sum("bin_size").over(prior), F.lit(0)))
    bins = bins.join(goal.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).select(
        F.col("source").alias("s"), F.col("bin").alias("b"), "start", "source_size", "target")
    df = df.join(bins, F.col("source").eqNullSafe(F.col("s")) & (F.col("bin") == F.col("b")))
    inside = Window.partitionBy("source", "bin").orderBy("key", "digest").rowsBetween(Window.unboundedPreceding, -1)
    taken_before = F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.floor("target").cast("long") - epochs * F.col("source_size")
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - taken_before))
    return df.select("doc_id", "source", "size", "source_size", "target",
                     (epochs * F.col("size") + part).cast("long").alias("taken"))


def label_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality weights of the labelled documents."""
    return c.table(spark, sf_dir, "labels").select(
        "doc_id", F.when(F.col("quality") > 0, GOOD).when(F.col("quality") <= 0, POOR).alias("weight"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = c.table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs, label_weights(spark, sf_dir))


ORACLE = r"""
WITH q AS (SELECT doc_id, max(CASE WHEN quality > 0 THEN 2.0::DOUBLE WHEN quality <= 0 THEN 0.5::DOUBLE END) AS weight FROM labels GROUP BY doc_id),
k AS (SELECT d.doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
             md5(concat_ws('|', 'mix-1', coalesce(d.doc_id::VARCHAR, ''), md5(coalesce(text, '')))) AS digest, coalesce(weight, 1.0) AS weight
      FROM documents d LEFT JOIN q ON q.doc_id = d.doc_id),
o AS (SELECT *, -ln((('0x' || digest[1:13])::BIGINT::DOUBLE + 0.5) / 4503599627370496.0) / weight AS key FROM k),
p AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM o),
s AS (SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS w FROM k GROUP BY source),
r AS (SELECT *, 3 * source_size AS most, (3 * source_size)::DOUBLE / w AS ratio FROM s),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER b, 0))::DOUBLE / (sum(w) OVER () - coalesce(sum(w) OVER b, 0))::DOUBLE AS level
      FROM r WINDOW b AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT source, source_size, least(most::DOUBLE, w * (SELECT arg_min(level, ratio) FROM l WHERE ratio >= level)) AS target FROM l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM g)
SELECT doc_id, p.source, size, source_size, target,
       (epochs * size + greatest(0, least(size, floor(target)::BIGINT - epochs * source_size - before)))::BIGINT AS taken
FROM p JOIN e ON p.source IS NOT DISTINCT FROM e.source
"""
