"""From raw documents to a training mix: five stages, each one operator.

Every stage takes what its predecessor kept, written as Parquet and read
again. All but the last return the columns of ``documents``; the last returns
the words that the mix takes from each document.

Defined cases, in every stage: an empty table gives an empty result; rows with
equal id and text are one document; a null id comes after all others; extra
columns pass through all stages but the last, which returns its own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm import common, decontaminate, lines, mixing, near, quality


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no rule, on hosts that are not rejected. A null or
    empty text has no words and goes; a null host is a host; repeated rows are
    judged alike."""
    return quality.judge(docs).where("kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines are deleted; ``n_chars`` follows the text.
    Null texts and texts without a word stay as they are; no row goes; of equal
    runs the one in the smallest id stays; repeated rows keep the same lines."""
    out = lines.remove_repeats(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id
    (of equal ids, the smallest text hash); of repeated rows one stays. Null
    texts and texts without a word are in no group and all stay."""
    return near.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage. Null and empty texts have none and
    stay; an empty benchmark removes nothing; repeated rows go or stay together."""
    return decontaminate.remove_leaks(docs, common.table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words taken from each document by the mix of sources. Null and empty
    texts have size 0 and give none; a null source is a source, the last one;
    rows with equal id and text have equal keys and are taken in any order."""
    return mixing.mix(docs, mixing.label_weights(spark, sf_dir))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
]

#: Near duplicates and decontamination are not expressible in SQL; the whole
#: pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    base = f"{common.shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if number + 1 == len(STAGES):
            return out
        out.write.parquet(f"{base}/{number}-{name}")
        docs = spark.read.schema(out.schema).parquet(f"{base}/{number}-{name}")
