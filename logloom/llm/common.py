"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from bisect import bisect_left
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.session import apply_defaults, ensure_checkpoint_dir

#: One white-space character, and a word: a run of anything else.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_defaults(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` as the session
    names it. Only a local session without the setting gets a scratch folder."""
    return spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and read it back: cuts
    the lineage, survives the loss of executors and gives the planner sizes."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Working column names that no column of ``df`` has (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` without columns of these names in any case: an operator's output
    column takes the place of an input column of the same name."""
    low = {n.lower() for n in names}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in low])


def text_key(text: Column) -> Column:
    """64 bits of a whole text; with the document's id it names a logical
    document: rows with the same id and text are repeats of one document."""
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def word_array(text: Column) -> Column:
    """The words of a text in order; null and empty texts have none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def bounded_sample(df: DataFrame, most: int, *key: str) -> DataFrame:
    """About ``most`` rows, those whose hash of ``key`` falls under the share
    that the row count gives (all rows of a small table), and never over twice
    as many. Rows are dropped where they are read, so no task or driver gets
    more than the sample."""
    n = df.count()
    if n <= most:
        return df
    low = F.pmod(F.xxhash64(F.lit("sample"), *key), F.lit(1 << 30))
    return df.where(low < int(most / n * (1 << 30))).limit(2 * most)


class Spans:
    """Disjoint spans in order; overlapping ones of the first are joined."""

    def __init__(self, spans: Iterable[tuple[int, int]] = ()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, z in sorted(spans):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(z, self.ends[-1])
            else:
                self.starts.append(a), self.ends.append(z)

    def meets(self, a: int, z: int) -> bool:
        i = bisect_left(self.starts, z)
        return i > 0 and self.ends[i - 1] > a

    def add(self, a: int, z: int):
        """Add a span that meets none."""
        i = bisect_left(self.starts, a)
        self.starts.insert(i, a), self.ends.insert(i, z)
