"""S7/S8: registry export to sharded CSV and read-back with an explicit
schema (the JSON-list cells contain commas and quotes)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

REGISTRY_SCHEMA = T.StructType([
    T.StructField("sub_name", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("min_created_ts", T.TimestampNTZType()),
    T.StructField("inputs_", T.StringType()),
    T.StructField("outputs", T.StringType()),
    T.StructField("hash_ids", T.StringType()),
    T.StructField("contract_addresses", T.StringType()),
    T.StructField("contract_name", T.StringType()),
    T.StructField("namespace", T.StringType()),
    T.StructField("count", T.LongType()),
])

_OPTS = {"header": "true", "multiLine": "true", "escape": '"', "quote": '"',
         "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}


def write_registry_csv(registry: DataFrame, path: str) -> None:
    registry.write.mode("overwrite").options(**_OPTS).csv(path)


def read_registry_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REGISTRY_SCHEMA).options(**_OPTS).csv(path)
