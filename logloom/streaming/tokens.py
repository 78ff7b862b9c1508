"""Incremental ERC-20 Transfer decoding over a stream of log files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import tokens as tk


def erc20_transfer_stream(spark: SparkSession, logs_dir: str, schema, token_types: DataFrame,
                          max_files_per_trigger: int = 64) -> DataFrame:
    """``readStream`` of Parquet log files -> decoded ERC-20 Transfer rows.
    ``token_types`` is the static side of the semi join."""
    logs = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(logs_dir))
    return tk.erc20_transfer(logs, token_types)


def decode_all_stream(spark: SparkSession, logs_dir: str, schema, specs: DataFrame,
                      max_files_per_trigger: int = 64) -> DataFrame:
    """D9 decode-all on a stream of log files: stream-static equi-join with the
    spec rows, per-row layout decode, Arrow finishing per micro-batch."""
    from ..plans import fanout

    logs = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(logs_dir))
    return fanout.decode_all_events(logs, specs)
