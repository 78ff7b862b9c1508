"""SQL surface: the pass-through base views (S6) and the word functions as
Spark SQL temporary functions, so analysts can write the reference's models
in SQL (``hexToInt``, ``word_to_address``, ``data_word``)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..functions import hexint as H
from .catalog import ChainTables


def register_views(tables: ChainTables, prefix: str = "ethereum") -> list[str]:
    """S6: ``ethereum_logs``, ``_traces``, ``_transactions``, ``_blocks`` and
    ``_contracts`` temp views over the configured sources (``SELECT *``)."""
    names = []
    for name, df in [("logs", tables.logs()), ("traces", tables.traces()),
                     ("transactions", tables.transactions()), ("blocks", tables.blocks()),
                     ("contracts", tables.contracts())]:
        view = f"{prefix}_{name}"
        df.createOrReplaceTempView(view)
        names.append(view)
    return names


def register_functions(spark: SparkSession) -> None:
    """X1 ``hexToInt`` (Arrow UDF) and F1/F2 as SQL functions."""
    spark.udf.register("hexToInt", H._hex_to_decimal_udf)
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION word_to_address(w STRING) RETURNS STRING "
              "RETURN concat('0x', right(w, 40))")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION data_word(d STRING, i INT) RETURNS STRING "
              "RETURN substr(d, 3 + 64 * i, 64)")
