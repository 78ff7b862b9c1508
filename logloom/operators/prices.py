"""M13 ``prices.usd``: a price feed labelled with token contract, symbol and
decimals.

The reference's two LEFT JOINs are followed by ``WHERE pt.contract IS NOT
NULL``, which makes the first one inner (JN9); it is written inner directly,
with the NULL-contract coins filtered before the join. The coin map and the
token dimension are dimension tables; Spark broadcasts them only when their
measured size is under the broadcast threshold, else it shuffles on the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usd(token_prices: DataFrame, coin_map: DataFrame, tokens: DataFrame) -> DataFrame:
    coins = coin_map.where(F.col("contract").isNotNull()).select(
        F.col("id").alias("coin_id"), F.col("contract").alias("contract_address"), "symbol")
    dims = tokens.select(F.col("address").alias("contract_address"), "decimals")
    return (token_prices.join(coins, "coin_id")
            .join(dims, "contract_address", "left")
            .select("contract_address", F.lit("ethereum").alias("blockchain"), "decimals",
                    F.col("timestamp").alias("minute"), F.col("price_usd").alias("price"), "symbol"))
