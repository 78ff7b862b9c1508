"""Where the chain tables come from.

``ChainTables`` is the only place that knows how inputs are obtained: on a
cluster, from Parquet paths (or catalog tables) of the real chain data; in
tests, the bench and ``__spark_entry__``, from fixture encoders over the driver
tables. Every job takes DataFrames, so the two are interchangeable.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..sources import fixtures


@dataclass
class ChainTables:
    spark: SparkSession
    sf_dir: str | None = None
    paths: dict[str, str] = field(default_factory=dict)

    def _load(self, name: str, fixture) -> DataFrame:
        if name in self.paths:
            return self.spark.read.parquet(self.paths[name])
        if self.sf_dir is None:
            raise KeyError(f"no source configured for table {name!r}")
        return fixture()

    # S1 / S2 / S3 scans
    def logs(self) -> DataFrame:
        return self._load("logs", lambda: fixtures.logs(self.spark, self.sf_dir))

    def traces(self) -> DataFrame:
        return self._load("traces", lambda: fixtures.traces(self.spark, self.sf_dir))

    def traces_batch(self) -> DataFrame:
        return self._load("traces_batch", lambda: fixtures.traces_batch(self.spark, self.sf_dir))

    def transactions(self) -> DataFrame:
        return self._load("transactions", lambda: fixtures.transactions(self.spark, self.sf_dir))

    def blocks(self) -> DataFrame:
        return self._load("blocks", lambda: fixtures.blocks(self.spark, self.sf_dir))

    def contracts(self, partial: bool = False) -> DataFrame:
        return self._load("contracts_partial" if partial else "contracts",
                          lambda: fixtures.contracts(self.spark, self.sf_dir, partial))

    # S4 / S5 seeds
    def address_to_ordinal(self) -> DataFrame:
        return self._load("address_to_ordinal",
                          lambda: fixtures.address_to_ordinal(self.spark, self.sf_dir))

    def abi_to_ordinal(self) -> DataFrame:
        return self._load("abi_to_ordinal", lambda: fixtures.abi_to_ordinal(self.spark))

    def allow_list(self) -> DataFrame:
        return self._load("allow_list",
                          lambda: fixtures.allow_list(self.spark))

    # price feed inputs
    def token_prices(self) -> DataFrame:
        return self._load("token_prices", lambda: fixtures.token_prices(self.spark, self.sf_dir))

    def coin_map(self) -> DataFrame:
        return self._load("coin_map",
                          lambda: fixtures.coin_map(self.spark, self.sf_dir))

    def tokens(self) -> DataFrame:
        return self._load("tokens", lambda: fixtures.tokens(self.spark, self.sf_dir))
