"""Plan shape: one scan for classification, hash predicate pushed into the
Parquet scan, no row-at-a-time Python UDF anywhere."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL, library_queries
from logloom.operators import tokens as tk
from logloom.plans.catalog import ChainTables


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_token_types_single_scan(spark):
    t = ChainTables(spark, SF_SMALL)
    plan = _plan(tk.token_types(t.contracts()))
    assert plan.count("FileScan parquet") == 1


@pytest.fixture(scope="module")
def stored_logs(spark):
    d = tempfile.mkdtemp(prefix="logloom-test-logs-")
    t = ChainTables(spark, SF_SMALL)
    t.logs().write.mode("overwrite").parquet(os.path.join(d, "logs"))
    t.contracts().write.mode("overwrite").parquet(os.path.join(d, "contracts"))
    return d


def test_hash_filter_pushed_to_scan(spark, stored_logs):
    t = ChainTables(spark, None, {"logs": f"{stored_logs}/logs", "contracts": f"{stored_logs}/contracts"})
    df = tk.erc20_transfer(t.logs(), tk.token_types(t.contracts(), ordered=False))
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(evt_hash), EqualTo(evt_hash,0xddf252ad" in plan
    assert df.count() > 0


@pytest.mark.parametrize("key", library_queries())
def test_no_row_at_a_time_python(spark, key):
    plan = _plan(E.queries()[key](spark, SF_SMALL))
    assert "BatchEvalPython" not in plan
    # Python over whole rows: only Keccak, over the distinct signatures
    assert all("_keccak_batches" in line for line in plan.splitlines() if "MapInPandas" in line)


def test_decode_pushes_hashes_and_time_bound(spark, stored_logs):
    from logloom.operators import decode as dec
    from logloom.operators import registry as reg

    t = ChainTables(spark, SF_SMALL)
    specs = reg.signature_specs(t.address_to_ordinal(), t.abi_to_ordinal(), t.contracts())
    s = ChainTables(spark, None, {"logs": f"{stored_logs}/logs"})
    df = dec.decode_table(s.logs(), specs, "Token_V0_evt_Transfer", "event")
    plan = _formatted(df)
    assert "EqualTo(evt_hash,0xddf252ad" in plan or "In(evt_hash, [0xddf252ad" in plan
    assert "GreaterThanOrEqual(block_time," in plan
    assert df.count() > 0


def test_bloom_filters_below_the_exchange_when_specs_are_not_broadcast(spark, tmp_path):
    from logloom.plans import fanout, parity
    from logloom.plans.catalog import ChainTables

    t = ChainTables(spark, SF_SMALL)
    path = str(tmp_path / "logs")
    t.logs().write.parquet(path)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    want = sorted(map(repr, fanout.decode_all_events(spark.read.parquet(path), parity._specs(t)).collect()))
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = fanout.decode_all_events(spark.read.parquet(path), parity._specs(t))
        plan = df._jdf.queryExecution().executedPlan().toString()
        scan = plan.index(path) if path in plan else plan.index("FileScan parquet")
        below = plan[plan.rindex("Exchange hashpartitioning", 0, scan):scan]
        assert "might_contain" in below
        assert sorted(map(repr, df.collect())) == want
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_z_order_skips_row_groups_by_address_alone(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    from logloom.plans import fanout
    from logloom.plans.catalog import ChainTables

    logs = ChainTables(spark, "/root/testdata/sf0.01").logs()
    path = str(tmp_path / "z")
    fanout.write_clustered(logs, path, partitions=256, z_order=True)
    assert spark.read.parquet(path).count() == logs.count()
    groups: list[dict] = []
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            row = meta.row_group(g)
            groups.append({n: row.column(names.index(n)).statistics for n in ("contract_address", "evt_hash", "block_number")})

    def share(column, value):
        return sum(s[column].min <= value <= s[column].max for s in groups) / len(groups)
    some = logs.select("contract_address", "evt_hash", "block_number").orderBy("tx_hash").limit(20).collect()
    assert len(groups) >= 200
    assert max(share("contract_address", r["contract_address"]) for r in some) < 0.1
    assert sum(share("evt_hash", r["evt_hash"]) for r in some) / len(some) < 0.6
    assert sum(share("block_number", r["block_number"]) for r in some) / len(some) < 0.6


def test_decode_all_pushes_the_earliest_bound(spark, tmp_path):
    import datetime as dt

    from logloom.plans import fanout, parity
    from logloom.plans.catalog import ChainTables

    t = ChainTables(spark, SF_SMALL)
    path = str(tmp_path / "logs")
    t.logs().write.parquet(path)
    source, specs = spark.read.parquet(path), parity._specs(t)
    known = specs.withColumn("min_created_ts", F.coalesce("min_created_ts", F.lit(dt.datetime(1995, 1, 1)).cast("timestamp_ntz")))
    for sp, pushed in ((known, True), (known.withColumn("min_created_ts", F.lit(None).cast("timestamp_ntz")), False)):
        plan = fanout.decode_all_events(source, sp)._jdf.queryExecution().executedPlan().toString()
        scan = next(line for line in plan.splitlines() if "FileScan parquet" in line and "topic1" in line)
        assert ("GreaterThanOrEqual(block_time" in scan) == pushed
    late = fanout.decode_all_events(source, known)
    assert late.where(F.col("evt_block_time") < F.lit(known.agg(F.min("min_created_ts")).first()[0])).count() == 0
