"""

``entry(spark)`` runs the flagship query (ERC-20 Transfer) at sf0.001.
callable ``(spark, sf_dir) -> DataFrame``; ``oracle_sql()`` gives the DuckDB
statement that computes the same rows from the raw driver tables. Arrays and
structs are rendered as JSON text at the query edge so both engines hash the
same values.
"""

from __future__ import annotations

import importlib
import importlib.util
import os
import sys
from collections.abc import Callable

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import duck_oracle as duck  # noqa: E402
import duck_parity  # noqa: E402
from logloom.operators import abi as abi_ops  # noqa: E402
from logloom.operators import decode as dec  # noqa: E402
from logloom.operators import prices as px  # noqa: E402
from logloom.operators import registry as reg  # noqa: E402
from logloom.operators import tokens as tk  # noqa: E402
from logloom.plans import fanout, parity  # noqa: E402
from logloom.plans.catalog import ChainTables  # noqa: E402
from logloom.functions import words as wd  # noqa: E402
from logloom.session import apply_defaults  # noqa: E402

SF0001 = "/root/testdata/sf0.001"


def _tables(spark: SparkSession, sf_dir: str) -> ChainTables:
    apply_defaults(spark)
    return ChainTables(spark, sf_dir)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: ERC-20 Transfer table at sf0.001."""
    return _m_token("erc20_ethereum.evt_Transfer")(spark, SF0001)


def _m3_token_types(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return tk.token_types(t.contracts())


def _m3_token_types_union(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return tk.token_types_union(t.contracts())


def _m_token(table: str, json_cols: tuple[str, ...] = ()):
    def run(spark, sf_dir):
        t = _tables(spark, sf_dir)
        df = tk.token_events(t.logs(), tk.token_types(t.contracts(), ordered=False), table)
        for c in json_cols:
            df = df.withColumn(c, F.to_json(F.col(c)))
        return df
    return run


def _m1_abi_catalog(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return reg.abi_catalog(t.address_to_ordinal(), t.abi_to_ordinal())


def _x_entries(kind: str):
    """X2 / X3 as the reference calls them: per catalog row (address, contract
    name), the events or functions of its ABI, named ``{Contract}_evt_{Event}``
    / ``{Contract}_call_{Function}``. ABI text is parsed once per distinct ABI
    and joined to the (growing) address catalog."""
    def run(spark, sf_dir):
        t = _tables(spark, sf_dir)
        e = abi_ops.with_hash_ids(abi_ops.signature_entries(t.abi_to_ordinal()))
        cat = t.address_to_ordinal().select(
            "address", "ordinal", reg.sanitize(F.col("name")).alias("contract_name"))
        infix = "_evt_" if kind == "event" else "_call_"
        return cat.join(e.where(F.col("type") == kind), "ordinal").select(
            "address", "contract_name", "ordinal", "type",
            F.concat("contract_name", F.lit(infix), "entry_name").alias("sub_name"),
            "signature", "inputs", "outputs", "hash_id")
    return run


def _a1_ungrouped(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return reg.ungrouped_signatures(t.address_to_ordinal(), t.abi_to_ordinal(), t.contracts(partial=True))


def _m2_registry(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return reg.signature_registry(t.address_to_ordinal(), t.abi_to_ordinal(),
                                  t.contracts(partial=True), t.allow_list())


def _m13_prices(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return px.usd(t.token_prices(), t.coin_map(), t.tokens())


def _specs(t: ChainTables):
    return reg.signature_specs(t.address_to_ordinal(), t.abi_to_ordinal(), t.contracts(partial=True),
                               t.allow_list())


def _d_table(table: str, kind: str, source: str, json_cols: tuple[str, ...] = ()):
    def run(spark, sf_dir):
        t = _tables(spark, sf_dir)
        df = dec.decode_table(getattr(t, source)(), _specs(t), table, kind)
        for c in json_cols:
            df = df.withColumn(c, F.to_json(F.col(c)))
        return df
    return run


def _d9_decode_all(spark, sf_dir):
    """D9 + D5: every registered event table in one scan (long form)."""
    t = _tables(spark, sf_dir)
    return fanout.decode_all_events(t.logs(), _specs(t), as_json=True)


def _f_words(spark, sf_dir):
    """F1-F9 over every log row: address from a topic, i-th data word,
    first/last word, hexToInt, INT64 / BIGNUMERIC / BOOL safe casts."""
    t = _tables(spark, sf_dir)
    logs = t.logs()
    d0 = wd.data_word("data", 0)
    first = wd.first_word("data")
    return logs.select(
        F.col("tx_hash").alias("evt_tx_hash"), F.col("index").alias("evt_index"),
        wd.word_to_address("topic1").alias("t1_address"),
        d0.alias("d0"), wd.data_word("data", 1).alias("d1"),
        first.alias("first_word"), wd.last_word("data").alias("last_word"),
        wd.hex_to_decimal(wd.prefixed(d0)).alias("d0_int"),
        wd.hex_to_long("topic3").alias("t3_int64"),
        wd.bignumeric_range(wd.hex_to_decimal(first)).alias("d0_bignumeric"),
        wd.hex_to_bool(first).alias("d0_bool"),
    )


def _registry(t: ChainTables):
    return reg.signature_registry(t.address_to_ordinal(), t.abi_to_ordinal(),
                                  t.contracts(partial=True), t.allow_list(), ordered=False)


def _d7_contract_addresses(spark, sf_dir):
    """D7/F16 in the reference's shape: JSON address lists exploded to rows,
    keyed by name. The lists come in chunks, so no cell grows with a signature."""
    t = _tables(spark, sf_dir)
    lists = reg.registry_addresses(t.address_to_ordinal(), t.abi_to_ordinal(), t.contracts(partial=True), t.allow_list())
    return lists.select("sub_name", F.explode(F.from_json("contract_addresses", "array<string>")).alias("contract_address")).distinct()


def _f21_registry_specs(spark, sf_dir):
    """F21 as the reference reads it: the first layout of each registry row."""
    return reg.layout_cells(_registry(_tables(spark, sf_dir)), first=True).drop("layout_no")


def _x6_document(spark, sf_dir):
    """X6 decoded documents ({"topic": ..., "data": ...}) of every table, read
    back by JSON path: F10 JSON_VALUE (scalars only) + BIGNUMERIC safe cast,
    F12 JSON_VALUE_ARRAY."""
    t = _tables(spark, sf_dir)
    doc = fanout.decode_all_events(t.logs(), _specs(t), as_json="document").withColumn("_doc", F.try_parse_json("args"))
    ids = fanout.json_value_array("args", "$.data.ids")
    value_text = fanout.json_value("args", "$.data.value", "_doc")
    return doc.select(
        "evt_tx_hash", "evt_index", "namespace", "table", F.col("args").alias("document"),
        fanout.json_value("args", "$.topic.from", "_doc").alias("topic_from"),
        value_text.alias("value_text"),
        wd.bignumeric_range(value_text).alias("value_bignumeric"),
        fanout.json_value("args", "$.data.ids", "_doc").alias("ids_as_scalar"),
        F.when(ids.isNotNull(), F.size(ids)).alias("n_ids"),
        F.try_element_at(ids, F.lit(1)).alias("first_id"),
    )


def _d9_decode_all_calls(spark, sf_dir):
    """D9 for calls: every registered function decoded in one scan of the
    traces (both trace fixtures)."""
    t = _tables(spark, sf_dir)
    traces = t.traces().unionByName(t.traces_batch())
    return fanout.decode_all_calls(traces, _specs(t), as_json=True)


def _a5_a6_keyed_pick(spark, sf_dir):
    """A5 + A6 over the long form of every table: pick arguments by key, split
    the ``|||`` lists and cast items safely (bigint drops values above 2^63)."""
    t = _tables(spark, sf_dir)
    batch = fanout.decode_all_events(t.logs(), _specs(t))
    ids = fanout.split_cast(fanout.pick("args", "ids"), "decimal(38,0)")
    values64 = fanout.split_cast(fanout.pick("args", "values"), "bigint")
    picked = batch.select(
        "evt_tx_hash", "evt_index", "namespace", "table",
        fanout.pick("args", "from").alias("from"), ids.alias("ids"), values64.alias("values_64"))
    return picked.select(
        "evt_tx_hash", "evt_index", "namespace", "table", "from",
        F.when(F.col("ids").isNotNull(), F.size("ids")).alias("n_ids"),
        F.aggregate("ids", F.lit(0).cast("decimal(38,0)"), lambda a, x: a + x).cast("string").alias("ids_sum"),
        F.when(F.col("values_64").isNotNull(), F.size("values_64")).alias("n_values_64"),
    )


def _s6_base_views(spark, sf_dir):
    """S6: the pass-through views, joined and counted in SQL per block day."""
    from logloom.plans import sql

    t = _tables(spark, sf_dir)
    sql.register_views(t)
    return spark.sql("""
        SELECT to_date(b.time) AS block_day, count(DISTINCT b.number) AS n_blocks, count(DISTINCT t.hash) AS n_transactions,
               count(tr.trace_id) AS n_traces, count_if(tr.success) AS n_successful
        FROM ethereum_blocks b JOIN ethereum_transactions t ON t.block_number = b.number
        LEFT JOIN ethereum_traces tr ON tr.tx_hash = t.hash
        GROUP BY to_date(b.time)""")


_DECODE_KEYS = {
    "d1_decode_events_static": ("Token_V0_evt_Transfer", "event", "logs", ()),
    "d2_decode_events_dynamic_arrays": ("Token_V2_evt_TransferBatch", "event", "logs", ("ids", "values")),
    "d2_decode_events_dynamic_string": ("Token_V2_evt_URI", "event", "logs", ()),
    "d3_decode_calls_static": ("Token_V0_call_transfer", "call", "traces", ()),
    "d4_decode_calls_dynamic": ("Token_V2_call_balanceOfBatch", "call", "traces_batch",
                                ("accounts", "ids", "output_0")),
}


_TOKEN_KEYS = {
    "m4_erc20_transfer": ("erc20_ethereum.evt_Transfer", ()),
    "m5_erc20_approval": ("erc20_ethereum.evt_Approval", ()),
    "m6_erc721_transfer": ("erc721_ethereum.evt_Transfer", ()),
    "m7_erc721_approval": ("erc721_ethereum.evt_Approval", ()),
    "m8_erc721_approval_for_all": ("erc721_ethereum.evt_ApprovalForAll", ()),
    "m9_erc1155_approval_for_all": ("erc1155_ethereum.evt_ApprovalForAll", ()),
    "m10_erc1155_transfer_single": ("erc1155_ethereum.evt_TransferSingle", ()),
    "m11_erc1155_transfer_batch": ("erc1155_ethereum.evt_TransferBatch", ("ids", "values")),
    "m12_erc1155_uri": ("erc1155_ethereum.evt_URI", ()),
}


def _optional(name: str):
    """The module, or None where its file is not there (an import error inside
    it is raised)."""
    parent = name.rpartition(".")[0]
    if parent and importlib.util.find_spec(parent) is None:
        return None
    return importlib.import_module(name) if importlib.util.find_spec(name) else None


def _training_data() -> tuple[dict, dict]:
    """Queries and oracle statements of the optional training-data subpackage."""
    q, o = {}, {}
    ops = _optional("logloom.llm.queries")
    if ops is not None:
        q.update(ops.QUERIES)
        o.update(ops.ORACLES)
        pipe = _optional("corpus_pipeline")
        if pipe is not None:
            q["pipeline"] = pipe.run
            if pipe.ORACLE_SQL:
                o["pipeline"] = pipe.ORACLE_SQL
    return q, o


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "m3_token_types": _m3_token_types,
        "u2_token_types_union": _m3_token_types_union,
        "m1_abi_catalog": _m1_abi_catalog,
        "x2_parse_abi_events": _x_entries("event"),
        "x3_parse_abi_functions": _x_entries("call"),
        "a1_ungrouped_signatures": _a1_ungrouped,
        "m2_signature_registry": _m2_registry,
        "m13_prices_usd": _m13_prices,
    }
    for key, (table, js) in _TOKEN_KEYS.items():
        q[key] = _m_token(table, js)
    for key, args in _DECODE_KEYS.items():
        q[key] = _d_table(*args)
    # also checked against the wide decoders in tests/test_fanout.py
    q["d9_decode_all_events"] = _d9_decode_all
    q["a5_a6_keyed_pick_split_cast"] = _a5_a6_keyed_pick
    q["d9_decode_all_calls"] = _d9_decode_all_calls
    q["f1_f9_word_functions"] = _f_words
    q["d7_f16_contract_addresses"] = _d7_contract_addresses
    q["f21_s11_s13_registry_specs"] = _f21_registry_specs
    q["x6_f10_f12_json_document"] = _x6_document
    q["s6_base_views"] = _s6_base_views
    q.update(parity.QUERIES)
    q.update(_training_data()[0])
    return q


def oracle_sql() -> dict[str, str]:
    o = {
        "m3_token_types": duck.token_types_sql(),
        "u2_token_types_union": duck.token_types_sql(),
        "m1_abi_catalog": duck.abi_catalog_sql(),
        "x2_parse_abi_events": duck.signature_entries_sql("event"),
        "x3_parse_abi_functions": duck.signature_entries_sql("call"),
        "a1_ungrouped_signatures": duck.ungrouped_sql(),
        "m2_signature_registry": duck.signature_registry_sql(),
        "m13_prices_usd": duck.prices_usd_sql(),
    }
    o.update(duck.token_tables_sql())
    o.update({
        "d1_decode_events_static": duck.d1_sql(),
        "d2_decode_events_dynamic_arrays": duck.d2_batch_sql(),
        "d2_decode_events_dynamic_string": duck.d2_uri_sql(),
        "d3_decode_calls_static": duck.d3_sql(),
        "d4_decode_calls_dynamic": duck.d4_sql(),
        "d9_decode_all_events": duck.d9_sql(),
        "a5_a6_keyed_pick_split_cast": duck.a5_a6_sql(),
        "d9_decode_all_calls": duck.d9_calls_sql(),
        "f1_f9_word_functions": duck.words_sql(),
        "d7_f16_contract_addresses": duck.contract_addresses_sql(),
        "f21_s11_s13_registry_specs": duck.registry_specs_sql(),
        "x6_f10_f12_json_document": duck.document_sql(),
        "s6_base_views": duck.base_views_sql(),
    })
    o.update(duck_parity.statements())
    o.update(_training_data()[1])
    return o
