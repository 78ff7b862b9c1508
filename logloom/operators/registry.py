"""ABI catalog (M1) and signature registry (M2), plus the normalised spec
rows the decoders join against (D7).

Plan shape (M2): ABI text is parsed once per distinct ABI (ordinal), not per
address; hashes are computed over distinct signatures; addresses join the
parsed entries by ordinal; contract creation time comes from a left join on
address. The allow-list join is on ``lower(sub_name)`` (JN4/JN5); the group
keeps the allow-list spelling, and the window counts groups per name after
the GROUP BY (W1).
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import abi as abi_ops


def sanitize(c: Column) -> Column:
    """F17 ``REPLACE(x, '.', '_')``."""
    return F.replace(c, F.lit("."), F.lit("_"))


def table_name(sub_name: Column) -> Column:
    """S13: output table name, ``.`` -> ``_`` and ``++`` removed."""
    return F.replace(F.replace(sub_name, F.lit("."), F.lit("_")), F.lit("++"), F.lit(""))


def output_schema(namespace: Column, target_prefix: str | None = None) -> Column:
    """S11: ``{namespace}_ethereum``, optionally prefixed per environment."""
    schema = F.concat(namespace, F.lit("_ethereum"))
    return F.concat(F.lit(f"{target_prefix}_"), schema) if target_prefix else schema


def abi_catalog(address_to_ordinal: DataFrame, abi_to_ordinal: DataFrame) -> DataFrame:
    """M1 ABI catalog view: address, sanitised name/namespace, ordinal, abi (JN1)."""
    return address_to_ordinal.join(abi_to_ordinal, "ordinal", "left").select(
        "address", sanitize(F.col("name")).alias("name"), sanitize(F.col("namespace")).alias("namespace"),
        "ordinal", "abi")


def ungrouped_signatures(address_to_ordinal: DataFrame, abi_to_ordinal: DataFrame,
                         contracts: DataFrame, with_abi: bool = False) -> DataFrame:
    """The registry's ``ungrouped`` relation: one distinct row per (signature
    entry, address) with the contract's creation time (JN2, JN3, A1, U1).
    ``with_abi`` keeps the ABI parameter trees the decoders need."""
    entries = abi_ops.with_hash_ids(abi_ops.signature_entries(abi_to_ordinal, "ordinal"))
    cat = address_to_ordinal.select(
        "address", "ordinal", sanitize(F.col("name")).alias("contract_name"),
        sanitize(F.col("namespace")).alias("namespace"))
    created = contracts.select("address", F.col("block_timestamp").alias("min_created_ts"))
    rows = cat.join(entries, "ordinal").join(created, "address", "left")
    infix = F.when(F.col("type") == "event", F.lit("_evt_")).otherwise(F.lit("_call_"))
    return rows.select(
        F.concat(F.col("contract_name"), infix, F.col("entry_name")).alias("sub_name"),
        "inputs", "outputs", "type", "hash_id", "min_created_ts", "address",
        "contract_name", "namespace", *(["abi_inputs", "abi_outputs"] if with_abi else []),
    ).distinct()


def json_distinct_list(c: str) -> Column:
    """A3 ``TO_JSON_STRING(ARRAY_AGG(DISTINCT x))`` keeping NULL, sorted
    (NULL first) so the text is deterministic."""
    return F.to_json(F.transform(F.array_sort(F.collect_set(F.struct(F.col(c).alias("x")))),
                                 lambda y: y["x"]))


#: Addresses of one chunk of a signature's address list.
CHUNK = 10_000


def _listed(address_to_ordinal: DataFrame, abi_to_ordinal: DataFrame, contracts: DataFrame, allow_list: DataFrame) -> DataFrame:
    """The ungrouped rows whose name the allow-list spells in some way."""
    u = ungrouped_signatures(address_to_ordinal, abi_to_ordinal, contracts)
    names = allow_list.select(F.col("sub_name").alias("n_sub_name")).distinct()
    return u.join(names, F.lower(u["sub_name"]) == F.lower(names["n_sub_name"]))


_GROUP = ("sub_name", "type", "contract_name", "namespace", "n_sub_name")


def signature_registry(address_to_ordinal: DataFrame, abi_to_ordinal: DataFrame,
                       contracts: DataFrame, allow_list: DataFrame,
                       ordered: bool = True, addresses: bool = True) -> DataFrame:
    """M2 ``decoded_contracts``: one row per (allow-listed name spelling, type,
    contract_name, namespace) with JSON lists of inputs, outputs, hash ids and
    addresses, first creation time and the number of groups sharing the name.
    ``addresses=False`` leaves out the address cell, whose size nothing bounds
    (a standard token's signature has millions): :func:`registry_addresses`
    gives them in chunks."""
    joined = _listed(address_to_ordinal, abi_to_ordinal, contracts, allow_list)
    grouped = joined.groupBy(*_GROUP).agg(
        F.min("min_created_ts").alias("min_created_ts"),
        json_distinct_list("inputs").alias("inputs_"),
        json_distinct_list("outputs").alias("outputs"),
        json_distinct_list("hash_id").alias("hash_ids"),
        *([json_distinct_list("address").alias("contract_addresses")] if addresses else []),
    )
    # W1: evaluated after the GROUP BY, partitioned by the ABI's own spelling
    counted = grouped.withColumn("count", F.count(F.lit(1)).over(Window.partitionBy("sub_name")))
    out = counted.select(
        F.col("n_sub_name").alias("sub_name"), "type", "min_created_ts", "inputs_", "outputs",
        "hash_ids", *(["contract_addresses"] if addresses else []), "contract_name", "namespace", "count")
    if ordered:
        out = out.orderBy(F.desc("count"), "sub_name", "type", "contract_name", "namespace")
    return out


def registry_addresses(address_to_ordinal: DataFrame, abi_to_ordinal: DataFrame, contracts: DataFrame,
                       allow_list: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """A3 with bounded cells: the distinct addresses of each registry row in
    numbered chunks of about ``chunk``, as JSON lists. (sub_name, type,
    contract_name, namespace, chunk, n_addresses, contract_addresses)

    Distinct addresses are found by a shuffle on (row, address), which spreads
    the largest signature over all tasks; the number of chunks of a row is a
    two-step count (by hash part, then by row), and an address's chunk is its
    hash modulo that number, so no task ever holds more than some chunks."""
    rows = _listed(address_to_ordinal, abi_to_ordinal, contracts, allow_list).select(*_GROUP, "address").distinct()
    part = F.conv(F.substring(F.sha2("address", 256), 1, 8), 16, 10).cast("bigint")
    rows = rows.withColumn("_h", F.coalesce(part, F.lit(0)))
    sizes = rows.groupBy(*_GROUP, (F.col("_h") % 64).alias("_p")).agg(F.count("address").alias("n")).groupBy(*_GROUP).agg(
        F.greatest(F.ceil(F.sum("n") / chunk), F.lit(1)).alias("_chunks"))
    sizes = sizes.withColumnsRenamed({k: f"_{k}" for k in _GROUP})
    each = rows.join(sizes, reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in _GROUP])).select(
        *_GROUP, "address", (F.col("_h") % F.col("_chunks")).alias("chunk"))
    return each.groupBy(*_GROUP, "chunk").agg(
        F.count("address").alias("n_addresses"), F.to_json(F.array_sort(F.collect_list("address"))).alias("contract_addresses")).select(
        F.col("n_sub_name").alias("sub_name"), "type", "contract_name", "namespace", "chunk", "n_addresses", "contract_addresses")


def layout_cells(registry: DataFrame, first: bool = False) -> DataFrame:
    """F21 (JSON list cell -> layouts), S11 schema name and S13 table name of
    each registry row: one row per layout of a name, numbered from 0 in the
    cell's order, or with ``first`` the first one only, as the reference takes
    it. ``[null]`` / ``[""]`` cells give the default layout (no inputs, one
    text output); a row's outputs go with its inputs where it has as many, else
    the first ones do."""
    none, none_out = "[]", '[{"name":"output_0","type":"STRING"}]'
    ins, outs = F.from_json("inputs_", "array<string>"), F.from_json("outputs", "array<string>")

    def spec(cell, default):
        return F.when(F.coalesce(cell, F.lit("")) == "", F.lit(default)).otherwise(F.concat(F.lit("["), cell, F.lit("]")))
    rows = registry.select("*", ins.alias("_ins"), outs.alias("_outs"))
    rows = rows.select("*", F.posexplode_outer(F.slice("_ins", 1, 1) if first else F.col("_ins")).alias("layout_no", "_in"))
    own = F.when(F.size("_outs") == F.size("_ins"), F.get("_outs", F.col("layout_no"))).otherwise(F.get("_outs", F.lit(0)))
    return rows.select(
        "sub_name", "type", "contract_name", "namespace", table_name(F.col("sub_name")).alias("table_name"),
        output_schema(F.col("namespace")).alias("schema_name"), F.coalesce("layout_no", F.lit(0)).alias("layout_no"),
        spec(F.col("_in"), none).alias("input_spec"), spec(own, none_out).alias("output_spec"))


def signature_specs(address_to_ordinal: DataFrame, abi_to_ordinal: DataFrame,
                    contracts: DataFrame, allow_list: DataFrame | None = None) -> DataFrame:
    """D7 in normalised form: one row per (type, hash_id, address) with the
    table it decodes into, its layout (inputs/outputs text) and the lower time
    bound. Keyed by (namespace, sub_name, type) -- not by name alone -- so equal
    names in different namespaces keep their own addresses."""
    u = ungrouped_signatures(address_to_ordinal, abi_to_ordinal, contracts, with_abi=True)
    if allow_list is not None:
        names = allow_list.select(F.lower("sub_name").alias("lname")).distinct()
        u = u.join(names, F.lower(u["sub_name"]) == names["lname"], "left_semi")
    return u.select(
        "type", "hash_id", F.col("address").alias("contract_address"), "namespace",
        table_name(F.col("sub_name")).alias("table"), "sub_name", "inputs", "outputs",
        "abi_inputs", "abi_outputs", "min_created_ts")
