"""ABI documents -> signature entries (X2 ``PARSE_ABI_EVENTS``, X3
``PARSE_ABI_FUNCTIONS``, X4/X5 reduce-to-one-entry).

Parsing is ``from_json`` into a flat schema, then ``explode``: invalid JSON or
a NULL ABI parse to NULL and yield no entries, the reference's ``'ERROR'``
rows. A parameter keeps its tuple ``components`` as JSON text, so the schema
has no levels and a document may nest tuples as deeply as JSON parses. What a
tuple's text says (canonical spelling, registry type, its fields) is worked out
bottom-up by one Arrow UDF that sees nothing but those texts; parameters
without a tuple, nearly all, stay native: ``transform`` / ``concat`` per
argument. Hashes (Keccak-256) are computed by ``mapInPandas`` over the
*distinct* canonical signatures only and joined back.

The type expressions are generated as Spark SQL text and handed to one
``F.expr`` each: the same Catalyst expressions the Column API would build, but
one JVM round trip instead of hundreds (query construction took seconds).
"""

from __future__ import annotations

import json
import re
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keccak import keccak_hex

#: ``components``: the JSON text of a tuple's fields.
PARAM = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("indexed", T.BooleanType()),
    T.StructField("components", T.StringType()),
])
ENTRY = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("anonymous", T.BooleanType()),
    T.StructField("inputs", T.ArrayType(PARAM)),
    T.StructField("outputs", T.ArrayType(PARAM)),
])
ABI_SCHEMA = T.ArrayType(ENTRY)

# Regexes as Spark SQL string literals (the SQL parser turns "\\" into "\").
_SQL_SUFFIX = r"'(\\[[0-9]*\\])+$'"
_SQL_INT_WIDEN = r"'^(u?int)(\\[|$)'"


# ------------------------------------------------- tuples, from their text --

_SUFFIX = re.compile(r"(\[[0-9]*\])+$")


def _scalar_vocab(base: str) -> str:
    m = re.fullmatch(r"(u?)int([0-9]*)", base)
    if m:
        return "INT64" if int(m[2] or 256) <= (56 if m[1] else 64) else "BIGNUMERIC"
    return {"address": "ADDRESS", "bool": "BOOL"}.get(base, "STRING")


def _tuple_facts(fields: list) -> tuple[str, str, list]:
    """Canonical spelling, registry type and plain fields of a tuple."""
    canonical, vocab, plain = [], [], []
    for f in fields:
        kind, name = f.get("type") or "", f.get("name") or ""
        base = _SUFFIX.sub("", kind)
        out = {"name": name, "type": kind}
        if base == "tuple":
            c, v, out["components"] = _tuple_facts(f.get("components") or [])
            c += kind[len("tuple"):]
        else:
            c = re.sub(r"^(u?int)(\[|$)", r"\g<1>256\2", kind)
            v = _scalar_vocab(base)
            if base != kind:
                v = f"ARRAY<{name} {v}>"
        canonical.append(c)
        vocab.append(f"{name} {v}")
        plain.append(out)
    return f"({','.join(canonical)})", f"ARRAY<{', '.join(vocab)}>", plain


def tuple_facts(text: str | None):
    """(canonical, vocab, components) of a ``components`` text, or None."""
    try:
        canonical, vocab, plain = _tuple_facts(json.loads(text))
        return canonical, vocab, json.dumps(plain, separators=(",", ":"), ensure_ascii=False)
    except (TypeError, ValueError, AttributeError, RecursionError):
        return None


_FACTS = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("canonical", "vocab", "components")]))


@F.pandas_udf(_FACTS)
def _tuples(components: pd.Series) -> pd.Series:
    known: dict = {None: None}

    def facts(text):
        if text not in known:
            known[text] = tuple_facts(text)
        return known[text]
    return components.map(lambda texts: [facts(t) for t in texts], na_action="ignore")


# ------------------------------------------- one parameter, as SQL text ------

def _scalar_vocab_sql(base: str) -> str:
    bits = f"coalesce(try_cast(nullif(regexp_extract({base}, '^u?int([0-9]*)$', 1), '') AS INT), 256)"
    return (f"CASE WHEN {base} = 'address' THEN 'ADDRESS' WHEN {base} = 'bool' THEN 'BOOL' "
            f"WHEN {base} RLIKE '^int[0-9]*$' THEN IF({bits} <= 64, 'INT64', 'BIGNUMERIC') "
            f"WHEN {base} RLIKE '^uint[0-9]*$' THEN IF({bits} <= 56, 'INT64', 'BIGNUMERIC') "
            "ELSE 'STRING' END")


def vocab_type_sql(p: str, facts: str) -> str:
    """Registry type: ADDRESS / INT64 / BIGNUMERIC / BOOL / STRING, or
    ``ARRAY<name TYPE, ...>`` for tuples, arrays and arrays of tuples (one
    spelling for all three, as in the reference's documents).

    intN with N <= 64 and uintN with N <= 56 fit a signed 64-bit column
    (INT64); wider integers are BIGNUMERIC (kept as exact decimal text)."""
    base = f"regexp_replace({p}.type, {_SQL_SUFFIX}, '')"
    scalar = _scalar_vocab_sql(base)
    return (f"CASE WHEN {base} = 'tuple' THEN {facts}.vocab "
            f"WHEN {p}.type RLIKE {_SQL_SUFFIX} THEN concat('ARRAY<', coalesce({p}.name, ''), ' ', {scalar}, '>') "
            f"ELSE {scalar} END")


def canonical_type_sql(p: str, facts: str) -> str:
    """ABI canonical type: tuples spelled ``(t1,t2)`` + array suffix;
    ``uint``/``int`` widened to 256 bits."""
    t = f"regexp_replace({p}.type, {_SQL_INT_WIDEN}, '$1256$2')"
    return (f"CASE WHEN startswith({t}, 'tuple') THEN concat({facts}.canonical, "
            f"regexp_extract({t}, '^tuple(.*)$', 1)) ELSE {t} END")


def parse_abi(abi_docs: DataFrame, key: str = "ordinal") -> DataFrame:
    """One row per ABI entry: (key, entry) for events and functions."""
    parsed = abi_docs.select(key, F.from_json("abi", ABI_SCHEMA).alias("entries"))
    return parsed.select(key, F.explode("entries").alias("e")).where(
        F.col("e.type").isin("event", "function") & F.col("e.name").isNotNull())


def _event_inputs_sql(inputs: str, facts: str) -> str:
    n_indexed = f"size(filter(slice({inputs}, 1, i + 1), y -> coalesce(y.indexed, false)))"
    return (f"array_join(transform({inputs}, (x, i) -> to_json(named_struct("
            f"'name', coalesce(x.name, ''), 'type', {vocab_type_sql('x', facts)}, "
            f"'index_type', IF(coalesce(x.indexed, false), concat('topic', CAST({n_indexed} AS STRING)), "
            f"'data')))), ',')")


def _plain_sql(params: str, facts: str) -> str:
    return (f"array_join(transform({params}, (x, i) -> to_json(named_struct("
            f"'name', coalesce(x.name, ''), 'type', {vocab_type_sql('x', facts)}))), ',')")


def _full_sql(params: str, facts: str) -> str:
    return (f"to_json(transform({params}, (x, i) -> named_struct('name', x.name, 'type', x.type, 'indexed', x.indexed, "
            f"'components', {facts}.components)))")


def signature_entries(abi_docs: DataFrame, key: str = "ordinal") -> DataFrame:
    """X2 + X3: (key, type 'event'|'call', entry_name, signature, inputs,
    outputs, abi_inputs, abi_outputs). Anonymous events are excluded (no hash
    topic). A tuple without readable components has no signature."""
    e = parse_abi(abi_docs, key)
    is_event = F.col("e.type") == "event"
    params = T.ArrayType(PARAM)
    staged = e.where(~(is_event & F.coalesce(F.col("e.anonymous"), F.lit(False)))).select(
        key,
        F.when(is_event, F.lit("event")).otherwise(F.lit("call")).alias("type"),
        F.col("e.name").alias("entry_name"),
        F.coalesce(F.col("e.inputs"), F.array().cast(params)).alias("_in"),
        F.coalesce(F.col("e.outputs"), F.array().cast(params)).alias("_out"),
    )
    # NULL, not a list of NULLs, for entries without a tuple: nothing to convert
    texts = F.expr("transform(concat(_in, _out), p -> IF(startswith(p.type, 'tuple'), p.components, NULL))")
    staged = staged.withColumn("_texts", texts).withColumn(
        "_facts", _tuples(F.expr("IF(exists(_texts, t -> t IS NOT NULL), _texts, NULL)"))).drop("_texts")
    ins, outs = "get(_facts, i)", "get(_facts, i + size(_in))"
    sig = F.expr(f"concat(entry_name, '(', array_join(transform(_in, (p, i) -> {canonical_type_sql('p', ins)}), ','), ')')")
    whole = F.expr(f"forall(transform(_in, (p, i) -> {canonical_type_sql('p', ins)}), t -> t IS NOT NULL)")
    is_ev = F.col("type") == "event"
    return staged.select(
        key, "type", "entry_name",
        F.when(whole, sig).alias("signature"),
        F.when(is_ev, F.expr(_event_inputs_sql("_in", ins))).otherwise(F.expr(_plain_sql("_in", ins))).alias("inputs"),
        F.when(is_ev, F.lit(None).cast("string")).otherwise(F.expr(_plain_sql("_out", outs))).alias("outputs"),
        F.expr(_full_sql("_in", ins)).alias("abi_inputs"),
        F.expr(_full_sql("_out", outs)).alias("abi_outputs"),
    )


_HASH_SCHEMA = T.StructType([
    T.StructField("signature", T.StringType()),
    T.StructField("keccak", T.StringType()),
])


def _keccak_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"signature": pdf["signature"],
                            "keccak": [keccak_hex(s) for s in pdf["signature"]]})


def signature_hashes(signatures: DataFrame) -> DataFrame:
    """(signature, keccak) for the distinct signatures of ``signatures``."""
    distinct = signatures.select("signature").where(F.col("signature").isNotNull()).distinct()
    return distinct.mapInPandas(_keccak_batches, _HASH_SCHEMA)


def with_hash_ids(entries: DataFrame) -> DataFrame:
    """Adds ``hash_id``: full topic0 hash for events, 4-byte selector for calls."""
    hashed = entries.join(signature_hashes(entries), "signature", "left")
    return hashed.withColumn(
        "hash_id",
        F.when(F.col("type") == "event", F.col("keccak")).otherwise(F.substring("keccak", 1, 10)),
    ).drop("keccak")


def reduce_abi(abi_docs: DataFrame, entry_name: str, kind: str, key: str = "ordinal") -> DataFrame:
    """X4/X5 (D8): the ABI restricted to entries named ``entry_name`` of one
    kind ('event' or 'function'), as JSON text per key. The entries keep all
    their fields and their order."""
    entries = abi_docs.select(key, F.from_json("abi", "array<string>").alias("entries"))
    named = F.filter("entries", lambda e: (F.get_json_object(e, "$.name") == entry_name) & (F.get_json_object(e, "$.type") == kind))
    return entries.select(key, named.alias("found")).where(F.size("found") > 0).select(
        key, F.concat(F.lit("["), F.array_join("found", ","), F.lit("]")).alias("abi"))
