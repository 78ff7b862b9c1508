"""D9 decode-all: every registered event (or call) decoded in ONE scan.

The reference generates one SQL model per signature (300k+ scans of the logs).
Here the logs are joined once with all spec rows on ``(hash, address)`` plus the
residual ``block_time >= min_ts`` (JN10), and each row is decoded with *its own*
layout by one interpretive native expression (``transform`` over the parsed
ABI parameters). Everything ends in one form, ``entries``: an array with the
place (topic, data, input, output), name, kind and value of each argument, or
its items. All results are native expressions over it: the long form (D5:
``args`` as ``array<struct<key, value>>``, arrays joined by ``|||``), its JSON
text, the decoded document (X6/X7), and the typed columns of the table sink.

Python sees words, not rows: the 256-bit integers of a row as one flat column of
hex words, and the payloads whose layout the expression cannot read (tuples,
fixed and nested arrays, arrays of ``string`` or ``bytes``), which
``functions.nested`` reads for all rows of a layout together. Rows without
either pass as NULL.

An address may be listed with several layouts of one hash (an ERC-20 and an
ERC-721 ``Transfer``); each row takes the one that fits it best (``_CHOICE``).

Scale: the spec side is (hash, address) rows; Spark broadcasts it only if its
measured size is below the threshold, otherwise both sides shuffle on
``(hash, address)`` -- never on the hash alone, so the hot Transfer hash spreads
over all addresses, and AQE splits a skewed address partition. Output is
range-clustered by hash and address, not partitioned per table (300k
directories would be a small-file disaster); ``write_tables`` makes tables.
"""

from __future__ import annotations

import json
import re
import uuid
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import words as wd
from ..functions.hexint import in_lists
from ..functions.nested import dumps, each_argument, words
from ..operators import abi as abi_ops
from ..operators import decode as dec
from ..operators.decode import CALL_META, EVENT_META, head_words, input_names, is_dynamic, is_wide, output_names, parse_param
from ..session import ensure_checkpoint_dir, stage

ENTRY = T.StructType([T.StructField(n, T.StringType()) for n in ("src", "key", "kind", "value")]
                     + [T.StructField("items", T.ArrayType(T.StringType()))])
SEP = "|||"
# 0-based places of the first word of event data / call output and of call input
_DATA, _INPUT = wd.DATA_BASE - 1, wd.INPUT_BASE - 1
_PLAIN_PARAMS = T.ArrayType(T.StructType([T.StructField("name", T.StringType()),
                                          T.StructField("type", T.StringType()),
                                          T.StructField("indexed", T.BooleanType())]))


# What a layout says, worked out once per distinct one: the unique argument
# names, the columns of its table, and what a row must look like to fit it.
_SHAPE = T.StructType([T.StructField("names", T.ArrayType(T.StringType())), T.StructField("types", T.ArrayType(T.StringType())),
                       T.StructField("topics", T.IntegerType()), T.StructField("head", T.LongType()),
                       T.StructField("static", T.BooleanType())])


def column_type(p: dict) -> str:
    """SQL type of an argument's column, as in the wide form: arrays of plain
    values are arrays, everything deeper is JSON text."""
    n = parse_param(p)
    array = n.kind == "array" and not p.get("indexed")
    e = n.elem if array else n
    if e.kind != "scalar" or p.get("indexed") and is_dynamic(e):
        return "string"
    plain = "boolean" if e.scalar == "bool" else "bigint" if e.scalar.startswith(("uint", "int")) and not is_wide(e.scalar) else "string"
    return f"array<{plain}>" if array else plain


def shape(kind: str, abi_in: str | None, abi_out: str | None) -> dict:
    ins, outs = json.loads(abi_in or "[]"), json.loads(abi_out or "[]")
    if kind == "event":
        names, params = input_names(ins, EVENT_META), ins
        types = [column_type(p) for p in ins]
    else:
        names = input_names(ins, CALL_META)
        names = names + output_names(outs, CALL_META + tuple(names))
        types = [column_type(p) for p in [*ins, *outs]] + ([] if outs else ["string"])
        params = ins
    data = [parse_param(p) for p in params if kind == "call" or not p.get("indexed")]
    return {"names": names, "types": types, "topics": sum(bool(p.get("indexed")) for p in ins), "head": 64 * sum(map(head_words, data)),
            "static": not any(map(is_dynamic, data))}


@F.arrow_udf(_SHAPE)
def _shapes(kind: pa.Array, abi_in: pa.Array, abi_out: pa.Array) -> pa.Array:
    known: dict = {}
    out = []
    for key in zip(kind.to_pylist(), abi_in.to_pylist(), abi_out.to_pylist()):
        if key not in known:
            known[key] = shape(*key)
        out.append(known[key])
    fields = [("names", pa.list_(pa.string())), ("types", pa.list_(pa.string())), ("topics", pa.int32()), ("head", pa.int64()), ("static", pa.bool_())]
    return pa.array(out, type=pa.struct(fields))


# Per-argument layout, computed once per spec row (before the join) so that
# log rows only extract words. Kinds: address, bool, u64, i64, uwide, iwide,
# word (bytesN), string, bytes, and "array:<kind>" for T[] of scalars.
_SQL_FIXED = r"'\\[[0-9]+\\]|\\]\\['"

_KIND_SQL = """CASE
  WHEN p.type RLIKE {fixed} OR p.type LIKE 'tuple%' THEN NULL
  ELSE concat(IF(p.type LIKE '%[]', 'array:', ''), CASE
    WHEN b = 'address' THEN 'address' WHEN b = 'bool' THEN 'bool'
    WHEN b RLIKE '^uint[0-9]*$' THEN IF(nb <= 56, 'u64', 'uwide')
    WHEN b RLIKE '^int[0-9]*$' THEN IF(nb <= 64, 'i64', 'iwide')
    WHEN b = 'string' THEN 'string' WHEN b = 'bytes' THEN 'bytes'
    WHEN b RLIKE '^bytes[0-9]+$' THEN 'word' END) END"""


def _kind_sql() -> str:
    b = "IF(p.type LIKE '%[]', substr(p.type, 1, length(p.type) - 2), p.type)"
    nb = f"coalesce(try_cast(nullif(regexp_extract({b}, '^u?int([0-9]*)$', 1), '') AS INT), 256)"
    return _KIND_SQL.format(fixed=_SQL_FIXED).replace("nb", nb).replace(" b ", f" {b} ").replace(
        "WHEN b", f"WHEN {b}")


def call_layout_sql(inputs: str, outputs: str) -> str:
    """Layout of a call: arguments after the 4-byte selector (``input``,
    offsets relative to char 11), results in ``output`` (char 3). A function
    without outputs gets ``output_0``, the raw first output word."""
    kind = _kind_sql()
    key_in, key_out = "get(_shape.names, i)", f"get(_shape.names, i + size({inputs}))"
    ins = (f"transform({inputs}, (p, i) -> named_struct('key', {key_in}, 'kind', {kind}, "
           f"'head', 11 + i * 64, 'src', 'in', 'area', 11))")
    outs = (f"IF(size({outputs}) = 0, array(named_struct('key', element_at(_shape.names, -1), 'kind', 'word', 'head', 3, "
            f"'src', 'out', 'area', 3)), transform({outputs}, (p, i) -> named_struct('key', {key_out}, "
            f"'kind', {kind}, 'head', 3 + i * 64, 'src', 'out', 'area', 3)))")
    return f"concat({ins}, {outs})"


def layout_sql(params: str) -> str:
    """``array<struct<key, kind, indexed, topic, head>>`` for a parameter list."""
    b = "IF(p.type LIKE '%[]', substr(p.type, 1, length(p.type) - 2), p.type)"
    nb = f"coalesce(try_cast(nullif(regexp_extract({b}, '^u?int([0-9]*)$', 1), '') AS INT), 256)"
    kind = _KIND_SQL.format(fixed=_SQL_FIXED).replace("nb", nb).replace(" b ", f" {b} ").replace(
        "WHEN b", f"WHEN {b}")
    n_idx = f"size(filter(slice({params}, 1, i), y -> coalesce(y.indexed, false)))"
    return (f"transform({params}, (p, i) -> named_struct('key', get(_shape.names, i), 'kind', {kind}, "
            f"'indexed', coalesce(p.indexed, false), 'topic', {n_idx} + 1, "
            f"'head', 3 + (i - {n_idx}) * 64))")


_ZEROS48 = "0" * 48
_MAXW = 1 << 31


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` for ``value``, as SQL. Inside a lambda Spark shares
    no common subexpressions: what is used twice is bound, or worked out twice."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _wlong(w: str) -> str:
    """word_to_long in SQL: 64-char word whose value fits 63 bits, else NULL.
    ``w`` is used several times: a name."""
    return (f"IF(length({w}) = 64 AND substr({w}, 1, 48) = '{_ZEROS48}' AND substr({w}, 49, 16) RLIKE '^[0-9a-fA-F]+$', "
            f"try_cast(conv(substr({w}, 49, 16), 16, 10) AS BIGINT), NULL)")


def _word_text_sql(kind: str, w: str) -> str:
    """Text of a word (``w``: a name) of a kind."""
    signed = (f"IF(length({w}) = 64 AND {w} RLIKE '^[0-9a-fA-F]+$' AND ((substr({w}, 1, 48) = '{_ZEROS48}' "
              f"AND substr({w}, 49, 1) < '8') OR (lower(substr({w}, 1, 48)) = '{'f' * 48}' "
              f"AND lower(substr({w}, 49, 1)) >= '8')), conv(substr({w}, 49, 16), 16, -10), NULL)")
    return (f"CASE WHEN {kind} LIKE '%address' THEN concat('0x', right({w}, 40)) "
            f"WHEN {kind} LIKE '%bool' THEN CAST({_wlong(w)} <> 0 AS STRING) "
            f"WHEN {kind} LIKE '%u64' THEN CAST({_wlong(w)} AS STRING) "
            f"WHEN {kind} LIKE '%i64' THEN {signed} ELSE {w} END")


def _args_sql(text: str = "data", area: str = "3", topics: bool = True) -> str:
    """Per-row decode over the precomputed layout ``_layout`` (SQL text).
    ``text`` / ``area`` may depend on the argument (calls read ``input``
    after the selector and ``output``). The words, offsets and lengths of an
    argument are read once each."""
    def tail(width: int) -> str:
        """What the offset word ``w`` points at: its length word, then as many times ``width`` characters."""
        read = (f"IF(n <= {_MAXW} AND s + 63 + n * {width} <= length(t), "
                f"substr(t, least(s + 64, {_MAXW - 1}), least(n * {width}, {_MAXW - 1})), NULL)")
        size = _let("l", f"substr(t, least(s, {_MAXW - 1}), 64)", _let("n", _wlong("l"), read))
        return _let("o", _wlong("w"), f"IF(o <= {_MAXW}, {_let('s', f'{area} + o * 2', size)}, NULL)")

    items = f"transform(regexp_extract_all({tail(64)}, '(.{{64}})', 1), e -> {_word_text_sql('a.kind', 'e')})"
    data_value = (f"CASE WHEN a.kind = 'string' THEN try_validate_utf8(CAST(unhex({tail(2)}) AS STRING)) "
                  f"WHEN a.kind = 'bytes' THEN concat('0x', {tail(2)}) "
                  f"WHEN a.kind LIKE 'array:%' THEN NULL "
                  f"ELSE {_word_text_sql('a.kind', 'w')} END")

    def read(src: str, data: str) -> str:
        entry = (f"named_struct('src', {src}, 'key', a.key, 'kind', a.kind, 'value', {data_value}, "
                 f"'items', IF(a.kind LIKE 'array:%', {items}, NULL))")
        return _let("t", data, _let("w", "substr(t, a.head, 64)", entry))
    if not topics:
        return f"transform(_layout, a -> {read("IF(a.src = 'out', 'output', 'input')", text)})"
    topic = "element_at(array(topic1, topic2, topic3), least(a.topic, 3))"
    hashed = "(a.kind IN ('string', 'bytes') OR a.kind LIKE 'array:%')"
    topic_value = f"IF({hashed}, {topic}, {_let('w', f'substr({topic}, 3, 64)', _word_text_sql('a.kind', 'w'))})"
    own = f"named_struct('src', 'topic', 'key', a.key, 'kind', IF({hashed}, 'word', a.kind), 'value', {topic_value}, 'items', CAST(NULL AS array<string>))"
    return f"transform(_layout, a -> IF(a.indexed, {own}, {read("'data'", text)}))"


@F.arrow_udf(T.ArrayType(T.ArrayType(T.StringType())))
def _unsigned(hexes: pa.Array) -> pa.Array:
    return in_lists(hexes)


@F.arrow_udf(T.ArrayType(T.ArrayType(T.StringType())))
def _signed(hexes: pa.Array) -> pa.Array:
    return in_lists(hexes, True)


def _wide_sql(kind: str) -> str:
    """The hex words of a row's arguments of one wide kind, in lists; an empty
    list if it has none: Spark's Arrow writer goes through the NULL lists before
    a row again for each row, so many of them cost their square."""
    return (f"IF(exists(_raw, r -> r.kind IN ('{kind}', 'array:{kind}')), transform(_raw, r -> CASE WHEN r.kind = '{kind}' THEN array(r.value) "
            f"WHEN r.kind = 'array:{kind}' THEN r.items END), CAST(array() AS array<array<string>>))")


_WITH_WIDE = ("transform(_raw, (r, i) -> named_struct('src', r.src, 'key', r.key, 'kind', r.kind, 'value', "
              "CASE r.kind WHEN 'uwide' THEN get(get(_u, i), 0) WHEN 'iwide' THEN get(get(_i, i), 0) ELSE r.value END, 'items', "
              "CASE r.kind WHEN 'array:uwide' THEN get(_u, i) WHEN 'array:iwide' THEN get(_i, i) ELSE r.items END))")


def _quoted(x: str) -> str:
    """JSON of a text, as SQL."""
    return _let("j", f"to_json(array({x}))", "substr(j, 2, length(j) - 2)")


_LONG = f"transform(_entries, e -> named_struct('key', e.key, 'value', IF(e.items IS NULL, e.value, array_join(e.items, '{SEP}', ''))))"
_JSON = f"to_json({_LONG}, map('ignoreNullFields', 'false'))"
_FRAGMENT = (f"CASE WHEN e.items IS NOT NULL THEN to_json(e.items, map('ignoreNullFields', 'false')) WHEN e.value IS NULL THEN 'null' "
             f"WHEN e.kind = 'json' THEN e.value ELSE {_quoted('e.value')} END")
#: X6/X7 decoded document: ``{"topic": {...}, "data": {...}}`` for events,
#: ``{"input": {...}, "output": {...}}`` for calls; arrays as JSON arrays, NULL fields kept.
_DOCUMENT = (f"concat('{{', array_join(transform(array_distinct(transform(_entries, e -> e.src)), s -> concat('\"', s, '\":{{', "
             f"array_join(transform(filter(_entries, e -> e.src = s), e -> concat({_quoted('e.key')}, ':', {_FRAGMENT})), ','), '}}')), ','), '}}')")


def _table_bound() -> Column:
    """Table-level lower time bound (group minimum of creation times, as the
    reference applies it) as a window over the spec rows -- a self-join with
    an aggregate would compute the whole registry lineage twice."""
    return F.min("min_created_ts").over(Window.partitionBy("namespace", "table"))


def _native(params: Column) -> Column:
    """Layouts that the native expression reads."""
    return F.forall(params, lambda p: ~p["type"].startswith("tuple") & ~p["type"].rlike(r"\[[0-9]+\]")
                    & ~p["type"].rlike(r"\]\[") & ~p["type"].isin("string[]", "bytes[]"))


def _shaped(s: DataFrame, *columns) -> DataFrame:
    return s.select(F.col("hash_id").alias("_h"), F.col("contract_address").alias("_a"), "namespace", "table", "min_created_ts", *columns,
                    _shapes("type", "abi_inputs", "abi_outputs").alias("_shape"))


def _options(one: DataFrame, *fields: str) -> DataFrame:
    """One row per (hash, address, table): its layouts in an array, and the table's time bound."""
    each = F.struct("_abi_in", "_abi_out", *fields)
    listed = one.groupBy("_h", "_a", "namespace", "table").agg(
        F.array_sort(F.collect_set(each)).alias("_options"), F.min("min_created_ts").alias("min_created_ts"))
    return listed.withColumn("min_ts", _table_bound()).drop("min_created_ts")


def _choice(fit: str) -> Column:
    """The layout that fits the row best, the first of equal ones (O3)."""
    return F.expr(f"IF(size(_options) = 1, _options[0], array_max(transform(_options, (o, i) -> named_struct('fit', {fit}, 'i', -i, 'o', o))).o)")


#: How well an event's layout fits a log: its number of topics, then room for the
#: head in the data, then the exact length of a static layout.
_EVENT_FIT = ("IF(o._shape.topics = size(array_compact(array(topic1, topic2, topic3))), 4, 0) + IF(length(data) - 2 >= o._shape.head, 2, 0) "
              "+ IF(o._shape.static AND length(data) - 2 = o._shape.head, 1, 0)")
_CALL_FIT = "IF(length(input) - 10 >= o._shape.head, 2, 0) + IF(o._shape.static AND length(input) - 10 = o._shape.head, 1, 0)"


def event_specs(specs: DataFrame) -> DataFrame:
    """Event spec rows, one per hash, address and table, with the table-level
    lower time bound and the possible layouts (small)."""
    s = specs.where(F.col("type") == "event")
    one = _shaped(s, F.col("abi_inputs").alias("_abi_in"), F.lit(None).cast("string").alias("_abi_out"),
                        _native(F.from_json("abi_inputs", T.ArrayType(abi_ops.PARAM))).alias("_plain"),
                        F.from_json("abi_inputs", _PLAIN_PARAMS).alias("_params"))
    return _options(one.withColumn("_layout", F.expr(layout_sql("_params"))), "_shape", "_plain", "_layout")


def call_specs(specs: DataFrame) -> DataFrame:
    """Call spec rows like :func:`event_specs`, with the success guard (the
    reference guards only layouts with arrays/tuples)."""
    s = specs.where(F.col("type") == "call")
    both = F.concat(F.from_json("abi_inputs", T.ArrayType(abi_ops.PARAM)), F.from_json("abi_outputs", T.ArrayType(abi_ops.PARAM)))
    guard = F.exists(both, lambda p: p["type"].contains("[") | p["type"].startswith("tuple"))
    one = _shaped(s, F.col("abi_inputs").alias("_abi_in"), F.col("abi_outputs").alias("_abi_out"),
                        _native(both).alias("_plain"), guard.alias("_guard"),
                        F.from_json("abi_inputs", _PLAIN_PARAMS).alias("_pin"), F.from_json("abi_outputs", _PLAIN_PARAMS).alias("_pout"))
    return _options(one.withColumn("_layout", F.expr(call_layout_sql("_pin", "_pout"))), "_shape", "_plain", "_layout", "_guard")


def _staged(specs: DataFrame) -> DataFrame:
    """The spec side written once to the shared folder: the registry runs once,
    the planner knows the size, and where it is too large to broadcast Spark
    builds Bloom filters of its hashes and addresses (``bloom_filter_agg``) and
    puts them below the exchange, on the scan of the logs. That takes a stored
    side with a predicate, which the address gives."""
    return stage(specs, "specs").where((F.length("_a") > 0) & (F.length("_h") > 0))


def _since(source: DataFrame, specs: DataFrame) -> DataFrame:
    """P6 for the scan: no table has rows before the earliest time bound of all,
    where every spec row has one; a literal, so that row groups are skipped."""
    lo = specs.agg(F.min("min_ts").alias("lo"), F.count(F.lit(1)).alias("n"), F.count("min_ts").alias("known")).first()
    return source.where(F.col("block_time") >= F.lit(lo["lo"])) if lo["n"] and lo["known"] == lo["n"] else source


def decode_all_events(logs: DataFrame, specs: DataFrame, as_json: bool | str = False) -> DataFrame:
    """D9 (events) + D5 long form, one scan of ``logs``. ``as_json``: False ->
    ``args`` array<struct<key,value>>; True -> the same as JSON text;
    ``"document"`` -> X6 decoded document text; ``"entries"`` -> the entries
    with the layout's column names and types."""
    sp = _staged(event_specs(specs))
    joined = _since(logs, sp).join(sp, (F.col("evt_hash") == F.col("_h")) & (F.col("contract_address") == F.col("_a")))
    joined = joined.where(F.col("min_ts").isNull() | (F.col("block_time") >= F.col("min_ts")))
    mine = joined.select(*dec.event_meta(), "namespace", "table", "topic1", "topic2", "topic3", "data", _choice(_EVENT_FIT).alias("_o"))
    mine = mine.select("*", "_o._shape", "_o._layout", "_o._plain")
    rest = F.struct(F.col("_o._abi_in").alias("_abi"), F.col("data").alias("text"), F.lit(None).cast("string").alias("out"),
                    F.lit(None).cast("string").alias("_abi_out"), "topic1", "topic2", "topic3")
    return _finish(mine, F.expr(_args_sql("data")), rest, as_json, "event", EVENT_META)


def decode_all_calls(traces: DataFrame, specs: DataFrame, as_json: bool | str = False) -> DataFrame:
    """D9 (calls) + D5 long form, one scan of ``traces``; ``as_json`` as for events (X7 documents)."""
    sp = _staged(call_specs(specs))
    joined = _since(traces, sp).join(sp, (F.col("method_id") == F.col("_h")) & (F.col("to") == F.col("_a")))
    joined = joined.where(F.col("min_ts").isNull() | (F.col("block_time") >= F.col("min_ts")))
    mine = joined.select(*dec.call_meta(), "namespace", "table", "input", "output", "success", _choice(_CALL_FIT).alias("_o"))
    failed = F.col("_o._guard") & ~F.coalesce(F.col("success"), F.lit(False))
    mine = mine.select("*", "_o._shape", "_o._layout", "_o._plain", F.when(~failed, F.col("input")).alias("_in"),
                       F.when(~failed, F.col("output")).alias("_out"))
    rest = F.struct(F.col("_o._abi_in").alias("_abi"), F.col("_in").alias("text"), F.col("_out").alias("out"), "_o._abi_out")
    return _finish(mine, F.expr(_args_sql("IF(a.src = 'out', _out, _in)", "a.area", topics=False)), rest, as_json, "call", CALL_META)


_ARROW_ENTRY = pa.list_(pa.struct([("src", pa.string()), ("key", pa.string()), ("kind", pa.string()), ("value", pa.string()),
                                   ("items", pa.list_(pa.string()))]))


def _read_column(reader, node, at, area) -> tuple[str, pa.Array]:
    """One argument of all rows: texts of a ``word``, items of an ``array:``, JSON."""
    if node.kind == "scalar":
        return "word", reader.plain(node, at, area)
    if node.kind == "array" and node.elem.kind == "scalar":
        return "array:", reader.items(node, at, area)
    return "json", reader.json(node, at, area)


def _columns(params: list[dict], names: list[str], src: str, texts: pa.Array, base: int, topics: list[pa.Array] | None = None) -> list[tuple]:
    """One layout's parameters, each as its place, name, kind and column of values."""
    data = [parse_param(p) for p in params if not (topics is not None and p.get("indexed"))]
    found = each_argument(data, texts, base)
    out, seen = [], 0
    for p, name in zip(params, names):
        if topics is not None and p.get("indexed"):
            n = parse_param(p)
            own = topics[seen] if seen < 3 else pa.nulls(len(texts), pa.string())
            seen += 1
            out.append(("topic", name, "word", words(n.scalar, own) if n.kind == "scalar" and not is_dynamic(n) else own))
        else:
            out.append((src, name, *_read_column(*next(found))))
    return out


def _as_entries(columns: list[tuple], n: int) -> pa.Array:
    """The entries of ``n`` rows, from the columns of their arguments."""
    cols = []
    for src, name, kind, values in columns:
        items = pa.nulls(n, pa.list_(pa.string()))
        if kind == "array:":
            values, items = pa.nulls(n, pa.string()), values
        elif kind == "json":  # an empty list is one in every form: no items
            empty = pc.fill_null(pc.equal(values, "[]"), False)
            items = pa.ListArray.from_arrays(pa.array(np.zeros(n + 1, dtype=np.int32)), pa.array([], pa.string()), mask=pc.invert(empty))
            values = pc.if_else(empty, pa.scalar(None, pa.string()), values)
        same = [pa.repeat(pa.scalar(x, pa.string()), n) for x in (src, name, kind)]
        cols.append(pa.StructArray.from_arrays([*same, values, items], fields=list(_ARROW_ENTRY.value_type)))
    # a row's entries follow each other
    flat = pa.concat_arrays(cols).take(pa.array(np.arange(len(cols) * n).reshape(len(cols), -1).T.ravel())) if cols else pa.array([], _ARROW_ENTRY.value_type)
    return pa.ListArray.from_arrays(pa.array((np.arange(n + 1) * len(cols)).astype(np.int32)), flat, type=_ARROW_ENTRY)


#: Bytes that JSON texts escape: 1 for quote and backslash, 2 for control characters.
_ESCAPED = np.zeros(256, dtype=np.uint8)
_ESCAPED[:32] = 2
_ESCAPED[list(b'"\\')] = 1


def json_text(text: str) -> str:
    """``text`` as ``to_json`` writes it."""
    return '"' + re.sub(r"[\x00-\x1f]", lambda m: f"\\u{ord(m[0]):04X}" if (short := dumps(m[0]))[2] == "u" else short[1:-1],
                        text.replace("\\", "\\\\").replace('"', '\\"')) + '"'


def _json_texts(texts: pa.Array) -> pa.Array:
    """:func:`json_text` of each; NULL stays NULL."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else [0, 0]
    odd = _ESCAPED[np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0]:offsets[-1]]].max(initial=0)
    if odd == 2:
        rows = pc.fill_null(pc.match_substring_regex(texts, r"[\x00-\x1f]"), False)
        own = pa.array([json_text(t)[1:-1] for t in texts.filter(rows).to_pylist()], pa.string())
    if odd:
        plain = pc.replace_substring(pc.replace_substring(texts, "\\", "\\\\"), '"', '\\"')
        texts = pc.replace_with_mask(plain, rows, own) if odd == 2 else plain
    return pc.binary_join_element_wise('"', texts, '"', "")


def _as_long(columns: list[tuple], n: int) -> pa.Array:
    """The long form of ``n`` rows as JSON, as ``_JSON`` has it."""
    parts: list = []
    for _, name, kind, values in columns:
        if kind == "array:":
            values = pc.binary_join(values, SEP)
        elif kind == "json":
            values = pc.if_else(pc.equal(values, "[]"), "", values)
        parts += [f'{"," if parts else "["}{{"key":{json_text(name)},"value":', pc.fill_null(_json_texts(values), "null"), "}"]
    return pc.binary_join_element_wise(*parts, "]", "") if parts else pa.array(["[]"] * n, pa.string())


def _as_document(columns: list[tuple], n: int) -> pa.Array:
    """The decoded document of ``n`` rows, as ``_DOCUMENT`` has it."""
    parts: list = []
    for src in dict.fromkeys(c[0] for c in columns):
        parts.append(f'{"}," if parts else "{"}"{src}":{{')
        for i, (_, name, kind, values) in enumerate(c for c in columns if c[0] == src):
            if kind == "word":
                values = _json_texts(values)
            elif kind == "array:":
                lists = pa.ListArray.from_arrays(values.offsets, _json_texts(values.values))
                values = pc.if_else(values.is_valid(), pc.binary_join_element_wise("[", pc.binary_join(lists, ","), "]", ""), pa.scalar(None, pa.string()))
            parts += [f'{"," if i else ""}{json_text(name)}:', pc.fill_null(values, "null")]
    return pc.binary_join_element_wise(*parts, "}}", "") if parts else pa.array(["{}"] * n, pa.string())


#: Forms of nested rows, and their Arrow types.
_FORMS = {"entries": (_as_entries, _ARROW_ENTRY), "long": (_as_long, pa.string()), "document": (_as_document, pa.string())}


def _nested_rows(kind: str, form: str, rest: pa.Array) -> pa.Array:
    """The rows whose layout is not native, read layout by layout, in a form."""
    make, result = _FORMS[form]
    abi, abi_out = (pc.dictionary_encode(rest.field(c)) for c in ("_abi", "_abi_out"))
    code = [pc.fill_null(x.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64) for x in (abi, abi_out)]
    here = rest.is_valid().to_numpy(zero_copy_only=False) & (code[0] >= 0)
    layout = np.where(here, code[0] * (len(abi_out.dictionary) + 1) + code[1] + 1, -1)
    parts, place = [], np.full(len(rest), -1, dtype=np.int64)
    for own in np.unique(layout[here]).tolist():
        rows = np.flatnonzero(layout == own)
        a, o = (abi.dictionary[int(code[0][rows[0]])].as_py(), abi_out.dictionary[int(code[1][rows[0]])].as_py() if code[1][rows[0]] >= 0 else None)
        take = lambda c, at=pa.array(rows): rest.field(c) if len(at) == len(rest) else rest.field(c).take(at)
        ins, texts = json.loads(a), take("text")
        if kind == "event":
            names = input_names(ins, EVENT_META)
            cols = _columns(ins, names, "data", texts, _DATA, [take(f"topic{i}") for i in (1, 2, 3)])
        else:
            outs, results = json.loads(o or "[]"), take("out")
            names = input_names(ins, CALL_META)
            last = output_names(outs, CALL_META + tuple(names))
            cols = _columns(ins, names, "input", texts, _INPUT)
            cols += (_columns(outs, last, "output", results, _DATA) if outs else
                     [("output", last[0], "word", pc.utf8_slice_codeunits(results, _DATA, _DATA + 64))])
        place[rows] = sum(map(len, parts)) + np.arange(len(rows))
        parts.append(make(cols, len(rows)))
    if not parts:
        return pa.nulls(len(rest), result)
    if len(parts[0]) == len(rest):
        return parts[0]
    return pa.concat_arrays(parts).take(pa.array(place, mask=place < 0))


def _nested(kind: str, form: str):
    """An Arrow UDF over ``_rest``."""
    @F.arrow_udf(T.ArrayType(ENTRY) if form == "entries" else T.StringType())
    def nested_rows(rest: pa.Array) -> pa.Array:
        return _nested_rows(kind, form, rest)
    return nested_rows


def _finish(df: DataFrame, raw: Column, rest: Column, as_json, kind: str, meta: tuple[str, ...]) -> DataFrame:
    """Entries of every row, then the form asked for. Only wide integers and
    nested layouts go to Python, in Arrow batches of their own columns: the
    metadata stays in the JVM, and filters on it are pushed below."""
    meta = [c for c in (*meta, "namespace", "table") if c in df.columns]
    plain = F.col("_plain")
    df = df.select(*dict.fromkeys(meta), "_shape", F.when(plain, raw).alias("_raw"), F.when(~plain, rest).alias("_rest"))
    text = as_json and as_json != "entries"  # nested rows come as the text asked for
    read = _nested(kind, "entries" if not text else "document" if as_json == "document" else "long")
    # all that Python does in one pass over the rows
    df = df.select(*dict.fromkeys(meta), "_shape", "_raw", _unsigned(F.expr(_wide_sql("uwide"))).alias("_u"),
                   _signed(F.expr(_wide_sql("iwide"))).alias("_i"), read("_rest").alias("_nested"))
    # a column of its own, used by one expression at a time
    native = F.expr(_WITH_WIDE)
    df = df.select(*dict.fromkeys(meta), "_shape", "_nested", (native if text else F.coalesce(native, "_nested")).alias("_entries"))
    if as_json == "entries":
        return df.drop("_nested").withColumnsRenamed({"_entries": "entries", "_shape": "shape"})
    form = F.expr(_DOCUMENT if as_json == "document" else _JSON if as_json else _LONG)
    return df.select(*dict.fromkeys(meta), F.lit(True).alias("layout_supported"), (F.coalesce("_nested", form) if text else form).alias("args"))


#: Rows that the quantiles of the interleaved key are read from, and bits of each column's rank.
SAMPLE, BITS = 4096, 6


def interleaved(df: DataFrame, columns: list[str], address: str = "contract_address") -> Column:
    """A Z-order key: the bits of each column's rank among the quantiles of
    ``SAMPLE`` rows (those with the smallest hash, so any part of the table is
    as likely), most significant first, in turn; the address gives two bits to
    each one of the others. Rows that are near in any of the columns lie near."""
    rows = df.select(*columns).orderBy(F.xxhash64(*df.columns)).limit(SAMPLE).collect()  # bounded
    ranks = {}
    for c in columns:
        values = sorted(r[c] for r in rows if r[c] is not None)
        cuts = sorted({values[len(values) * i >> BITS] for i in range(1, 1 << BITS)}) if values else []
        spread = (1 << BITS) // (len(cuts) + 1)  # a column of few values still uses the high bits
        ranks[c] = sum((F.when(F.col(c) >= F.lit(v), spread).otherwise(0) for v in cuts), F.lit(0)).cast("int")
    turns, left = [], {c: BITS for c in columns}
    while any(left.values()):
        for c in columns:
            for _ in range(2 if c == address else 1):
                if left[c]:
                    left[c] -= 1
                    turns.append((c, left[c]))
    key = F.lit(0).cast("bigint")
    for c, bit in turns:
        key = key * 2 + F.getbit(ranks[c], F.lit(bit))
    return key


def write_clustered(df: DataFrame, path: str, keys: tuple[str, ...] | None = None,
                    partitions: int | None = None, z_order: bool = False) -> None:
    """S9/S12 sink: full rebuild, range-clustered on ``keys`` so Parquet
    min/max statistics skip row groups for a hash or address predicate. The
    default keys (of events or calls) end with the block number and the row's
    place in it, so one hot contract is spread over several ranges. With
    ``z_order`` an interleaved key of address, hash and block number comes
    first: a predicate on any one of them alone skips row groups too. Parquet
    Bloom filters of addresses and hashes serve what min/max leaves open."""
    if keys is None:
        known = ("evt_hash", "method_id", "contract_address", "evt_block_number", "call_block_number",
                 "block_number", "evt_index", "call_trace_id", "index")
        keys = tuple(k for k in known if k in df.columns)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if z_order:
        first = [k for k in ("contract_address", "evt_hash", "method_id", "evt_block_number", "call_block_number", "block_number") if k in keys]
        df = df.withColumn("_z", interleaved(df, first))
        keys = ("_z", *keys)
    out = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).drop("_z").write.mode("overwrite")
    for c in ("contract_address", "evt_hash", "method_id"):
        if c in df.columns:
            out = out.option(f"parquet.bloom.filter.enabled#{c}", "true")
    out.parquet(path)


def pick(args, key: str) -> Column:
    """A5 keyed pick ``MAX(IF(d.key = name, d.value, NULL))`` over the
    key/value array; a name that occurs twice gives its largest value."""
    col = F.col(args) if isinstance(args, str) else args
    return F.array_max(F.transform(F.filter(col, lambda x: x["key"] == key), lambda x: x["value"]))


def split_cast(text, to_type: str) -> Column:
    """A6 ``ARRAY_AGG(SAFE_CAST(item AS T))`` over a ``|||``-joined list:
    items that do not cast are dropped; an empty result is NULL."""
    col = F.col(text) if isinstance(text, str) else text
    items = F.filter(F.transform(F.split(col, r"\|\|\|"), lambda x: x.try_cast(to_type)),
                     lambda x: x.isNotNull())
    return F.transform(F.array(items), lambda x: F.when(F.size(x) > 0, x))[0]  # split and cast once


def _typed(value: str, items: str, to: str) -> str:
    """A column of a type from an entry's text or items, as SQL."""
    if to.startswith("array<"):
        return items if to == "array<string>" else f"transform({items}, x -> try_cast(x AS {to[6:-1]}))"
    return f"coalesce({value}, to_json({items}))" if to == "string" else f"try_cast({value} AS {to})"


def write_tables(source: DataFrame, specs: DataFrame, kind: str, root: str, target_prefix: str | None = None, threads: int = 8) -> list[tuple[str, str]]:
    """S9 + S11: every table of ``specs`` from ONE scan and decode of
    ``source``, with typed columns, as ``{root}/schema=.../table=...``, where
    the schema is ``[prefix_]{namespace}_ethereum``. Written tables are replaced,
    others under ``root`` stay (dynamic partition overwrite). Returns the
    (schema, table) pairs.

    The decoded rows are written once, by class of tables with the same columns
    (Parquet files of one class have one schema). Each class, read from its own
    partition only, is then written to its tables. Both writes are rebalanced:
    AQE splits a class or table that is too large for one task (a Transfer table
    with a third of all rows) and joins small ones, by measured sizes. The loop
    is over classes, not tables."""
    from ..operators import registry as reg

    spark = source.sparkSession
    decode = decode_all_events if kind == "event" else decode_all_calls
    columns = F.to_json(F.struct("shape.names", "shape.types"))
    rows = decode(source, specs, as_json="entries").select(
        "*", reg.output_schema(F.col("namespace"), target_prefix).alias("schema"), F.sha2(columns, 256).alias("class"), columns.alias("columns"))
    staged = f"{ensure_checkpoint_dir(spark).rstrip('/')}/decoded-{uuid.uuid4().hex}"
    rows.drop("shape", "namespace").hint("rebalance", "class").write.partitionBy("class").parquet(staged)
    decoded = spark.read.parquet(staged)
    classes = decoded.groupBy("class").agg(F.first("columns").alias("columns")).collect()  # column lists, no rows
    meta = [c for c in decoded.columns if c not in ("entries", "class", "columns", "schema", "table")]

    def write(c):
        shape = json.loads(c["columns"])
        cols = [F.expr(_typed(f"entries[{i}].value", f"entries[{i}].items", t)).alias(n)
                for i, (n, t) in enumerate(zip(shape["names"], shape["types"]))]
        own = decoded.where(F.col("class") == c["class"]).select(*cols, *meta, "schema", "table")
        (own.hint("rebalance", "schema", "table").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("schema", "table").parquet(root))
    with ThreadPoolExecutor(threads) as pool:
        list(pool.map(write, classes))
    return [tuple(r) for r in decoded.select("schema", "table").distinct().orderBy("schema", "table").collect()]


def read_table(spark, root: str, schema: str, table: str) -> DataFrame:
    """One table that :func:`write_tables` wrote, with its own columns."""
    return spark.read.parquet(f"{root}/schema={schema}/table={table}")


def materialize_tables(source: DataFrame, specs: DataFrame, tables: list[str], kind: str,
                       root: str, target_prefix: str | None = None) -> list[str]:
    """A few requested wide tables as full rebuilds (``overwrite``), one decode
    pass per table with its filters pushed to the scan, partitioned by output
    schema -> ``{root}/{table}/schema=.../``; :func:`write_tables` writes all
    tables in one pass. Returns the written table paths."""
    from ..operators import registry as reg

    written = []
    for table in tables:
        df = dec.decode_table(source, specs, table, kind)
        path = f"{root}/{table}"
        (df.withColumn("schema", reg.output_schema(F.col("namespace"), target_prefix)).drop("namespace")
         .write.mode("overwrite").partitionBy("schema").parquet(path))
        written.append(path)
    return written


def _variant(doc, parsed) -> Column:
    return F.try_parse_json(F.col(doc) if isinstance(doc, str) else doc) if parsed is None else F.col(parsed)


def json_value(doc, path: str, parsed=None) -> Column:
    """F10 ``JSON_VALUE``: scalar at ``path`` as text; objects/arrays -> NULL
    (``get_json_object`` alone would return their JSON text). The JSON type
    decides: a text that begins with a bracket is a scalar. ``parsed`` as in
    :func:`json_extract`."""
    col = F.col(doc) if isinstance(doc, str) else doc
    kind = F.schema_of_variant(F.try_variant_get(_variant(doc, parsed), path, "variant"))
    text = F.try_variant_get(_variant(doc, parsed), path, "string")  # of a string the text itself: the document is not parsed again
    return F.transform(F.array(kind), lambda k: F.when(k == "STRING", text).when(
        ~(k.startswith("ARRAY") | k.startswith("OBJECT")), F.get_json_object(col, path)))[0]


def json_value_array(doc, path: str) -> Column:
    """F12 ``JSON_VALUE_ARRAY``: array of scalars at ``path`` as array<string>."""
    col = F.col(doc) if isinstance(doc, str) else doc
    return F.from_json(F.get_json_object(col, path), "array<string>")


def json_extract(doc, path: str, parsed=None) -> Column:
    """F11 ``JSON_EXTRACT``: the value at ``path`` as JSON text (texts keep
    their quotes); a JSON null or no value -> NULL. ``parsed``: the document as
    a VARIANT column, where several paths are read from it."""
    return F.nullif(F.to_json(F.try_variant_get(_variant(doc, parsed), path, "variant")), F.lit("null"))


def json_extract_scalar(doc, path: str, parsed=None) -> Column:
    """F11 ``JSON_EXTRACT_SCALAR``: a scalar at ``path`` as plain text, objects and arrays -> NULL."""
    return json_value(doc, path, parsed)


def documents(decoded: DataFrame) -> DataFrame:
    """Decoded documents (``as_json="document"``) with ``args`` as VARIANT."""
    return decoded.withColumn("args", F.parse_json("args"))
