"""Layouts from the registry's own text (F22): a registry that was exported
and read back (S7/S8) can drive the decoders, without the ABI documents.

The text names registry types: ``ADDRESS``, ``INT64``, ``ARRAY<a T, b
ARRAY<...>>``. A recursive-descent parser turns one into a tree, with any
nesting. The text says less than the ABI: BIGNUMERIC may be any wide integer,
STRING any bytes, and one ARRAY spelling serves tuples, arrays of tuples and
arrays of plain values. The hash id settles it: of the ABI types that the text
may stand for, most common ones first, those whose signature has the row's hash
are the layout. Where none of ``TRIES`` does, and for results (which no hash
covers), the most common reading stands.
"""

from __future__ import annotations

import itertools
import json
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keccak import keccak_hex
from . import registry as reg

#: Signatures tried for one layout.
TRIES = 4096

# ABI types a registry type may stand for, by how common they are.
_READINGS = {
    "ADDRESS": ["address"],
    "BOOL": ["bool"],
    "INT64": ["uint8", "uint32", "int24", "uint16", "uint24", "uint40", "uint48", "int64", "int32", "int8", "int16", "uint56"],
    "BIGNUMERIC": ["uint256", "int256", "uint128", "uint112", "uint160", "uint96", "uint64", "int128", "uint192", "uint224"],
    "STRING": ["string", "bytes32", "bytes", "bytes4", "bytes20", "bytes16", "bytes8", "function"],
}
_TOKEN = re.compile(r"\s*(ARRAY\s*<|[<>,]|[^\s<>,]+)", re.IGNORECASE)


def parse_type(text: str):
    """A registry type: its name, or for ``ARRAY<...>`` the list of its (name,
    type) fields. Field names may be empty. Raises ValueError."""
    tokens = [re.sub(r"\s", "", t) for t in _TOKEN.findall(text or "")]
    at = 0

    def peek():
        return tokens[at] if at < len(tokens) else ""

    def take(expected=None):
        nonlocal at
        t = peek()
        if not t or expected and t != expected:
            raise ValueError(f"{text!r}: no {expected or 'type'} at {at}")
        at += 1
        return t

    def kind():
        t = take().upper()
        if t != "ARRAY<":
            if t not in _READINGS:
                raise ValueError(f"{text!r}: unknown type {t}")
            return t
        fields = []
        while peek() != ">":
            if fields:
                take(",")
            # a field without a name starts with its type
            after = tokens[at + 1] if at + 1 < len(tokens) else ""
            nameless = peek().upper() == "ARRAY<" or peek().upper() in _READINGS and after in (",", ">")
            fields.append(("" if nameless else take(), kind()))
        take(">")
        return fields

    out = kind()
    if at != len(tokens):
        raise ValueError(f"{text!r}: more text after the type")
    return out


def _readings(name: str, kind) -> list[dict]:
    """ABI parameters that a (name, type) may stand for, the common ones first."""
    if isinstance(kind, str):
        return [{"name": name, "type": t} for t in _READINGS[kind]]
    out = []
    if len(kind) == 1 and kind[0][0] == name and isinstance(kind[0][1], str):
        out = [{"name": name, "type": f"{t}[]"} for t in _READINGS[kind[0][1]]]
    fields = list(itertools.islice(by_rank([_readings(*f) for f in kind]), TRIES))
    return out + [{"name": name, "type": t, "components": list(f)} for f in fields for t in ("tuple", "tuple[]")]


def by_rank(choices: list[list]):
    """One of each list, in the order of the sum of their places."""
    most = sum(len(c) - 1 for c in choices)

    def places(i, total):
        if i == len(choices) - 1:
            if total < len(choices[i]):
                yield (choices[i][total],)
            return
        for k in range(min(total, len(choices[i]) - 1) + 1):
            for rest in places(i + 1, total - k):
                yield (choices[i][k], *rest)
    if not choices:
        yield ()
        return
    for total in range(most + 1):
        yield from places(0, total)


def _canonical(p: dict) -> str:
    if "components" in p:
        return "(" + ",".join(map(_canonical, p["components"])) + ")" + p["type"][len("tuple"):]
    return p["type"]


def _parameters(text: str | None) -> list[tuple[dict, object]]:
    """(plain fields, type tree) of a layout's text, JSON objects joined by commas."""
    out = []
    for p in json.loads(f"[{text or ''}]"):
        # both spellings of the place: "topic1" / "data", and "topics[1]" / "input"
        indexed = bool(re.fullmatch(r"topics?\[?[0-9]+\]?", p.get("index_type") or ""))
        out.append(({"name": p.get("name") or "", "indexed": indexed}, parse_type(p.get("type") or "STRING")))
    return out


def layout(text: str | None, entry: str | None = None, hashes: tuple = ()) -> tuple[list[dict], str | None]:
    """ABI parameters of a layout's text, and which of ``hashes`` their
    signature has (None: none of them, the most common reading)."""
    plain = _parameters(text)
    choices = [_readings(p["name"], kind) for p, kind in plain]
    first = None
    for params in itertools.islice(by_rank(choices), TRIES if hashes else 1):
        full = [{**p, **q} for p, q in zip((x for x, _ in plain), params)]
        first = first or full
        own = keccak_hex(f"{entry}({','.join(map(_canonical, full))})") if hashes else None
        for h in hashes:
            if own == h or own[:10] == h:
                return full, h
    return first or [], None


_SPEC = T.StructType([T.StructField(n, T.StringType()) for n in ("inputs", "outputs", "hash_id", "abi_inputs", "abi_outputs")])


def _layouts(sub_name: str, kind: str, inputs: str, outputs: str, hash_ids: str) -> list[dict]:
    """The layouts of one registry row with their hash."""
    entry = re.split("_evt_" if kind == "event" else "_call_", sub_name, maxsplit=1, flags=re.IGNORECASE)[-1]
    hashes = tuple(h for h in json.loads(hash_ids or "[]") if h)
    results = [t for t in json.loads(outputs or "[]") if t]
    out, open_ = [], []
    for text in json.loads(inputs or "[]"):
        try:
            params, h = layout(text, entry, hashes)
        except ValueError:
            continue  # no layout, no rows
        (out if h else open_).append((text, params, h))
    # a layout without a hash takes one that no other has
    left = [h for h in hashes if h not in {h for *_, h in out}]
    out += [(text, params, h) for (text, params, _), h in zip(open_, left)]
    shown = results[0] if results else None
    abi_out = json.dumps(layout(shown)[0]) if shown else "[]"
    return [{"inputs": text, "outputs": shown, "hash_id": h, "abi_inputs": json.dumps(params), "abi_outputs": abi_out} for text, params, h in out]


@F.pandas_udf(T.ArrayType(_SPEC))
def _registry_layouts(names: pd.Series, kinds: pd.Series, inputs: pd.Series, outputs: pd.Series, hash_ids: pd.Series) -> pd.Series:
    known: dict = {}
    out = []
    for key in zip(names, kinds, inputs, outputs, hash_ids):
        if key not in known:
            known[key] = _layouts(*key)
        out.append(known[key])
    return pd.Series(out, dtype=object)


def specs_from_registry(registry: DataFrame) -> DataFrame:
    """The decoders' spec rows (as ``registry.signature_specs``) from registry
    rows alone: each layout of a row with its hash, for each address of it. A
    name that the allow-list spells in two ways gives a table for each."""
    each = registry.select("sub_name", "type", "namespace", "min_created_ts", "contract_addresses",
                       F.explode(_registry_layouts("sub_name", "type", "inputs_", "outputs", "hash_ids")).alias("l"))
    return each.select(
        "type", "l.hash_id", F.explode(F.from_json("contract_addresses", "array<string>")).alias("contract_address"), "namespace",
        reg.table_name(F.col("sub_name")).alias("table"), "sub_name", "l.inputs", "l.outputs", "l.abi_inputs", "l.abi_outputs", "min_created_ts")
