"""ABI documents: tuples of any depth, documents that are partly unreadable, reduced documents."""

import json

from logloom.functions.keccak import keccak_hex
from logloom.operators import abi


def nested(levels, leaf="uint"):
    field = {"name": "leaf", "type": leaf}
    for i in range(levels):
        field = {"name": f"l{i}", "type": "tuple" + ("[]" if i % 3 == 0 else ""), "components": [{"name": "a", "type": "address"}, field]}
    return field


def spelled(p):
    if p["type"].startswith("tuple"):
        return "(" + ",".join(spelled(c) for c in p["components"]) + ")" + p["type"][5:]
    return "uint256" if p["type"] == "uint" else p["type"]


def documents(spark, *docs):
    return spark.createDataFrame([(i, d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)], "ordinal long, abi string")


def test_tuples_of_forty_levels(spark):
    deep = [{"type": "event", "name": "Deep", "inputs": [{"name": "x", "type": "bool", "indexed": True}, nested(40)]},
            {"type": "event", "name": "Transfer", "inputs": [{"name": "to", "type": "address"}]},
            {"type": "function", "name": "f", "inputs": [nested(11)], "outputs": [nested(3, "int64"), {"name": "", "type": "uint56[]"}]}]
    got = {(r["ordinal"], r["entry_name"]): r for r in
           abi.with_hash_ids(abi.signature_entries(documents(spark, deep, [{"type": "event", "name": "E", "inputs": []}]))).collect()}
    assert len(got) == 4
    want = f"Deep(bool,{spelled(nested(40))})"
    assert got[0, "Deep"]["signature"] == want and got[0, "Deep"]["hash_id"] == keccak_hex(want)
    assert got[0, "Transfer"]["signature"] == "Transfer(address)"
    assert got[0, "f"]["signature"] == f"f({spelled(nested(11))})"
    outputs = json.loads("[" + got[0, "f"]["outputs"] + "]")
    assert outputs[0]["type"] == "ARRAY<a ADDRESS, l1 ARRAY<a ADDRESS, l0 ARRAY<a ADDRESS, leaf INT64>>>"
    assert outputs[1]["type"] == "ARRAY< INT64>"
    inputs = json.loads("[" + got[0, "Deep"]["inputs"] + "]")
    assert [x["index_type"] for x in inputs] == ["topic1", "data"]


def test_unreadable_tuples_lose_only_their_own_signature(spark):
    doc = [{"type": "event", "name": "A", "inputs": [{"name": "t", "type": "tuple"}]},
           {"type": "event", "name": "B", "inputs": [{"name": "t", "type": "tuple", "components": []}]},
           {"type": "event", "name": "C", "inputs": [{"name": "t", "type": "tuple", "components": "text"}]},
           {"type": "event", "name": "D", "inputs": [{"name": None, "type": "uint8"}]}]
    got = {r["entry_name"]: r["signature"] for r in abi.signature_entries(documents(spark, doc, "broken [", "{}")).collect()}
    assert got == {"A": None, "B": "B(())", "C": None, "D": "D(uint8)"}


def test_reduced_documents_keep_their_fields(spark):
    doc = [{"type": "function", "name": "f", "stateMutability": "view", "inputs": [nested(12)], "extra": {"k": [1]}},
           {"type": "event", "name": "f", "inputs": []}, {"type": "function", "name": "f", "inputs": []}, {"type": "function", "name": "g"}]
    got = {r["ordinal"]: json.loads(r["abi"]) for r in abi.reduce_abi(documents(spark, doc, "broken", [doc[3]]), "f", "function").collect()}
    assert got == {0: [doc[0], doc[2]]}
