"""Layouts that share a table, malformed bytes, clashing names, large integers."""

import json

import pytest
from pyspark.sql import functions as F

from logloom.functions import words as wd
from logloom.operators import decode as dec
from logloom.plans import fanout

HASH = "0x" + "ab" * 32
SPEC = ("type string, hash_id string, contract_address string, namespace string, table string, sub_name string, "
        "inputs string, outputs string, abi_inputs string, abi_outputs string, min_created_ts timestamp_ntz")
LOG = ("contract_address string, topic0 string, topic1 string, topic2 string, topic3 string, data string, "
       "block_number long, block_time timestamp_ntz, index long, tx_hash string, tx_index long, evt_hash string")


def word(n):
    return f"{n:064x}"


def arg(name, typ, indexed=False):
    return {"name": name, "type": typ, "indexed": indexed}


def specs(spark, *layouts):
    rows = [("event", HASH, f"0x{i:040x}", "ns", "T_evt_E", "T_evt_E", "", None, json.dumps(params), "[]", None)
            for i, params in enumerate(layouts)]
    return spark.createDataFrame(rows, SPEC)


def logs(spark, *rows):
    """(contract number, topics, data, block number)"""
    return spark.createDataFrame(
        [(f"0x{i:040x}", HASH, *(list(topics) + [None] * 3)[:3], "0x" + data, block, None, n, "0xt", 1, HASH)
         for n, (i, topics, data, block) in enumerate(rows)], LOG)


def test_each_row_is_decoded_with_its_own_layout_in_one_scan(spark, tmp_path):
    sp = specs(spark, [arg("from", "address"), arg("value", "uint256")], [arg("_from", "address"), arg("_value", "uint256")],
               [arg("from", "uint256", True), arg("value", "uint256")])
    logs(spark, (0, [], word(7) + word(70), 1), (1, [], word(8) + word(80), 2),
         (2, ["0x" + word(9)], word(90), 3)).write.parquet(str(tmp_path / "logs"))
    df = dec.decode_table(spark.read.parquet(str(tmp_path / "logs")), sp, "T_evt_E", "event")
    # one scan of the logs; the staged spec rows are a scan of their own
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert sum("topic1" in line for line in scans) == 1 and sum("__layout" in line or "abi_inputs" in line for line in scans) == len(scans) - 1
    rows = {r["evt_index"]: r for r in df.collect()}
    assert df.count() == 3
    assert rows[0]["from"] == "0x" + word(7)[24:] and rows[0]["value"] == "70" and rows[0]["_from"] is None
    assert rows[1]["_from"] == "0x" + word(8)[24:] and rows[1]["_value"] == "80" and rows[1]["from"] is None
    assert rows[2]["from"] == "9" and rows[2]["value"] == "90"


def test_invalid_utf8_gives_null(spark):
    bad = word(32) + word(3) + "ff00fe".ljust(64, "0")
    good = word(32) + word(2) + "6869".ljust(64, "0")
    sp = specs(spark, [arg("uri", "string")])
    source = logs(spark, (0, [], bad, 1), (0, [], good, 2))
    assert [r["uri"] for r in dec.decode_table(source, sp, "T_evt_E", "event").orderBy("evt_index").collect()] == [None, "hi"]
    long = fanout.decode_all_events(source, sp).orderBy("evt_index").collect()
    assert [r["args"][0]["value"] for r in long] == [None, "hi"]
    text = spark.createDataFrame([("ff",), ("e9",), ("c3a9",), (None,)], "h string").select(wd.hex_to_text("h")).collect()
    assert [r[0] for r in text] == [None, None, "é", None]


def test_metadata_keeps_large_integers(spark):
    big = 9007199254740993
    long = fanout.decode_all_events(logs(spark, (0, [], word(1 << 255), big), (0, [], word(5), None)),
                                    specs(spark, [arg("v", "uint256")])).collect()
    assert {r["evt_block_number"]: r["args"][0]["value"] for r in long} == {big: str(1 << 255), None: "5"}


def test_names_are_unique_without_case_and_against_metadata(spark, tmp_path):
    params = [arg("From", "uint256"), arg("from", "uint256"), arg("contract_address", "uint256"), arg("", "uint256"), arg("", "bool")]
    assert dec.input_names(params, dec.EVENT_META) == ["From", "from_2", "contract_address_2", "input_3", "input_4"]
    assert dec.output_names([{"name": "r"}, {"name": "R"}, {"name": ""}]) == ["output_r", "output_R_2", "output_2"]
    df = dec.decode_table(logs(spark, (0, [], "".join(word(i) for i in range(1, 6)), 1)), specs(spark, params), "T_evt_E", "event")
    df.write.parquet(str(tmp_path / "out"))
    row = spark.read.parquet(str(tmp_path / "out")).collect()[0]
    assert (row["From"], row["from_2"], row["contract_address_2"], row["input_3"], row["input_4"]) == ("1", "2", "3", "4", True)


def test_pick_takes_names_that_occur_twice(spark):
    long = fanout.decode_all_events(logs(spark, (0, [], word(3) + word(2), 1)), specs(spark, [arg("x", "uint256"), arg("x", "uint256")]))
    row = long.select(fanout.pick("args", "x").alias("x"), fanout.pick("args", "none").alias("none")).collect()[0]
    assert (row["x"], row["none"]) == ("3", None)


@pytest.mark.parametrize("doc,want", [
    ('{"a":{"s":"[x] token"}}', "[x] token"), ('{"a":{"s":"{"}}', "{"), ('{"a":{"s":[1]}}', None), ('{"a":{"s":{"k":1}}}', None),
    ('{"a":{"s":12}}', "12"), ('{"a":{"s":true}}', "true"), ('{"a":{"s":null}}', None), ('{"a":{}}', None), ("broken", None), (None, None)])
def test_json_value_goes_by_type(spark, doc, want):
    df = spark.createDataFrame([(doc,)], "d string").select(fanout.json_value("d", "$.a.s").alias("v"))
    assert df.collect()[0]["v"] == want


def test_clustered_sink_spreads_a_hot_contract(spark, tmp_path):
    df = spark.range(4000).select(F.lit("h").alias("evt_hash"), F.lit("a").alias("contract_address"), F.col("id").alias("evt_block_number"))
    fanout.write_clustered(df, str(tmp_path / "c"), partitions=8)
    sizes = [r["n"] for r in spark.read.parquet(str(tmp_path / "c")).groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) < 1000


# --- random nested layouts, encoded here and read by both forms ---------------

def enc(t, v):
    """(dynamic, hex) of a value of a type tree: 'uint256', ['[]', t], ['[k]', k, t], ['()', [(name, t), ...]]"""
    if isinstance(t, str):
        if t in ("string", "bytes"):
            b = v.encode() if t == "string" else bytes.fromhex(v[2:])
            return True, word(len(b)) + b.hex().ljust(-(-len(b) // 32) * 64, "0")
        n = int(v, 16) if t == "address" else int(v)
        return False, word(n % (1 << 256))
    if t[0] == "()":
        return pack([x for _, x in t[1]], [v[name] for name, _ in t[1]])
    if t[0] == "[]":
        return True, word(len(v)) + pack([t[1]] * len(v), v)[1]
    return pack([t[2]] * t[1], v)


def pack(types, values):
    parts = [enc(t, v) for t, v in zip(types, values)]
    size = sum(32 if d else len(x) // 2 for d, x in parts)
    head, tail = "", ""
    for d, x in parts:
        if d:
            head, tail = head + word(size + len(tail) // 2), tail + x
        else:
            head += x
    return any(d for d, _ in parts), head + tail


def spelled(t):
    """(ABI type, components)"""
    if isinstance(t, str):
        return t, None
    if t[0] == "()":
        return "tuple", [dict(zip(("type", "components"), spelled(x)), name=n) for n, x in t[1]]
    inner, parts = spelled(t[-1])
    return inner + ("[]" if t[0] == "[]" else f"[{t[1]}]"), parts


def random_type(r, depth):
    k = r.choice(["s", "s", "[]", "[k]", "()"]) if depth else "s"
    if k == "s":
        return r.choice(["uint256", "address", "bool", "int128", "string", "bytes", "uint8"])
    if k == "()":
        return ["()", [(f"f{i}", random_type(r, depth - 1)) for i in range(r.randrange(1, 4))]]
    return ["[]", random_type(r, depth - 1)] if k == "[]" else ["[k]", r.randrange(1, 4), random_type(r, depth - 1)]


def random_value(r, t):
    if isinstance(t, str):
        return {"uint256": lambda: str(r.getrandbits(256)), "address": lambda: f"0x{r.getrandbits(160):040x}", "bool": lambda: r.random() < 0.5,
                "int128": lambda: str(r.getrandbits(128) - (1 << 127)), "string": lambda: "é" * r.randrange(40), "uint8": lambda: str(r.randrange(256)),
                "bytes": lambda: "0x" + "ab" * r.randrange(70)}[t]()
    if t[0] == "()":
        return {n: random_value(r, x) for n, x in t[1]}
    return [random_value(r, t[-1]) for _ in range(r.randrange(4) if t[0] == "[]" else t[1])]


def long_text(v):
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, str):
        return v
    if isinstance(v, list) and not any(isinstance(x, (list, dict)) for x in v):
        return "|||".join(long_text(x) for x in v)
    return json.dumps(v, separators=(",", ":"), ensure_ascii=False)


def test_random_nested_layouts_in_the_long_form(spark):
    import random
    r = random.Random(11)
    layouts, rows, want = [], [], []
    for i in range(60):
        types = [random_type(r, 3) for _ in range(r.randrange(1, 4))]
        values = [random_value(r, t) for t in types]
        layouts.append([dict(zip(("type", "components"), spelled(t)), name=f"a{j}", indexed=False) for j, t in enumerate(types)])
        rows.append((i, [], pack(types, values)[1], i))
        want.append([(f"a{j}", long_text(v)) for j, v in enumerate(values)])
    got = fanout.decode_all_events(logs(spark, *rows), specs(spark, *layouts)).collect()
    assert len(got) == 60
    for x in got:
        assert [(a["key"], a["value"]) for a in x["args"]] == want[x["evt_index"]], layouts[x["evt_index"]]


def test_nested_calls_and_documents(spark):
    abi_in = [{"name": "trades", "type": "tuple[]", "components": [{"name": "pair", "type": "uint256[2]"}, {"name": "k", "type": "uint256"}]},
              {"name": "m", "type": "uint256[][]"}]
    t = [["[]", ["()", [("pair", ["[k]", 2, "uint256"]), ("k", "uint256")]]], ["[]", ["[]", "uint256"]]]
    v = [[{"pair": ["11", "12"], "k": "3"}], [["7", "8"], []]]
    spec = spark.createDataFrame([("call", "0x01020304", "0x" + "0" * 40, "ns", "T_call_f", "T_call_f", "", None, json.dumps(abi_in), "[]", None)], SPEC)
    call = spark.createDataFrame([("0xt", "0x" + "0" * 40, "0xf", 1, None, True, "", "id", None, "call", "0", "0x01020304", "0x01020304" + pack(t, v)[1], "0x" + word(9))],
                                 "tx_hash string, to string, from string, block_number long, block_time timestamp_ntz, success boolean, trace_address string, "
                                 "trace_id string, error string, type string, value string, method_id string, input string, output string")
    doc = json.loads(fanout.decode_all_calls(call, spec, as_json="document").collect()[0]["args"])
    assert doc == {"input": {"trades": v[0], "m": v[1]}, "output": {"output_0": word(9)}}
    wide = dec.decode_table(call, spec, "T_call_f", "call").collect()[0]
    assert json.loads(wide["trades"]) == v[0] and json.loads(wide["m"]) == v[1]
