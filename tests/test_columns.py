"""Nested values are read and rendered as columns; offsets are cut from a payload and documents are parsed once."""

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from logloom.functions import hexint, nested
from logloom.operators import decode as dec
from logloom.plans import fanout, parity

from conftest import SF_SMALL
from test_layouts import word


def test_values_are_arrow_columns_of_json():
    n = dec.parse_param({"type": "tuple[]", "components": [{"name": "s", "type": "string"}, {"name": "b", "type": "bool"}]})
    said = ['"\\\n', "é", ""]
    heads = "".join(word(o) for o in (96, 224, 352))
    tails = "".join(word(64) + word(1) + word(len(s.encode())) + s.encode().hex().ljust(64, "0") for s in said)
    text = word(32) + word(3) + heads + tails
    here = np.zeros(3, dtype=np.int64)
    got = nested.Reader(pa.array([text, None, text[:-128]])).json(n, here, here)
    assert got.type == pa.string() and got.null_count == 2
    assert json.loads(got[0].as_py()) == [{"s": s, "b": True} for s in said]


def test_plain_items_and_words_are_arrow_columns():
    n = dec.parse_param({"type": "bool[]"})
    here = np.zeros(2, dtype=np.int64)
    assert nested.Reader(pa.array([word(32) + word(2) + word(0) + word(7), word(64)])).items(n, here, here).to_pylist() == [["false", "true"], None]
    assert nested.words("int64", pa.array(["0x" + "f" * 64, "0x", None])).to_pylist() == ["-1", None, None]


def test_offsets_are_cut_once(spark):
    plan = spark.range(1).select(F.lit("0x").alias("t"), "id").select(dec.bounded_word(F.col("t"), F.col("id")).alias("x"))
    assert plan._jdf.queryExecution().analyzed().toString().split("\n")[0].count("substr(") == 1


def test_documents_are_parsed_once_for_all_paths(spark):
    plan = parity.json_extracts(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parse_json") + plan.lower().count("parsejson") == 1


def test_parts_of_a_payload_are_built_once(spark):
    from logloom.sources import fixtures

    plan = fixtures.nested_logs(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("é") == 3  # its length twice, and the text


def test_words_of_an_argument_are_read_once():
    assert fanout._args_sql().count("RLIKE") < 20  # 129 when every use of an offset or length read it again
    assert fanout._args_sql("IF(a.src = 'out', _out, _in)", "a.area", topics=False).count("RLIKE") < 20


def test_odd_payloads_of_a_layout(spark):
    kinds = ("string", "bytes", "array:u64", "array:bool", "i64", "address")
    layout = [(k, k, False, 1, 3) for k in kinds] + [("s", "string", True, 1, 3), ("f", "u64", True, 9, 3)]
    good = "0x" + word(32) + word(2) + "4142".ljust(64, "0")
    data = {1: good, 2: good[:130], 3: "0x" + word(1 << 40), 4: "0x", 5: None, 6: "0x" + word(32) + word(0), 7: "0x" + word(32) + "f" * 64, 8: "0x" + "z" * 64}
    rows = [(i, d, "0x" + word(7), None, "0x" + word(9), layout) for i, d in data.items()]
    df = spark.createDataFrame(rows, "id int, data string, topic1 string, topic2 string, topic3 string, "
                                     "_layout array<struct<key:string,kind:string,indexed:boolean,topic:int,head:int>>")
    got = {r["id"]: {e["key"]: (e["src"], e["kind"], e["value"], e["items"]) for e in r["x"]}
           for r in df.select("id", F.expr(fanout._args_sql()).alias("x")).collect()}
    texts = {i: (g["string"][2], g["bytes"][2], g["array:u64"][3], g["i64"][2]) for i, g in got.items()}
    assert texts == {1: ("AB", "0x4142", None, "32"), 2: (None, None, None, "32"), 3: (None, None, None, str(1 << 40)), 4: (None, None, None, None),
                     5: (None, None, None, None), 6: ("", "0x", [], "32"), 7: (None, None, None, "32"), 8: (None, None, None, None)}
    assert got[1]["s"] == ("topic", "word", "0x" + word(7), None) and got[1]["f"] == ("topic", "u64", "9", None)
    assert got[1]["address"] == ("data", "address", "0x" + word(32)[-40:], None) and got[5]["address"][2] is None


def test_lists_are_split_and_cast_once(spark):
    df = spark.createDataFrame([("1|||x|||3",), ("x",), (None,)], "t string")
    out = df.select(fanout.split_cast("t", "bigint").alias("v"))
    assert [r["v"] for r in out.collect()] == [[1, 3], None, None]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1


def test_integers_are_converted_in_slices(monkeypatch):
    sizes, whole = [], hexint.integers
    monkeypatch.setattr(hexint, "integers", lambda digits, signed=False: sizes.append(len(digits)) or whole(digits, signed))
    monkeypatch.setattr(hexint, "SLICE", 4, raising=False)
    lists = pa.array([[word(i) for i in range(6)], None, [None, "zz"], [word((1 << 256) - 1 - i) for i in range(5)]])
    assert hexint.in_lists(lists, True).to_pylist() == [[str(i) for i in range(6)], None, [None, None], [str(-1 - i) for i in range(5)]]
    assert max(sizes) <= 4


def test_arrow_input_of_the_decoders_has_no_null_lists(spark, monkeypatch):
    """Spark's Arrow writer goes through the NULL lists before a row again for each row."""
    entry = "array<struct<src: string, key: string, kind: string, value: string, items: array<string>>>"
    df = spark.createDataFrame([([("data", "a", "word", "00", None)],), (None,)], f"_raw {entry}")
    assert [r[0] for r in df.select(F.expr(fanout._wide_sql("uwide"))).collect()] == [[], []]
    seen = []
    one = spark.range(1).select(F.lit("0x").alias("data"), *(F.lit(None).cast("string").alias(f"topic{i}") for i in (1, 2, 3)))
    monkeypatch.setattr(fanout, "_finish", lambda df, raw, rest, *_: seen.append(df.select(rest).schema[0].dataType) or df)
    specs = "hash_id string, contract_address string, namespace string, `table` string, type string, abi_inputs string, abi_outputs string, min_created_ts timestamp_ntz"
    logs = one.select("*", *(F.lit("h").alias(c) for c in ("evt_hash", "contract_address", "tx_hash")), F.lit(1).alias("block_number"),
                      F.lit(None).cast("timestamp_ntz").alias("block_time"), F.lit(1).alias("index"), F.lit(1).alias("tx_index"))
    fanout.decode_all_events(logs, spark.createDataFrame([], specs))
    assert seen and all(f.dataType.typeName() == "string" for f in seen[0].fields)


def test_texts_of_nested_rows_are_those_of_the_entries(spark):
    texts = ['a"b\\c', "é\n\t\b\f\r\x01\x1f\x7f/", None, "", "plain", "|||"]
    lists = [["x"], [], None, ['"', "\x02"], ["", "é"], ["a", "b|||c"]]
    json_ = ["[]", '[{"a":"1\\u0001"}]', None, "{}", '["\\""]', "true"]
    columns = [("topic", 'k"1', "word", pa.array(texts)), ("data", "ids", "array:", pa.array(lists, pa.list_(pa.string()))),
               ("data", "t", "json", pa.array(json_)), ("topic", "é\x03", "word", pa.array(texts[::-1]))]
    entries = fanout._as_entries(columns, 6).to_pylist()
    df = spark.createDataFrame([(i, [tuple(e.values()) for e in row]) for i, row in enumerate(entries)],
                               "id int, _entries array<struct<src: string, key: string, kind: string, value: string, items: array<string>>>")
    rows = df.orderBy("id").select(F.expr(fanout._JSON), F.expr(fanout._DOCUMENT)).collect()
    assert fanout._as_long(columns, 6).to_pylist() == [r[0] for r in rows]
    assert fanout._as_document(columns, 6).to_pylist() == [r[1] for r in rows]
    cut = [(*c[:3], c[3].slice(1, 3)) for c in columns]  # arrays that begin within their buffers
    assert fanout._as_long(cut, 3).to_pylist() == [r[0] for r in rows][1:4]
    assert fanout._as_document(cut, 3).to_pylist() == [r[1] for r in rows][1:4]
    assert fanout._as_long([], 2).to_pylist() == ["[]"] * 2 and fanout._as_document([], 2).to_pylist() == ["{}"] * 2


def test_hex_is_cut_by_bytes_and_other_text_by_characters(spark):
    rows = [("0123456789abcdef" * 3,), ("é" * 20 + "abc",), ("",), (None,)]
    df = spark.createDataFrame(rows, "t string").withColumn("n", F.length("t"))
    text = dec.Payload(F.col("t"), F.col("n"))
    for pos, size in ((3, 16), (21, 64), (47, 5), (60, 3), (3, 0)):
        got = df.select(text.cut(F.lit(pos), F.lit(size)), F.substr("t", F.lit(pos), F.lit(size))).collect()
        assert [r[0] for r in got] == [r[1] for r in got]
    plan = df.select(dec._word(text, F.lit(3)))._jdf.queryExecution().optimizedPlan().toString()
    assert "as binary" in plan


def test_fixture_words_pad_at_most_sixteen_characters(spark):
    from logloom.sources import fixtures
    n = [0, 1, 255, -1, 2**63 - 1, -2**63, None]
    df = spark.createDataFrame([(x, q) for x in n for q in (0, 1, 2, None)], "n bigint, q bigint")
    w, q = F.col("n"), F.col("q")
    numbers = F.slice(F.array(F.lit(1), F.lit(2)), F.lit(1), q.cast("int"))
    old = lambda x, k: F.lpad(F.lower(F.hex(x)), k, "0")
    small = w % 1000
    got = df.select(fixtures.W(w), old(w, 64), fixtures.A(w), F.concat(F.lit("0x"), old(w, 40)), fixtures._fills(q, small, fixtures.W(w)),
                    F.concat(old(q, 64), F.array_join(F.transform(numbers, lambda i: F.concat(old(w, 64), old(small + i, 64))), "")))
    for r in got.collect():
        assert r[0] == r[1] and r[2] == r[3] and r[4] == r[5]
    assert ", 16, '0')" in fixtures.W(w)._jc.toString() and "transform" not in fixtures._fills(q, w, w)._jc.toString()


def test_a_string_is_read_from_the_parsed_document(spark):
    docs = ['{"a": "x\\u0041\\"", "n": 1.50, "b": true, "o": {"a": 1}, "l": ["["], "z": null, "s": "[1]"}', "no json", None]
    df = spark.createDataFrame([(d,) for d in docs], "d string").withColumn("v", F.try_parse_json("d"))
    got = df.select(*(fanout.json_value("d", f"$.{k}", "v") for k in "anbolzsm")).collect()
    assert tuple(got[0]) == ('xA"', "1.5", "true", None, None, None, "[1]", None) and not any(map(any, got[1:]))
    plan = df.select(fanout.json_value("d", "$.a", "v"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("STRING") < plan.index("get_json_object")


def test_wide_stages_stay_below_what_the_jvm_compiles(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    for own, want in ((None, "8000"), ("65535", "65535")):
        spark.conf.unset(key)
        if own:
            spark.conf.set(key, own)
        parity.tuple_arrays(spark, SF_SMALL)
        assert spark.conf.get(key) == want
    spark.conf.unset(key)
