"""Chain-shaped inputs derived from the driver's TPC-H-like tables.

The reference reads public Ethereum tables that are not available here, so
logs, traces, contracts, ABI seeds and price feeds are *encoded* from
``lineitem``, ``orders``, ``supplier``, ``part`` and ``events`` with plain
DataFrame expressions (formulas in FIXTURES.md). The work grows with the
driver tables; nothing is collected. Oracles compute expected decoded values
directly from the source columns, never by re-decoding these encodings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import signatures as sig


def read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def read_spread(spark: SparkSession, sf_dir: str, name: str, key: str, *cols: str) -> DataFrame:
    """Read a driver table and hash-partition it on ``key`` before encoding:
    a file may be a single task, and the per-row encoding (sha2, hex words)
    would then run on one core. Hash partitioning (not round robin) keeps task
    retries deterministic."""
    return read(spark, sf_dir, name, *cols).repartition(key)


def _hex16(n: Column) -> Column:
    return F.lpad(F.lower(F.hex(n.cast("bigint"))), 16, "0")


def W(n: Column) -> Column:
    """64-char zero-padded lower-case hex word of a non-negative integer.
    ``lpad`` copies its padding character by character, so it gets 16 at most."""
    return F.concat(F.lit("0" * 48), _hex16(n))


def A(n: Column) -> Column:
    """``0x`` + 40-char address of a non-negative integer."""
    return F.concat(F.lit("0x" + "0" * 24), _hex16(n))


def SHA(x: Column) -> Column:
    return F.sha2(x.cast("string"), 256)


def _hex_text(s: Column) -> Column:
    return F.lower(F.hex(s))


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ethereum.logs`` encoded from ``lineitem`` (FIXTURES.md 2.1)."""
    li = read_spread(spark, sf_dir, "lineitem", "l_orderkey", "l_orderkey", "l_partkey", "l_suppkey",
                     "l_linenumber", "l_quantity", "l_shipdate")
    s, o, p = F.col("l_suppkey"), F.col("l_orderkey"), F.col("l_partkey")
    ln = F.col("l_linenumber").cast("bigint")
    q = F.col("l_quantity").cast("bigint")
    w = F.when(p % 10 == 0, SHA(o)).otherwise(W(o * 1000 + q))
    kind = (
        F.when((s % 5).isin(0, 3), F.when(ln % 2 == 0, "transfer").otherwise("approval"))
        .when(s % 5 == 1, F.element_at(F.array(F.lit("transfer721"), F.lit("approval721"),
                                               F.lit("approvalforall")), (ln % 3 + 1).cast("int")))
        .when(s % 5 == 2, F.element_at(F.array(F.lit("single"), F.lit("batch"),
                                               F.lit("approvalforall"), F.lit("uri")),
                                       (ln % 4 + 1).cast("int")))
        .otherwise("transfer")
    )
    df = li.select("*", kind.alias("kind"), w.alias("w"), q.alias("q"))
    k = F.col("kind")
    w = F.col("w")
    q = F.col("q")
    hash_of = (
        F.when(k.isin("transfer", "transfer721"), sig.TRANSFER)
        .when(k.isin("approval", "approval721"), sig.APPROVAL)
        .when(k == "approvalforall", sig.APPROVAL_FOR_ALL)
        .when(k == "single", sig.TRANSFER_SINGLE)
        .when(k == "batch", sig.TRANSFER_BATCH)
        .otherwise(sig.URI)
    )
    n = q % 4
    uri_payload = F.rpad(_hex_text(F.concat(F.lit("uri-"), F.lpad(p.cast("string"), 8, "0"))), 64, "0")
    data = (
        F.when(k.isin("transfer", "approval", "transfer721", "approval721"), F.concat(F.lit("0x"), w))
        .when(k == "approvalforall", F.concat(F.lit("0x"), W(o % 2)))
        .when(k == "single", F.concat(F.lit("0x"), W(p), w))
        .when(k == "batch", F.concat(
            F.lit("0x"), W(F.lit(64)), W(64 + 32 * (1 + n)),
            W(n), F.repeat(W(p), n.cast("int")), W(n), F.repeat(w, n.cast("int"))))
        .when(k == "uri", F.concat(F.lit("0x"), W(F.lit(32)), W(F.lit(12)), uri_payload))
        .otherwise(F.lit("0x"))
    )
    topic1 = F.when(k == "uri", F.concat(F.lit("0x"), W(p))).otherwise(F.concat(F.lit("0x"), W(p + 1)))
    topic2 = F.when(k == "uri", F.lit(None).cast("string")).otherwise(F.concat(F.lit("0x"), W(o + 1)))
    topic3 = (
        F.when(k.isin("transfer721", "approval721"), F.concat(F.lit("0x"), w))
        .when(k.isin("single", "batch"), F.concat(F.lit("0x"), W(q + 1)))
    )
    return df.select(
        A(s).alias("contract_address"),
        hash_of.alias("topic0"),
        topic1.alias("topic1"),
        topic2.alias("topic2"),
        topic3.alias("topic3"),
        data.alias("data"),
        o.alias("block_number"),
        F.col("l_shipdate").alias("block_time"),
        ln.alias("index"),
        F.concat(F.lit("0x"), SHA(o)).alias("tx_hash"),
        (o % 200).alias("tx_index"),
        hash_of.alias("evt_hash"),
    )


def contracts(spark: SparkSession, sf_dir: str, partial: bool = False) -> DataFrame:
    """``crypto_ethereum.contracts`` from ``supplier`` (FIXTURES.md 2.2)."""
    from ..operators.tokens import NEEDLES

    s = F.col("s_suppkey")
    erc20 = "00".join(NEEDLES["erc20"])
    erc721 = "00".join(NEEDLES["erc721"])
    erc1155 = "00".join(NEEDLES["erc1155"])
    almost20 = "00".join(NEEDLES["erc20"][:-1])
    body = (
        F.when(s % 5 == 0, F.lit(erc20))
        .when(s % 5 == 1, F.lit(erc721))
        .when(s % 5 == 2, F.lit(erc1155))
        .when(s % 5 == 3, F.lit(erc20 + "00" + erc721))
        .otherwise(F.lit(almost20))
    )
    df = read(spark, sf_dir, "supplier", "s_suppkey")
    if partial:
        df = df.where(s % 7 != 6)
    return df.select(
        A(s).alias("address"),
        F.concat(F.lit("0x6080"), body).alias("bytecode"),
        F.timestamp_add("DAY", s, F.lit("1992-01-01 00:00:00").cast("timestamp_ntz")).alias("block_timestamp"),
    )


def traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ethereum.traces`` from ``orders`` (FIXTURES.md 2.3): ERC-20
    ``transfer`` / ``transferFrom`` calls; failed orders are reverted calls."""
    o = read_spread(spark, sf_dir, "orders", "o_orderkey", "o_orderkey", "o_custkey", "o_orderstatus",
                    "o_totalprice", "o_orderdate")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    even = key % 2 == 0
    method = F.when(even, F.lit("0xa9059cbb")).otherwise(F.lit("0x23b872dd"))
    args = F.when(even, F.concat(W(cust), W(cents))).otherwise(F.concat(W(cust), W(cust + 1), W(cents)))
    ok = F.col("o_orderstatus") != "F"
    tx = F.concat(F.lit("0x"), SHA(key))
    contracts_ = read(spark, sf_dir, "supplier", "s_suppkey").agg(F.count("*").alias("n_contracts"))
    return o.join(F.broadcast(contracts_)).select(  # one row: the number of contracts
        tx.alias("tx_hash"),
        A(cust % F.col("n_contracts")).alias("to"),
        A(cust + 1).alias("from"),
        key.alias("block_number"),
        F.col("o_orderdate").alias("block_time"),
        ok.alias("success"),
        F.lit("").alias("trace_address"),
        F.concat(F.lit("call_"), tx).alias("trace_id"),
        F.when(~ok, F.lit("Reverted")).alias("error"),
        F.lit("call").alias("type"),
        F.lit("0").alias("value"),
        method.alias("method_id"),
        F.concat(method, args).alias("input"),
        F.when(ok, F.concat(F.lit("0x"), W(F.lit(1)))).otherwise(F.lit("0x")).alias("output"),
    )


def traces_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dynamic-argument traces from ``lineitem``: ``balanceOfBatch(address[],
    uint256[])`` calls on ERC-1155 contracts; the output is the uint256[]
    balance list. n = quantity mod 4 (empty arrays occur)."""
    li = read_spread(spark, sf_dir, "lineitem", "l_orderkey", "l_orderkey", "l_partkey", "l_suppkey",
                     "l_linenumber", "l_quantity", "l_shipdate")
    s, o, p = F.col("l_suppkey"), F.col("l_orderkey"), F.col("l_partkey")
    ln = F.col("l_linenumber").cast("bigint")
    q = F.col("l_quantity").cast("bigint")
    n = q % 4
    ni = n.cast("int")
    args = F.concat(W(F.lit(64)), W(64 + 32 * (1 + n)), W(n), F.repeat(W(o + 1), ni),
                    W(n), F.repeat(W(p), ni))
    out = F.concat(F.lit("0x"), W(F.lit(32)), W(n), F.repeat(W(o * 1000 + q), ni))
    ok = ln != 7
    tx = F.concat(F.lit("0x"), SHA(o * 10 + ln))
    return li.where(s % 5 == 2).select(
        tx.alias("tx_hash"),
        A(s).alias("to"),
        A(p + 1).alias("from"),
        o.alias("block_number"),
        F.col("l_shipdate").alias("block_time"),
        ok.alias("success"),
        ln.cast("string").alias("trace_address"),
        F.concat(F.lit("call_"), tx).alias("trace_id"),
        F.when(~ok, F.lit("Reverted")).alias("error"),
        F.lit("call").alias("type"),
        F.lit("0").alias("value"),
        F.lit("0x4e1273f4").alias("method_id"),
        F.concat(F.lit("0x4e1273f4"), args).alias("input"),
        F.when(ok, out).otherwise(F.lit("0x")).alias("output"),
    )


def address_to_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ABI seed: contract name / namespace / ABI ordinal per address."""
    s = F.col("s_suppkey")
    return read(spark, sf_dir, "supplier", "s_suppkey").select(
        A(s).alias("address"),
        F.concat(F.lit("Token.V"), (s % 3).cast("string")).alias("name"),
        F.concat(F.lit("proj."), (s % 4).cast("string")).alias("namespace"),
        (s % 6).alias("ordinal"),
    )


def abi_to_ordinal(spark: SparkSession) -> DataFrame:
    """ABI seed: the ABI documents (ordinal 5 deliberately missing)."""
    from .abis import ABI_DOCUMENTS

    rows = [(i, doc) for i, doc in enumerate(ABI_DOCUMENTS)]
    return spark.createDataFrame(rows, "ordinal bigint, abi string")


def allow_list(spark: SparkSession) -> DataFrame:
    from .abis import ALLOW_LIST

    return spark.createDataFrame([(n,) for n in ALLOW_LIST], "sub_name string")


def token_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_spread(spark, sf_dir, "events", "user_id", "ts", "user_id", "value")
    return ev.select(
        F.col("ts").alias("timestamp"),
        F.col("value").alias("price_usd"),
        F.concat(F.lit("coin-"), F.col("user_id").cast("string")).alias("coin_id"),
    )


def coin_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p_partkey")
    return read(spark, sf_dir, "part", "p_partkey", "p_brand").select(
        F.concat(F.lit("coin-"), p.cast("string")).alias("id"),
        F.when(p % 5 != 0, A(p)).alias("contract"),
        F.col("p_brand").alias("symbol"),
    )


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s_suppkey")
    return read(spark, sf_dir, "supplier", "s_suppkey").select(
        A(s).alias("address"), (s % 19).cast("int").alias("decimals"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ethereum.transactions`` from ``orders``: one per order."""
    o = read_spread(spark, sf_dir, "orders", "o_orderkey", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return o.select(
        F.concat(F.lit("0x"), SHA(F.col("o_orderkey"))).alias("hash"),
        A(F.col("o_custkey") + 1).alias("from"),
        A(F.col("o_custkey")).alias("to"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string").alias("value"),
        F.col("o_orderkey").alias("block_number"),
        F.col("o_orderdate").alias("block_time"),
    )


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ethereum.blocks``: the blocks of the transactions."""
    o = read(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    return o.groupBy(F.col("o_orderkey").alias("number")).agg(
        F.min("o_orderdate").alias("time"), F.count("*").alias("transaction_count"))


# --- nested arguments: one ABI document per supplier, logs and calls ---------

def pack(*parts) -> Column:
    """Head and tail of arguments: a part is the hex words of a static value,
    or ``(tail,)`` of a dynamic one."""
    size = F.lit(0).cast("bigint")
    for part in parts:
        size = size + (32 if isinstance(part, tuple) else (F.octet_length(part) / 2).cast("bigint"))
    heads, tails = [], []
    for part in parts:
        if isinstance(part, tuple):
            heads.append(W(size))
            tails.append(part[0])
            size = size + (F.octet_length(part[0]) / 2).cast("bigint")
        else:
            heads.append(part)
    return F.concat(*heads, *tails)


def _bytes_tail(hexes: Column) -> Column:
    n = (F.octet_length(hexes) / 2).cast("bigint")
    return F.concat(W(n), F.rpad(hexes, (F.ceil(n / 32) * 64).cast("int"), F.lit("0")))


def _text_tail(text: Column) -> Column:
    return _bytes_tail(_hex_text(F.encode(text, "UTF-8")))


def _fills(n: Column, p: Column, w: Column) -> Column:
    """``(uint256 amount, address to)[]``: n pairs (w, p + i), i from 1."""
    return F.concat(W(n), *(F.when(n >= i, F.coalesce(F.concat(w, W(p + i)), F.lit(""))).otherwise("") for i in (1, 2)))


def nested_abis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ABI documents that grow with ``supplier``: one per address, with a
    function of its own whose argument nests tuples ``s % 13`` deep."""
    import json

    from .abis import BATCH, QUOTE

    s = F.col("s_suppkey")
    k = (s % 13).cast("int")
    deep = F.concat(F.repeat(F.lit('{"name":"a","type":"tuple","components":['), k), F.lit('{"name":"v","type":"uint"}'), F.repeat(F.lit("]}"), k))
    own = F.concat(F.lit('{"type":"function","name":"f'), s.cast("string"), F.lit('","inputs":['), deep, F.lit('],"outputs":[]}'))
    return read(spark, sf_dir, "supplier", "s_suppkey").select(
        s.alias("ordinal"), F.concat(F.lit(f"[{json.dumps(BATCH)},{json.dumps(QUOTE)},"), own, F.lit("]")).alias("abi"))


def nested_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s_suppkey")
    return read(spark, sf_dir, "supplier", "s_suppkey").select(
        A(s).alias("address"), F.lit("Maker").alias("name"), F.concat(F.lit("mk"), (s % 2).cast("string")).alias("namespace"), s.alias("ordinal"))


def nested_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``Batch`` events from ``lineitem``: n = quantity mod 3 fills, a grid
    whose row j holds j numbers, two notes and a signature."""
    from ..functions.keccak import keccak_hex
    from .abis import BATCH_SIGNATURE

    li = read_spread(spark, sf_dir, "lineitem", "l_orderkey", "l_orderkey", "l_partkey", "l_suppkey",
                     "l_linenumber", "l_quantity", "l_shipdate")
    s, o, p = F.col("l_suppkey"), F.col("l_orderkey"), F.col("l_partkey")
    ln, q = F.col("l_linenumber").cast("bigint"), F.col("l_quantity").cast("bigint")
    w = F.when(p % 10 == 0, SHA(o)).otherwise(W(o * 1000 + q))
    n = q % 3
    grid = (F.when(n == 0, W(F.lit(0))).when(n == 1, F.concat(W(F.lit(1)), W(F.lit(32)), W(F.lit(0))))
            .otherwise(F.concat(W(F.lit(2)), W(F.lit(64)), W(F.lit(96)), W(F.lit(0)), W(F.lit(1)), W(p + 1))))
    notes = F.concat(W(F.lit(2)), pack((_text_tail(F.concat(F.lit("n-"), F.lpad(p.cast("string"), 8, "0"))),),
                                       (_text_tail(F.concat(F.lit("é"), o.cast("string"))),)))
    sig_ = pack(W(ln), (_bytes_tail(F.lpad(F.lower(F.hex(p)), 8, "0")),))
    topic = F.lit(keccak_hex(BATCH_SIGNATURE))
    # each part a column of its own, built once: packing needs its length and its text
    li = li.withColumn("_w", w)
    li = li.select("*", _fills(n, p, F.col("_w")).alias("_fills"), grid.alias("_grid"), notes.alias("_notes"), sig_.alias("_sig"))
    return li.select(
        A(s).alias("contract_address"), topic.alias("topic0"), F.concat(F.lit("0x"), W(p + 1)).alias("topic1"),
        F.lit(None).cast("string").alias("topic2"), F.lit(None).cast("string").alias("topic3"),
        F.concat(F.lit("0x"), pack(*((F.col(c),) for c in ("_fills", "_grid", "_notes", "_sig")))).alias("data"),
        o.alias("block_number"), F.col("l_shipdate").alias("block_time"), ln.alias("index"),
        F.concat(F.lit("0x"), SHA(o)).alias("tx_hash"), (o % 200).alias("tx_index"), topic.alias("evt_hash"))


def nested_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``quote`` calls from ``orders``: key mod 3 fills; failed orders are reverted calls."""
    from ..functions.keccak import keccak_hex
    from .abis import QUOTE_SIGNATURE

    o = read_spread(spark, sf_dir, "orders", "o_orderkey", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    n, ok = key % 3, F.col("o_orderstatus") != "F"
    method = keccak_hex(QUOTE_SIGNATURE)[:10]
    args = pack((_fills(n, cust, W(cents)),), (pack(W(key % 250), (_bytes_tail(F.lpad(F.lower(F.hex(cust)), 8, "0")),)),))
    pairs = F.concat(W(n), F.repeat(F.concat(W(cust), W(cents)), n.cast("int")))
    tx = F.concat(F.lit("0x"), SHA(key))
    contracts_ = read(spark, sf_dir, "supplier", "s_suppkey").agg(F.count("*").alias("n_contracts"))
    return o.join(F.broadcast(contracts_)).select(  # one row: the number of contracts
        tx.alias("tx_hash"), A(cust % F.col("n_contracts")).alias("to"), A(cust + 1).alias("from"), key.alias("block_number"),
        F.col("o_orderdate").alias("block_time"), ok.alias("success"), F.lit("").alias("trace_address"),
        F.concat(F.lit("call_"), tx).alias("trace_id"), F.when(~ok, F.lit("Reverted")).alias("error"), F.lit("call").alias("type"),
        F.lit("0").alias("value"), F.lit(method).alias("method_id"), F.concat(F.lit(method), args).alias("input"),
        F.when(ok, F.concat(F.lit("0x"), pack(W((key % 2)), (pairs,), W(cents)))).otherwise(F.lit("0x")).alias("output"))
