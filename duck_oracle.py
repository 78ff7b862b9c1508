"""DuckDB oracle SQL for ``__spark_entry__.oracle_sql()``.

Every statement reads only the raw driver tables and computes the *expected*
result straight from the source columns (the rules of FIXTURES.md), never by
decoding the hex encodings the Spark side builds. 256-bit values are turned
into decimal text with an exact HUGEINT limb fold generated below.
"""

from __future__ import annotations

from logloom.operators import signatures as sig


def W(n: str) -> str:
    return f"lpad(lower(hex(CAST({n} AS BIGINT))), 64, '0')"


def A(n: str) -> str:
    return f"('0x' || lpad(lower(hex(CAST({n} AS BIGINT))), 40, '0'))"


def SHA(x: str) -> str:
    return f"sha256(CAST({x} AS VARCHAR))"


_D = 10 ** 18


def _limb_weights():
    table = []
    for k in range(8):
        w = 1 << (32 * (7 - k))
        ds = []
        for _ in range(5):
            ds.append(w % _D)
            w //= _D
        table.append(ds)
    return table


def dec256(limbs: list[str]) -> str:
    """Exact decimal text of a 256-bit value given eight 32-bit limb
    expressions (most significant first), via base-10^18 HUGEINT digits."""
    wts = _limb_weights()
    digits = []
    carry = None
    for j in range(5):
        terms = [f"CAST({limbs[k]} AS HUGEINT) * {wts[k][j]}" for k in range(8) if wts[k][j]]
        total = " + ".join(terms) if terms else "CAST(0 AS HUGEINT)"
        if carry is not None:
            total = f"({total}) + ({carry})"
        digits.append(f"(({total}) % {_D})")
        carry = f"(({total}) // {_D})"
    text = " || ".join(f"lpad(CAST({d} AS VARCHAR), 18, '0')" for d in reversed(digits))
    return f"coalesce(nullif(ltrim({text}, '0'), ''), '0')"


def hex_limbs(h: str) -> list[str]:
    return [f"CAST(('0x' || substr({h}, {8 * k + 1}, 8)) AS BIGINT)" for k in range(8)]


# --- logs rows, described from lineitem -------------------------------------

LINEITEM_KINDS = """
li AS (
  SELECT l_orderkey AS o, l_partkey AS p, l_suppkey AS s,
         CAST(l_linenumber AS BIGINT) AS ln, CAST(l_quantity AS BIGINT) AS q,
         l_shipdate AS bt,
         CASE WHEN l_suppkey % 5 IN (0, 3)
                THEN CASE WHEN l_linenumber % 2 = 0 THEN 'transfer' ELSE 'approval' END
              WHEN l_suppkey % 5 = 1
                THEN (['transfer721', 'approval721', 'approvalforall'])[l_linenumber % 3 + 1]
              WHEN l_suppkey % 5 = 2
                THEN (['single', 'batch', 'approvalforall', 'uri'])[l_linenumber % 4 + 1]
              ELSE 'transfer' END AS kind
  FROM lineitem
),
lsha AS (
  SELECT *, """ + SHA("o") + """ AS sh FROM li
),
lv AS (
  SELECT *,
         CASE WHEN p % 10 = 0 THEN """ + dec256(hex_limbs("sh")) + """
              ELSE CAST(o * 1000 + q AS VARCHAR) END AS wdec,
         CASE WHEN p % 10 = 0 THEN NULL ELSE o * 1000 + q END AS wlong
  FROM lsha
)"""

EVT_META = (
    "o AS evt_block_number, bt AS evt_block_time, ln AS evt_index, "
    "'0x' || sh AS evt_tx_hash"
)


def _token_sql(select: str, where: str, evt_hash: str) -> str:
    return (f"WITH {LINEITEM_KINDS}\nSELECT {A('s')} AS contract_address, {select}, {EVT_META}, "
            f"'{evt_hash}' AS evt_hash\nFROM lv WHERE {where}")


ERC20 = "s % 5 IN (0, 3)"
ERC721 = "s % 5 IN (1, 3)"
ERC1155 = "s % 5 = 2"


def token_tables_sql() -> dict[str, str]:
    uri_value = ("'0x' || " + W("32") + " || " + W("12") + " || rpad(lower(hex('uri-' || "
                 "lpad(CAST(p AS VARCHAR), 8, '0'))), 64, '0')")
    return {
        "m4_erc20_transfer": _token_sql(
            f"{A('p + 1')} AS \"from\", {A('o + 1')} AS \"to\", wdec AS \"value\"",
            f"{ERC20} AND kind IN ('transfer', 'transfer721')", sig.TRANSFER),
        "m5_erc20_approval": _token_sql(
            f"{A('p + 1')} AS owner, {A('o + 1')} AS spender, wdec AS \"value\"",
            f"{ERC20} AND kind IN ('approval', 'approval721')", sig.APPROVAL),
        "m6_erc721_transfer": _token_sql(
            f"{A('p + 1')} AS \"from\", {A('o + 1')} AS \"to\", "
            "CASE WHEN kind = 'transfer721' THEN wlong END AS tokenId",
            f"{ERC721} AND kind IN ('transfer', 'transfer721')", sig.TRANSFER),
        "m7_erc721_approval": _token_sql(
            f"{A('o + 1')} AS approved, {A('p + 1')} AS owner, "
            "CASE WHEN kind = 'approval721' THEN wlong END AS tokenId",
            f"{ERC721} AND kind IN ('approval', 'approval721')", sig.APPROVAL),
        "m8_erc721_approval_for_all": _token_sql(
            f"CAST(NULL AS VARCHAR) AS approved, {A('o + 1')} AS operator, {A('p + 1')} AS owner, "
            "(o % 2 <> 0) AS approved_flag",
            f"{ERC721} AND kind = 'approvalforall'", sig.APPROVAL_FOR_ALL),
        "m9_erc1155_approval_for_all": _token_sql(
            f"{A('p + 1')} AS account, {A('o + 1')} AS operator, CAST(NULL AS VARCHAR) AS approved, "
            "(o % 2 <> 0) AS approved_flag",
            f"{ERC1155} AND kind = 'approvalforall'", sig.APPROVAL_FOR_ALL),
        "m10_erc1155_transfer_single": _token_sql(
            f"{A('o + 1')} AS \"from\", CAST(p AS VARCHAR) AS id, {A('p + 1')} AS operator, "
            f"{A('q + 1')} AS \"to\", wdec AS \"value\"",
            f"{ERC1155} AND kind = 'single'", sig.TRANSFER_SINGLE),
        "m11_erc1155_transfer_batch": _token_sql(
            f"{A('o + 1')} AS \"from\", "
            "CAST(to_json(list_transform(range(q % 4), lambda x: CAST(p AS VARCHAR))) AS VARCHAR) AS ids, "
            f"{A('p + 1')} AS operator, {A('q + 1')} AS \"to\", "
            "CAST(to_json(list_transform(range(q % 4), lambda x: wdec)) AS VARCHAR) AS \"values\"",
            f"{ERC1155} AND kind = 'batch'", sig.TRANSFER_BATCH),
        "m12_erc1155_uri": _token_sql(
            f"CAST(p AS VARCHAR) AS id, {uri_value} AS \"value\", "
            "'uri-' || lpad(CAST(p AS VARCHAR), 8, '0') AS uri_text",
            f"{ERC1155} AND kind = 'uri'", sig.URI),
    }


def token_types_sql() -> str:
    s = "s_suppkey"
    return (f"SELECT {A(s)} AS contract_address, ({s} % 5 IN (0, 3)) AS erc20, "
            f"({s} % 5 IN (1, 3)) AS erc721, ({s} % 5 = 2) AS erc1155 "
            f"FROM supplier WHERE {s} % 5 <> 4")


# --- ABI registry ------------------------------------------------------------

def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _abi_values() -> str:
    from logloom.sources.abis import ABI_DOCUMENTS

    rows = ", ".join(f"({i}, {_sql_str(d)})" for i, d in enumerate(ABI_DOCUMENTS))
    return f"abis AS (SELECT * FROM (VALUES {rows}) AS t(ordinal, abi))"


def _param_json(depth: int) -> str:
    base = '"name":"VARCHAR","type":"VARCHAR","indexed":"BOOLEAN"'
    if depth == 0:
        return "{" + base + "}"
    return "{" + base + ',"components":[' + _param_json(depth - 1) + "]}"


_ENTRY_JSON = ('[{"type":"VARCHAR","name":"VARCHAR","anonymous":"BOOLEAN","inputs":['
               + _param_json(3) + '],"outputs":[' + _param_json(3) + "]}]")

_SUFFIX = r"(\[[0-9]*\])+$"


def _scalar(base: str) -> str:
    bits = (f"coalesce(CAST(nullif(regexp_extract({base}, '^u?int([0-9]*)$', 1), '') AS INTEGER), 256)")
    return (f"CASE WHEN {base} = 'address' THEN 'ADDRESS' WHEN {base} = 'bool' THEN 'BOOL' "
            f"WHEN regexp_full_match({base}, 'int[0-9]*') THEN CASE WHEN {bits} <= 64 THEN 'INT64' ELSE 'BIGNUMERIC' END "
            f"WHEN regexp_full_match({base}, 'uint[0-9]*') THEN CASE WHEN {bits} <= 56 THEN 'INT64' ELSE 'BIGNUMERIC' END "
            "ELSE 'STRING' END")


def _vocab(p: str, depth: int) -> str:
    base = f"regexp_replace({p}.type, '{_SUFFIX}', '')"
    name = f"coalesce({p}.name, '')"
    out = (f"CASE WHEN regexp_matches({p}.type, '{_SUFFIX}') THEN 'ARRAY<' || {name} || ' ' || "
           f"({_scalar(base)}) || '>' ELSE ({_scalar(base)}) END")
    if depth > 0:
        c = f"c{depth}"
        fields = (f"array_to_string(list_transform({p}.components, lambda {c}: coalesce({c}.name, '') "
                  f"|| ' ' || ({_vocab(c, depth - 1)})), ', ')")
        out = f"CASE WHEN {base} = 'tuple' THEN 'ARRAY<' || {fields} || '>' ELSE {out} END"
    return out


def _canon(p: str, depth: int) -> str:
    t = f"regexp_replace({p}.type, '^(u?int)(\\[|$)', '\\1256\\2')"
    if depth == 0:
        return t
    c = f"k{depth}"
    inner = f"array_to_string(list_transform({p}.components, lambda {c}: {_canon(c, depth - 1)}), ',')"
    return (f"CASE WHEN starts_with({t}, 'tuple') THEN '(' || {inner} || ')' || "
            f"regexp_extract({t}, '^tuple(.*)$', 1) ELSE {t} END")


def _py_canon(p) -> str:
    import re

    t = re.sub(r"^(u?int)(\[|$)", r"\g<1>256\g<2>", p["type"])
    if t.startswith("tuple"):
        return "(" + ",".join(_py_canon(c) for c in p.get("components", [])) + ")" + t[5:]
    return t


def _hash_values() -> str:
    import json

    from logloom.functions.keccak import keccak_hex
    from logloom.sources.abis import ABI_DOCUMENTS

    sigs = set()
    for doc in ABI_DOCUMENTS:
        try:
            entries = json.loads(doc)
        except ValueError:
            continue
        for e in entries:
            if e.get("type") in ("event", "function"):
                sigs.add(e["name"] + "(" + ",".join(_py_canon(p) for p in e.get("inputs", [])) + ")")
    rows = ", ".join(f"({_sql_str(s)}, '{keccak_hex(s)}')" for s in sorted(sigs))
    return f"hashes AS (SELECT * FROM (VALUES {rows}) AS t(signature, keccak))"


def entries_cte() -> str:
    plain = ("array_to_string(list_transform(coalesce({L}, []), lambda x: to_json(struct_pack("
             "name := coalesce(x.name, ''), type := " + _vocab("x", 3) + "))), ',')")
    ev = ("array_to_string(list_transform(coalesce(e.inputs, []), lambda x, i: to_json(struct_pack("
          "name := coalesce(x.name, ''), type := " + _vocab("x", 3) + ", index_type := "
          "CASE WHEN coalesce(x.indexed, false) THEN 'topic' || CAST(len(list_filter("
          "list_slice(e.inputs, 1, i), lambda y: coalesce(y.indexed, false))) AS VARCHAR) "
          "ELSE 'data' END))), ',')")
    sig = ("e.name || '(' || array_to_string(list_transform(coalesce(e.inputs, []), lambda x: "
           + _canon("x", 3) + "), ',') || ')'")
    return f"""{_abi_values()},
{_hash_values()},
parsed AS (
  SELECT ordinal, unnest(from_json(abi, '{_ENTRY_JSON}')) AS e FROM abis WHERE json_valid(abi)
),
entries AS (
  SELECT ordinal,
         CASE WHEN e.type = 'event' THEN 'event' ELSE 'call' END AS type,
         e.name AS entry_name,
         {sig} AS signature,
         CASE WHEN e.type = 'event' THEN {ev} ELSE {plain.format(L='e.inputs')} END AS inputs,
         CASE WHEN e.type = 'event' THEN CAST(NULL AS VARCHAR) ELSE {plain.format(L='e.outputs')} END AS outputs
  FROM parsed
  WHERE e.type IN ('event', 'function') AND e.name IS NOT NULL
    AND NOT (e.type = 'event' AND coalesce(e.anonymous, false))
),
hashed AS (
  SELECT en.*, CASE WHEN type = 'event' THEN h.keccak ELSE substr(h.keccak, 1, 10) END AS hash_id
  FROM entries en LEFT JOIN hashes h USING (signature)
)"""


def seeds_cte() -> str:
    s = "s_suppkey"
    return f"""cat AS (
  SELECT {A(s)} AS address, replace('Token.V' || CAST({s} % 3 AS VARCHAR), '.', '_') AS contract_name,
         replace('proj.' || CAST({s} % 4 AS VARCHAR), '.', '_') AS namespace, {s} % 6 AS ordinal
  FROM supplier
),
contracts_partial AS (
  SELECT {A(s)} AS address, TIMESTAMP '1992-01-01' + to_days(CAST({s} AS INTEGER)) AS block_timestamp
  FROM supplier WHERE {s} % 7 <> 6
)"""


def _allow_values() -> str:
    from logloom.sources.abis import ALLOW_LIST

    rows = ", ".join(f"({_sql_str(n)})" for n in ALLOW_LIST)
    return f"names AS (SELECT * FROM (VALUES {rows}) AS t(sub_name))"


def abi_catalog_sql() -> str:
    return (f"WITH {_abi_values()}, {seeds_cte()}\n"
            "SELECT cat.address, cat.contract_name AS name, cat.namespace, CAST(cat.ordinal AS BIGINT) AS ordinal, abis.abi "
            "FROM cat LEFT JOIN abis ON abis.ordinal = cat.ordinal")


def signature_entries_sql(kind: str) -> str:
    infix = "_evt_" if kind == "event" else "_call_"
    return (f"WITH {entries_cte()},\n{seeds_cte()}\n"
            f"SELECT cat.address, cat.contract_name, CAST(cat.ordinal AS BIGINT) AS ordinal, h.type, "
            f"cat.contract_name || '{infix}' || h.entry_name AS sub_name, h.signature, h.inputs, h.outputs, "
            f"h.hash_id FROM cat JOIN hashed h ON h.ordinal = cat.ordinal WHERE h.type = '{kind}'")


def ungrouped_cte() -> str:
    return f"""{entries_cte()},
{seeds_cte()},
ungrouped AS (
  SELECT DISTINCT cat.contract_name || CASE WHEN h.type = 'event' THEN '_evt_' ELSE '_call_' END || h.entry_name AS sub_name,
         h.inputs, h.outputs, h.type, h.hash_id, c.block_timestamp AS min_created_ts, cat.address,
         cat.contract_name, cat.namespace
  FROM cat JOIN hashed h ON h.ordinal = cat.ordinal
  LEFT JOIN contracts_partial c ON c.address = cat.address
)"""


def _jlist(c: str) -> str:
    return f"CAST(to_json(list_sort(list(DISTINCT {c}), 'ASC', 'NULLS FIRST')) AS VARCHAR)"


def signature_registry_sql() -> str:
    return f"""WITH {ungrouped_cte()},
{_allow_values()}
SELECT n.sub_name, u.type, min(u.min_created_ts) AS min_created_ts,
       {_jlist('u.inputs')} AS inputs_, {_jlist('u.outputs')} AS outputs,
       {_jlist('u.hash_id')} AS hash_ids, {_jlist('u.address')} AS contract_addresses,
       u.contract_name, u.namespace,
       COUNT(*) OVER (PARTITION BY u.sub_name) AS count
FROM ungrouped u
LEFT JOIN names n ON lower(n.sub_name) = lower(u.sub_name)
WHERE lower(u.sub_name) IN (SELECT lower(sub_name) FROM names)
GROUP BY u.sub_name, u.type, u.contract_name, u.namespace, n.sub_name"""


def ungrouped_sql() -> str:
    return f"WITH {ungrouped_cte()}\nSELECT * FROM ungrouped"


# --- registry-driven decode (D1-D4) -----------------------------------------

def _spec_cte(sub_name: str) -> str:
    return f"""{ungrouped_cte()},
spec AS (
  SELECT u.namespace, u.hash_id, u.address, b.min_ts
  FROM (SELECT DISTINCT namespace, hash_id, address FROM ungrouped WHERE sub_name = '{sub_name}') u
  JOIN (SELECT namespace, min(min_created_ts) AS min_ts FROM ungrouped
        WHERE sub_name = '{sub_name}' GROUP BY namespace) b USING (namespace)
)"""


def _evt_meta() -> str:
    return (f"{A('s')} AS contract_address, o AS evt_block_number, bt AS evt_block_time, "
            "ln AS evt_index, '0x' || sh AS evt_tx_hash, o % 200 AS evt_tx_index, sp.namespace")


def decode_event_sql(sub_name: str, select: str, kinds: list[str], evt_hash: str) -> str:
    kl = ", ".join(f"'{k}'" for k in kinds)
    return f"""WITH {LINEITEM_KINDS},
{_spec_cte(sub_name)}
SELECT {select}, {_evt_meta()}, '{evt_hash}' AS evt_hash
FROM lv JOIN spec sp ON sp.address = {A('s')} AND sp.hash_id = '{evt_hash}'
WHERE kind IN ({kl}) AND (sp.min_ts IS NULL OR bt >= sp.min_ts)"""


def d1_sql() -> str:
    return decode_event_sql(
        "Token_V0_evt_Transfer",
        f"{A('p + 1')} AS \"from\", {A('o + 1')} AS \"to\", wdec AS \"value\"",
        ["transfer", "transfer721"], sig.TRANSFER)


def d2_batch_sql() -> str:
    return decode_event_sql(
        "Token_V2_evt_TransferBatch",
        f"{A('p + 1')} AS operator, {A('o + 1')} AS \"from\", {A('q + 1')} AS \"to\", "
        "CAST(to_json(list_transform(range(q % 4), lambda x: CAST(p AS VARCHAR))) AS VARCHAR) AS ids, "
        "CAST(to_json(list_transform(range(q % 4), lambda x: wdec)) AS VARCHAR) AS \"values\"",
        ["batch"], sig.TRANSFER_BATCH)


def d2_uri_sql() -> str:
    return decode_event_sql(
        "Token_V2_evt_URI",
        "'uri-' || lpad(CAST(p AS VARCHAR), 8, '0') AS \"value\", CAST(p AS VARCHAR) AS id",
        ["uri"], sig.URI)


def _orders_calls() -> str:
    return f"""oc AS (
  SELECT o_orderkey AS o, o_custkey AS c, o_orderdate AS bt, o_orderstatus <> 'F' AS ok,
         CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
         '0x' || {SHA('o_orderkey')} AS tx, {A('o_custkey % (SELECT count(*) FROM supplier)')} AS addr
  FROM orders
)"""


def _call_meta(ok: str, method: str, frm: str, trace_address: str) -> str:
    return (f"tx AS call_tx_hash, addr AS contract_address, o AS call_block_number, bt AS call_block_time, "
            f"{ok} AS call_success, {trace_address} AS call_trace_address, 'call_' || tx AS call_trace_id, "
            f"CASE WHEN NOT {ok} THEN 'Reverted' END AS call_error, 'call' AS call_trace_type, "
            f"{frm} AS trace_from_address, '0' AS trace_value, '{method}' AS method_id, sp.namespace")


def d3_sql() -> str:
    return f"""WITH {_orders_calls()},
{_spec_cte('Token_V0_call_transfer')}
SELECT {A('c')} AS "to", CAST(cents AS VARCHAR) AS "value", CASE WHEN ok THEN true END AS output_0,
       {_call_meta('ok', '0xa9059cbb', A('c + 1'), "''")}
FROM oc JOIN spec sp ON sp.address = addr AND sp.hash_id = '0xa9059cbb'
WHERE o % 2 = 0 AND (sp.min_ts IS NULL OR bt >= sp.min_ts)"""


def d4_sql() -> str:
    return f"""WITH {LINEITEM_KINDS},
bc AS (
  SELECT *, ln <> 7 AS ok, '0x' || {SHA('o * 10 + ln')} AS tx, {A('s')} AS addr FROM lv WHERE s % 5 = 2
),
{_spec_cte('Token_V2_call_balanceOfBatch')}
SELECT CASE WHEN ok THEN CAST(to_json(list_transform(range(q % 4), lambda x: {A('o + 1')})) AS VARCHAR) END AS accounts,
       CASE WHEN ok THEN CAST(to_json(list_transform(range(q % 4), lambda x: CAST(p AS VARCHAR))) AS VARCHAR) END AS ids,
       CASE WHEN ok THEN CAST(to_json(list_transform(range(q % 4), lambda x: CAST(o * 1000 + q AS VARCHAR))) AS VARCHAR) END AS output_0,
       {_call_meta('ok', '0x4e1273f4', A('p + 1'), 'CAST(ln AS VARCHAR)').replace('o AS call_block_number', 'o AS call_block_number')}
FROM bc JOIN spec sp ON sp.address = addr AND sp.hash_id = '0x4e1273f4'
WHERE (sp.min_ts IS NULL OR bt >= sp.min_ts)"""


def prices_usd_sql() -> str:
    return f"""SELECT {A('pt.p_partkey')} AS contract_address, 'ethereum' AS blockchain,
       CAST(s.s_suppkey % 19 AS INTEGER) AS decimals, e.ts AS minute, e.value AS price, pt.p_brand AS symbol
FROM events e
JOIN part pt ON pt.p_partkey % 5 <> 0 AND pt.p_partkey = e.user_id
LEFT JOIN supplier s ON s.s_suppkey = pt.p_partkey"""


# --- D9 decode-all (long form, JSON args) -----------------------------------

def _event_rows_sql(columns: str, render) -> str:
    """Every log row x every allow-listed event spec row with the same (hash,
    address) and within the table's time bound; ``render`` makes the argument
    text of a (ABI ordinal, hash) layout from (name, value, place) triples,
    values computed from the source columns."""
    whex = "CASE WHEN p % 10 = 0 THEN sh ELSE " + W("o * 1000 + q") + " END"
    t1_addr = f"CASE WHEN kind = 'uri' THEN {A('p')} ELSE {A('p + 1')} END"
    t1_uw = "CAST(CASE WHEN kind = 'uri' THEN p ELSE p + 1 END AS VARCHAR)"
    t2_addr = f"CASE WHEN kind = 'uri' THEN NULL ELSE {A('o + 1')} END"
    t3_addr = (f"CASE WHEN kind IN ('transfer721', 'approval721') THEN '0x' || right({whex}, 40) "
               f"WHEN kind IN ('single', 'batch') THEN {A('q + 1')} END")
    t3_uw = ("CASE WHEN kind IN ('transfer721', 'approval721') THEN wdec "
             "WHEN kind IN ('single', 'batch') THEN CAST(q + 1 AS VARCHAR) END")
    d0_uw = ("CASE WHEN kind IN ('transfer', 'approval', 'transfer721', 'approval721') THEN wdec "
             "WHEN kind = 'approvalforall' THEN CAST(o % 2 AS VARCHAR) WHEN kind = 'single' THEN CAST(p AS VARCHAR) "
             "WHEN kind = 'batch' THEN '64' WHEN kind = 'uri' THEN '32' END")
    d0_bool = "CASE WHEN o % 2 <> 0 THEN 'true' ELSE 'false' END"
    d1_uw = "CASE WHEN kind = 'single' THEN wdec END"
    ids = "list_transform(range(q % 4), lambda x: CAST(p AS VARCHAR))"
    vals = "list_transform(range(q % 4), lambda x: wdec)"
    uri = "'uri-' || lpad(CAST(p AS VARCHAR), 8, '0')"
    layouts = [
        (0, sig.TRANSFER, [("from", t1_addr, "topic"), ("to", t2_addr, "topic"), ("value", d0_uw, "data")]),
        (0, sig.APPROVAL, [("owner", t1_addr, "topic"), ("spender", t2_addr, "topic"), ("value", d0_uw, "data")]),
        (1, sig.TRANSFER, [("from", t1_addr, "topic"), ("to", t2_addr, "topic"), ("tokenId", t3_uw, "topic")]),
        (1, sig.APPROVAL_FOR_ALL, [("owner", t1_addr, "topic"), ("operator", t2_addr, "topic"), ("approved", d0_bool, "data")]),
        (2, sig.TRANSFER_SINGLE, [("operator", t1_addr, "topic"), ("from", t2_addr, "topic"), ("to", t3_addr, "topic"),
                                  ("id", d0_uw, "data"), ("value", d1_uw, "data")]),
        (2, sig.TRANSFER_BATCH, [("operator", t1_addr, "topic"), ("from", t2_addr, "topic"), ("to", t3_addr, "topic"),
                                 ("ids", ids, "data"), ("values", vals, "data")]),
        (2, sig.URI, [("value", uri, "data"), ("id", t1_uw, "topic")]),
    ]
    cases = " ".join(f"WHEN s % 6 = {o} AND sp.hash_id = '{h}' THEN CAST({render(args)} AS VARCHAR)" for o, h, args in layouts)
    evt_hash = ("CASE WHEN kind IN ('transfer', 'transfer721') THEN '" + sig.TRANSFER + "' "
                "WHEN kind IN ('approval', 'approval721') THEN '" + sig.APPROVAL + "' "
                "WHEN kind = 'approvalforall' THEN '" + sig.APPROVAL_FOR_ALL + "' "
                "WHEN kind = 'single' THEN '" + sig.TRANSFER_SINGLE + "' "
                "WHEN kind = 'batch' THEN '" + sig.TRANSFER_BATCH + "' ELSE '" + sig.URI + "' END")
    return f"""WITH {LINEITEM_KINDS},
{_allow_values()},
{ungrouped_cte()},
ev AS (SELECT DISTINCT namespace, sub_name, hash_id, address FROM ungrouped WHERE type = 'event'
       AND lower(sub_name) IN (SELECT lower(sub_name) FROM names)),
bound AS (SELECT namespace, sub_name, min(min_created_ts) AS min_ts FROM ungrouped WHERE type = 'event'
          GROUP BY namespace, sub_name),
sp AS (SELECT ev.*, bound.min_ts FROM ev JOIN bound USING (namespace, sub_name)),
lh AS (SELECT *, {evt_hash} AS eh FROM lv)
SELECT {columns}, sp.namespace, sp.sub_name AS "table", CASE {cases} END AS args
FROM lh JOIN sp ON sp.hash_id = lh.eh AND sp.address = {A('s')}
WHERE sp.min_ts IS NULL OR bt >= sp.min_ts"""


def d9_sql() -> str:
    """Expected long-form rows: arguments as key/value text, lists joined."""
    def kv(args):
        text = [(k, f"array_to_string({v}, '|||')" if v.startswith("list_transform") else v) for k, v, _ in args]
        return "to_json([" + ", ".join(f"{{'key': '{k}', 'value': {v}}}" for k, v in text) + "])"

    return _event_rows_sql(
        f"{A('s')} AS contract_address, o AS evt_block_number, bt AS evt_block_time, ln AS evt_index, "
        "'0x' || sh AS evt_tx_hash, o % 200 AS evt_tx_index, eh AS evt_hash, true AS layout_supported", kv)


def a5_a6_sql() -> str:
    """Every row of the long form: keyed picks (A5) and the split, safely cast
    id / value lists (A6), summarised per row."""
    def arg(key):
        return f"list_extract(list_filter(kvs, lambda x: x.key = '{key}'), 1).value"

    def cast(key, to):
        return (f"list_filter(list_transform(string_split({arg(key)}, '|||'), lambda x: TRY_CAST(x AS {to})), "
                "lambda x: x IS NOT NULL)")
    return f"""WITH long AS ({d9_sql()}),
kv AS (SELECT *, json_transform(args, '[{{"key":"VARCHAR","value":"VARCHAR"}}]') AS kvs FROM long),
c AS (SELECT *, {cast('ids', 'DECIMAL(38, 0)')} AS ids, {cast('values', 'BIGINT')} AS v64 FROM kv)
SELECT evt_tx_hash, evt_index, namespace, "table", {arg('from')} AS "from",
       CASE WHEN len(ids) > 0 THEN CAST(len(ids) AS INTEGER) END AS n_ids,
       CASE WHEN len(ids) > 0 THEN CAST(list_sum(ids) AS VARCHAR) END AS ids_sum,
       CASE WHEN len(v64) > 0 THEN CAST(len(v64) AS INTEGER) END AS n_values_64
FROM c"""


def d9_calls_sql() -> str:
    """Expected long-form call rows over both trace fixtures (ERC-20 style
    calls from ``orders``, balanceOfBatch calls from ``lineitem``)."""
    def kv(*pairs):
        return "to_json([" + ", ".join(f"{{'key': '{k}', 'value': {v}}}" for k, v in pairs) + "])"

    out_bool = "CASE WHEN ok THEN 'true' END"
    order_layouts = [
        (0, "0xa9059cbb", kv(("to", A("c")), ("value", "CAST(cents AS VARCHAR)"), ("output_0", out_bool))),
        (0, "0x23b872dd", kv(("from", A("c")), ("to", A("c + 1")), ("value", "CAST(cents AS VARCHAR)"),
                             ("output_0", out_bool))),
        (1, "0x23b872dd", kv(("from", A("c")), ("to", A("c + 1")), ("tokenId", "CAST(cents AS VARCHAR)"),
                             ("output_0", f"CASE WHEN ok THEN {W('1')} ELSE '' END"))),
    ]
    rep = "array_to_string(list_transform(range(q % 4), lambda x: {v}), '|||')"
    batch = kv(("accounts", f"CASE WHEN ok THEN {rep.format(v=A('o + 1'))} END"),
               ("ids", f"CASE WHEN ok THEN {rep.format(v='CAST(p AS VARCHAR)')} END"),
               ("output_0", f"CASE WHEN ok THEN {rep.format(v='CAST(o * 1000 + q AS VARCHAR)')} END"))
    o_cases = " ".join(f"WHEN (c % (SELECT count(*) FROM supplier)) % 6 = {o} AND sp.hash_id = '{h}' THEN {e}" for o, h, e in order_layouts)
    meta_o = _call_meta("ok", "' || m || '", A("c + 1"), "''").replace("'' || m || ''", "m")
    meta_b = _call_meta("ok", "0x4e1273f4", A("p + 1"), "CAST(ln AS VARCHAR)")
    return f"""WITH {LINEITEM_KINDS},
{_orders_calls()},
om AS (SELECT *, CASE WHEN o % 2 = 0 THEN '0xa9059cbb' ELSE '0x23b872dd' END AS m FROM oc),
bc AS (
  SELECT *, ln <> 7 AS ok, '0x' || {SHA('o * 10 + ln')} AS tx, {A('s')} AS addr FROM lv WHERE s % 5 = 2
),
{_allow_values()},
{ungrouped_cte()},
cv AS (SELECT DISTINCT namespace, sub_name, hash_id, address FROM ungrouped WHERE type = 'call'
       AND lower(sub_name) IN (SELECT lower(sub_name) FROM names)),
bound AS (SELECT namespace, sub_name, min(min_created_ts) AS min_ts FROM ungrouped WHERE type = 'call'
          GROUP BY namespace, sub_name),
sp AS (SELECT cv.*, bound.min_ts FROM cv JOIN bound USING (namespace, sub_name))
SELECT {meta_o}, sp.sub_name AS "table", true AS layout_supported,
       CAST(CASE {o_cases} END AS VARCHAR) AS args
FROM om JOIN sp ON sp.hash_id = om.m AND sp.address = om.addr
WHERE sp.min_ts IS NULL OR bt >= sp.min_ts
UNION ALL
SELECT {meta_b}, sp.sub_name AS "table", true AS layout_supported,
       CAST(CASE WHEN s % 6 = 2 THEN {batch} END AS VARCHAR) AS args
FROM bc JOIN sp ON sp.hash_id = '0x4e1273f4' AND sp.address = bc.addr
WHERE sp.min_ts IS NULL OR bt >= sp.min_ts"""


# --- word primitives (F1-F9) over every log row ------------------------------

def words_sql() -> str:
    whex = "CASE WHEN p % 10 = 0 THEN sh ELSE " + W("o * 1000 + q") + " END"
    uri_pay = "rpad(lower(hex('uri-' || lpad(CAST(p AS VARCHAR), 8, '0'))), 64, '0')"
    one_word = "kind IN ('transfer', 'approval', 'transfer721', 'approval721')"
    d0 = (f"CASE WHEN {one_word} THEN {whex} WHEN kind = 'approvalforall' THEN {W('o % 2')} "
          f"WHEN kind = 'single' THEN {W('p')} WHEN kind = 'batch' THEN {W('64')} ELSE {W('32')} END")
    d1 = (f"CASE WHEN kind = 'single' THEN {whex} WHEN kind = 'batch' THEN {W('64 + 32 * (1 + q % 4)')} "
          f"WHEN kind = 'uri' THEN {W('12')} ELSE '' END")
    last = (f"CASE WHEN {one_word} OR kind = 'single' THEN {whex} WHEN kind = 'approvalforall' THEN {W('o % 2')} "
            f"WHEN kind = 'batch' THEN CASE WHEN q % 4 > 0 THEN {whex} ELSE {W('0')} END ELSE {uri_pay} END")
    d0_int = ("CASE WHEN " + one_word + " THEN wdec WHEN kind = 'approvalforall' THEN CAST(o % 2 AS VARCHAR) "
              "WHEN kind = 'single' THEN CAST(p AS VARCHAR) WHEN kind = 'batch' THEN '64' ELSE '32' END")
    bign = f"CASE WHEN {one_word} AND p % 10 = 0 THEN NULL ELSE {d0_int} END"
    d0_bool = (f"CASE WHEN {one_word} THEN CASE WHEN p % 10 = 0 THEN NULL ELSE true END "
               "WHEN kind = 'approvalforall' THEN o % 2 <> 0 WHEN kind = 'single' THEN p <> 0 ELSE true END")
    t3_long = ("CASE WHEN kind IN ('transfer721', 'approval721') THEN wlong "
               "WHEN kind IN ('single', 'batch') THEN q + 1 END")
    t1_addr = f"CASE WHEN kind = 'uri' THEN {A('p')} ELSE {A('p + 1')} END"
    return f"""WITH {LINEITEM_KINDS}
SELECT '0x' || sh AS evt_tx_hash, ln AS evt_index, {t1_addr} AS t1_address,
       {d0} AS d0, {d1} AS d1, '0x' || ({d0}) AS first_word, {last} AS last_word,
       {d0_int} AS d0_int, {t3_long} AS t3_int64, {bign} AS d0_bignumeric, {d0_bool} AS d0_bool
FROM lv"""


def contract_addresses_sql() -> str:
    return f"""WITH reg AS ({signature_registry_sql()})
SELECT DISTINCT sub_name, CAST(a AS VARCHAR) AS contract_address
FROM reg, unnest(CAST(json(contract_addresses) AS VARCHAR[])) AS t(a)"""


def registry_specs_sql() -> str:
    default_out = '[{"name":"output_0","type":"STRING"}]'
    return f"""WITH reg AS ({signature_registry_sql()})
SELECT sub_name, type, contract_name, namespace,
       replace(replace(sub_name, '.', '_'), '++', '') AS table_name,
       namespace || '_ethereum' AS schema_name,
       CASE WHEN inputs_ IN ('[null]', '[""]') THEN '[]'
            ELSE '[' || json_extract_string(inputs_, '$[0]') || ']' END AS input_spec,
       CASE WHEN outputs IN ('[null]', '[""]') THEN '{default_out}'
            ELSE '[' || json_extract_string(outputs, '$[0]') || ']' END AS output_spec
FROM reg"""


def document_sql() -> str:
    """X6 decoded documents of every event table, read back by JSON path (F10
    scalar JSON_VALUE with a BIGNUMERIC safe cast, F12 JSON_VALUE_ARRAY)."""
    def document(args):
        places = dict.fromkeys(place for _, _, place in args)
        return "to_json({" + ", ".join(f"'{x}': {{" + ", ".join(f"'{k}': {v}" for k, v, place in args if place == x) + "}"
                                       for x in places) + "})"

    value = "json_extract_string(args, '$.data.value')"
    return f"""WITH doc AS ({_event_rows_sql("'0x' || sh AS evt_tx_hash, ln AS evt_index", document)})
SELECT evt_tx_hash, evt_index, namespace, "table", args AS document,
       json_extract_string(args, '$.topic.from') AS topic_from, {value} AS value_text,
       CASE WHEN regexp_full_match({value}, '[0-9]+') AND (length({value}) < 39 OR length({value}) = 39
            AND {value} <= '578960446186580977117854925043439539266') THEN {value} END AS value_bignumeric,
       CAST(NULL AS VARCHAR) AS ids_as_scalar,
       CAST(json_array_length(args, '$.data.ids') AS INTEGER) AS n_ids,
       json_extract_string(args, '$.data.ids[0]') AS first_id
FROM doc"""


def base_views_sql() -> str:
    """S6: one transaction, block and trace per order."""
    return """SELECT CAST(o_orderdate AS DATE) AS block_day, count(*) AS n_blocks, count(*) AS n_transactions,
       count(*) AS n_traces, count(*) FILTER (o_orderstatus <> 'F') AS n_successful
FROM orders GROUP BY CAST(o_orderdate AS DATE)"""
