"""Run ``queries()[k]`` on Spark and ``oracle_sql()[k]`` on DuckDB and compare
(column names, row count, order-insensitive values). CLI:

    python tests/oracle_check.py /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck_connection(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _spark_type(t) -> str:
    """DuckDB type-name prefix a Spark type should map to."""
    name = t.simpleString()
    for prefix, duck in (("string", "VARCHAR"), ("bigint", "BIGINT"), ("int", "INTEGER"),
                         ("boolean", "BOOL"), ("timestamp_ntz", "TIMESTAMP"), ("double", "DOUBLE"),
                         ("decimal", "DECIMAL"), ("array", "")):
        if name.startswith(prefix):
            return duck
    return name.upper()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def compare(spark, sf_dir: str, key: str, con=None) -> tuple[bool, str]:
    import __spark_entry__ as E

    con = con or duck_connection(sf_dir)
    t0 = time.time()
    sdf = E.queries()[key](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    sql = E.oracle_sql().get(key)
    if sql is None:
        return True, f"{key}: rows={len(s_rows)} (no oracle) {t1 - t0:.1f}s"
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"{key}: columns differ spark={sorted(s_cols)} duck={sorted(d_cols)}"
    s_types = {f.name: _spark_type(f.dataType) for f in sdf.schema.fields}
    d_types = {d[0]: str(d[1]).upper() for d in res.description}
    bad_types = {c: (s_types[c], d_types[c]) for c in s_cols
                 if not d_types[c].startswith(s_types[c])}
    if bad_types:
        return False, f"{key}: column types differ {bad_types}"
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_index = {c: i for i, c in enumerate(d_cols)}
    s_norm = sorted((tuple(_norm(r[i]) for i in order) for r in s_rows), key=_key)
    d_norm = sorted((tuple(_norm(r[d_index[s_cols[i]]]) for i in order) for r in d_rows), key=_key)
    if len(s_norm) != len(d_norm):
        return False, f"{key}: row count spark={len(s_norm)} duck={len(d_norm)}"
    for a, b in zip(s_norm, d_norm):
        if a != b:
            cols = [s_cols[i] for i in order]
            diff = {c: (x, y) for c, x, y in zip(cols, a, b) if x != y}
            return False, f"{key}: value mismatch {diff}"
    return True, f"{key}: ok rows={len(s_norm)} spark {t1 - t0:.1f}s"


def main(argv):
    from logloom.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    import __spark_entry__ as E

    keys = argv[2:] or list(E.queries())
    con = duck_connection(sf_dir)
    bad = 0
    for k in keys:
        try:
            ok, msg = compare(spark, sf_dir, k, con)
        except Exception as e:  # report and continue
            ok, msg = False, f"{k}: ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(("PASS " if ok else "FAIL ") + msg, flush=True)
    print(f"{len(keys) - bad}/{len(keys)} passed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
