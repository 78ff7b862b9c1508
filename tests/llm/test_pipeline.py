import corpus_pipeline as cp

from . import helpers as h
from .test_native import plain_lines


def test_stages_against_brute_force(spark, tmp_path):
    """Each stage on its predecessor's rows, written and read again."""
    con = h.duck()
    docs = spark.read.parquet(f"{h.SF}/documents.parquet")
    columns, before = docs.columns, docs.collect()
    items = con.execute("select item_id, text from benchmark").fetchall()
    for number, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, h.SF)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = docs.collect()
        left, had = {r["doc_id"]: r for r in after}, sorted(before, key=lambda r: r["doc_id"])
        if number + 1 < len(cp.STAGES):
            assert docs.columns == columns
        if name == "quality_rules":
            from logloom.llm import quality
            kept = con.execute(f"select doc_id from ({quality.ORACLE}) where kept").fetchall()
            assert set(left) == {i for i, in kept} and 0 < len(left) < len(before)
        elif name == "line_dedup":
            want = plain_lines([(r["doc_id"], r["text"]) for r in had])
            assert [left[r["doc_id"]]["text"] for r in had] == want
            assert all(r["n_chars"] == len(r["text"]) for r in after)
        elif name == "near_duplicates":
            pairs = [(r["doc_id"], r["text"]) for r in had]
            want = h.near_brute(pairs)
            assert set(left) == {pairs[i][0] for i, (a, _) in want.items() if a == i}
        elif name == "decontamination":
            assert set(left) == {r["doc_id"] for r in had if not h.leaked_items(r["text"], items)} and len(left) < len(had)
        else:
            sizes = {r["doc_id"]: len(h.WORD.findall(r["text"] or "")) for r in had}
            assert {i: r["size"] for i, r in left.items()} == sizes
            taken = {s: sum(r["taken"] for r in after if r["source"] == s) for s in {r["source"] for r in after}}
            assert all(abs(taken[r["source"]] - r["target"]) < 1 for r in after)
        before = after
    assert sorted(map(tuple, cp.run(spark, h.SF).collect())) == sorted(map(tuple, before))


def test_stages_on_edge_rows(spark):
    for table in (h.edge(spark), h.empty(spark)):
        docs = table
        for name, stage in cp.STAGES:
            out = stage(spark, table, h.SF)
            out.collect()
            if name != "source_mixing":
                assert out.columns == docs.columns
