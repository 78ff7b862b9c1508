import pytest

import __spark_entry__ as entry
from logloom.llm import lines, mixing, quality

from . import helpers as h

ORACLES = {"op1_line_dedup": lines.ORACLE, "op2_quality_rules": quality.ORACLE, "op9_mixing": mixing.ORACLE}


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_oracle(spark, name):
    got = entry.queries()[name](spark, h.SF).toPandas()
    assert h.rows(got) == h.rows(h.duck().execute(ORACLES[name]).df())


@pytest.mark.parametrize("name", ORACLES)
def test_no_python_in_native_plans(spark, name):
    plan = entry.queries()[name](spark, h.SF)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def plain_lines(docs, w=3, words=50):
    """Texts after removal, for distinct (id, text) in corpus order given: runs
    of ``w`` lines, and shorter ones of ``words`` words, go where they stand later."""
    first, out = {}, []

    def windows(ls, at):
        for m in range(1, w + 1):
            for j in range(len(at) - m + 1):
                part = tuple(ls[i] for i in at[j:j + m])
                if m == w or sum(len(h.WORD.findall(x)) for x in part) >= words:
                    yield j, m, part
    for n, (_, t) in enumerate(docs):
        ls = (t or "").split("\n")
        at = [i for i, x in enumerate(ls) if h.WORD.search(x)]
        for j, _, part in windows(ls, at):
            first[part] = min(first.get(part, (n, j)), (n, j))
    for n, (_, t) in enumerate(docs):
        ls = (t or "").split("\n")
        at = [i for i, x in enumerate(ls) if h.WORD.search(x)]
        gone = {at[j + k] for j, m, part in windows(ls, at) for k in range(m) if first[part] < (n, j)}
        out.append(None if t is None else "\n".join(x for i, x in enumerate(ls) if i not in gone))
    return out


def test_long_lines_are_runs(spark):
    """One line of 90 words in several documents, two of them exact copies of two lines."""
    long = " ".join(f"w{i}" for i in range(90))
    half = " ".join(f"v{i}" for i in range(30))
    docs = [(1, long), (2, f"short\n{long}"), (3, f"{long}\nend"), (4, f"{half}\n{half} x"), (5, f"{half}\n{half} x"), (6, f"{half}\nelse"), (7, long)]
    got = {r["doc_id"]: r for r in lines.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), counts=True).collect()}
    assert [got[i]["text"] for i, _ in docs] == plain_lines(docs) == [long, "short", "end", docs[3][1], "", docs[5][1], ""]
    assert got[5]["n_removed"] == 2 and got[6]["n_removed"] == 0
    forty = " ".join(f"w{i}" for i in range(49))  # under the bound: only with two others
    docs = [(1, f"{forty}\nb\nc"), (2, forty), (3, f"x\n{forty}\nb\nc")]
    got = {r["doc_id"]: r["text"] for r in lines.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert [got[i] for i, _ in docs] == plain_lines(docs) == [docs[0][1], forty, "x"]


def test_line_dedup_edges(spark):
    got = lines.remove_repeats(h.edge(spark), counts=True)
    assert set(h.edge(spark).columns) <= set(got.columns)
    rows = {(r["doc_id"], r["source"], r["n_lines"]): r for r in got.collect()}
    assert len(got.collect()) == len(h.EDGE)
    assert rows[(1, "a", 8)]["text"] == h.BODY and rows[(1, "a", 8)]["n_removed"] == 0
    assert rows[(2, "a", 8)]["text"] == "" and rows[(2, "a", 8)]["n_removed"] == 8
    assert rows[(None, None, 8)]["text"] == ""  # a null id comes last
    assert rows[(3, None, 0)]["text"] is None and rows[(5, "b", 3)]["text"] == " \n\t\n "
    assert lines.remove_repeats(h.empty(spark)).count() == 0


def test_line_dedup_brute(spark):
    import random
    r = random.Random(4)
    docs = [(i, "\n".join(r.choice(["a b", "c", "d e", "f", "", " ", "g h"]) for _ in range(r.randrange(14)))) for i in range(150)]
    got = dict(lines.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    assert [got[i] for i, _ in docs] == plain_lines(docs)


def test_quality_edges(spark):
    got = quality.judge(h.edge(spark))
    by = {(r["doc_id"], r["source"]): r for r in got.collect()}
    assert got.count() == len(h.EDGE)
    assert not by[(3, None)]["kept"] and by[(3, None)]["n_words"] == 0
    assert by[(6, "c")]["n_words"] == 60_000 and by[(6, "c")]["base_failed"]  # the long text repeats its words in a cycle
    assert by[(9, "")]["word_chars"] == len("x\x00yé z漢字")
    assert quality.judge(h.empty(spark)).count() == 0


def test_bad_host_is_rejected_good_host_kept(spark):
    good = " ".join(f"w{i}" for i in range(40))
    rows = [(i, good + f" {i}", "good") for i in range(60)] + [(100 + i, "bad", "junk") for i in range(60)] + [(500, good, "junk"), (501, good, None)]
    got = {r["doc_id"]: r for r in quality.judge(spark.createDataFrame(rows, h.EDGE_SCHEMA)).collect()}
    assert all(got[i]["kept"] for i in range(60)) and got[501]["kept"]
    assert got[500]["host_rejected"] and not got[500]["kept"] and not got[500]["base_failed"]


def test_prior_leaves_out_what_chance_gives_small_hosts(spark):
    """Hosts of two documents at one true rate: their rates spread by chance only, so they are drawn to the mean."""
    rows = [(h_, bool(i), i + j < 1) for h_ in range(400) for i in (0, 1) for j in [(h_ >> i) & 1]]
    judged = spark.createDataFrame([(f"h{a}", failed, False) for a, _, failed in rows], "host string, base_failed boolean, rule_failed boolean")
    rates = [r["shrunk_rate"] for r in quality.host_rates(judged, "host").collect()]
    mean = 1_000_000 * sum(f for _, _, f in rows) / len(rows)
    assert max(abs(r - mean) for r in rates) < 20_000


def test_mixing_edges(spark):
    got = mixing.mix(h.edge(spark)).collect()
    assert len(got) == len(h.EDGE)
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    goal = {r["source"]: r["target"] for r in got}
    for s, t in goal.items():
        assert abs(sum(r["taken"] for r in got if r["source"] == s) - t) < 1
    assert sum(goal.values()) == pytest.approx(sum(r["size"] for r in got), abs=1e-6)
    assert mixing.mix(h.empty(spark)).count() == 0
    assert h.rows(mixing.mix(h.edge(spark)).toPandas()) == h.rows(mixing.mix(h.edge(spark).repartition(5)).toPandas())
