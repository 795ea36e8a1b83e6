"""The registered queries without SQL on the smallest test tables, against brute force."""

import math
import os

import duckdb
import pytest

from clickscope.llm import langid as L
from clickscope.llm import queries as Q
from llm import test_langid, test_lm_scoring, test_packing
from llm.test_simhash import slow_components
from llm.test_token_counts import whole

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def documents(*cols):
    return duckdb.sql(f"SELECT {', '.join(cols)} FROM read_parquet('{SF}/documents.parquet')").fetchall()


def test_a_query_for_each_operator():
    numbers = sorted(int(n[2:n.index("_")]) for n in Q.queries())
    assert numbers == list(range(1, 14)) and set(Q.oracle_sql()) <= set(Q.queries())


def test_token_counts(spark):
    want = sorted((i, len((t or "").encode()), whole(t), whole(t) > 512) for i, t in documents("doc_id", "text"))
    assert sorted(map(tuple, Q.op1_token_counts(spark, SF).collect())) == want


def test_simhash(spark):
    got = sorted(map(tuple, Q.op4_simhash_near_dedup(spark, SF).collect()), key=str)
    assert got == slow_components(documents("doc_id", "text"), 4)


def test_lm_scoring_equals_brute_force(spark):
    test_lm_scoring.same(Q.op9_lm_scoring(spark, SF).collect(), test_lm_scoring.brute(documents("doc_id", "text")))


def test_packing_holds_every_id_once(spark):
    assert test_packing.check(Q.op10_packing(spark, SF).collect(), documents("doc_id", "text"), 4096) > 0.9


def test_language_id_equals_a_plain_search(spark, tmp_path):
    """Phrases counted by substring search; languages with equal samples tie, and the first name wins."""
    rows = [(i, t[:400], k) for i, t, k in test_langid.rows()[:70]]
    rows += [(500 + i, t, "xx") for i, t, k in rows if k == "ru"] + [(900, "", "en"), (901, "?!", "de"), (902, None, None)]
    rows = [(i, t, "xy" if k == "ru" else k) for i, t, k in rows]
    # the same texts under two labels: each label learns all of its rows
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in Q.op5_language_id(spark, str(tmp_path)).collect()}
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    samples = L.fit_sample(docs, learn=L.crc_mod("doc_id", 3) != 1)
    names, cost = sorted(samples), {k: math.log2(max(2, len(v))) for k, v in samples.items()}
    for i, t, _ in rows:
        if i >= 900:
            assert (got[i].lang_pred, got[i].score) == ("und", 0)
            continue
        data = t.lower().encode()
        bits = [test_langid.slow_count(samples[k], data) * cost[k] / len(data) for k in names]
        two = sorted(bits)[:2]
        assert got[i].lang_pred == names[bits.index(two[0])]
        assert got[i].score == pytest.approx(two[1] / (two[0] + two[1])) and got[i].bits_per_byte == pytest.approx(two[0])


def test_language_ties_go_to_the_first_name(spark):
    same = "the same words for both of the labels, and nothing else"
    rows = [(i, same, k) for i in range(30) for k in ("zz", "aa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {(r.lang_pred, r.score) for r in L.identify(docs).collect()} == {("aa", 0.5)}
