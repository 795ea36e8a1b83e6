import random

import pytest

import corpus_pipeline as C
from llm.test_line_dedup import brute as brute_lines
from llm.test_mixing import brute as brute_mix
from llm.test_simhash import slow_components

pytest.importorskip("public_tokenizers")


def documents():
    rng = random.Random(3)
    kinds = {"en": "the of and tion ing er".split(), "de": "ung ver sch ein ä ß".split()}
    lines = [" ".join("".join(rng.choice(kinds[k]) for _ in range(3)) for _ in range(rng.randrange(4, 12)))
             for k in kinds for _ in range(40)]
    rows = []
    for i in range(70):
        text = "\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 7)))
        rows.append((i, text, "en", rng.choice(["a", "a", "b", "c"]), len(text), i))
    rows += [(100 + i, rows[i][1], rows[i][2], "b", rows[i][4], 0) for i in range(10)]  # copies
    odd = [(300, None, "en", "a", 0, 1), (301, "", "en", None, 0, 2), (302, "12 %% ?", "de", "a", 7, 3), (303, lines[0], None, None, 9, 4)]
    return rows + odd + [(None, "ein verschung " * 5, "de", "b", 70, 5), rows[3]]


def test_stages_follow_their_operators(spark, tmp_path):
    rows = documents()
    schema = "doc_id long, text string, lang string, source string, n_chars long, score long"
    docs = spark.createDataFrame(rows, schema).repartition(3)
    before, seen = sorted(map(tuple, docs.collect()), key=str), {}
    for name, function in C.STAGES:
        path = str(tmp_path / name)
        function(spark, docs, str(tmp_path)).write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = sorted(map(tuple, docs.collect()), key=str)
        if name != "packing":
            assert docs.dtypes == [tuple(c.replace("long", "bigint").split()) for c in schema.split(", ")]
    rejected = [r for r in before if r not in [(*x[:2], r[2], *x[3:]) for x in seen["language_id"]]]
    assert {r[0] for r in rejected} == {300, 301, 302}
    assert all(r[2] for r in seen["language_id"])

    kept = seen["language_id"]
    lost = brute_lines(list({(r[0], r[1]) for r in kept}), 2, 24)
    want = []
    for r in kept:
        drop = set(sum(lost[r[0]], []))
        text = "\n".join(x for k, x in enumerate(r[1].split("\n")) if k not in drop)
        want.append((r[0], text, r[2], r[3], len(text), r[5]))
    assert sorted(want, key=str) == seen["line_dedup"] and any(w[1] != r[1] for w, r in zip(want, kept))

    classes = {}
    for i, _, least in slow_components([r[:2] for r in want], 4):
        classes.setdefault(least, set()).add(i)
    assert sorted(str(r[0]) for r in seen["simhash_near_dedup"]) == sorted(map(str, classes))
    assert set(seen["simhash_near_dedup"]) <= set(want)

    taken, _, _ = brute_mix([(r[0], r[1], r[3]) for r in seen["simhash_near_dedup"]])
    times = {i: t / n if n else 0 for i, n, _, _, t in taken}
    mixed = [r[0] for r in seen["mixing"]]
    assert set(seen["mixing"]) <= set(seen["simhash_near_dedup"])
    assert all(abs(mixed.count(i) - t) <= 0.5 for i, t in times.items())

    pieces = spark.read.parquet(str(tmp_path / "packing")).collect()
    texts, owners = {r[0]: r[1] for r in seen["mixing"]}, {}
    for p in pieces:  # copies of a document are packed apart
        owners.setdefault((p.doc_id, p.start), []).append(p)
    assert all(len(v) == mixed.count(i) for (i, s), v in owners.items() if s == 0)
    one = [v[0] for v in owners.values()]
    assert sum(p.length for p in pieces) == sum(p.doc_tokens for p in pieces if p.start == 0)
    assert {p.doc_id for p in one} == set(texts)


def test_run_and_empty_documents(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([r[:5] for r in documents()[:30]], schema).write.parquet(str(tmp_path / "documents.parquet"))
    got = C.run(spark, str(tmp_path)).collect()
    texts = {r[0]: r[1] for r in documents()[:30]}
    assert got and {p.doc_id for p in got} <= set(texts)
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert C.run(spark, str(tmp_path / "none")).collect() == []


def test_language_is_evaluated_once(spark):
    docs = spark.createDataFrame([r[:5] for r in documents()], "doc_id long, text string, lang string, source string, n_chars long")
    plan = C.identified(spark, docs, "")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_short_clean_texts_stay(spark):
    rows = documents() + [(400 + i, t, "en", "a", len(t)) for i, t in enumerate(["a", "ab", "of it", "zq", "Ja."])]
    docs = spark.createDataFrame([r[:5] for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id for r in C.identified(spark, docs, "").collect()} >= set(range(400, 405))
