import numpy as np
from pyspark.sql import Row

from clickscope.llm import topk as T


def brute(rows, k, scale=256, every=50):
    ok = [(i, tuple(int(np.floor(float(np.float32(v)) * scale)) for v in e)) for i, e in rows
          if i is not None and e and all(v is not None and np.isfinite(v) for v in e)]
    out = []
    for qi, q in set(ok):
        if qi % every == 0:
            s = sorted((-sum(a * b for a, b in zip(q, x)), i) for i, x in ok if i != qi and len(x) == len(q))
            out += [(qi, r + 1, i, -v) for r, (v, i) in enumerate(s[:k])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([Row(vec_id=i, embedding=e, dims="clash", label=0) for i, e in rows],
                                 "vec_id long, embedding array<float>, dims string, label int")


def test_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 0.2, 8).round(2).tolist()) for i in range(230)]
    rows += [(1000 + i, rows[50][1]) for i in range(20)]  # ties
    rows += [(2000, None), (2050, [None] * 8), (2100, [float("nan")] * 8), (2150, [float("inf")] + [0.0] * 7),
             (2200, [0.0] * 8), (None, [0.1] * 8), (2250, []), (2300, [0.5, 0.5]), (2301, [0.25, 0.1])]
    rows += [rows[0], rows[0], rows[100]] + [rows[7]] * 9 + [rows[33]] * 2  # repeats are candidates each time
    got = T.top_k(frame(spark, rows), query_block=2, candidate_block=60).collect()
    assert sorted(map(tuple, got)) == brute(rows, 5)


def test_few_rows_and_empty(spark):
    rows = [(0, [1.0, 2.0]), (1, [2.0, -1.0])]
    assert sorted(map(tuple, T.top_k(frame(spark, rows)).collect())) == brute(rows, 5)
    assert T.top_k(frame(spark, rows).limit(0)).collect() == []
    assert T.top_k(frame(spark, rows[:1])).collect() == []


def test_lists_stop_early_and_are_exact():
    rng = np.random.default_rng(5)
    x = np.floor(rng.normal(0, 32, (4000, 16)))
    x[17] = x[3] + 1
    for kind in (np.float64, np.int64):
        lists = T.Lists(np.arange(4000), x.astype(kind))
        best, depth = lists.top(x[3:9].astype(kind), [np.array([i]) for i in range(3, 9)], 5)
        for i, (rows, score) in zip(range(3, 9), best):
            full = x @ x[i]
            full[i] = -np.inf
            want = np.lexsort((np.arange(4000), -full))[:5]
            assert rows.tolist() == want.tolist() and score.tolist() == full[want].tolist()
        assert max(depth) < 4000


def test_registered_query_and_sql_agree_on_repeats(spark, tmp_path):
    import duckdb
    from clickscope.llm import queries as Q
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(0, 0.2, 6).tolist()) for i in range(120)]
    frame(spark, rows + [rows[0], rows[3], rows[3]]).select("vec_id", "embedding", "label").write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    assert sorted(map(tuple, Q.op8_exact_top_k(spark, str(tmp_path)).collect())) == sorted(con.execute(Q.OP8_SQL).fetchall())
