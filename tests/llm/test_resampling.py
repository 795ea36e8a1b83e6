import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Row

from clickscope.llm import resampling as R


def words(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def runs(t, order):
    w = words(t)
    return [" ".join(w[i:i + k]) for k in range(1, order + 1) for i in range(len(w) - k + 1)]


def brute(rows, target, order, buckets, least, share, seed):
    """(id, features, weight, score, rank) of each row, in the order of the rows."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for count, texts in ((s, [x for _, x in rows]), (t, target)):
        for x in texts:
            for f in runs(x, order):
                count[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    out = []
    for i, x in rows:
        fs = runs(x, order)
        weight = sum(gain[bucket(f)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = [k for k, (_, x) in enumerate(rows) if len(words(x)) >= least]
    fit.sort(key=lambda k: (-out[k][3], out[k][0] is None, out[k][0] or 0, out[k][1], len(words(rows[k][1]))))
    for rank, k in enumerate(fit[:share * len(fit) // 100], 1):
        out[k][4] = rank
    return sorted(map(tuple, out), key=str)


def corpus(n, seed):
    rng = random.Random(seed)
    vocabulary = ["The", "of", "AND", "x1", "Ähre", "naïve", "日本", "don't", "a-b", "É", "z" * 40]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(60)))) for i in range(n)]
    odd = [(n, None), (n + 1, ""), (n + 2, " \n\t.,"), (n + 3, "the " * 9000), (n + 4, "y" * 70000 + " end"), (None, rows[0][1]),
           rows[1], rows[1], (rows[2][0], rows[3][1]), (n + 5, "a\x00b\x7fc퟿d")]
    return rows + odd


TARGET = ["the of and x1", None, "", "naïve Ähre 日本 ähre"]


def frame(spark, rows):
    return spark.createDataFrame([Row(doc_id=i, text=t, rank="clash", _s=1, _words=2) for i, t in rows],
                                 "doc_id long, text string, rank string, _s int, _words int").repartition(3)


def test_equals_brute_force(spark):
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    for order, buckets, share in ((2, 10000, 25), (3, 50, 100), (1, 7, 40)):
        rows = corpus(80, order)
        found = R.resample(frame(spark, rows), target, order=order, buckets=buckets, share=share, seed=7)
        assert found.columns == ["doc_id", "text", "_s", "_words", "n_features", "weight", "score", "rank"]
        got = found.select("doc_id", "n_features", "weight", "score", "rank").collect()
        want = brute(rows, TARGET, order, buckets, 20, share, 7)
        # equal rows share ranks in any order
        assert sorted(map(tuple, got), key=str) == want


def test_empty_tables(spark):
    rows, none = frame(spark, corpus(5, 1)), spark.createDataFrame([], "text string")
    assert R.resample(rows.limit(0), none).collect() == []
    assert R.resample(rows, none).count() == len(corpus(5, 1))


def test_hashes_of_joined_runs():
    rng = random.Random(1)
    parts = [bytes(rng.randrange(256) for _ in range(rng.choice([0, 1, 2, 7, 33, 5000, 100001]))) for _ in range(60)]
    a, b = parts[:30], parts[30:]
    crc = lambda xs: np.array([zlib.crc32(x) for x in xs], np.uint32)
    got = R._Crc().join(crc(a), crc(b), np.array([len(x) for x in b]))
    assert got.tolist() == [zlib.crc32(x + y) for x, y in zip(a, b)]


def test_batches_hold_every_row_once():
    texts = pa.array([b"x" * n for n in (0, 3, 50, 1, 1, 0, 9)] + [None])
    got = list(R.batches_of(texts, 10))
    assert [r for a, b in got for r in range(a, b)] == list(range(8)) and len(got) > 3
    assert list(R.batches_of(texts[:0])) == []
