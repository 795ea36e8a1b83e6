import hashlib
import random
import re

import pytest
from pyspark.sql import Row, functions as F

from clickscope.llm import mixing as M


def brute(rows, weights=(1, 2, 3), cap=3):
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    docs = [(s, int(md5(("" if i is None else str(i)) + "|" + md5(t or ""))[:15], 16), i,
             len(re.findall("[^\x20\x09-\x0D]+", t or ""))) for i, t, s in rows]
    names = sorted({d[0] for d in docs if d[0] is not None}) + ([None] if any(d[0] is None for d in docs) else [])
    size = {n: sum(d[3] for d in docs if d[0] == n) for n in names}
    w = {n: weights[k % len(weights)] for k, n in enumerate(names)}
    target, capped = {}, set()
    while True:
        left = sum(size.values()) - sum(cap * size[n] for n in capped)
        free = [n for n in names if n not in capped]
        target = {n: cap * size[n] if n in capped else w[n] * left / sum(w[x] for x in free) for n in names}
        over = {n for n in free if target[n] > cap * size[n]}
        if not over:
            break
        capped |= over
    out = []
    for n in names:
        p = int(target[n] // size[n]) if size[n] else 0
        rest, at = int(target[n] - p * size[n] + 0.5), 0
        for _, _, i, z in sorted((d for d in docs if d[0] == n), key=lambda d: d[1]):
            out.append((i, z, size[n], round(target[n], 6), p * z + min(max(rest - at, 0), z)))
            at += z
    return sorted(out, key=str), target, size


def rows(n=120, seed=1):
    rng = random.Random(seed)
    out = [(i, " ".join(["w"] * rng.randrange(0, 40)) + f" x{i}", rng.choice(["a", "a", "a", "b", "Z", "é", "tiny"])) for i in range(n)]
    out += [(500, None, "a"), (501, "", "b"), (502, " \t\n ", "empty"), (None, "some words", "a"), (503, "in none", None),
            (504, "one\x1ctwo\xa0three four", "b"), out[3]]
    return out + [(600 + i, "t", "tiny2") for i in range(2)]


def frame(spark, data):
    return spark.createDataFrame([Row(doc_id=i, text=t, source=s, size="clash", _size=1) for i, t, s in data],
                                 "doc_id long, text string, source string, size string, _size int")


def test_equals_brute_force(spark):
    data = rows()
    got = M.mix(frame(spark, data)).collect()
    want, target, size = brute(data)
    assert sorted(((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in got), key=str) == want
    assert sum(r.taken for r in got) == pytest.approx(sum(size.values()), abs=len(size))
    assert all(r.taken <= 3 * r["size"] for r in got)
    assert all((r.position is None) == (r.taken == 0) and (r.position is None or 0 <= r.position <= 1) for r in got)
    assert all(abs(r.copies - r.taken / r["size"]) <= 0.5 for r in got if r["size"])
    positions = [r.position for r in got if r.position is not None]
    assert positions == sorted(positions) and [r.position for r in got[len(positions):]] == [None] * (len(got) - len(positions))


def test_positions_invert_the_demand(spark):
    knots = ((0.0, 1.0), (0.25, 3.0), (0.5, 0.5), (1.0, 0.5))
    whole = M.integral(knots)

    def area(t):
        got = 0.0
        for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
            if t > t0:
                u = min(t, t1) - t0
                got += w0 * u + (w1 - w0) / (t1 - t0) * u * u / 2
        return got

    df = spark.range(101).select((F.col("id") * whole / 100).alias("a"))
    for r in df.select("a", M.time_at(F.col("a"), knots).alias("t")).collect():
        assert area(r.t) == pytest.approx(r.a, abs=1e-9)


def test_reruns_and_partitions_agree_and_empty(spark):
    data = rows(60, 2)
    a = sorted(map(str, M.mix(frame(spark, data)).collect()))
    assert a == sorted(map(str, M.mix(frame(spark, data[::-1]).repartition(5)).collect()))
    assert M.mix(frame(spark, data).limit(0)).collect() == []
    assert [r.taken for r in M.mix(frame(spark, [(1, None, None), (2, "", "a")])).collect()] == [0, 0]
