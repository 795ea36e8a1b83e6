import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import Row

from clickscope.llm import codes as C


def nearest(x, book):
    d = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in book]
    return d.index(min(d)), min(d)


def brute(rows, parts, entries, rounds, scale):
    """(id, code, error, label_error, digest) of each kept row; rows of other lengths have nulls."""
    kept = [(i, [math.floor(scale * float(c)) for c in v], lab) for i, v, lab in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    w = len(first[0][1]) // parts if first else 0
    fits = lambda x: len(x) == len(first[0][1]) and len(x) % parts == 0
    cut = lambda x, p: x[p * w:p * w + w]
    books = [[cut(x, p) for _, x, _ in first if fits(x)] for p in range(parts)]
    for _ in range(rounds if books and books[0] else 0):
        for p in range(parts):
            groups = {}
            for _, x, _ in kept:
                if fits(x):
                    groups.setdefault(nearest(cut(x, p), books[p])[0], []).append(cut(x, p))
            for e, xs in groups.items():
                books[p][e] = [sum(c) // len(xs) for c in zip(*xs)]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out, total = [], {}
    for i, x, lab in kept:
        code = error = None
        if fits(x):
            found = [nearest(cut(x, p), books[p]) for p in range(parts)]
            code, error = "".join(f"{e:02x}" for e, _ in found), sum(d for _, d in found)
            total[lab] = total.get(lab, 0) + error
        out.append([i, code, error, lab])
    return sorted([(i, c, e, total.get(lab), digest) for i, c, e, lab in out], key=str)


def frame(spark, rows):
    return spark.createDataFrame([Row(vec_id=i, embedding=v, label=lab, code=1, _x=2) for i, v, lab in rows],
                                 "vec_id long, embedding array<float>, label int, code int, _x int").repartition(3)


def corpus(n, dim, seed):
    rng = random.Random(seed)
    f = lambda v: float(np.float32(v))
    rows = [(i, [f(rng.gauss(0, 0.3)) for _ in range(dim)], rng.choice([1, 2, None])) for i in range(n)]
    rows += [(n + i, [f(round(c, 1)) for c in rows[i][1]], 1) for i in range(n // 3)]  # ties
    rows += [rows[0], rows[1], (rows[1][0], rows[2][1], 2), (None, rows[3][1], None)]
    nan, inf = float("nan"), float("inf")
    bad = [(900, None, 1), (901, [nan] * dim, 1), (902, [inf] + [0.0] * (dim - 1), None), (903, [None] * dim, 2)]
    return rows + bad + [(904, [0.5] * (dim + 1), 3), (905, [], 1), (906, [0.0] * dim, 1), (907, [-0.0] * dim, 1)]


def test_equals_brute_force(spark):
    for dim, parts, entries, side in ((8, 4, 16, 64), (6, 2, 256, 300), (3, 3, 5, 7)):
        rows = corpus(60, dim, dim)
        found = C.compress(frame(spark, rows), parts=parts, entries=entries, rounds=3, scale=1024, side=side)
        assert found.columns == ["vec_id", "embedding", "label", "_x", "code", "error", "label_error", "codebooks_sha256"]
        got = found.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()
        assert sorted(map(tuple, got), key=str) == brute(rows, parts, entries, 3, 1024)


def test_few_empty_and_odd_tables(spark):
    rows = corpus(60, 8, 8)
    assert C.compress(frame(spark, rows).limit(0)).collect() == []
    for some in (rows[:2], [(1, [0.5] * 7, 1), (2, [0.5] * 8, None)], [(1, [], 1)]):
        got = C.compress(frame(spark, some), parts=4).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()
        assert sorted(map(tuple, got), key=str) == brute(some, 4, 256, 4, 1024)
    with pytest.raises(ValueError):
        C.compress(frame(spark, [(1, [1e9] * 8, 1)]))


def test_cells_lose_no_nearest_entry():
    rng = np.random.default_rng(1)
    book = rng.integers(-50, 50, (40, 5))
    book[7] = book[3]  # a tie everywhere
    x = np.concatenate([rng.integers(-80, 80, (700, 5)), book, (book[:-1] + book[1:]) // 2])
    d = ((x[:, None] - book) ** 2).sum(2)
    for side in (1, 3, 20, 500):
        for room in (1, 10_000):
            cells = C.Cells(book, side, room)
            for part in np.array_split(x, 4):
                i, e = cells.nearest(part)
                at = ((part[:, None] - book) ** 2).sum(2)
                assert (i == at.argmin(1)).all() and (e == at.min(1)).all()
    assert d.argmin(1).tolist().count(7) == 0
    remembering = C.Cells(book, 500)
    for _ in range(3):
        remembering.nearest(x)
    assert remembering.met == len(np.unique(x // 500, axis=0))  # each cell once
    assert C.Cells(book, 3).nearest(x)[0].tolist() == d.argmin(1).tolist()
    narrow = C.Cells(book, 3)
    narrow.nearest(x)
    assert narrow.pairs < len(x) * len(book) / 2  # most entries are dominated
