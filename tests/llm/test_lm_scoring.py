import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import Row

from clickscope.llm import lm_scoring as M


def tokens(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall("[^\x20\x09-\x0D]+", low) + ["</s>"]


def fold(i):
    return None if i is None else crc32(str(i).encode()) % 10


def brute(rows):
    train = [tokens(t) for i, t in rows if fold(i) not in (None, 0)]

    def count(docs):
        one, two = Counter(), Counter()
        for d in docs:
            one.update(d)
            two.update(zip(["</s>"] + d, d))
        return one, two

    one, two = count(train)
    n, v = sum(one.values()), len(one)
    cells = Counter()
    for d in train:
        o, t = count([d])
        for a, b in zip(["</s>"] + d, d):
            c = one[a] - o[a]
            k = 0 if c == 0 else 1 + int(math.log2(c))
            ps = [(two[a, b] - t[a, b]) / c if c else 0, (one[b] - o[b]) / (n - len(d)) if n > len(d) else 0]
            cells[(k, *[M.NEVER if not p else round(M.OCTAVE * math.log2(p)) for p in ps])] += 1
    w = M.learn(np.array([(*c, m) for c, m in cells.items()], np.int64).reshape(-1, 4), v)
    out = []
    for i, text in rows:
        d = tokens(text)
        base = sum(math.log10((one[x] + 0.1) / (n + 0.1 * (v + 1))) for x in d)
        s = 0
        for a, b in zip(["</s>"] + d, d):
            k = 0 if not one[a] else 1 + int(math.log2(one[a]))
            s += math.log10(w[k][0] * (two[a, b] / one[a] if one[a] else 0) + w[k][1] * one[b] / max(n, 1) + w[k][2] / (v + 1))
        out.append((i, fold(i) == 0, len(d), sum(one[x] > 0 for x in d), n, base, s))
    return out


def corpus(n=150, seed=1):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(60)]
    rows = []
    for i in range(n):
        w, out = rng.choice(vocab), []
        for _ in range(rng.randrange(1, 60)):
            out.append(rng.choice(["W", "w"]) + w[1:])
            w = vocab[(int(w[1:]) * 7 + rng.randrange(3)) % 60] if rng.random() < 0.8 else rng.choice(vocab)
        rows.append((i, rng.choice([" ", "\n\t"]).join(out)))
    return rows + [(700, None), (701, ""), (702, " \t"), (None, "w1 w2 unseen"), (703, "É x\xa0y " * 400), rows[5], (710, rows[6][1])]


def run(spark, rows):
    df = spark.createDataFrame([Row(doc_id=i, text=t, n="clash", g=1) for i, t in rows],
                               "doc_id long, text string, n string, g int").repartition(3)
    return M.score_documents(df).collect()


def same(got, want):
    got, want = (sorted(map(tuple, x), key=lambda r: (str(r[0]), r[2:])) for x in (got, want))
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=1e-7) and a[6] == pytest.approx(b[6], abs=1e-7)


def test_equals_brute_force_and_beats_the_base(spark):
    rows = corpus()
    got = run(spark, rows)
    same(got, brute(rows))
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_nothing_to_learn_from_and_empty(spark):
    got = run(spark, [(None, "a b"), (None, None)])
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.held_out) for r in got) == [(1, 0, 0, False), (3, 0, 0, False)]
    assert run(spark, []) == []


def test_packing_of_numbers():
    rng = np.random.default_rng(1)
    for keys in (np.array([5], np.uint64), np.unique(rng.integers(0, 2 ** 64 - 1, 1000, np.uint64)),
                 np.arange(300, dtype=np.uint64) + np.uint64(2 ** 64 - 300)):
        assert (M._unpack(*M._pack(keys)) == keys).all()
    n = np.array([0, 1, 254, 255, 256, 10 ** 12])
    assert (M._large(*M._small(n)) == n).all()


def test_many_blocks_and_long_texts(monkeypatch):
    texts = [t.encode() if t is not None else None for _, t in corpus(40)]
    b = M.Block(texts, np.ones(len(texts), bool))
    assert b.sizes.tolist() == [len(tokens(t.decode() if t else t)) for t in texts]
    assert b.counts().sum() == 2 * b.sizes.sum() and (np.diff(b.keys.astype(object)) > 0).all()
