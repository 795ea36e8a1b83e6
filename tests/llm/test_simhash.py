import random
import re
from itertools import combinations

import xxhash
from pyspark.sql import Row

from clickscope.llm import simhash as S


def slow_fingerprint(text, words=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x20\x09-\x0D]+", low)
    sh = [" ".join(w[i:i + words]) for i in range(max(1, len(w) - words + 1))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def slow_components(rows, radius):
    fp = [slow_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if (fp[a] ^ fp[b]).bit_count() <= radius:
            root[find(b)] = find(a)
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(find(k), []).append(rows[k][0])
    low = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return sorted(((i, f"{f:016x}", low[find(k)]) for k, ((i, _), f) in enumerate(zip(rows, fp))), key=str)


def corpus(n, seed):
    rng = random.Random(seed)
    vocab = ["Ab", "cD", "É", "x1", "the", "of", "ß"] + [f"w{i}" for i in range(300)]
    base = [[rng.choice(vocab) for _ in range(rng.randrange(1, 400))] for _ in range(n)]
    rows = [(i, " ".join(w)) for i, w in enumerate(base)]
    for i in range(n):  # near copies
        w = list(base[i])
        if len(w) > 50:
            w[rng.randrange(len(w))] = "zzz"
        rows.append((n + i, "\n\t ".join(w)))
    odd = [None, "", " \n ", "a", "a  b", "a b", "  lead trail  ", "a\x1cb\x85c\xa0d e f", "A" * 5000, "b " * 70000]
    return rows + [(5000 + i, t) for i, t in enumerate(odd)] + [(None, "a b"), (None, "solo words only"), rows[0]]


def components(spark, rows, **kw):
    df = spark.createDataFrame([Row(doc_id=i, text=t, fp="clash", component_id="x") for i, t in rows],
                               "doc_id long, text string, fp string, component_id string")
    got = S.simhash_components(df, **kw)
    return sorted(((r[0], r[1], r[2]) for r in got.select("doc_id", S.hex16("fingerprint"), "component_id").collect()), key=str)


def test_fingerprints():
    for _, t in corpus(30, 2):
        b = None if t is None else t.encode()
        assert S.fingerprint(b) & (1 << 64) - 1 == slow_fingerprint(t)


def test_masks_cover_every_pair_within_the_radius():
    rng = random.Random(4)
    masks = [m & (1 << 64) - 1 for m in S.covering_masks(4)]
    assert len(masks) == 31
    for _ in range(3000):
        d = sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 5)))
        assert any(not d & m for m in masks)


def test_components_equal_brute_force(spark):
    rows = corpus(60, 7)
    assert components(spark, rows) == slow_components(rows, 4)


def test_large_buckets_are_dealt_in_blocks(spark, monkeypatch):
    rng = random.Random(9)
    base = rng.getrandbits(64)
    fps = {base}
    while len(fps) < 60:
        fps.add(rng.choice(sorted(fps)) ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64))
    fps |= {rng.getrandbits(64) for _ in range(20)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")

    def classes(edges):
        root = {f: f for f in signed}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x
        for a, b in edges:
            root[find(a)] = find(b)
        out = {}
        for f in signed:
            out.setdefault(find(f), set()).add(f)
        return sorted(map(sorted, out.values()))

    want = classes([(a, b) for a, b in combinations(signed, 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4])
    got = S.near_edges(df, 4, block=8).collect()
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 4 for a, b in got)
    assert classes(got) == want


def test_empty(spark):
    assert components(spark, []) == []
