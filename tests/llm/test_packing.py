import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Row
from tokenizers import Tokenizer

from clickscope.llm import packing as K

P = pytest.importorskip("public_tokenizers")
PATH = P.path("word_bpe_49k.json")


TOKENIZER = Tokenizer.from_file(PATH)


def ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [2]


def texts(n=150, seed=2):
    rng = random.Random(seed)
    out = [" ".join(rng.choice(["the", "ab", "Wörld", "x1y2", "don't", "…"]) for _ in range(rng.choice([1, 5, 30, 90])))
           for _ in range(n)]
    return out + [None, "", " \n\t ", "<|endoftext|> a<|startoftext|>b", "a\xa0b c\x1cd", "é ́x", "ΑΣ Σ", "İx", "w" * 900, "the " * 700]


def frame(spark, rows):
    return spark.createDataFrame([Row(doc_id=i, text=t, sequence_id="clash") for i, t in rows],
                                 "doc_id long, text string, sequence_id string").repartition(3)


def check(got, rows, capacity):
    want = sorted((i, tuple(ids(t))) for i, t in rows)
    by_seq, docs = {}, {}
    for r in got:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
        docs.setdefault(r.doc_id, []).append(r)
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    for i, seq in want:
        at = 0
        for r in sorted(docs[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(seq)
            part = np.array(seq[at:at + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(part)
            at += r.length
        assert at == len(seq)
    total = sum(len(s) for _, s in want)
    return total / (len(by_seq) * capacity)


def test_every_id_is_in_one_piece_and_sequences_fit(spark):
    rows = list(enumerate(texts()))
    got = K.pack(frame(spark, rows), PATH, capacity=256, unit=4).collect()
    assert check(got, rows, 256) > 0.9


def test_ids_of_long_texts_and_small_memory(monkeypatch):
    monkeypatch.setattr(K, "CHUNK", 40)
    monkeypatch.setattr(K, "MEMO_PARTS", 5)
    monkeypatch.setattr(K, "JOINED", 3)
    own = K._Ids(PATH)
    some = texts(40) + texts(40)
    for at in range(0, len(some), 7):
        got = [x.tolist() for x in own.texts(pa.array(some[at:at + 7], pa.string()))]
        assert got == [ids(t)[:-1] for t in some[at:at + 7]]
    assert "".join(K.cut_long("añ b\tc  d".encode(), 2)) == "añ b\tc  d"


def test_ids_of_odd_strings():
    rng = random.Random(9)
    pieces = ["a", "Zb", "Ö", "ß", "É", "é", "́", "İ", "ſ", "K", "Ω", "日", "7", "²", "'s", "'LL", "'", "<|endoftext|>", "<|", "|>", "<", "***",
              "&", "_", "~", " ", "  ", "\t", "\n", "\x0b", "\x1c", "\x85", "\xa0", "\u200b", "\u2028", "\u3000", "\ufeff", "\x00", "😀", "</w>"]
    some = ["".join(rng.choice(pieces) for _ in range(rng.randrange(14))) for _ in range(6000)]
    own = K._Ids(PATH)
    got = [x.tolist() for x in own.texts(pa.array(some, pa.string()))]
    assert got == [e.ids for e in TOKENIZER.encode_batch(some, add_special_tokens=False)]
    assert [x.tolist() for x in own.texts(pa.array(some, pa.string()).slice(17, 900))] == got[17:917]



def test_repeats_null_ids_and_empty(spark):
    rows = [(None, "a b"), (None, "a b"), (5, "x y z")]
    got = K.pack(frame(spark, rows), PATH).collect()
    assert len(got) == 3 and len({(r.sequence_id, r.offset) for r in got}) == 3 and len({r.sequence_id for r in got}) == 1
    assert K.pack(frame(spark, rows).limit(0), PATH).collect() == []


def test_patterns_hold_the_demand_and_are_near_the_bound():
    rng = np.random.default_rng(1)
    for room, m, n in ((32, 20, 50), (64, 40, 3000), (16, 16, 5), (256, 120, 2000)):
        widths = np.sort(rng.choice(np.arange(1, room + 1), m, replace=False))
        demand = rng.integers(1, n, m)
        out = K.plan(widths, demand, room)
        assert (sum(c * t for c, t in out) == demand).all() and all((c * widths).sum() <= room for c, _ in out)
        cols, x = K.generate(widths, demand.astype(float), room)
        assert np.allclose(cols @ x, demand)
        # dual values of the basis, scaled to be feasible, bound the optimum
        prices = np.linalg.inv(cols.astype(float)).sum(0)
        area = (widths * demand).sum() / room
        bound = max(area, prices @ demand / max(1, K.best_pattern(np.maximum(prices, 0), widths, room)[0]))
        assert x.sum() <= bound * 1.02
        assert sum(t for _, t in out) <= x.sum() + m
    assert K.plan(np.empty(0, np.int64), np.empty(0, np.int64), 32) == []


def test_knapsack_is_optimal():
    rng = np.random.default_rng(3)
    for _ in range(30):
        widths, prices = np.sort(rng.choice(np.arange(1, 15), 5, replace=False)), rng.random(5)
        best = np.zeros(31)
        for c in range(1, 31):
            best[c] = max([best[c - 1]] + [best[c - w] + p for w, p in zip(widths, prices) if w <= c])
        value, took = K.best_pattern(prices, widths, 30)
        assert value == pytest.approx(best[30]) and (took * prices).sum() == pytest.approx(value)
        assert (took * widths).sum() <= 30
