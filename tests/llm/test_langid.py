import random
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import Row

from clickscope.llm import langid as L


def slow_count(sample: bytes, text: bytes) -> int:
    at = n = 0
    while at < len(text):
        k = 1
        while at + k <= len(text) and text[at:at + k] in sample:
            k += 1
        at += max(1, k - 1)
        n += 1
    return n


def test_phrase_counts_equal_a_plain_search(monkeypatch):
    rng = random.Random(1)

    def words(alphabet, n):
        return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 5))) for _ in range(n)).encode()

    samples = {"x": words("abcd", 200), "y": words("cdéf", 150), "z": b"q"}
    texts = [b"", b"a", b"?", b"??a??", words("abcdef?", 30), words("abcd", 400), words("zq", 50), samples["x"], b"ab" * 900]
    want = np.array([[slow_count(samples[n], t) for n in "xyz"] for t in texts])
    for segment, sync, wave in ((4096, 128, 1 << 20), (32, 8, 1 << 20), (16, 16, 100), (64, 4, 300)):
        monkeypatch.setattr(L, "SEGMENT", segment)
        monkeypatch.setattr(L, "SYNC", sync)
        monkeypatch.setattr(L, "WAVE_BYTES", wave)
        assert (L.Parser(samples).counts(texts) == want).all()


def test_tables_are_built_in_little_more_than_their_own_memory():
    rng = random.Random(2)
    samples = {n: bytes(rng.choices(b"abcdefghijklmnopqrstuvwxyz ", k=4000)) for n in "wxyz"}
    tracemalloc.start()
    try:
        size = L.Parser(samples).table.nbytes
        assert tracemalloc.get_traced_memory()[1] < 4 * size
    finally:
        tracemalloc.stop()


def test_a_worker_holds_a_slice_and_releases_the_rest(monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choices("ab é", k=rng.randrange(60))) for _ in range(300)] + [None, "", "a" * 500, None]
    samples, held, released = {"x": b"abba", "y": "é a".encode()}, [], []
    whole = L.Parser(samples).predict(texts)
    predict = L.Parser.predict
    monkeypatch.setattr(L, "WAVE_BYTES", 200)
    monkeypatch.setattr(L, "ROWS", 20)
    monkeypatch.setattr(L.Parser, "predict", lambda self, some: held.append(some) or predict(self, some))
    monkeypatch.setattr(L, "release", lambda: released.append(len(held)))
    array = pa.array(["cut off", *texts])[1:]
    got = [tuple(r.values()) for x in L.predictions(iter([array[:150], array[150:150], array[150:]]), samples) for r in x.to_pylist()]
    assert got == whole and sum(held, []) == texts
    assert all(len(s) == 1 or len(s) <= 20 and sum(len((t or "").encode()) for t in s) <= 200 for s in held)
    assert released == [len(held)]


def rows():
    rng = random.Random(5)
    kinds = {"en": "the of and tion ing er".split(), "de": "ung ver sch ein ä ß".split(), "ru": "ов ст на пр".split()}
    out = []
    for i in range(240):
        k = rng.choice(list(kinds))
        out.append((i, " ".join("".join(rng.choice(kinds[k]) for _ in range(3)) for _ in range(rng.randrange(4, 60))), k))
    return out


def frame(spark, data):
    return spark.createDataFrame([Row(doc_id=i, text=t, lang=l, score="clash") for i, t, l in data],
                                 "doc_id long, text string, lang string, score string")


def test_held_out_accuracy_and_odd_rows(spark):
    from zlib import crc32
    data = rows()
    odd = [(900, None, "en"), (901, "", "en"), (902, " 12 ² ?! ", "de"), (None, data[0][1], "en"), (903, data[0][1], None), data[0]]
    got = L.identify(frame(spark, data + odd)).collect()
    assert len(got) == len(data) + len(odd)
    for r in got:
        assert r.held_out == (r.doc_id is not None and crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and (r.lang_pred == "und") == (r.doc_id in (900, 901, 902))
    held = [r for r in got if r.held_out and r.doc_id < 900]
    assert len(held) > 40 and sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held)
    truth = {t: l for _, t, l in data}
    assert all(r.lang_pred == truth[r.text] for r in got if r.doc_id is None or r.doc_id == 903)


def test_nothing_to_learn_and_empty(spark):
    data = [(1, "abc", None), (2, None, None)]
    assert {r.lang_pred for r in L.identify(frame(spark, data)).collect()} == {"und"}
    assert L.identify(frame(spark, data).limit(0)).collect() == []
