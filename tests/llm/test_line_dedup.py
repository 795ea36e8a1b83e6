import random

from pyspark.sql import Row, functions as F

from clickscope.llm import line_dedup as L


BLANKS = " \t\n\r\x0b\f"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def brute(rows, edits, least):
    """Line numbers dropped, by row (ids distinct)."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0]))
    first, near = {}, {}
    for i, t in order:
        for k, line in enumerate((t or "").split("\n") if t is not None else []):
            first.setdefault(line, (i is not None, i or 0, k))
    lines = [x for x in first if x.strip(BLANKS) and len(x) >= least]
    for x in lines:
        near[x] = any(first[y] < first[x] and abs(len(x) - len(y)) <= edits and distance(x, y) <= edits
                      for y in lines if y != x)
    out = {}
    for i, t in rows:
        got = [[], []]
        for k, line in enumerate(t.split("\n") if t is not None else []):
            if line.strip(BLANKS):
                if first[line] != (i is not None, i or 0, k):
                    got[0].append(k)
                elif near.get(line):
                    got[1].append(k)
        out[i] = got
    return out


def mutate(rng, s, n):
    s = list(s)
    for _ in range(n):
        at, kind = rng.randrange(len(s) or 1), rng.randrange(3)
        s[at:at + (kind != 0)] = [rng.choice("abcdé ")] if kind < 2 else []
    return "".join(s)


def corpus(seed, n=60, alphabet="abcd é"):
    rng = random.Random(seed)
    base = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 30))) for _ in range(40)]
    rows = []
    for i in range(n):
        lines = [mutate(rng, rng.choice(base), rng.randrange(5)) if rng.random() < 0.6 else rng.choice(base)
                 for _ in range(rng.randrange(0, 8))]
        rows.append((i, "\n".join(x + " " * (rng.random() < 0.05) for x in lines)))
    return rows + [(900, None), (901, ""), (902, "\n\n"), (903, " \n x"), (905, "\t\r\n\r\n\t\n\x0b\f\r\n\r"), (906, "a\r\n\r\nb\r\n\r\na\r"), (None, base[0] + "\n" + base[1]), (904, "y" * 3000)]


def frame(spark, rows):
    return spark.createDataFrame([Row(doc_id=i, text=t, d="clash", n_near="x") for i, t in rows],
                                 "doc_id long, text string, d string, n_near string").repartition(3)


def compare(spark, rows, edits, least, hot):
    got = L.dedup_lines(frame(spark, rows), edits=edits, min_chars=least, hot=hot).collect()
    want = brute(rows, edits, least)
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        exact, near = want[r.doc_id]
        assert (r.n_exact, r.n_near, sorted(r.dropped)) == (len(exact), len(near), sorted(exact + near)), r
        t = texts[r.doc_id]
        kept = None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in exact + near)
        assert r.text == kept and r.n_lines == (0 if t is None else len(t.split("\n")))
    return sum(len(n) for _, n in want.values())


def test_equals_brute_force(spark):
    assert compare(spark, corpus(1), 2, 5, 32) > 10


def test_other_thresholds_and_hot_keys(spark):
    assert compare(spark, corpus(2, 40), 1, 4, 1) > 3  # every shared key is hot


def test_verification_equals_the_plain_distance(spark):
    rng = random.Random(5)
    pairs = []
    for _ in range(250):
        a = "".join(rng.choice("abé") for _ in range(rng.randrange(0, 14)))
        pairs.append((a, mutate(rng, a, rng.randrange(5)) if a and rng.random() < 0.7 else
                      "".join(rng.choice("abé") for _ in range(rng.randrange(0, 14)))))
    for _ in range(250):  # long enough to be given up early, edits at both ends
        a = "".join(rng.choice("abcdé ") for _ in range(rng.randrange(15, 70)))
        pairs.append((a, rng.choice("abx") + mutate(rng, a, rng.randrange(4))[rng.randrange(2):] + rng.choice(["", "y"])))
    df = spark.createDataFrame(pairs, "a string, b string")
    for k in (1, 2, 3):
        for r in df.select("a", "b", L.near(F.col("a"), F.col("b"), k).alias("n"),
                           L.may_be_near(F.col("a"), F.col("b"), k).alias("m")).collect():
            within = distance(r.a, r.b) <= k
            assert r.n == within and (r.m or not within), r


def test_keys_are_those_of_characters_and_ascii_lines_are_cut_by_bytes(spark):
    rng = random.Random(7)
    lines = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(3, 40))) for alphabet in ("abc ", "abé ", "日本𝄞a") for _ in range(30)]
    df = spark.createDataFrame([(i, 0, x, len(x)) for i, x in enumerate(lines)], "h long, d long, line string, n int")
    for keys, places in ((L.index_keys, [(0, i, 0) for i in range(3)]),
                         (L.probe_keys, [(0, 1, -1), (0, 1, 1), (1, 0, 0), (1, 1, 0), (1, 1, 1), (1, 2, 1), (2, 0, 0), (2, 1, 1), (2, 2, 2)])):
        pieces = []
        for h, x in enumerate(lines):
            for less, i, shift in places:
                m = len(x) - less
                cuts = [0]
                for j in range(3):
                    cuts.append(cuts[-1] + m // 3 + (j >= 3 - m % 3))
                a, b = cuts[i] + shift, cuts[i + 1] + shift
                if m >= 5 and a >= 0 and b <= len(x):
                    pieces.append((h, m, i, x[a:b]))
        want = spark.createDataFrame(pieces, "h long, other int, i int, piece string").select("h", F.xxhash64("other", "i", "piece").alias("key"))
        got = keys(df, 2, 5)
        assert sorted(got.select("h", "key").collect()) == sorted(want.collect())
        assert "cast(line" in got._jdf.queryExecution().optimizedPlan().toString()  # ASCII lines: cut by bytes


def test_white_space_is_told_from_the_left_only(spark):
    lines = ["", " ", "\t\r \x0b\f", " x", "x ", "é\t", "\u00a0", "\u2003 "]
    df = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(lines))], "doc_id long, text string")
    got = L.line_decisions(df, min_chars=5)
    assert [(r.d, r.dropped) for r in got.collect()] == [(2, [3, 4, 5, 6, 7])]


def test_repeated_rows_and_empty(spark):
    rows = [(1, "same line here\nother"), (1, "same line here\nother"), (2, "same line here")]
    got = {(r.doc_id, r.text): r.n_exact for r in L.dedup_lines(frame(spark, rows)).collect()}
    assert got == {(1, "same line here\nother"): 0, (2, ""): 1}
    assert L.dedup_lines(frame(spark, rows).limit(0)).collect() == []
