import os
import re
import time

import pytest
from fixtures import BATCH0, BATCH1, T0, lines_df

from clickscope.operators import ads as A
from clickscope.sources.adlog import ad_log_parse, read_ad_log_files
from clickscope.streaming import jobs, state
from clickscope.streaming.counters import Counters
from clickscope.streaming.latest import Latest

NOW = {"availableNow": True}
KEYS = ["dt", "province", "city", "adid"]


def put(folder, *batches):
    """Each batch as a file, in their order behind what the folder holds."""
    os.makedirs(folder, exist_ok=True)
    first = len(os.listdir(folder))
    for i, batch in enumerate(batches, first):
        path = os.path.join(folder, f"part-{i}.txt")
        with open(path, "w") as f:
            f.write("\n".join(batch) + "\n")
        os.utime(path, (time.time() - 1000 + i * 10,) * 2)
    return folder


def finished(query):
    assert query.awaitTermination(300) and query.exception() is None
    return query


def stream(spark, folder):
    return read_ad_log_files(spark, folder, max_files_per_trigger=1)


def clicks(n, user="u1", ad="a1", area="A"):
    return [f"{T0 + k} {area} x {user} {ad}" for k in range(n)]


# ---------------------------------------------------------------- blacklist

def test_blacklist_counts_until_the_ban(spark, tmp_dir):
    src, chk = put(os.path.join(tmp_dir, "in"), BATCH0, BATCH1), os.path.join(tmp_dir, "chk")
    q = finished(jobs.start_blacklist(stream(spark, src), chk, 3, NOW, 2))
    assert q.lastProgress["batchId"] == 1
    assert [r.userid for r in state.banned_users(spark, chk).collect()] == ["u1"]
    want = {("a1", "u1", 3), ("a2", "u1", 1), ("a1", "u2", 1)}
    assert {(r.adid, r.userid, r.clicks) for r in state.user_clicks(spark, chk).collect()} == want


def test_blacklist_does_not_depend_on_cuts(spark, tmp_dir):
    lines = BATCH0 + BATCH1 + [x.replace("u1", "u3") for x in BATCH0]
    for n, cut in enumerate([[lines], [lines[:3], lines[3:]], [lines[k::4] for k in range(4)]]):
        src, chk = put(os.path.join(tmp_dir, f"in{n}"), *cut), os.path.join(tmp_dir, f"chk{n}")
        finished(jobs.start_blacklist(stream(spark, src), chk, 3, NOW, 2))
        assert sorted(r.userid for r in state.banned_users(spark, chk).collect()) == ["u1", "u3"]


def test_blacklist_restart_replay_and_new_checkpoint(spark, tmp_dir):
    src, chk = put(os.path.join(tmp_dir, "in"), clicks(2), clicks(1, "u2")), os.path.join(tmp_dir, "chk")
    finished(jobs.start_blacklist(stream(spark, src), chk, 3, NOW, 2))
    # the last micro-batch is replayed: its commit record is gone, as after a crash before it was written
    commits = os.path.join(chk, "commits")
    last = max((x for x in os.listdir(commits) if x.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        if os.path.exists(os.path.join(commits, name)):
            os.remove(os.path.join(commits, name))
    put(src, clicks(1, "u2"))
    finished(jobs.start_blacklist(stream(spark, src), chk, 3, NOW, 2))
    got = {(r.userid, r.clicks) for r in state.user_clicks(spark, chk).collect()}
    assert got == {("u1", 2), ("u2", 2)} and state.banned_users(spark, chk).count() == 0
    # a new checkpoint goes on from the state of the old one
    new, more = os.path.join(tmp_dir, "chk-new"), put(os.path.join(tmp_dir, "more"), clicks(1), clicks(5, "u4") + clicks(1))
    finished(jobs.start_blacklist(stream(spark, more), new, 3, NOW, 2, earlier=chk))
    assert sorted(r.userid for r in state.banned_users(spark, new).collect()) == ["u1", "u4"]
    assert {(r.userid, r.clicks) for r in state.user_clicks(spark, new).collect()} == {("u1", 3), ("u2", 2), ("u4", 5)}


def test_a_hot_user_sends_few_rows(spark):
    many = lines_df(spark, clicks(900) + clicks(3, "u2")).coalesce(1)
    few = state.combined(jobs.parsed_clicks(many), ["dt", "adid", "userid"]).collect()
    assert sorted((r.userid, r.clicks) for r in few) == [("u1", 900), ("u2", 3)]


# ---------------------------------------------------------------- counts

def test_counts_are_read_from_the_state_store(spark, tmp_dir):
    src, chk = put(os.path.join(tmp_dir, "in"), BATCH0, BATCH1), os.path.join(tmp_dir, "chk")
    finished(jobs.start_area_city_clicks(stream(spark, src), chk, NOW, 2))
    got = jobs.area_city_clicks(spark, chk)
    assert got.columns == [*KEYS, "clicks"]
    assert {(r.adid, r.clicks) for r in got.collect()} == {("a1", 5), ("a2", 1)}


def test_a_new_checkpoint_loses_no_count(spark, tmp_dir):
    """Three clicks, then one under a new checkpoint: 4, not 1."""
    one, two = put(os.path.join(tmp_dir, "a"), clicks(3)), put(os.path.join(tmp_dir, "b"), clicks(1))
    chks = [os.path.join(tmp_dir, f"chk{k}") for k in range(2)]
    for src, chk in zip((one, two), chks):
        finished(jobs.start_area_city_clicks(stream(spark, src), chk, NOW, 2))
    assert [r.clicks for r in jobs.area_city_clicks(spark, chks).collect()] == [4]

    table = Counters(spark, os.path.join(tmp_dir, "incr"), KEYS, buckets=4)
    for k, src in enumerate((one, two)):
        finished(jobs.start_area_city_clicks_incr(stream(spark, src), table, os.path.join(tmp_dir, f"i{k}"), NOW))
    assert [r.clicks for r in table.totals().collect()] == [4]

    top = Latest(spark, os.path.join(tmp_dir, "top"), jobs.TOP_SCHEMA)
    tops = [os.path.join(tmp_dir, f"t{k}") for k in range(2)]
    finished(jobs.start_area_top3(stream(spark, one), top, tops[0], 3, NOW, 2))
    assert [r.clicks for r in top.read().collect()] == [3]
    q = jobs.start_area_top3(stream(spark, two), top, tops[1], 3, NOW, 2)
    with pytest.raises(Exception, match="another checkpoint"):
        q.awaitTermination(300)
    new = os.path.join(tmp_dir, "t2")
    finished(jobs.start_area_top3(stream(spark, two), top, new, 3, NOW, 2, earlier=[tops[0]]))
    assert [r.clicks for r in top.read().collect()] == [4]


# ---------------------------------------------------------------- counters in place

def rows(spark, *counts):
    return spark.createDataFrame([("d", "A", "x", ad, n) for ad, n in counts], "dt string, province string, city string, adid string, clicks long")


def test_counters_replay_runs_and_folds(spark, tmp_dir):
    path = os.path.join(tmp_dir, "c")
    t = Counters(spark, path, KEYS, buckets=4)
    read = lambda t: {r.adid: r.clicks for r in t.totals().collect()}
    assert read(t) == {}
    t.add("r1", 0, rows(spark, ("a", 1), ("b", 2)))
    t.add("r1", 1, rows(spark, ("a", 5)))
    t.add("r1", 1, rows(spark, ("a", 5)))  # replay
    t.add("r2", 0, rows(spark, ("a", 10)))
    assert read(t) == {"a": 16, "b": 2}
    for n in range(2, 8):
        t.add("r1", n, rows(spark, ("a", 1), (f"x{n}", n)))
        if n % 2:
            t.fold("r1", n - 1)
            t.fold("r1", n - 1)  # replay
            t.add("r1", n, rows(spark, ("a", 1), (f"x{n}", n)))
    want = {"a": 22, "b": 2, **{f"x{n}": n for n in range(2, 8)}}
    assert read(t) == want
    kinds = sorted((r, k, int(n)) for r, k, n in t._parts())
    assert ("r1", "fold", 6) in kinds and ("r1", "batch", 1) not in kinds and ("r2", "batch", 0) in kinds
    # another session finds what is stored; a fold that may be unfinished is made anew
    spark.sql(f"DROP TABLE {t.name}")
    again = Counters(spark, path, KEYS, buckets=4)
    assert read(again) == want
    again.add("r1", 7, rows(spark, ("a", 1), ("x7", 7)))
    assert ("r1", "fold", "6") not in again._parts() and read(again) == want
    only = rows(spark, ("x3", 0), ("none", 0))
    assert {r.adid: r.clicks for r in again.totals(only).collect()} == {"x3": 3}


def test_counters_are_summed_and_joined_without_shuffling_them(spark, tmp_dir):
    t = Counters(spark, os.path.join(tmp_dir, "c"), KEYS, buckets=4)
    for n in range(3):
        t.add("r", n, rows(spark, ("a", 1), ("b", 2)))
    t.fold("r", 1)
    plan = t.totals()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    plan = t.totals(rows(spark, ("a", 0)))._jdf.queryExecution().executedPlan().toString()
    above = plan.splitlines()
    scan = next(i for i, x in enumerate(above) if "clickscope_counters" in x)
    depth = lambda x: len(re.match(r"[ :+\-]*", x)[0])
    at, parents = depth(above[scan]), []
    for x in reversed(above[:scan]):
        if depth(x) < at:
            at = depth(x)
            parents.append(x)
    assert not [x for x in parents if "Exchange" in x] and plan.count("Exchange hashpartitioning") >= 1


# ---------------------------------------------------------------- top ads

def test_merged_top_equals_the_full_ranking(spark):
    import random
    rng, counts = random.Random(4), {}
    stored = spark.createDataFrame([], jobs.TOP_SCHEMA)
    for _ in range(6):
        changed = set()
        for _ in range(40):
            k = (rng.choice(["d1", "d2", None]), rng.choice("AB"), rng.choice("abcdefgh"))
            counts[k] = counts.get(k, 0) + rng.randrange(1, 4)
            changed.add(k)
        new = spark.createDataFrame([(*k, counts[k]) for k in changed], "dt string, province string, adid string, clicks long")
        again = jobs.merged_top(jobs.merged_top(stored, new, 3), new, 3)  # a replay
        stored = spark.createDataFrame(again.collect(), jobs.TOP_SCHEMA)
        want = []
        for g in {k[:2] for k in counts}:
            best = sorted((-n, k[2]) for k, n in counts.items() if k[:2] == g)[:3]
            want += [(*g, ad, -n, i) for i, (n, ad) in enumerate(best, 1)]
        assert sorted(map(tuple, stored.collect()), key=str) == sorted(want, key=str)


def test_top3_reads_no_other_counts_of_a_group(spark, tmp_dir):
    top = Latest(spark, os.path.join(tmp_dir, "t"), jobs.TOP_SCHEMA)
    b0 = A.ad_area_clicks(A.with_day(ad_log_parse(lines_df(spark, BATCH0))))
    b1 = A.ad_area_clicks(A.with_day(ad_log_parse(lines_df(spark, BATCH0 + BATCH1)))).where("adid = 'a1'")
    for b in (b0, b1, b1):
        jobs.top3_step(b, top, 3, "run")
    assert [r.value_json for r in jobs.top3_json(top).collect()] == ['{"a1":5,"a2":1}']
    assert len([x for x in os.listdir(top.path) if x.startswith("version=")]) == 2 and top.writer() == "run"
    plan = jobs.merged_top(top.read(), b1, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("WindowGroupLimit") == 2


def test_top3_stream_equals_batch_for_any_cut(spark, tmp_dir):
    """Same log lines cut into 1, 3 and 5 files: the stream's final top-3 JSON
    equals the batch query every time."""
    from clickscope.plans import inputs
    from clickscope.sources.adapters import ad_log_lines
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("test tables not present")
    ads = inputs.ads(spark, sf)
    want = sorted(tuple(r) for r in A.ad_area_top3_json(A.ad_area_top3(A.ad_area_clicks(ads))).collect())
    for n in (1, 3, 5):
        root = os.path.join(tmp_dir, f"cut{n}")
        ad_log_lines(ads.repartitionByRange(n, "ts_ms", "event_id")).write.text(os.path.join(root, "in"))
        top = Latest(spark, os.path.join(root, "top"), jobs.TOP_SCHEMA)
        finished(jobs.start_area_top3(stream(spark, os.path.join(root, "in")), top, os.path.join(root, "chk"), 3, NOW, 4))
        assert sorted(tuple(r) for r in jobs.top3_json(top).collect()) == want, n


# ---------------------------------------------------------------- log, sources, preview

def test_parsed_log_once_and_one_checkpoint(spark, tmp_dir):
    src, chk, out = put(os.path.join(tmp_dir, "in"), BATCH0), os.path.join(tmp_dir, "chk"), os.path.join(tmp_dir, "out")
    finished(jobs.start_ad_log_parse(stream(spark, src), out, chk, NOW))
    put(src, BATCH1)
    finished(jobs.start_ad_log_parse(stream(spark, src), out, chk, NOW))
    got = jobs.parsed_log(spark, out)
    assert got.columns == jobs.AD_COLS and got.count() == 6
    assert [r.line for r in jobs.parsed_log(spark, out, ok=False).collect()] == ["short line"]
    with pytest.raises(ValueError, match="another checkpoint"):
        jobs.start_ad_log_parse(stream(spark, src), out, chk + "-new", NOW)


def test_kafka_reader_is_configured(spark):
    """No Kafka connector or broker here: check the reader fails only for the
    missing connector, after taking the topic and offsets options."""
    from clickscope.sources.adlog import read_ad_log_kafka
    with pytest.raises(Exception) as err:
        read_ad_log_kafka(spark, "broker:9092", starting_offsets="earliest")
    assert "kafka" in str(err.value).lower()


def test_settings_are_restored(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with jobs._settings(spark, {"spark.sql.shuffle.partitions": "3", **state.ROCKSDB}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before and "HDFS" in spark.conf.get(list(state.ROCKSDB)[0], "HDFS")


def test_console_preview_runs(spark, tmp_dir):
    src = put(os.path.join(tmp_dir, "in"), BATCH0)
    q = finished(jobs.start_console_preview(jobs.parsed_clicks(read_ad_log_files(spark, src)), os.path.join(tmp_dir, "chk"),
                                            rows=3, trigger=NOW))
    assert q.lastProgress["numInputRows"] == 5
