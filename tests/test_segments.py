import os

import pytest
from fixtures import BATCH0, BATCH1, lines_df
from pyspark.sql import functions as F

from clickscope.sources import segments as S
from clickscope.streaming import jobs

NOW = {"availableNow": True}


def values(df):
    return sorted(r.value for r in df.collect())


def test_lines_come_back_whatever_the_ranges(spark, tmp_dir, monkeypatch):
    lines = [f"line {k} é" + "x" * (k % 37) for k in range(300)] + ["", "", "last"]
    path = os.path.join(tmp_dir, "log")
    S.append_lines(lines_df(spark, lines[:100]).repartition(5), path, "a", partitions=3)
    S.append_lines(lines_df(spark, lines[100:]).repartition(2), path, "b", partitions=3)
    assert values(S.read_lines(spark, path)) == sorted(lines)
    found = S.segments(*S.open_fs(path))
    assert len({s.partition for s in found}) == 3
    for size in (1, 7, 50, 10_000):
        for chunk in (5, 64, 1 << 20):
            monkeypatch.setattr(S, "CHUNK", chunk)
            got = [(v, o) for r in S.ranges(found, {}, S.ends(found), size) for b in S.read_range(path, r)
                   for v, o in zip(b.column(0).to_pylist(), b.column(2).to_pylist())]
            assert sorted(v for v, _ in got) == sorted(lines), (size, chunk)
    rows = S.read_lines(spark, path).collect()
    assert len({(r.log_partition, r.offset) for r in rows}) == len(lines)


def test_an_append_happens_once(spark, tmp_dir):
    path = os.path.join(tmp_dir, "log")
    assert S.read_lines(spark, path).collect() == []
    S.append_lines(lines_df(spark, BATCH0), path, "run-1")
    S.append_lines(lines_df(spark, BATCH0), path, "run-1")  # a rerun
    assert values(S.read_lines(spark, path)) == sorted(BATCH0)

    bad = lines_df(spark, BATCH1 + ["two\nlines"]).repartition(3)
    with pytest.raises(Exception, match="line end"):
        S.append_lines(bad, path, "run-2")
    listed = {s.file for s in S.segments(*S.open_fs(path))}
    assert {f"data/{n}" for n in os.listdir(os.path.join(path, "data")) if n.endswith(".log")} == listed  # nothing is left
    S.append_lines(lines_df(spark, BATCH1), path, "run-2")
    assert values(S.read_lines(spark, path)) == sorted(BATCH0 + BATCH1)
    with pytest.raises(Exception):
        lines_df(spark, BATCH0).write.format(S.FORMAT).option("path", path).option("run_id", "x").mode("overwrite").save()


def test_rows_of_a_result(spark, tmp_dir):
    path = os.path.join(tmp_dir, "rows")
    df = spark.createDataFrame([("a", 1, None), (None, 2, "x\ny")], "k string, n long, t string")
    for run in ("1", "1", "2"):
        S.append_rows(df.withColumn("run", F.lit(run)), path, run)
    got = S.read_rows(spark, path, "k string, n long, t string, run string")
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(*r, run) for run in "12" for r in df.collect()], key=str)


def city_clicks(spark, path, chk, **options):
    q = jobs.start_area_city_clicks(S.stream_lines(spark, path, **options), chk, NOW, 2)
    assert q.awaitTermination(300)
    return q


def test_a_stream_stopped_within_a_batch_reads_it_again(spark, tmp_dir):
    path, chk, out = (os.path.join(tmp_dir, n) for n in ("log", "chk", "out"))
    S.append_lines(lines_df(spark, BATCH0).repartition(2), path, "a", partitions=2)
    stop = []

    def step(batch, batch_id):
        rows = [r.value for r in batch.collect()]
        if batch_id == 1 and not stop:
            stop.append(1)
            raise RuntimeError("stopped within the batch")
        with open(f"{out}-{batch_id}", "w") as f:
            f.write("\n".join(rows))

    def run():
        return S.stream_lines(spark, path, range_bytes=20).writeStream.foreachBatch(step).option("checkpointLocation", chk).trigger(**NOW).start()

    run().awaitTermination(300)
    S.append_lines(lines_df(spark, BATCH1).repartition(2), path, "b", partitions=2)
    with pytest.raises(Exception, match="stopped within"):
        run().awaitTermination(300)
    S.append_lines(lines_df(spark, ["later x y z w"]), path, "c", partitions=2)
    for _ in range(2):  # the batch that was stopped, then what came later
        run().awaitTermination(300)
    got = [sorted(open(f"{out}-{k}").read().split("\n")) for k in range(3)]
    assert got == [sorted(BATCH0), sorted(BATCH1), ["later x y z w"]]  # batch 1 anew, with the offsets it had


def test_counts_from_the_log_and_latest_offsets(spark, tmp_dir):
    path = os.path.join(tmp_dir, "log")
    S.append_lines(lines_df(spark, BATCH0), path, "a")
    chk, late = os.path.join(tmp_dir, "chk"), os.path.join(tmp_dir, "late")
    city_clicks(spark, path, chk)
    city_clicks(spark, path, late, starting_offsets="latest")
    S.append_lines(lines_df(spark, BATCH1), path, "b")
    city_clicks(spark, path, chk)
    city_clicks(spark, path, late, starting_offsets="latest")
    assert {(r.adid, r.clicks) for r in jobs.area_city_clicks(spark, chk).collect()} == {("a1", 5), ("a2", 1)}
    assert {(r.adid, r.clicks) for r in jobs.area_city_clicks(spark, late).collect()} == {("a1", 2)}
