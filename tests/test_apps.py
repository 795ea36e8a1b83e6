import os

from fixtures import BATCH0, BATCH1, visits_df

from clickscope import apps
from clickscope.sources.adlog import read_ad_log_files


def test_batch_apps(spark, tmp_dir):
    path = os.path.join(tmp_dir, "uva")
    visits_df(spark).write.partitionBy("date").parquet(path)
    v, bad = apps.load_visits(spark, path, start="2019-01-01 00:00:00", end="2019-01-01 23:59:59", date_col="date")
    assert apps.write_quarantine(bad, os.path.join(tmp_dir, "bad")) == 0
    tid = apps.new_task_id()
    top = apps.category_top10_app(v, tid).collect()
    assert top[0].task_id == tid and top[0].category_id == "1"
    s = apps.category_session_top10_app(v, tid)
    assert s.columns == ["task_id", "category_id", "session_id", "click_count"] and s.count() == 3
    assert {r.page_flow for r in apps.page_flow_app(v, "1,2,3", "event_id").collect()} == {"1-2", "2-3"}


def test_stream_app_blacklist(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("\n".join(BATCH0 + BATCH1) + "\n")
    root = os.path.join(tmp_dir, "root")
    q = apps.start_stream_app(spark, "blacklist", read_ad_log_files(spark, src), root, threshold=3,
                              trigger={"availableNow": True})
    q.awaitTermination(300)
    got = apps.stream_results(spark, "blacklist", root)
    assert [r.userid for r in got["blacklist"].collect()] == ["u1"]
    assert {(r.adid, r.userid, r.clicks) for r in got["user_ad_day"].collect()} == {("a1", "u1", 4), ("a2", "u1", 1), ("a1", "u2", 1)}


def test_cli_writes_whole_results_and_the_quarantine(spark, tmp_dir, capsys):
    from clickscope.schemas import VISIT_ACTION
    cols = [f"{f.name} string" if f.name == "user_id" else f"{f.name} {f.dataType.simpleString()}" for f in VISIT_ACTION]
    rows = [("2019-01-01", u, "s", p, f"2019-01-01 00:{p // 60:02}:{p % 60:02}", None, -1, -1, None, None, None, None, 1)
            for p, u in [(k, "7") for k in range(1, 131)]] + [("2019-01-01", "no number", "s", None, "x", None, -1, -1, "7,8", None, None, None, 1)]
    path, out = os.path.join(tmp_dir, "visits.parquet"), os.path.join(tmp_dir, "out")
    spark.createDataFrame(rows, ", ".join(cols)).write.parquet(path)
    apps.main(["page-flow", "--table", path, "--path", ",".join(map(str, range(1, 131))), "--out", out])
    assert spark.read.parquet(out).count() == 129
    bad = spark.read.parquet(out + "-quarantine").collect()
    assert [(r.user_id, r.order_category_ids) for r in bad] == [("no number", "7,8")]
    assert "1 rows" in capsys.readouterr().out


def test_cli_main_on_test_tables(spark, tmp_dir, capsys):
    import pytest
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("test tables not present")
    out = os.path.join(tmp_dir, "rates")
    apps.main(["page-flow", "--testdata", sf, "--tie-col", "event_id", "--out", out])
    assert out in capsys.readouterr().out
    assert "1-2" in {r.page_flow for r in spark.read.parquet(out).collect()}


def test_jdbc_sink_argument_level(spark):
    """No database may be started here: check the writer reaches the JDBC
    driver lookup with the right options and fails cleanly without one."""
    import pytest
    from clickscope.sinks import append_jdbc
    df = spark.createDataFrame([("t", "1", 1, 2, 3)], "task_id string, category_id string, "
                               "click_count long, order_count long, pay_count long")
    with pytest.raises(Exception) as err:
        append_jdbc(df, "jdbc:nosuchdb://nowhere/mall", "category_top10", user="u", password="p",
                    num_partitions=1)
    assert "driver" in str(err.value).lower()


def test_other_stream_apps(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("\n".join(BATCH0 + BATCH1) + "\n")
    root = os.path.join(tmp_dir, "root")
    for name in ("area-city-clicks", "area-city-clicks-incr", "area-top3"):
        q = apps.start_stream_app(spark, name, read_ad_log_files(spark, src), root,
                                  trigger={"availableNow": True}, state_partitions=2)
        assert q.awaitTermination(300) and q.exception() is None
    want = {("a1", 5), ("a2", 1)}
    for name in ("area-city-clicks", "area-city-clicks-incr"):
        got = apps.stream_results(spark, name, root)["area_city"]
        assert {(r.adid, r.clicks) for r in got.collect()} == want
    assert [r.value_json for r in apps.stream_results(spark, "area-top3", root)["json"].collect()] == ['{"a1":5,"a2":1}']
