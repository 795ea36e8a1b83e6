"""Physical-plan shape: the strategies the operators are designed around."""

import os

from fixtures import visits_df

from clickscope.operators import ads as A
from clickscope.operators import category as C
from clickscope.sources.adlog import ad_log_parse
from clickscope.sources.tables import visits_in_range


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top10_is_take_ordered_and_broadcast_semi(spark):
    v = visits_df(spark)
    assert "TakeOrderedAndProject" in _plan(C.category_top10(v))
    p = _plan(C.category_session_top10(v))
    assert "LeftSemi" in p and "BroadcastHashJoin" in p
    assert "WindowGroupLimit" in p and "Partial" in p


def test_admitted_clicks_ranks_only_groups_over_the_threshold(spark):
    from fixtures import BATCH0, lines_df
    ads = ad_log_parse(lines_df(spark, BATCH0))
    p = _plan(A.ad_admitted_clicks(ads.withColumn("event_id", ads.ts_ms), 3))
    assert "LeftSemi" in p[p.index("WindowGroupLimit"):]


def test_scan_prunes_columns_and_pushes_bounds(spark, tmp_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    path = os.path.join(tmp_dir, "uva")
    visits_df(spark).write.parquet(path)
    v = spark.read.parquet(path)
    df = visits_in_range(v, "2019-01-01 10:00:01", "2019-01-01 10:02:00").select("session_id")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(action_time" in p and "LessThanOrEqual(action_time" in p
    assert "ReadSchema: struct<session_id:string,action_time:string>" in p


def test_date_partition_pruning(spark, tmp_dir):
    path = os.path.join(tmp_dir, "uva_by_date")
    visits_df(spark).unionByName(visits_df(spark, date="2019-01-02")).write.partitionBy("date").parquet(path)
    v = spark.read.parquet(path)
    df = visits_in_range(v, "2019-01-02 00:00:00", None, date_col="date")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in p and df.count() == 11


def _hot_user_ads(spark, n=30000):
    from pyspark.sql import functions as F
    return spark.range(n).select(
        F.col("id").alias("event_id"), (F.lit(1546300800000) + F.col("id")).alias("ts_ms"),
        F.lit("2019-01-01").alias("dt"), F.lit("A").alias("province"), F.lit("x").alias("city"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 20000).cast("string")).alias("userid"),
        F.when(F.col("id") % 3 == 0, F.lit("1")).otherwise((F.col("id") % 6).cast("string")).alias("adid"))


def test_hot_user_joins_are_split_by_aqe(spark):
    """One user with a third of all clicks: with broadcast off, AQE splits
    the hot partition of the anti join and of the admitted-clicks join."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        ads = _hot_user_ads(spark)
        filtered = A.ad_log_filtered(ads, 3)
        assert filtered.count() == 20000
        filtered.collect()
        assert "skew=true" in _plan(filtered)
        admitted = A.ad_admitted_clicks(ads, 3)
        got = {(r.adid, r.userid): r.clicks for r in admitted.collect()}
        assert got[("1", "hot")] == 3 and len(got) == 20001
        assert "skew=true" in _plan(admitted)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_shared_dir_reads_session_setting(spark):
    from clickscope.session import scratch_path, shared_dir
    root = shared_dir(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root)


def test_shared_dir_must_be_named_on_a_cluster():
    import pytest
    from types import SimpleNamespace
    from clickscope.session import shared_dir
    conf = SimpleNamespace(get=lambda key, default=None: None)
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master)))


def test_time_range_reaches_the_scan(spark):
    from clickscope.plans import all_queries
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        return
    plan = all_queries()["visits_in_range"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-05" in plan and "LessThan(ts,2024-01-07" in plan, plan


def test_no_round_robin_and_no_tie_column_needed(spark):
    from clickscope.operators import pageflow as P
    from clickscope.schemas import VISIT_ACTION
    rows = [("2019-01-01", 1, "s", page, t, None, -1, -1, None, None, None, None, 1)
            for page, t in ((3, "2019-01-01 00:00:02"), (1, "2019-01-01 00:00:01"), (2, "2019-01-01 00:00:01"),
                            (1, "2019-01-01 00:00:01"), (3, "2019-01-01 00:01:01"))]
    v = spark.createDataFrame(rows, VISIT_ACTION)  # exactly the 13 columns
    want = [("s", 1, 1), ("s", 1, 2), ("s", 2, 3), ("s", 3, 3)]
    for split in (None, 1):
        got = P.page_transitions(v.repartition(3), tie_split=split)
        assert sorted(tuple(r) for r in got.collect()) == want
    assert {r.page_flow: r.rate for r in P.page_flow_rate(v, "1,2,3").collect()} == {"1-2": 0.5, "2-3": 1.0}


def test_conform_keeps_column_pruning(spark, tmp_dir):
    from clickscope.sources.tables import conform_visits
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    path = os.path.join(tmp_dir, "uva_prune")
    visits_df(spark).write.parquet(path)
    good, _ = conform_visits(spark.read.parquet(path), C.REQUIRED)
    p = C.category_counts(good)._jdf.queryExecution().executedPlan().toString()
    schema = p[p.index("ReadSchema: ") + len("ReadSchema: "):].split("\n")[0]
    assert "click_category_id" in schema and "order_category_ids" in schema
    assert "session_id" not in schema and "action_time" not in schema
    assert "IsNotNull(click_category_id)" in p
