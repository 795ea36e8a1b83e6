import os

import pytest
from pyspark.sql import functions as F

from clickscope.operators import ads as A
from clickscope.operators import bloom as B
from clickscope.plans import inputs
from clickscope.sinks.writers import overwrite_table

SF = "/root/testdata/sf0.01"


def rows(spark, n=4000):
    return spark.range(n).select(F.when(F.col("id") % 50 != 7, F.concat(F.lit("u"), F.col("id") % 900)).alias("userid"), "id",
                                 F.lit("clash").alias("word")).repartition(3)


def nodes(plan):
    """All nodes of an executed plan, those of query stages too."""
    out = [plan]
    name = plan.nodeName()
    inner = plan.executedPlan() if name.startswith("AdaptiveSparkPlan") else plan.plan() if "QueryStage" in name else None
    kids = [inner] if inner is not None else [plan.children().apply(i) for i in range(plan.children().size())]
    for k in kids:
        out += nodes(k)
    return out


def shuffled(df):
    """Rows written by each exchange of a collected frame."""
    df.collect()
    found = [n for n in nodes(df._jdf.queryExecution().executedPlan()) if n.nodeName() == "Exchange"]
    return [n.metrics().apply("shuffleRecordsWritten").value() for n in found]


def test_equals_the_plain_anti_join(spark):
    df = rows(spark)
    listed = spark.range(0, 900, 9).select(F.concat(F.lit("u"), "id").alias("userid"))
    for some in (listed, listed.limit(0), listed.union(listed), listed.union(spark.sql("select cast(null as string)")), df.select("userid")):
        want = sorted(df.join(some, "userid", "left_anti").select(*df.columns).collect(), key=str)
        for bits in (6, 12, 22):  # 64 bits are full
            got = B.split_anti_join(df, some, "userid", bits)
            assert got.columns == df.columns and sorted(got.collect(), key=str) == want


def test_the_filter_is_bounded_and_rarely_wrong(spark):
    keys = spark.range(20000).select(F.col("id").cast("string").alias("k"))
    assert B.bloom_filter(keys, "k", 12).count() <= 1 << 6
    words = B.bloom_filter(keys, "k")
    flagged = B.with_maybe(keys, "k", words, "maybe")
    assert flagged.where("maybe").count() == 20000  # none lost
    others = spark.range(50000, 90000).select(F.col("id").cast("string").alias("k"))
    assert B.with_maybe(others, "k", words, "maybe").where("maybe").count() < 400


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_few_clicks_are_shuffled(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with a long list
    try:
        ads = inputs.ads(spark, SF).select("event_id", "userid", "dt", "adid").cache()
        listed = A.over_threshold(ads, 3).distinct().cache()
        n, hit = ads.count(), ads.join(F.broadcast(listed), "userid", "left_semi").count()
        by_filter = shuffled(B.split_anti_join(ads, listed, "userid"))
        plain = shuffled(ads.join(listed, "userid", "left_anti"))
        assert max(plain) == n and hit < n
        assert hit <= max(x for x in by_filter) <= hit + n // 100
        ads.unpersist(), listed.unpersist()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_clustered_table_skips_row_groups(spark, tmp_dir):
    df = spark.range(20000).select((F.col("id") * 7919 % 20000).alias("id")).select("id", F.format_string("2024-%05d", "id").alias("at")).repartition(4)
    read = {}
    for name, by in (("plain", None), ("clustered", ["at"])):
        table = overwrite_table(df, f"bloom_{name}", path=os.path.join(tmp_dir, name), cluster_by=by, files=8 if by else None)
        got = spark.table(table).where("at >= '2024-00100' and at < '2024-00200'")
        assert got.count() == 100
        got.collect()
        scan = [n for n in nodes(got._jdf.queryExecution().executedPlan()) if "Scan" in n.nodeName()][0]
        read[name] = scan.metrics().apply("numOutputRows").value()
    assert read["plain"] == 20000 and read["clustered"] <= 20000 // 4
