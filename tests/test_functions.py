from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from clickscope.functions import epoch_ms_to_day, epoch_ms_to_text, jvm_split
from clickscope.functions.timefmt import epoch_ms_of


def java_split(s, sep=","):
    """Reference model of the JVM's String.split with a literal separator."""
    if s is None:
        return None
    parts = s.split(sep)
    if s == "":
        return [""]
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def _split_all(spark, values, sep=","):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    rows = df.select("i", jvm_split("s", sep).alias("a")).orderBy("i").collect()
    return [r.a for r in rows]


def test_jvm_split_fixture_cases(spark):
    # FIXTURES 4.2: list text -> ids
    cases = ["1,2,,", "", ",1", ",", "1,,2", None]
    want = [["1", "2"], [""], ["", "1"], [], ["1", "", "2"], None]
    assert _split_all(spark, cases) == want


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="12,x ", max_size=8), min_size=1, max_size=12))
def test_jvm_split_matches_java_model(spark, values):
    assert _split_all(spark, values) == [java_split(v) for v in values]


def test_jvm_split_space_separator(spark):
    got = _split_all(spark, ["a b c d e", "a b c d ", "a  b"], " ")
    assert got == [["a", "b", "c", "d", "e"], ["a", "b", "c", "d"], ["a", "", "b"]]


def test_epoch_helpers_ignore_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        r = spark.range(1).select(
            epoch_ms_to_text(F.lit(1577836799999)).alias("t"),
            epoch_ms_to_day(F.lit(1577836799999)).alias("d"),
            epoch_ms_to_day(F.lit(-1)).alias("neg"),
            epoch_ms_of(F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00.0005'")).alias("half"),
            epoch_ms_of(F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00.0004'")).alias("low"),
            epoch_ms_of(F.expr("TIMESTAMP_NTZ'1969-12-31 23:59:59.9995'")).alias("negh"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r.t == "2019-12-31 23:59:59"
    assert r.d == "2019-12-31"
    assert r.neg == "1969-12-31"
    assert r.half == 1704067200001 and r.low == 1704067200000 and r.negh == -1
