from fixtures import BATCH0, BATCH1, lines_df

from clickscope.operators import ads as A
from clickscope.sources.adlog import ad_log_parse, ad_log_rejects


def _ads(spark):
    lines = lines_df(spark, BATCH0 + BATCH1)
    return ad_log_parse(lines), lines


def test_parse_and_reject(spark):
    ads, lines = _ads(spark)
    assert ads.count() == 6
    assert [r.line for r in ad_log_rejects(lines).collect()] == ["short line"]
    extra = lines_df(spark, ["1 A x u a extra", "nan A x u a", "1 A x u "])
    assert ad_log_parse(extra).count() == 1 and ad_log_rejects(extra).count() == 2


def test_blacklist_and_counts(spark):
    ads, _ = _ads(spark)
    assert [r.userid for r in A.ad_blacklist(ads, 3).collect()] == ["u1"]
    area = {(r.province, r.city, r.adid): r.clicks for r in A.ad_area_city_clicks(ads).collect()}
    assert area == {("A", "x", "a1"): 5, ("A", "x", "a2"): 1}
    assert A.ad_log_filtered(ads, 3).count() == 1
    assert A.ad_log_filtered(ads, blacklist=A.ad_blacklist(ads, 3)).count() == 1


def test_admitted_clicks_per_event(spark):
    ads, _ = _ads(spark)
    ads = ads.withColumn("event_id", ads.ts_ms)
    got = {(r.adid, r.userid): r.clicks for r in A.ad_admitted_clicks(ads, 3).collect()}
    assert got == {("a1", "u1"): 3, ("a1", "u2"): 1}


def test_top3_json(spark):
    ads, _ = _ads(spark)
    rows = A.ad_area_top3_json(A.ad_area_top3(A.ad_area_clicks(ads))).collect()
    assert [tuple(r) for r in rows] == [("top3_ads_per_day:2019-01-01", "A", '{"a1":5,"a2":1}')]


def test_rollup_sums_match(spark):
    ads, _ = _ads(spark)
    by_city = A.ad_area_city_clicks(ads)
    a = sorted(tuple(r) for r in A.ad_area_clicks(area_city=by_city).collect())
    b = sorted(tuple(r) for r in A.ad_area_clicks(ads).collect())
    assert a == b


def test_top3_orders_by_clicks_then_ad_text(spark):
    lines = [f"1 A x u{i} {ad}" for i, ad in enumerate(["9"] * 3 + ["10"] * 2 + ["1"] * 2 + ["2"])]
    ads = ad_log_parse(lines_df(spark, lines))
    top = A.ad_area_top3(A.ad_area_clicks(ads)).orderBy("rn").collect()
    assert [(r.adid, r.clicks) for r in top] == [("9", 3), ("1", 2), ("10", 2)]
    js = A.ad_area_top3_json(A.ad_area_top3(A.ad_area_clicks(ads))).first().value_json
    assert js == '{"9":3,"1":2,"10":2}'
