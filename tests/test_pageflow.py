import random

from pyspark.sql import Window, functions as F

from fixtures import visits_df

from clickscope.operators import pageflow as P


def test_page_views_and_rates_fixture(spark):
    v = visits_df(spark)
    views = {r.page_id: r.page_views for r in P.page_views_in_flow(v, "1,2,3").collect()}
    assert views == {1: 3, 2: 4, 3: 3}
    rates = {r.page_flow: (r.jumps, r.page_views, r.rate) for r in P.page_flow_rate(v, "1,2,3", "event_id").collect()}
    assert rates == {"1-2": (1, 3, 1 / 3), "2-3": (2, 4, 2 / 4)}


def test_page_outside_path_breaks_step(spark):
    v = visits_df(spark)
    pairs = {(r.session_id, r.a, r.b) for r in P.page_transitions(v, "event_id").collect()}
    assert ("s4", 1, 9) in pairs and ("s4", 9, 2) in pairs and ("s4", 1, 2) not in pairs


def test_path_parsing():
    assert P.path_pairs("1,2,1,2") == [(1, 2), (2, 1)]
    assert P.path_pairs("5") == []
    assert P.path_pairs("01,2,3") == [(2, 3)]  # '01' never equals a page id's text
    assert P.path_pages([3, 1, 2]) == [1, 2, 3]


def test_one_page_path_gives_no_rows(spark):
    assert P.page_flow_rate(visits_df(spark), "1").count() == 0


def test_bucket_stitching_equals_plain_lead(spark):
    """Sessions spanning many minute buckets (and empty ones) give the same
    pairs as one lead window over the whole session."""
    rnd = random.Random(7)
    rows, eid = [], 0
    for s in range(6):
        t = rnd.randint(0, 3000)
        for _ in range(rnd.randint(1, 80)):
            t += rnd.choice([0, 0, 1, 5, 30, 59, 61, 300, 3600])
            eid += 1
            hh, mm, ss = (t // 3600) % 24, (t // 60) % 60, t % 60
            rows.append((eid, f"s{s}", rnd.randint(1, 5), f"{hh:02d}:{mm:02d}:{ss:02d}", -1, None, None))
    v = visits_df(spark, rows)
    w = Window.partitionBy("session_id").orderBy("action_time", "event_id")
    want = sorted(tuple(r) for r in v.select("session_id", F.col("page_id").alias("a"),
                                              F.lead("page_id").over(w).alias("b"))
                  .where("b is not null").collect())
    assert len(want) == len(rows) - 6
    for levels in [P.BUCKET_LEVELS, (19,), (16,), (19, 16, 13), (19, 17, 16, 14, 13)]:
        got = sorted(tuple(r) for r in P.page_transitions(v, "event_id", levels=levels).collect())
        assert got == want, levels
    for split in (1, 2, 7):
        got = sorted(tuple(r) for r in P.page_transitions(v, "event_id", tie_split=split).collect())
        assert got == want, split
