"""Operators vs brute-force Python models on random small inputs."""

from collections import Counter, defaultdict

from hypothesis import given, settings, strategies as st

from clickscope.operators import ads as A
from clickscope.operators import category as C

DAY = 86_400_000
T0 = 1546300800000

click = st.tuples(st.integers(0, 3 * DAY), st.sampled_from(["u1", "u2", "u3", "hot"]),
                  st.sampled_from(["a1", "a2", "a3"]))


def admitted_model(rows, threshold):
    """Event by event: a click counts unless its user is already blacklisted;
    a user is blacklisted by the click that brings one (day, ad) count to
    the threshold."""
    counts, banned, admitted = Counter(), set(), Counter()
    for eid, (t, user, ad) in sorted(enumerate(rows), key=lambda r: (r[1][0], r[0])):
        if user in banned:
            continue
        day = (T0 + t) // DAY
        admitted[(day, ad, user)] += 1
        counts[(day, ad, user)] += 1
        if counts[(day, ad, user)] >= threshold:
            banned.add(user)
    return admitted


def _ads_df(spark, rows):
    data = [(eid, T0 + t, "A", "x", user, ad) for eid, (t, user, ad) in enumerate(rows)]
    return A.with_day(spark.createDataFrame(
        data, "event_id long, ts_ms long, province string, city string, userid string, adid string"))


@settings(max_examples=25, deadline=None)
@given(st.lists(click, min_size=1, max_size=60), st.integers(1, 4))
def test_admitted_clicks_matches_event_model(spark, rows, threshold):
    rows = [(t // 10000 * 10000, u, a) for t, u, a in rows]  # force equal timestamps (tie column)
    got = {(r.dt, r.adid, r.userid): r.clicks for r in A.ad_admitted_clicks(_ads_df(spark, rows), threshold).collect()}
    want = admitted_model(rows, threshold)
    import datetime
    day = lambda d: datetime.datetime.fromtimestamp(d * 86400, datetime.UTC).strftime("%Y-%m-%d")
    assert got == {(day(d), a, u): n for (d, a, u), n in want.items()}


@settings(max_examples=25, deadline=None)
@given(st.lists(click, min_size=1, max_size=60), st.integers(1, 4))
def test_blacklist_and_filter_match_model(spark, rows, threshold):
    ads = _ads_df(spark, rows)
    per = Counter(((T0 + t) // DAY, a, u) for t, u, a in rows)
    banned = {u for (_, _, u), n in per.items() if n >= threshold}
    assert sorted(r.userid for r in A.ad_blacklist(ads, threshold).collect()) == sorted(banned)
    assert A.ad_log_filtered(ads, threshold).count() == sum(1 for _, u, _ in rows if u not in banned)


visit = st.tuples(st.sampled_from(["click", "order", "pay", "none"]),
                  st.lists(st.sampled_from(["1", "2", "3", "10", ""]), min_size=1, max_size=4),
                  st.sampled_from(["s1", "s2", "s3"]))


@settings(max_examples=25, deadline=None)
@given(st.lists(visit, min_size=1, max_size=40))
def test_category_counts_and_top_match_model(spark, rows):
    from fixtures import visits_df
    data, model = [], defaultdict(lambda: [0, 0, 0])
    for i, (kind, ids, sess) in enumerate(rows):
        cat = int(ids[0]) if kind == "click" and ids[0] else -1
        lst = ",".join(ids)
        order = lst if kind == "order" else None
        pay = lst if kind == "pay" else None
        data.append((i, sess, 1, f"10:00:{i % 60:02d}", cat, order, pay))
        if cat != -1:
            model[str(cat)][0] += 1
        elif order is not None or pay is not None:
            parts = lst.split(",")
            while parts and parts[-1] == "":  # the JVM split drops trailing empties
                parts.pop()
            if lst == "":
                parts = [""]
            for p in parts:
                model[p][1 if order is not None else 2] += 1
    v = visits_df(spark, data)
    got = {r.category_id: [r.click_count, r.order_count, r.pay_count] for r in C.category_counts(v).collect()}
    assert got == dict(model)
    top = [r.category_id for r in C.category_top10(v, n=3).collect()]
    want = sorted(model, key=lambda c: (-model[c][0], -model[c][1], -model[c][2], c))[:3]
    assert top == want


times = st.builds(lambda d, h, m: f"2019-0{d // 28 + 1}-{d % 28 + 1:02d} {h:02d}:{m:02d}:00",
                  st.integers(0, 80), st.integers(0, 23), st.integers(0, 59))
bound = st.one_of(st.none(), times.map(lambda t: t), times.map(lambda t: t[:10]), times.map(lambda t: t[:7]),
                  times.map(lambda t: t[:13]))


@settings(max_examples=30, deadline=None)
@given(st.lists(times, min_size=1, max_size=30), bound, bound)
def test_implied_date_bounds_never_change_the_result(spark, ts, start, end):
    """The partition-pruning bounds on `date` are implied by the text bounds."""
    from clickscope.sources.tables import visits_in_range
    df = spark.createDataFrame([(i, t[:10], t) for i, t in enumerate(ts)], "id int, date string, action_time string")
    plain = sorted(r.id for r in visits_in_range(df, start, end).collect())
    pruned = sorted(r.id for r in visits_in_range(df, start, end, date_col="date").collect())
    model = sorted(i for i, t in enumerate(ts) if (start is None or t >= start) and (end is None or t <= end))
    assert plain == pruned == model
