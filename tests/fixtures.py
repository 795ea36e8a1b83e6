"""Hand-computed fixture tables (FIXTURES.md section 4)."""

from clickscope.schemas import VISIT_ACTION

# (event_id, session, page, time, click_cat, order list, pay list); date 2019-01-01.
VISITS_4_1 = [
    (1, "s1", 1, "10:00:00", 1, None, None),
    (2, "s1", 2, "10:00:05", 1, None, None),
    (3, "s1", 3, "10:00:09", -1, "1,2,2", None),
    (4, "s2", 1, "10:01:00", 2, None, None),
    (5, "s2", 3, "10:01:02", -1, None, "2,3"),
    (6, "s2", 2, "10:01:05", -1, None, None),
    (7, "s2", 3, "10:01:08", 1, "9", None),
    (8, "s3", 2, "10:02:00", -1, "4", "5"),
    (9, "s4", 1, "10:03:00", -1, None, None),
    (10, "s4", 9, "10:03:01", -1, None, None),
    (11, "s4", 2, "10:03:02", -1, None, None),
]


def visits_df(spark, rows=VISITS_4_1, date="2019-01-01"):
    data = [(eid, date, 1, s, page, f"{date} {t}", None, cat, cat, o, None, p, None, 1)
            for eid, s, page, t, cat, o, p in rows]
    schema = "event_id bigint, " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in VISIT_ACTION.fields)
    return spark.createDataFrame(data, schema)


T0 = 1546300800000  # 2019-01-01 00:00:00 UTC

# FIXTURES 4.3: two batches of ad-log lines, area A, city x, threshold 3.
BATCH0 = [f"{T0 + 1000} A x u1 a1", f"{T0 + 2000} A x u1 a1", f"{T0 + 3000} A x u1 a1",
          f"{T0 + 4000} A x u1 a2", "short line"]
BATCH1 = [f"{T0 + 5000} A x u1 a1", f"{T0 + 6000} A x u2 a1"]


def lines_df(spark, lines):
    return spark.createDataFrame([(v,) for v in lines], "value string")
