"""Single-step page conversion rates along a target page path.

For a path ``p1,p2,...,pn`` the rate of step ``pi-pj`` is the number of
times a session goes from page pi directly to page pj, divided by the
number of views of pi. Steps are taken between adjacent actions of a
session in time order over *all* its pages, so a page outside the path
breaks a step. The denominator counts every view of the first page,
including a session's last action.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

# Non-null columns the page-flow questions read (see conform_visits).
REQUIRED = ["session_id", "page_id", "action_time"]

# action_time prefixes 'yyyy-MM-dd HH:mm:ss' (second) and 'yyyy-MM-dd HH:mm'
# (minute): the time buckets adjacent pairs are found in, finest first.
BUCKET_LEVELS = (19, 16)


def parse_page_path(path: str | list) -> list[str]:
    """Target path as text ids; ``"1,2,3"`` or ``[1, 2, 3]``."""
    if isinstance(path, str):
        return path.split(",")
    return [str(p) for p in path]


def _as_page_id(text: str) -> int | None:
    """The page id a path item can match: page ids are compared as text, so
    only the canonical decimal form of a number matches."""
    try:
        v = int(text)
    except ValueError:
        return None
    return v if str(v) == text else None


def path_pages(path) -> list[int]:
    return sorted({p for p in map(_as_page_id, parse_page_path(path)) if p is not None})


def path_pairs(path) -> list[tuple[int, int]]:
    """Distinct adjacent steps of the path (a path with repeats is a set of steps)."""
    items = parse_page_path(path)
    pairs = []
    for x, y in zip(items, items[1:]):
        a, b = _as_page_id(x), _as_page_id(y)
        if a is not None and b is not None and (a, b) not in pairs:
            pairs.append((a, b))
    return pairs


def _pair_predicate(pairs: list[tuple[int, int]]) -> Column:
    if not pairs:
        return F.lit(False)
    return reduce(lambda acc, c: acc | c,
                  [(F.col("a") == a) & (F.col("b") == b) for a, b in pairs])


def page_views_in_flow(visits: DataFrame, path) -> DataFrame:
    """Views of each page on the path: (page_id, page_views).

    The page filter reaches the Parquet scan; the count is a partial
    aggregate, so at most one row per page and task is shuffled.
    """
    pages = path_pages(path)
    return (visits.where(F.col("page_id").isin(pages))
            .groupBy("page_id").agg(F.count(F.lit(1)).alias("page_views")))


def page_transitions(visits: DataFrame, tie_col: str | None = None,
                     levels: tuple[int, ...] = BUCKET_LEVELS,
                     tie_split: int | None = None) -> DataFrame:
    """Adjacent page pairs of every session: (session_id, a, b).

    Actions are ordered by ``action_time`` text, then ``tie_col`` if the
    table has such a column, then ``page_id``. Actions that agree in all of
    these are interchangeable, so the pairs don't depend on how a sort or a
    retry places them: without a tie column, the actions of one second
    count as taken in the order of their page ids. One
    window over a whole session would put a session holding a large share
    of all actions in one task, so the session is cut into time buckets
    (``action_time`` prefixes, finest first: seconds, then minutes):

    * level 0: ``lead`` over (session, second) gives the pairs inside a
      bucket; each bucket's last row (no lead) also carries its first page
      (a running ``first``), giving one edge row per non-empty bucket;
    * each next level groups the edge rows by a coarser prefix (minute,
      then the whole session) and pairs the last page of a bucket with the
      first page of the next non-empty one, again leaving one edge row per
      coarser bucket.

    Level 0 holds the rows of one session-second per task; each later
    level holds one narrow row per finer bucket (at most 60 per minute,
    and one per non-empty minute of a session at the last level), so no
    task grows with a session's size. The result equals a single ``lead``
    over the session.

    ``tie_split=B`` also cuts each session-second into ranges of
    ``floor(tie / B)`` (a numeric tie column) or, without a tie column, of
    single page ids, stitched back within the second, for inputs where a
    second of one session is itself huge. It costs one more narrow shuffle.
    """
    order_cols = ["action_time"] + ([tie_col] if tie_col else []) + ["page_id"]
    first_len, *coarser = levels
    split = bool(tie_split)
    sub = [(F.floor(F.col(tie_col) / F.lit(tie_split)) if tie_col else F.col("page_id")).alias("_sub")] if split else []
    v = visits.select("session_id", *order_cols,
                      F.substring("action_time", 1, first_len).alias("_key"), *sub)
    part0 = ["session_id", "_key"] + (["_sub"] if split else [])
    w0 = Window.partitionBy(*part0).orderBy(*order_cols)
    steps = v.select(*part0, F.col("page_id").alias("a"),
                     F.lead("page_id").over(w0).alias("b"),
                     F.first("page_id").over(w0.rowsBetween(Window.unboundedPreceding, 0)).alias("_first"))
    pairs = [steps.where(F.col("b").isNotNull()).select("session_id", "a", "b")]
    edges = steps.where(F.col("b").isNull()).select(*part0, "_first", F.col("a").alias("_last"))
    if split:
        # Stitch the tie ranges of one session-second back together.
        w = Window.partitionBy("session_id", "_key").orderBy("_sub")
        lv = edges.select("session_id", "_key", "_last",
                          F.lead("_first").over(w).alias("_next"),
                          F.first("_first").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_gfirst"))
        pairs.append(lv.where(F.col("_next").isNotNull())
                     .select("session_id", F.col("_last").alias("a"), F.col("_next").alias("b")))
        edges = (lv.where(F.col("_next").isNull())
                 .select("session_id", "_key", F.col("_gfirst").alias("_first"), "_last"))
    for prefix_len in [*coarser, None]:
        group = ["session_id"]
        if prefix_len is not None:
            edges = edges.withColumn("_grp", F.substring("_key", 1, prefix_len))
            group.append("_grp")
        w = Window.partitionBy(*group).orderBy("_key")
        lv = edges.select(*group, "_key", "_last",
                          F.lead("_first").over(w).alias("_next"),
                          F.first("_first").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_gfirst"))
        pairs.append(lv.where(F.col("_next").isNotNull())
                     .select("session_id", F.col("_last").alias("a"), F.col("_next").alias("b")))
        if prefix_len is not None:
            edges = (lv.where(F.col("_next").isNull())
                     .select("session_id", F.col("_grp").alias("_key"),
                             F.col("_gfirst").alias("_first"), "_last"))
    return reduce(DataFrame.unionByName, pairs)


def page_transition_counts(visits: DataFrame, path, tie_col: str | None = None,
                           tie_split: int | None = None) -> DataFrame:
    """Steps of the path that sessions took, with counts: (a, b, jumps)."""
    return (page_transitions(visits, tie_col, tie_split=tie_split).where(_pair_predicate(path_pairs(path)))
            .groupBy("a", "b").agg(F.count(F.lit(1)).alias("jumps")))


def page_flow_rate(visits: DataFrame, path, tie_col: str | None = None,
                   tie_split: int | None = None) -> DataFrame:
    """(page_flow 'a-b', jumps, page_views, rate = jumps / views of a).

    Steps nobody took do not appear. The denominator table has at most one
    row per path page, so its broadcast is bounded by the path length.
    """
    num = page_transition_counts(visits, path, tie_col, tie_split)
    den = page_views_in_flow(visits, path)
    return (num.join(F.broadcast(den), num.a == den.page_id)
            .select(F.concat_ws("-", F.col("a").cast("string"), F.col("b").cast("string")).alias("page_flow"),
                    "jumps", "page_views",
                    (F.col("jumps").cast("double") / F.col("page_views")).alias("rate")))
