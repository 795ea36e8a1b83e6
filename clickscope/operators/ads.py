"""Ad-click analytics: per-day counts, blacklist, area rankings.

Input: ad clicks with ``ts_ms, province, city, userid, adid`` (strings
except the epoch-ms timestamp) and optionally ``dt`` (UTC day) and a tie
column for clicks in the same millisecond. The day of a click comes from
its own timestamp, so a late click adds to its own day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from clickscope.fixed import TOP3_KEY_PREFIX, TOP_ADS
from clickscope.functions.render import ordered_json_object
from clickscope.functions.timefmt import epoch_ms_to_day
from clickscope.operators.bloom import split_anti_join


def with_day(ads: DataFrame) -> DataFrame:
    """Add ``dt``, the UTC day of ``ts_ms``, unless the frame already has it."""
    return ads if "dt" in ads.columns else ads.withColumn("dt", epoch_ms_to_day("ts_ms"))


def _count(name: str = "clicks"):
    return F.count(F.lit(1)).alias(name)


def ad_user_day_clicks(ads: DataFrame) -> DataFrame:
    """Clicks per (dt, adid, userid)."""
    return with_day(ads).groupBy("dt", "adid", "userid").agg(_count())


def over_threshold(ads: DataFrame, threshold: int) -> DataFrame:
    """(userid) once per (day, ad) on which the user reached ``threshold``.

    Not deduplicated: as the build side of a semi/anti join duplicates do
    not change the result, and leaving out the ``distinct`` keeps a plain
    shuffle under the join, which AQE can split when one user is hot.
    """
    return ad_user_day_clicks(ads).where(F.col("clicks") >= threshold).select("userid")


def ad_blacklist(ads: DataFrame, threshold: int) -> DataFrame:
    """Users with at least ``threshold`` clicks on one ad in one day: (userid)."""
    return over_threshold(ads, threshold).distinct()


def ad_log_filtered(ads: DataFrame, threshold: int | None = None,
                    blacklist: DataFrame | None = None) -> DataFrame:
    """Clicks of users not on the blacklist.

    The blacklist is ``blacklist`` (e.g. a stored set) or, with
    ``threshold``, derived from ``ads``. It grows with the user base, so it isn't
    broadcast; a filter of bounded size is, and only clicks of users that it may hold are shuffled
    to meet the list (see :func:`split_anti_join`). AQE splits the partition of a hot listed user.
    """
    if blacklist is None:
        if threshold is None:
            raise ValueError("give threshold or blacklist")
        blacklist = over_threshold(ads, threshold)
    return split_anti_join(ads, blacklist, "userid")


def ad_admitted_clicks(ads: DataFrame, threshold: int, tie_col: str = "event_id") -> DataFrame:
    """Clicks that pass the blacklist when it is applied event by event.

    A user's clicks are admitted up to and including the one at which any
    of their (day, ad) counts reaches ``threshold``; all later clicks are
    dropped. Result: (dt, adid, userid, clicks) over admitted clicks.

    * Only groups whose total reaches ``threshold`` can cut a user, so a semi
      join on the (partially aggregated) totals leaves their clicks alone.
      The threshold-th of them comes from ``row_number() <= threshold``,
      limited before its shuffle; the user's cut is the earliest.
    * The same totals are matched with the cut at
      group level: at most days x ads rows per user, whatever their clicks.
      Users never blacklisted keep their totals; no raw click of theirs is
      joined.
    * Only groups of blacklisted users join their raw clicks, on the full
      group key (AQE broadcasts the group list when small, or splits a hot
      group), and count the clicks up to the cut.
    """
    a = with_day(ads)
    order = ["ts_ms", tie_col]
    groups = ["dt", "adid", "userid"]
    w = Window.partitionBy(*groups).orderBy(*order)
    totals = ad_user_day_clicks(a)
    heavy = totals.where(F.col("clicks") >= threshold).select(*groups)
    nth = (a.select(*groups, *order).join(heavy, groups, "left_semi")
           .withColumn("_rn", F.row_number().over(w))
           .where(F.col("_rn") <= threshold)
           .where(F.col("_rn") == threshold))
    cut = nth.groupBy("userid").agg(F.min(F.struct(*order)).alias("_cut"))
    flagged = totals.join(cut, "userid", "left")
    free = flagged.where(F.col("_cut").isNull()).select(*groups, "clicks")
    cuts = flagged.where(F.col("_cut").isNotNull()).select(*groups, "_cut")
    before_cut = (a.join(cuts, groups)
                  .where(F.struct(*order) <= F.col("_cut"))
                  .groupBy(*groups).agg(_count()))
    return free.unionByName(before_cut)


def ad_area_city_clicks(ads: DataFrame) -> DataFrame:
    """Clicks per (dt, province, city, adid); not filtered by the blacklist."""
    return with_day(ads).groupBy("dt", "province", "city", "adid").agg(_count())


def ad_area_clicks(ads: DataFrame | None = None, area_city: DataFrame | None = None) -> DataFrame:
    """Clicks per (dt, province, adid): from raw clicks or rolled up from
    :func:`ad_area_city_clicks` by dropping the city."""
    if area_city is not None:
        return (area_city.groupBy("dt", "province", "adid")
                .agg(F.sum("clicks").cast("bigint").alias("clicks")))
    return with_day(ads).groupBy("dt", "province", "adid").agg(_count())


def ad_area_top3(area_clicks: DataFrame, n: int = TOP_ADS) -> DataFrame:
    """Top-n ads per (dt, province) by clicks, ties by ad id text:
    (dt, province, adid, clicks, rn)."""
    w = Window.partitionBy("dt", "province").orderBy(F.desc("clicks"), F.asc("adid"))
    return (area_clicks.withColumn("rn", F.row_number().over(w))
            .where(F.col("rn") <= n)
            .select("dt", "province", "adid", "clicks", "rn"))


def ad_area_top3_json(top: DataFrame) -> DataFrame:
    """Keyed JSON export of a top-n table: (key, field, value_json).

    key = ``top3_ads_per_day:<dt>``, field = province, value = ``{"ad":clicks,...}``
    in rank order. Each group holds at most n rows (the ranking's limit).
    """
    entries = F.sort_array(F.collect_list(F.struct("rn", "adid", "clicks")))
    as_kv = F.transform(entries, lambda e: F.struct(e["adid"].alias("key"), e["clicks"].alias("value")))
    return (top.groupBy("dt", "province")
            .agg(ordered_json_object(as_kv).alias("value_json"))
            .select(F.concat(F.lit(TOP3_KEY_PREFIX), F.col("dt")).alias("key"),
                    F.col("province").alias("field"), "value_json"))
