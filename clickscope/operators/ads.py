"""Ad clicks in batch form (J4): AGG-6, FLT-6, AGG-8, JOIN-9, and the batch twins of STR-4 … STR-7.

Input: typed clicks ``ts, date(yyyyMMdd), province, city, user_id, ad_id, event_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from .topn import group_top_n

DEFAULT_THRESHOLD = 100  # clicks per (day, user, ad) that put a user on the blacklist


def user_ad_click_counts(clicks: DataFrame) -> DataFrame:
    """AGG-6: ``date, user_id, ad_id, click_count``."""
    return clicks.groupBy("date", "user_id", "ad_id").agg(F.count(F.lit(1)).alias("click_count"))


def blacklist_from_counts(counts: DataFrame, threshold: int = DEFAULT_THRESHOLD) -> DataFrame:
    """FLT-6 + AGG-8: users with some (date, ad) total at or over the threshold."""
    return counts.where(F.col("click_count") >= threshold).select("user_id").distinct()


def filter_blacklisted(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    """JOIN-9: drop clicks of listed users (anti join; the planner and AQE pick the strategy from measured sizes)."""
    return clicks.join(blacklist.select("user_id"), "user_id", "left_anti")


def blacklist_cutoffs(clicks: DataFrame, threshold: int = DEFAULT_THRESHOLD) -> DataFrame:
    """Per listed user, the click that listed them: the earliest (ts, event_id) over all (date, ad) keys of
    the ``threshold``-th click of that key, ranked in two stages, so a hot key never lands whole in one task."""
    first_n = group_top_n(clicks, ["date", "user_id", "ad_id"], [F.col("ts"), F.col("event_id")], threshold, "_n",
                          salt_col="event_id")
    nth = first_n.where(F.col("_n") == F.lit(threshold))
    return nth.groupBy("user_id").agg(F.min(F.struct("ts", "event_id")).alias("_cut")).select(
        "user_id", F.col("_cut.ts").alias("cut_ts"), F.col("_cut.event_id").alias("cut_event_id"))


def apply_cutoffs(clicks: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Keep a click unless its user was listed by an earlier click (event-time form of STR-3 + STR-4).

    This is the blacklist loop with one click per micro-batch: deterministic, so it has a SQL oracle.
    """
    j = clicks.join(cutoffs, "user_id", "left")
    keep = (F.col("cut_ts").isNull() | (F.col("ts") < F.col("cut_ts"))
            | ((F.col("ts") == F.col("cut_ts")) & (F.col("event_id") <= F.col("cut_event_id"))))
    return j.where(keep).drop("cut_ts", "cut_event_id")


def ad_stat(clicks: DataFrame) -> DataFrame:
    """STR-5 batch twin: ``date, province, city, ad_id, click_count``."""
    return clicks.groupBy("date", "province", "city", "ad_id").agg(F.count(F.lit(1)).alias("click_count"))


def province_top(ad_stats: DataFrame, n: int = 3) -> DataFrame:
    """STR-6 batch twin: per (date, province) the ``n`` ads with most clicks over all cities (ties: ad id).
    Ranking by (date, province), keeping ``rank <= n`` (decisions D1, D2)."""
    by_prov = ad_stats.groupBy("date", "province", "ad_id").agg(
        F.sum("click_count").cast("bigint").alias("click_count"))
    top = group_top_n(by_prov, ["date", "province"], [F.desc("click_count"), F.asc("ad_id")], n)
    return top.select("date", "province", "ad_id", "click_count")


def click_trend(clicks: DataFrame) -> DataFrame:
    """STR-7 batch twin: clicks per (minute, ad) on the unfiltered log: ``date, hour, minute, ad_id, click_count``
    (date ``yyyyMMdd``, hour and minute zero-padded, FN-21)."""
    d, h, m = dates.minute_parts("ts")
    return clicks.groupBy(d.alias("date"), h.alias("hour"), m.alias("minute"), "ad_id").agg(
        F.count(F.lit(1)).alias("click_count"))
