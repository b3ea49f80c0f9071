"""Registered streaming queries: the events are appended to a segment log cut by cut, a running :class:`AdClickStream` takes
every cut as a batch (``stream_resume`` restarts it on its checkpoints instead), and the results are read back.

``stream_blacklist`` and ``stream_trend`` replay in several micro-batches (their results do not depend on
batch boundaries, §4.3 of the survey); ``stream_ad_stat`` / ``stream_province_top3`` / ``stream_user_click_count``
replay as one batch, where a list that is read when a batch begins cannot filter anything, so the oracle is the plain
count. ``stream_listing_*`` list users at the crossing click, so they equal the batch forms whatever the cuts are.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..checks.oracle_sql import with_ctes
from ..config import checkpoint_root
from ..sources import adlog, segment_log, tables
from ..streaming.ad_state import USER_GROUPS
from ..streaming.ad_stream import AdClickStream, run_segments
from .reg_ads import _KEPT, THRESHOLD, _TREND
from .registry import register

PARTITIONS = 4  # of the log and of the trend's state; the least of the main query's state
STATE_LINES = 1 << 17  # lines of a batch that one partition of the main query's state takes
# Cuts of the log in time order: five days each, or days 1-10, 11-20 and the rest.
FIVE_DAYS = "least(CAST((CAST(substr(date, 7, 2) AS INT) - 1) / 5 AS INT), 5)"


def _new_root(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/clickscope-stream/{uuid.uuid4().hex}"


def _clicks(spark: SparkSession, sf: str) -> DataFrame:
    c = tables.ad_clicks(spark, sf)
    return c.withColumn("value", adlog.log_line(c))


def _append(clicks: DataFrame, log: str) -> None:
    """A user's clicks keep their order in one partition of the log; a segment per partition and ten days."""
    segment_log.append_segments(clicks, log, F.pmod("user_id", F.lit(PARTITIONS)), ["event_id"], F.substring("date", 1, 7))


def _state_partitions(log: str) -> int:
    """Of the main query: as many as the lines that its first batch finds need, at most one per group of users."""
    lines = sum(segment_log.appended(log).values())
    return min(max(PARTITIONS, -(-lines // STATE_LINES)), USER_GROUPS)


def _replay(spark: SparkSession, sf: str, cut: str, cuts: int, main: bool = True, restart: bool = False,
            **options) -> AdClickStream:
    """Process the clicks with ``cut`` = 0, 1, … as batches of the main (or the trend) query: of one run, or with ``restart``
    of a new one on the same checkpoints each time."""
    root = _new_root(spark)
    log = f"{root}/log"
    clicks = _clicks(spark, sf).withColumn("_cut", F.expr(cut))
    query = None
    try:
        for i in range(cuts):
            _append(clicks.where(F.col("_cut") == i) if cuts > 1 else clicks, log)
            if i == 0:
                partitions = _state_partitions(log) if main else PARTITIONS
            if restart or cuts == 1:
                job = AdClickStream(spark, f"{root}/out", threshold=THRESHOLD, state_partitions=partitions, **options)
                run_segments(job, log, main=main, trend=not main)
                continue
            if query is None:
                job = AdClickStream(spark, f"{root}/out", threshold=THRESHOLD, state_partitions=partitions, **options)
                lines = segment_log.segment_stream(spark, log, "earliest")
                query = (job.start_main if main else job.start_trend)(lines, {"processingTime": "0 seconds"})
            query.processAllAvailable()
    finally:
        if query is not None:
            query.stop()
    return job


ONE = "0"


@register("stream_blacklist", with_ctes(["ad_clicks"], f"""
SELECT DISTINCT user_id FROM (
  SELECT user_id FROM ad_clicks GROUP BY date, user_id, ad_id HAVING count(*) >= {THRESHOLD})"""))
def q_stream_blacklist(spark: SparkSession, sf: str) -> DataFrame:
    return _replay(spark, sf, _DAY_CUTS, 3).blacklist()


@register("stream_trend", with_ctes(["ad_clicks"], _TREND))
def q_stream_trend(spark: SparkSession, sf: str) -> DataFrame:
    return _replay(spark, sf, _DAY_CUTS, 3, main=False).click_trend()


@register("stream_ad_stat", with_ctes(["ad_clicks"], """
SELECT date, province, city, ad_id, count(*) AS click_count FROM ad_clicks GROUP BY 1, 2, 3, 4"""))
def q_stream_ad_stat(spark: SparkSession, sf: str) -> DataFrame:
    return _replay(spark, sf, ONE, 1).ad_stat()


@register("stream_province_top3", with_ctes(["ad_clicks"], """
SELECT date, province, ad_id, click_count FROM (
  SELECT *, row_number() OVER (PARTITION BY date, province ORDER BY click_count DESC, ad_id) AS rn FROM (
    SELECT date, province, ad_id, count(*) AS click_count FROM ad_clicks GROUP BY 1, 2, 3))
WHERE rn <= 3"""))
def q_stream_province_top3(spark: SparkSession, sf: str) -> DataFrame:
    return _replay(spark, sf, ONE, 1).province_top3()


@register("stream_user_click_count", with_ctes(["ad_clicks"], """
SELECT date, user_id, ad_id, count(*) AS click_count FROM ad_clicks GROUP BY date, user_id, ad_id"""))
def q_stream_user_click_count(spark: SparkSession, sf: str) -> DataFrame:
    return _replay(spark, sf, ONE, 1).user_click_count()


@register("stream_resume", with_ctes(["ad_clicks"], _TREND))
def q_stream_resume(spark: SparkSession, sf: str) -> DataFrame:
    """STR-2: process the first half of every minute, stop, append the second halves to the log, restart on the same
    checkpoints. Every minute spans the cut, so the trend's state has to be resumed (and is kept whole: no watermark)."""
    half = "CAST(floor(second(ts) / 30) AS INT)"
    return _replay(spark, sf, half, 2, main=False, restart=True, watermark=None).click_trend()


# The log cut into three micro-batches by day of month (days 1-10, 11-20, 21-31): each cut is appended to the
# source and processed by its own ``availableNow`` run on the same checkpoints, so batch boundaries are exact.
_DAY_CUTS = ("CASE WHEN CAST(substr(date, 7, 2) AS INT) <= 10 THEN 0 "
             "WHEN CAST(substr(date, 7, 2) AS INT) <= 20 THEN 1 ELSE 2 END")


@register("stream_ad_stat_batches", with_ctes(["ad_clicks"], f"""
WITH g AS (SELECT *, {_DAY_CUTS} AS grp FROM ad_clicks),
crossing AS (
  SELECT user_id, min(grp) AS first_grp FROM (
    SELECT user_id, grp FROM g GROUP BY date, user_id, ad_id, grp HAVING count(*) >= {THRESHOLD})
  GROUP BY user_id),
kept AS (
  SELECT g.* FROM g LEFT JOIN crossing c ON g.user_id = c.user_id
  WHERE c.first_grp IS NULL OR g.grp <= c.first_grp)
SELECT date, province, city, ad_id, count(*) AS click_count FROM kept GROUP BY 1, 2, 3, 4"""))
def q_stream_ad_stat_batches(spark: SparkSession, sf: str) -> DataFrame:
    """STR-3/4/5 across batches: a user listed in one batch loses their clicks from the next batch on."""
    return _replay(spark, sf, _DAY_CUTS, 3).ad_stat()


# Each day cut at noon: batch 0 = all mornings, batch 1 = all afternoons. Every (date, province) top-3 group is
# written by batch 0 and rewritten by batch 1 (replace-group across batches), and users listed in batch 0 lose
# their afternoon clicks.
@register("stream_province_top3_batches", with_ctes(["ad_clicks"], f"""
WITH g AS (SELECT *, CASE WHEN hour(ts) < 12 THEN 0 ELSE 1 END AS grp FROM ad_clicks),
listed0 AS (
  SELECT DISTINCT user_id FROM (
    SELECT user_id FROM g WHERE grp = 0 GROUP BY date, user_id, ad_id HAVING count(*) >= {THRESHOLD})),
kept AS (SELECT * FROM g WHERE grp = 0 OR user_id NOT IN (SELECT user_id FROM listed0)),
prov AS (SELECT date, province, ad_id, count(*) AS click_count FROM kept GROUP BY 1, 2, 3)
SELECT date, province, ad_id, click_count FROM (
  SELECT *, row_number() OVER (PARTITION BY date, province ORDER BY click_count DESC, ad_id) AS rn FROM prov)
WHERE rn <= 3"""))
def q_stream_province_top3_batches(spark: SparkSession, sf: str) -> DataFrame:
    """STR-6 / SNK-5 across batches: top-3 groups rewritten by the second batch, blacklist feedback applied."""
    return _replay(spark, sf, "CASE WHEN hour(ts) < 12 THEN 0 ELSE 1 END", 2).province_top3()


# ---------------------------------------------------------------- users listed at the crossing click (keyed state)

@register("stream_listing_stat", with_ctes(["ad_clicks"], f"WITH {_KEPT} SELECT * FROM stat"))
def q_stream_listing_stat(spark: SparkSession, sf: str) -> DataFrame:
    """STR-3/4/5 in event order: equals ``ad_stat`` of the batch form, here over six batches."""
    return _replay(spark, sf, FIVE_DAYS, 6, listing="click").ad_stat()


@register("stream_listing_top3", with_ctes(["ad_clicks"], f"WITH {_KEPT} SELECT * FROM prov"))
def q_stream_listing_top3(spark: SparkSession, sf: str) -> DataFrame:
    """STR-6 / WIN-3 in event order: equals ``ad_province_top3`` of the batch form, here over three batches."""
    return _replay(spark, sf, _DAY_CUTS, 3, listing="click").province_top3()


@register("stream_running_totals", with_ctes(["ad_clicks"], f"WITH {_KEPT} SELECT * FROM stat"))
def q_stream_running_totals(spark: SparkSession, sf: str) -> DataFrame:
    """STR-5 / SNK-4: the running totals as the state holds them, published as a table by date."""
    job = _replay(spark, sf, _DAY_CUTS, 3, listing="click")
    path = f"{job.root}/published"
    job.main.publish(path)
    return spark.read.schema(job.main.stat.schema).parquet(path)


@register("stream_counter_lookup", with_ctes(["ad_clicks"], """
WITH counts AS (SELECT date, user_id, ad_id, count(*) AS n FROM ad_clicks GROUP BY 1, 2, 3),
keys AS (SELECT date, user_id, ad_id FROM counts UNION SELECT date, user_id, (ad_id + 1) % 10 FROM counts)
SELECT k.date, k.user_id, k.ad_id, coalesce(c.n, 0) AS click_count
FROM keys k LEFT JOIN counts c ON k.date = c.date AND k.user_id = c.user_id AND k.ad_id = c.ad_id"""))
def q_stream_counter_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-6: stored counters by (date, user, ad), 0 if absent: every counted key, and the same user's next ad."""
    keys = tables.ad_clicks(spark, sf).select("date", "user_id", "ad_id")
    keys = keys.unionByName(keys.withColumn("ad_id", (F.col("ad_id") + 1) % 10)).distinct()
    return _replay(spark, sf, ONE, 1).main.lookup_click_count(keys)


# ---------------------------------------------------------------- sliding windows

@register("stream_trend_sliding", with_ctes(["ad_clicks"], """
WITH secs AS (SELECT CAST(epoch(ts) AS BIGINT) AS s, ad_id FROM ad_clicks),
starts AS (SELECT DISTINCT ad_id, unnest(range(s - s % 10 - 3590, s - s % 10 + 10, 10)) AS w FROM secs),
counts AS (SELECT t.ad_id, t.w, count(*) AS n FROM starts t JOIN secs c
           ON c.ad_id = t.ad_id AND c.s >= t.w AND c.s < t.w + 3600 GROUP BY 1, 2),
marked AS (SELECT *, CASE WHEN lag(w) OVER o = w - 10 AND lag(n) OVER o = n THEN 0 ELSE 1 END AS fresh
           FROM counts WINDOW o AS (PARTITION BY ad_id ORDER BY w)),
runs AS (SELECT *, sum(fresh) OVER (PARTITION BY ad_id ORDER BY w) AS run FROM marked)
SELECT ad_id, min(w) AS first_start, max(w) AS last_start, min(n) AS click_count FROM runs GROUP BY ad_id, run"""))
def q_stream_trend_sliding(spark: SparkSession, sf: str) -> DataFrame:
    """STR-10: all windows of 60 minutes sliding by 10 seconds, equal neighbours as one row."""
    job = _replay(spark, sf, _DAY_CUTS, 3, main=False, trend_window="60 minutes",
                  trend_slide="10 seconds")
    return job.click_trend_runs()


# ---------------------------------------------------------------- the log's offsets

def _day_counts(spark: SparkSession, log: str, group: str, root: str, **options) -> DataFrame:
    """A consumer of its own: clicks per (date, ad) of what it reads, in one run without an earlier checkpoint."""
    lines = segment_log.segment_stream(spark, log, group=group, **options)
    out = f"{root}/lines-{uuid.uuid4().hex}"
    q = (lines.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    segment_log.commit_progress(q, log, group)
    return spark.read.schema(segment_log.SCHEMA).parquet(out)


def _per_day(lines: DataFrame) -> DataFrame:
    return adlog.parse_ad_log(lines).groupBy("date", "ad_id").agg(F.count(F.lit(1)).alias("click_count"))


_LATER = """
SELECT date, ad_id, count(*) AS click_count FROM ad_clicks WHERE CAST(substr(date, 7, 2) AS INT) > {day} GROUP BY 1, 2"""


@register("log_group_resume", with_ctes(["ad_clicks"], _LATER.format(day=10)))
def q_log_group_resume(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-9: a group reads days 1-10 and commits; a new program of that group without a checkpoint reads only what was
    appended since, though it asks for the earliest offsets."""
    root = _new_root(spark)
    clicks = _clicks(spark, sf).withColumn("_cut", F.expr(_DAY_CUTS))
    _append(clicks.where("_cut = 0"), f"{root}/log")
    _day_counts(spark, f"{root}/log", "reports", root)
    _append(clicks.where("_cut > 0"), f"{root}/log")
    return _per_day(_day_counts(spark, f"{root}/log", "reports", root, starting_offsets="earliest"))


@register("log_expired_offsets", with_ctes(["ad_clicks"], _LATER.format(day=20)))
def q_log_expired_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-9: a group committed after days 1-10; days 1-20 have left the log since, so its offsets have expired and it goes
    on at the earliest ones there are."""
    root = _new_root(spark)
    clicks = _clicks(spark, sf).withColumn("_cut", F.expr(_DAY_CUTS))
    _append(clicks.where("_cut = 0"), f"{root}/log")
    _day_counts(spark, f"{root}/log", "reports", root)
    _append(clicks.where("_cut = 1"), f"{root}/log")
    ends = segment_log.latest(f"{root}/log")
    _append(clicks.where("_cut = 2"), f"{root}/log")
    segment_log.expire(f"{root}/log", ends)
    return _per_day(_day_counts(spark, f"{root}/log", "reports", root, fail_on_data_loss=False))
