"""Registered J4 queries (ad clicks, batch forms and sinks) and their DuckDB twins."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..checks.oracle_sql import fmt_time, with_ctes
from ..config import checkpoint_root
from ..functions import dates
from ..operators import ads
from ..sinks import log_tables as lt
from ..sources import adlog, tables
from .registry import register

# Threshold of the registered queries (the test log's largest (day, user, ad) count is 2).
THRESHOLD = 2

_CLICK_COLS = f"{fmt_time('ts')} AS ts, date, province, city, user_id, ad_id, event_id"


def _clicks(spark, sf) -> DataFrame:
    return adlog.parse_ad_log(tables.ad_log_lines(spark, sf), keep=("event_id",))


def _out(df: DataFrame) -> DataFrame:
    return df.withColumn("ts", dates.format_time("ts")) if "ts" in df.columns else df


@register("parse_ad_log", with_ctes(["ad_clicks"], f"SELECT {_CLICK_COLS} FROM ad_clicks"))
def q_parse_ad_log(spark: SparkSession, sf: str) -> DataFrame:
    return _out(_clicks(spark, sf))


@register("ad_user_click_count", with_ctes(["ad_clicks"], """
SELECT date, user_id, ad_id, count(*) AS click_count FROM ad_clicks GROUP BY date, user_id, ad_id"""))
def q_ad_user_click_count(spark: SparkSession, sf: str) -> DataFrame:
    return ads.user_ad_click_counts(_clicks(spark, sf))


_BLACKLIST = f"""
bl AS (SELECT DISTINCT user_id FROM (
  SELECT user_id FROM ad_clicks GROUP BY date, user_id, ad_id HAVING count(*) >= {THRESHOLD}))"""


@register("ad_blacklist", with_ctes(["ad_clicks"], f"WITH {_BLACKLIST} SELECT user_id FROM bl"))
def q_ad_blacklist(spark: SparkSession, sf: str) -> DataFrame:
    return ads.blacklist_from_counts(ads.user_ad_click_counts(_clicks(spark, sf)), THRESHOLD)


@register("ad_blacklist_filter", with_ctes(["ad_clicks"], f"""WITH {_BLACKLIST}
SELECT {_CLICK_COLS} FROM ad_clicks WHERE user_id NOT IN (SELECT user_id FROM bl)"""))
def q_ad_blacklist_filter(spark: SparkSession, sf: str) -> DataFrame:
    c = _clicks(spark, sf)
    return _out(ads.filter_blacklisted(c, ads.blacklist_from_counts(ads.user_ad_click_counts(c), THRESHOLD)))


_KEPT = f"""
nth AS (SELECT user_id, ts, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY date, user_id, ad_id ORDER BY ts, event_id) AS n FROM ad_clicks)
  WHERE n = {THRESHOLD}),
cut AS (SELECT user_id, min(ts) AS cut_ts FROM nth GROUP BY user_id),
cut2 AS (SELECT c.user_id, c.cut_ts, min(n.event_id) AS cut_event_id
         FROM cut c JOIN nth n ON c.user_id = n.user_id AND c.cut_ts = n.ts GROUP BY c.user_id, c.cut_ts),
kept AS (
  SELECT a.* FROM ad_clicks a LEFT JOIN cut2 c ON a.user_id = c.user_id
  WHERE c.cut_ts IS NULL OR a.ts < c.cut_ts OR (a.ts = c.cut_ts AND a.event_id <= c.cut_event_id)),
stat AS (SELECT date, province, city, ad_id, count(*) AS click_count FROM kept GROUP BY 1, 2, 3, 4),
prov AS (
  SELECT date, province, ad_id, click_count FROM (
    SELECT *, row_number() OVER (PARTITION BY date, province ORDER BY click_count DESC, ad_id) AS rn FROM (
      SELECT date, province, ad_id, CAST(sum(click_count) AS BIGINT) AS click_count FROM stat GROUP BY 1, 2, 3))
  WHERE rn <= 3)"""


def _kept(spark, sf) -> DataFrame:
    c = _clicks(spark, sf)
    return ads.apply_cutoffs(c, ads.blacklist_cutoffs(c, THRESHOLD))


@register("ad_blacklist_cutoff", with_ctes(["ad_clicks"], f"WITH {_KEPT} SELECT {_CLICK_COLS} FROM kept"))
def q_ad_blacklist_cutoff(spark: SparkSession, sf: str) -> DataFrame:
    return _out(_kept(spark, sf))


@register("ad_stat", with_ctes(["ad_clicks"], f"WITH {_KEPT} SELECT * FROM stat"))
def q_ad_stat(spark: SparkSession, sf: str) -> DataFrame:
    return ads.ad_stat(_kept(spark, sf))


@register("ad_province_top3", with_ctes(["ad_clicks"], f"WITH {_KEPT} SELECT * FROM prov"))
def q_ad_province_top3(spark: SparkSession, sf: str) -> DataFrame:
    return ads.province_top(ads.ad_stat(_kept(spark, sf)), 3)


_TREND = """
SELECT strftime(ts, '%Y%m%d') AS date, strftime(ts, '%H') AS hour, strftime(ts, '%M') AS minute, ad_id,
       count(*) AS click_count
FROM ad_clicks GROUP BY 1, 2, 3, 4"""


@register("ad_click_trend", with_ctes(["ad_clicks"], _TREND))
def q_ad_click_trend(spark: SparkSession, sf: str) -> DataFrame:
    return ads.click_trend(_clicks(spark, sf))


# ---------------------------------------------------------------------------------------- sinks
# The log is applied as two batches (clicks before noon, then the rest: every day appears in both), then the
# sink is read back; the oracle is the whole-log result.

def _sink_path(spark, name) -> str:
    return f"{checkpoint_root(spark)}/clickscope-sinks/{name}-{uuid.uuid4().hex}"


def _halves(spark, sf):
    c = _clicks(spark, sf)
    morning = F.hour("ts") < 12
    return c.where(morning), c.where(~morning), c


_COUNT_SCHEMA = T.StructType([T.StructField("date", T.StringType()), T.StructField("user_id", T.LongType()),
                              T.StructField("ad_id", T.LongType()), T.StructField("click_count", T.LongType())])
_STAT_SCHEMA = T.StructType([T.StructField("date", T.StringType()), T.StructField("province", T.StringType()),
                             T.StructField("city", T.StringType()), T.StructField("ad_id", T.LongType()),
                             T.StructField("click_count", T.LongType())])
_PROV_SCHEMA = T.StructType([T.StructField("date", T.StringType()), T.StructField("province", T.StringType()),
                             T.StructField("ad_id", T.LongType()), T.StructField("click_count", T.LongType())])
_BL_SCHEMA = T.StructType([T.StructField("user_id", T.LongType())])


@register("upsert_increment", with_ctes(["ad_clicks"], """
SELECT date, user_id, ad_id, count(*) AS click_count FROM ad_clicks GROUP BY date, user_id, ad_id"""))
def q_upsert_increment(spark: SparkSession, sf: str) -> DataFrame:
    first, second, _ = _halves(spark, sf)
    t = lt.LogTable(spark, _sink_path(spark, "ad_user_click_count"), _COUNT_SCHEMA, ("date",))
    lt.increment_upsert(t, ads.user_ad_click_counts(first), 0)
    lt.increment_upsert(t, ads.user_ad_click_counts(second), 1)
    lt.increment_upsert(t, ads.user_ad_click_counts(second), 1)  # a replayed batch changes nothing
    return lt.read_increment(t, ["date", "user_id", "ad_id"], ["click_count"])


@register("upsert_replace", with_ctes(["ad_clicks"], """
SELECT date, province, city, ad_id, count(*) AS click_count FROM ad_clicks GROUP BY 1, 2, 3, 4"""))
def q_upsert_replace(spark: SparkSession, sf: str) -> DataFrame:
    first, _, whole = _halves(spark, sf)
    t = lt.LogTable(spark, _sink_path(spark, "ad_stat"), _STAT_SCHEMA, ("date",))
    lt.replace_upsert(t, ads.ad_stat(first), 0)   # running totals after batch 0
    lt.replace_upsert(t, ads.ad_stat(whole), 1)   # running totals after batch 1 (every key re-emitted)
    return lt.read_replace(t, ["date", "province", "city", "ad_id"], ["click_count"])


@register("replace_group", with_ctes(["ad_clicks"], """
SELECT date, province, ad_id, click_count FROM (
  SELECT *, row_number() OVER (PARTITION BY date, province ORDER BY click_count DESC, ad_id) AS rn FROM (
    SELECT date, province, ad_id, count(*) AS click_count FROM ad_clicks GROUP BY 1, 2, 3))
WHERE rn <= 3"""))
def q_replace_group(spark: SparkSession, sf: str) -> DataFrame:
    first, second, whole = _halves(spark, sf)
    t = lt.LogTable(spark, _sink_path(spark, "ad_province_top3"), _PROV_SCHEMA, ("date",))
    lt.replace_group(t, ads.province_top(ads.ad_stat(first), 3), 0)
    touched = second.select("date", "province").distinct()
    top_all = ads.province_top(ads.ad_stat(whole), 3).join(touched, ["date", "province"], "left_semi")
    lt.replace_group(t, top_all, 1)
    return lt.read_group(t, ["date", "province"])


@register("append_batches", with_ctes(["ad_clicks"], f"WITH {_BLACKLIST} SELECT user_id FROM bl"))
def q_append_batches(spark: SparkSession, sf: str) -> DataFrame:
    first, _, whole = _halves(spark, sf)
    t = lt.LogTable(spark, _sink_path(spark, "ad_blacklist"), _BL_SCHEMA)
    b0 = ads.blacklist_from_counts(ads.user_ad_click_counts(first), THRESHOLD)
    lt.append_rows(t, b0, 0)
    b1 = ads.blacklist_from_counts(ads.user_ad_click_counts(whole), THRESHOLD)
    lt.append_rows(t, b1.join(lt.read_append(t, upto=0), "user_id", "left_anti"), 1)  # D14: no duplicates
    return lt.read_append(t)
