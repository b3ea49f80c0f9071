"""Registered queries for the skew-safe join/aggregate operators, text helpers, group top-n and sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..checks.oracle_sql import with_ctes
from ..functions import text
from ..operators import joins, sessions, topn
from ..sources import scans, tables
from .registry import END_DATE, START_DATE, register

_JOIN_SQL = with_ctes(["uva", "user_info"], """
SELECT u.event_id, u.user_id, u.session_id, i.age, i.professional
FROM uva u JOIN user_info i ON u.user_id = i.user_id""")


def _join_sides(spark, sf):
    a = tables.user_visit_action(spark, sf).select("event_id", "user_id", "session_id")
    u = tables.user_info(spark, sf).select("user_id", "age", "professional")
    return a, u


@register("salted_join", _JOIN_SQL)
def q_salted_join(spark: SparkSession, sf: str) -> DataFrame:
    a, u = _join_sides(spark, sf)
    return joins.salted_join(a, u, "user_id", n=8, salt_col="event_id")


@register("skew_join", _JOIN_SQL)
def q_skew_join(spark: SparkSession, sf: str) -> DataFrame:
    a, u = _join_sides(spark, sf)
    return joins.skew_join(a, u, "user_id", fraction=0.1, seed=9, top=3, n_salts=16, salt_col="event_id")


@register("broadcast_join", with_ctes(["uva", "city_info"], """
SELECT u.event_id, u.city_id, c.city_name, c.area FROM uva u JOIN city_info c ON u.city_id = c.city_id"""))
def q_broadcast_join(spark: SparkSession, sf: str) -> DataFrame:
    a = tables.user_visit_action(spark, sf).select("event_id", "city_id")
    return joins.broadcast_join(a, tables.city_info(spark, sf), "city_id", max_rows=10_000)


@register("salted_agg", with_ctes(["uva"], """
SELECT city_id, page_id, count(*) AS cnt, CAST(sum(event_id) AS BIGINT) AS event_id_sum
FROM uva GROUP BY city_id, page_id"""))
def q_salted_agg(spark: SparkSession, sf: str) -> DataFrame:
    a = tables.user_visit_action(spark, sf)
    out = joins.salted_agg(a, ["city_id", "page_id"], n=8, sum_cols={"event_id_sum": "event_id"},
                           salt_col="event_id")
    return out.withColumn("event_id_sum", F.col("event_id_sum").cast("bigint"))


@register("random_prefix_roundtrip", with_ctes(["uva"], """
SELECT session_id, count(*) AS cnt FROM uva GROUP BY session_id"""))
def q_random_prefix_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """FN-15/16 (AGG-11 SQL form): prefix → partial count → strip prefix → final sum."""
    a = tables.user_visit_action(spark, sf)
    part = (a.select(text.random_prefix(F.col("session_id"), 10, by="event_id").alias("k"))
            .groupBy("k").agg(F.count(F.lit(1)).alias("cnt")))
    return part.groupBy(text.remove_random_prefix(F.col("k")).alias("session_id")).agg(
        F.sum("cnt").cast("bigint").alias("cnt"))


@register("group_top_n", """
SELECT o_custkey, o_orderkey, o_totalprice, rank FROM (
  SELECT o_custkey, o_orderkey, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank
  FROM orders) WHERE rank <= 3""")
def q_group_top_n(spark: SparkSession, sf: str) -> DataFrame:
    o = tables.read_table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    out = topn.group_top_n(o, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3)
    return out.withColumn("rank", F.col("rank").cast("bigint"))


_KV = """
kv AS (
  SELECT session_id,
         'sessionid=' || session_id || '|searchKeywords=' || array_to_string(kw, ',')
         || '|clickCategoryIds=' || array_to_string(cat, ',') || '|visitLength=' || CAST(vl AS VARCHAR)
         || '|stepLength=' || CAST(sl AS VARCHAR) AS kv
  FROM (SELECT session_id, list_sort(list_distinct(list(search_keyword))) AS kw,
               list_sort(list_distinct(list(click_category_id))) AS cat,
               date_diff('second', min(action_time), max(action_time)) AS vl, count(*) AS sl
        FROM uva WHERE date BETWEEN '2024-01-01' AND '2024-01-31' GROUP BY session_id))"""


def _kv(spark, sf) -> DataFrame:
    s = sessions.session_aggregate(scans.scoped_actions(spark, sf, START_DATE, END_DATE))
    rec = F.concat_ws("|",
                      F.concat(F.lit("sessionid="), F.col("session_id")),
                      F.concat(F.lit("searchKeywords="), F.array_join("search_keyword_list", ",")),
                      F.concat(F.lit("clickCategoryIds="), F.array_join("click_category_list", ",")),
                      F.concat(F.lit("visitLength="), F.col("visit_length").cast("string")),
                      F.concat(F.lit("stepLength="), F.col("step_length").cast("string")))
    return s.select("session_id", rec.alias("kv"))


@register("kv_text_get", with_ctes(["uva"], f"""WITH {_KV}
SELECT session_id,
       nullif(regexp_extract(kv, '(?:^|\\|)searchKeywords=([^|=]*)(?:\\||$)', 1), '') AS search_keywords,
       CAST(nullif(regexp_extract(kv, '(?:^|\\|)stepLength=([^|=]*)(?:\\||$)', 1), '') AS BIGINT) AS step_length
FROM kv"""))
def q_kv_text_get(spark: SparkSession, sf: str) -> DataFrame:
    kv = _kv(spark, sf)
    return kv.select("session_id", text.kv_get(F.col("kv"), "searchKeywords").alias("search_keywords"),
                     text.kv_get(F.col("kv"), "stepLength").cast("bigint").alias("step_length"))


@register("kv_text_set", with_ctes(["uva"], f"""WITH {_KV}
SELECT session_id,
       regexp_replace(kv, '(^|\\|)visitLength=[^|]*', '\\1visitLength=' || CAST(length(session_id) AS VARCHAR)) AS kv
FROM kv"""))
def q_kv_text_set(spark: SparkSession, sf: str) -> DataFrame:
    kv = _kv(spark, sf)
    return kv.select("session_id", text.kv_set(F.col("kv"), "visitLength", F.length("session_id")).alias("kv"))


@register("date_hour_counts", with_ctes(["uva"], """
SELECT strftime(min_t, '%Y-%m-%d_%H') AS date_hour, count(*) AS session_count
FROM (SELECT session_id, min(action_time) AS min_t FROM uva
      WHERE date BETWEEN '2024-01-01' AND '2024-01-31' GROUP BY session_id) GROUP BY 1"""))
def q_date_hour_counts(spark: SparkSession, sf: str) -> DataFrame:
    s = sessions.session_measures(scans.scoped_actions(spark, sf, START_DATE, END_DATE))
    return sessions.date_hour_counts(s)
