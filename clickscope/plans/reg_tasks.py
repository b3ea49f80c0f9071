"""Registered queries over task tables (SRC-5, SRC-6), hash samples (TOP-7) and the text and date functions that no other
query shows (FN-1, FN-4, FN-6, FN-8, FN-9, FN-10, FN-23), with their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..checks.oracle_sql import fmt_time, ratio, with_ctes
from ..functions import buckets, dates, numbers, text
from ..operators.task_stats import task_session_stats
from ..operators.topn import hash_sample
from ..sources import tables
from .registry import register

# List parameters of the derived tasks.
PROFESSIONALS, KEYWORDS = ["BUILDING", "MACHINERY"], ["kw1", "kw3"]
CITIES, CATEGORIES = [f"city{i}" for i in range(1, 25, 2)], [str(i) for i in range(0, 100, 3)]


def supplier_tasks(spark: SparkSession, sf: str) -> DataFrame:
    """A task table from the suppliers: ``task_id, task_name, task_type, task_param``; what is unset is left out."""
    k = F.col("s_suppkey")
    start = F.date_add(F.lit("2024-01-01").cast("date"), (k % 20).cast("int"))
    text_of = lambda d: F.date_format(d, "yyyy-MM-dd")
    ranged, aged = k % 4 != 0, k % 5 != 0

    def param(name, value, when=None):
        value = F.array(value if not isinstance(value, str) else F.lit(value))
        return (F.when(when, value) if when is not None else value).alias(name)

    params = F.to_json(F.struct(
        param("startDate", text_of(start), ranged), param("endDate", text_of(F.date_add(start, (k % 9).cast("int"))), ranged),
        param("startAge", (k % 30).cast("string"), aged), param("endAge", (k % 30 + 25).cast("string"), aged),
        param("sex", F.when(k % 3 == 0, "female").otherwise("male"), k % 3 < 2),
        param("professionals", ",".join(PROFESSIONALS), k % 6 == 0), param("cities", ",".join(CITIES), k % 10 == 0),
        param("keywords", ",".join(KEYWORDS), k % 7 == 0), param("categoryIds", ",".join(CATEGORIES), k % 11 == 0)))
    return tables.read_table(spark, sf, "supplier").select(
        k.cast("bigint").alias("task_id"), F.col("s_name").alias("task_name"), F.lit("session").alias("task_type"),
        params.alias("task_param"))


def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _share(col: str, lo: int, hi: int | None) -> str:
    cond = f"{col} >= {lo}" if hi is None else f"{col} BETWEEN {lo} AND {hi}"
    return ratio(f"count(CASE WHEN {cond} THEN 1 END)", "count(f.session_id)")


_SHARES = ", ".join([f"{_share('visit', lo, hi)} AS visit_{n}" for n, lo, hi in buckets.scaled(buckets.VISIT_BUCKETS, 1200)]
                    + [f"{_share('steps', lo, hi)} AS step_{n}" for n, lo, hi in buckets.STEP_BUCKETS])


@register("task_session_stats", with_ctes(["uva", "user_info"], f"""
WITH tasks AS (
  SELECT s_suppkey AS task_id, s_suppkey AS k,
         CASE WHEN s_suppkey % 4 <> 0 THEN DATE '2024-01-01' + CAST(s_suppkey % 20 AS INT) END AS a,
         CASE WHEN s_suppkey % 4 <> 0 THEN DATE '2024-01-01' + CAST(s_suppkey % 20 + s_suppkey % 9 AS INT) END AS b
  FROM supplier),
sess AS (
  SELECT t.k, u.session_id, min(u.user_id) AS user_id, count(*) AS steps,
         date_diff('second', min(action_time), max(action_time)) AS visit,
         bool_or(coalesce(search_keyword IN ({_in(KEYWORDS)}), false)) AS kw,
         bool_or(coalesce(click_category_id IN ({', '.join(CATEGORIES)}), false)) AS cat
  FROM tasks t JOIN uva u ON t.a IS NULL OR CAST(u.date AS DATE) BETWEEN t.a AND t.b GROUP BY 1, 2),
f AS (
  SELECT s.* FROM sess s JOIN user_info i ON s.user_id = i.user_id
  WHERE (k % 5 = 0 OR age BETWEEN k % 30 AND k % 30 + 25) AND (k % 3 = 2 OR sex = CASE k % 3 WHEN 0 THEN 'female' ELSE 'male' END)
    AND (k % 6 <> 0 OR professional IN ({_in(PROFESSIONALS)})) AND (k % 10 <> 0 OR city IN ({_in(CITIES)}))
    AND (k % 7 <> 0 OR kw) AND (k % 11 <> 0 OR cat))
SELECT t.task_id, count(f.session_id) AS session_count, {_SHARES}
FROM tasks t LEFT JOIN f ON f.k = t.k GROUP BY t.task_id"""))
def q_task_session_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Session statistics of a task per supplier, all in one pass."""
    return task_session_stats(tables.user_visit_action(spark, sf), tables.user_info(spark, sf), supplier_tasks(spark, sf),
                              visit_buckets=buckets.scaled(buckets.VISIT_BUCKETS, 1200))


@register("text_functions", """
SELECT c_custkey, coalesce(v, '') = '' AS is_empty, coalesce(v, '') <> '' AS is_not_empty,
       regexp_replace(',' || c_name || ',,', '^,|,$', '', 'g') AS trimmed,
       CASE WHEN length(d) = 1 THEN '0' || d ELSE d END AS padded, TRY_CAST(trim(n) AS BIGINT) AS number
FROM (SELECT *, CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE c_name END AS v,
             CAST(c_custkey % 110 AS VARCHAR) AS d,
             CASE c_custkey % 4 WHEN 0 THEN ' ' || c_custkey || ' ' WHEN 1 THEN c_name WHEN 2 THEN '' END AS n FROM customer)""")
def q_text_functions(spark: SparkSession, sf: str) -> DataFrame:
    k, name = F.col("c_custkey"), F.col("c_name")
    v = F.when(k % 3 == 1, "").when(k % 3 == 2, name)
    n = F.when(k % 4 == 0, F.concat(F.lit(" "), k.cast("string"), F.lit(" "))).when(k % 4 == 1, name).when(k % 4 == 2, "")
    return tables.read_table(spark, sf, "customer").select(
        k, text.is_empty(v).alias("is_empty"), text.is_not_empty(v).alias("is_not_empty"),
        text.trim_comma(F.concat(F.lit(","), name, F.lit(",,"))).alias("trimmed"),
        text.zero_pad2(k % 110).alias("padded"), numbers.to_long(n).alias("number"))


@register("date_functions", f"""
SELECT event_id, t < noon AS before_noon, t > noon AS after_noon, {fmt_time('t')} AS parsed_time,
       CAST(CAST(t AS DATE) AS VARCHAR) AS parsed_day, event_id % 2 = 0 AS parses, 1 AS days_between
FROM (SELECT event_id, date_trunc('second', ts) AS t, date_trunc('day', ts) + INTERVAL 12 HOUR AS noon FROM events)""")
def q_date_functions(spark: SparkSession, sf: str) -> DataFrame:
    t = dates.trunc_second("ts")
    noon = F.to_timestamp_ntz(F.concat(dates.format_date("ts"), F.lit(" 12:00:00")))
    maybe = F.when(F.col("event_id") % 2 == 0, dates.format_time(t)).otherwise(F.lit("no time"))
    return tables.read_table(spark, sf, "events").select(
        "event_id", dates.before(t, noon).alias("before_noon"), dates.after(t, noon).alias("after_noon"),
        dates.format_time(dates.parse_time(dates.format_time(t))).alias("parsed_time"),
        dates.parse_datekey(dates.format_datekey(t)).cast("string").alias("parsed_day"),
        dates.parse_time(maybe).isNotNull().alias("parses"),
        F.datediff(dates.today(), dates.yesterday()).alias("days_between"))


@register("bernoulli_sample", with_ctes(["uva"], """
SELECT event_id, session_id FROM uva
WHERE CAST('0x' || substr(md5('9|' || CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) < 429496729"""))
def q_bernoulli_sample(spark: SparkSession, sf: str) -> DataFrame:
    """TOP-7: a tenth of the action table; the id decides for each row."""
    rows = tables.user_visit_action(spark, sf).select("event_id", "session_id")
    return hash_sample(rows, "event_id", 0.1, seed=9)
