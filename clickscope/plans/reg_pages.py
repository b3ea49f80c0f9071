"""Registered J2 queries (page flow) and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..checks.oracle_sql import fmt_time, ratio, with_ctes
from ..functions import dates
from ..operators import pages
from ..sources import scans, tables
from .page_job import run_page_job
from .registry import END_DATE, START_DATE, TASK_ID, register

# The reference's seed page flow.
FLOW = [1, 2, 3, 4, 5, 6, 7, 8, 9]

_PAIRS = f"""
pairs AS (
  SELECT session_id, prev_page_id, page_id, action_time, event_id FROM (
    SELECT session_id, page_id, action_time, event_id,
           lag(page_id) OVER (PARTITION BY session_id ORDER BY action_time, event_id) AS prev_page_id
    FROM uva WHERE date BETWEEN '2024-01-01' AND '2024-01-31')
  WHERE prev_page_id IS NOT NULL),
flow AS (SELECT * FROM (VALUES {', '.join(f"({i}, '{p}')" for i, p in [(0, 'start'), *pages.flow_pairs(FLOW)])})
         AS t(pos, page_pair)),
split_pv AS (
  SELECT CAST(prev_page_id AS VARCHAR) || '_' || CAST(page_id AS VARCHAR) AS page_pair, count(*) AS pv
  FROM pairs GROUP BY 1 HAVING page_pair IN (SELECT page_pair FROM flow WHERE pos >= 1)),
start_pv AS (
  SELECT 'start' AS page_pair, count(*) AS pv FROM uva
  WHERE date BETWEEN '2024-01-01' AND '2024-01-31' AND page_id = {FLOW[0]}),
rates AS (
  SELECT pos, page_pair, pv, {ratio('pv', 'prev_pv')} AS convert_rate FROM (
    SELECT f.pos, f.page_pair, CAST(coalesce(v.pv, 0) AS BIGINT) AS pv,
           lag(CAST(coalesce(v.pv, 0) AS BIGINT)) OVER (ORDER BY f.pos) AS prev_pv
    FROM flow f LEFT JOIN (SELECT * FROM split_pv UNION ALL SELECT * FROM start_pv) v ON f.page_pair = v.page_pair)
  WHERE pos >= 1)"""


def _scoped(spark, sf):
    return scans.scoped_actions(spark, sf, START_DATE, END_DATE)


@register("page_pairs", with_ctes(["uva"], f"""WITH {_PAIRS}
SELECT session_id, prev_page_id, page_id, {fmt_time('action_time')} AS action_time, event_id FROM pairs"""))
def q_page_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return pages.page_pairs(_scoped(spark, sf)).withColumn("action_time", dates.format_time("action_time"))


@register("page_pairs_range", with_ctes(["uva"], f"""WITH {_PAIRS}
SELECT session_id, prev_page_id, page_id, {fmt_time('action_time')} AS action_time, event_id FROM pairs"""))
def q_page_pairs_range(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions cut by minute: nearly every pair crosses a chunk."""
    minute = dates.hour_index("action_time") * F.lit(60) + F.minute("action_time")
    return pages.page_pairs(_scoped(spark, sf), minute).withColumn("action_time", dates.format_time("action_time"))


@register("page_pairs_hash", with_ctes(["uva"], f"""WITH {_PAIRS}
SELECT session_id, prev_page_id, page_id, {fmt_time('action_time')} AS action_time, event_id FROM pairs"""))
def q_page_pairs_hash(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions cut by day: few pairs cross a chunk."""
    day = F.to_date("action_time")
    return pages.page_pairs(_scoped(spark, sf), day).withColumn("action_time", dates.format_time("action_time"))


@register("page_split_pv", with_ctes(["uva"], f"WITH {_PAIRS} SELECT page_pair, pv FROM split_pv"))
def q_page_split_pv(spark: SparkSession, sf: str) -> DataFrame:
    return pages.page_split_pv(pages.page_pairs(_scoped(spark, sf)), FLOW)


@register("page_convert_rate", with_ctes(["uva"], f"WITH {_PAIRS} SELECT pos, page_pair, pv, convert_rate FROM rates"))
def q_page_convert_rate(spark: SparkSession, sf: str) -> DataFrame:
    scoped = _scoped(spark, sf)
    split = pages.page_split_pv(pages.page_pairs(scoped), FLOW)
    return pages.convert_rates(spark, split, pages.start_page_pv(scoped, FLOW), FLOW)


@register("page_convert_text", with_ctes(["uva"], f"""WITH {_PAIRS}
SELECT CAST({TASK_ID} AS BIGINT) AS task_id,
       string_agg(page_pair || '=' || coalesce(CAST(convert_rate AS VARCHAR), 'null'), '|' ORDER BY pos)
         AS convert_rate
FROM rates"""))
def q_page_convert_text(spark: SparkSession, sf: str) -> DataFrame:
    actions = tables.user_visit_action(spark, sf, START_DATE, END_DATE)
    return run_page_job(spark, actions, FLOW, START_DATE, END_DATE, TASK_ID)
