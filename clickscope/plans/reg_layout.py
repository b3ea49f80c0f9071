"""Registered queries over the fact table stored by session and day (SRC-1 layout): the table is written from the events, then
read without a shuffle of its rows. Their results are those of the same operators over the plain table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..checks.oracle_sql import fmt_time, with_ctes
from ..config import checkpoint_root
from ..functions import dates
from ..operators import sessions
from ..operators.filters import filter_sessions
from ..sources import layout, tables
from .reg_pages import _PAIRS
from .reg_sessions import _AGE, _DETAIL_SQL_COLS, _SESS, AGE_PARAMS
from .registry import END_DATE, START_DATE, register

BUCKETS = 8


def stored_fact(spark: SparkSession, sf: str) -> DataFrame:
    name = f"fact_by_session_{uuid.uuid4().hex}"
    path = f"{checkpoint_root(spark)}/clickscope-layout/{name}"
    return layout.write_by_session(tables.user_visit_action(spark, sf, START_DATE, END_DATE), name, path, BUCKETS)


@register("layout_session_measures", with_ctes(["uva", "user_info"], f"""
WITH {_SESS}
SELECT session_id, user_id, visit_length, step_length, {fmt_time('start_ts')} AS start_time FROM sess"""))
def q_layout_session_measures(spark: SparkSession, sf: str) -> DataFrame:
    out = layout.session_measures(stored_fact(spark, sf))
    return out.withColumn("start_time", dates.format_time("start_time"))


@register("layout_session_detail", with_ctes(["uva", "user_info"], f"""
WITH {_SESS}
SELECT {_DETAIL_SQL_COLS}
FROM uva u WHERE u.date BETWEEN '2024-01-01' AND '2024-01-31'
  AND u.session_id IN (SELECT session_id FROM sess_u WHERE {_AGE})"""))
def q_layout_session_detail(spark: SparkSession, sf: str) -> DataFrame:
    fact = stored_fact(spark, sf)
    wanted = filter_sessions(sessions.with_user_info(layout.session_measures(fact), tables.user_info(spark, sf)), AGE_PARAMS)
    return layout.session_detail(fact, wanted).withColumn("action_time", dates.format_time("action_time"))


@register("layout_page_pairs", with_ctes(["uva"], f"""WITH {_PAIRS}
SELECT session_id, prev_page_id, page_id, {fmt_time('action_time')} AS action_time, event_id FROM pairs"""))
def q_layout_page_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return layout.page_pairs(stored_fact(spark, sf)).withColumn("action_time", dates.format_time("action_time"))
