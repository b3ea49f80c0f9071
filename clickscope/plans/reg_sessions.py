"""Registered J1 queries (session analysis) and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..checks.oracle_sql import fmt_time, ratio, with_ctes
from ..config import materialize
from ..functions import buckets, dates
from ..operators import categories, sessions
from ..params import SessionParams
from ..sources import scans, tables
from .registry import END_DATE, START_DATE, TASK_ID, register
from .session_job import filtered_sessions

# Parameters of the registered session queries
# (FIXTURES.md: age 10-50; extract total 1500 so that hour quotas bind)..
AGE_PARAMS = SessionParams(start_date=START_DATE, end_date=END_DATE, start_age=10, end_age=50)
ALL_PARAMS = SessionParams(start_date=START_DATE, end_date=END_DATE, start_age=10, end_age=50,
                           professionals=["BUILDING", "MACHINERY", "HOUSEHOLD"],
                           cities=[f"city{i}" for i in range(0, 25, 2)], sex="female",
                           keywords=["kw1", "kw3", "kw5", "kw7"],
                           category_ids=[str(i) for i in range(0, 100, 3)])
EXTRACT_TOTAL = 1500
SCAN_FROM, SCAN_TO = "2024-01-05", "2024-01-20"
HOURS_FACTOR = 1200

_SESS = """
sess AS (
  SELECT session_id, min(user_id) AS user_id,
         list_sort(list_distinct(list(search_keyword))) AS kw_list,
         list_sort(list_distinct(list(click_category_id))) AS cat_list,
         date_diff('second', min(action_time), max(action_time)) AS visit_length,
         count(*) AS step_length,
         min(action_time) AS start_ts
  FROM uva WHERE date BETWEEN '2024-01-01' AND '2024-01-31' GROUP BY session_id),
sess_u AS (
  SELECT s.*, u.age, u.professional, u.city, u.sex FROM sess s JOIN user_info u ON s.user_id = u.user_id)"""

_SESS_OUT = f"""session_id, user_id, nullif(array_to_string(kw_list, ','), '') AS search_keywords,
  nullif(array_to_string(cat_list, ','), '') AS click_category_ids, visit_length, step_length,
  {fmt_time('start_ts')} AS start_time, age, professional, city, sex"""

_AGE = "coalesce(age BETWEEN 10 AND 50, false)"


def _sql_list(vals, quote=True):
    return "[" + ", ".join((f"'{v}'" if quote else str(v)) for v in vals) + "]"


_ALL = " AND ".join([
    _AGE,
    f"coalesce(professional IN ({', '.join(repr(v) for v in ALL_PARAMS.professionals)}), false)",
    f"coalesce(city IN ({', '.join(repr(v) for v in ALL_PARAMS.cities)}), false)",
    "coalesce(sex = 'female', false)",
    f"coalesce(list_has_any(kw_list, {_sql_list(ALL_PARAMS.keywords)}), false)",
    f"coalesce(list_has_any(cat_list, {_sql_list(ALL_PARAMS.category_ids, quote=False)}::BIGINT[]), false)",
])


def _actions(spark, sf):
    return tables.user_visit_action(spark, sf)


def _sessions(spark, sf, p: SessionParams = AGE_PARAMS) -> DataFrame:
    return filtered_sessions(scans.scoped_actions(spark, sf, p.start_date, p.end_date), tables.user_info(spark, sf), p)


def _sessions_out(spark, sf, p: SessionParams, restrict: bool = True) -> DataFrame:
    """The filtered sessions with their lists, as text."""
    scoped = scans.scoped_actions(spark, sf, p.start_date, p.end_date)
    return sessions.session_output(sessions.with_lists(_sessions(spark, sf, p), scoped, restrict))


def _extract(spark, sf, actions: DataFrame | None = None) -> DataFrame:
    # Two columns of the sessions feed both the hour quotas and the draw: written once.
    sess = materialize(_sessions(spark, sf).select("session_id", "start_time"))
    return sessions.random_extract(sess, EXTRACT_TOTAL, task_id=TASK_ID, actions=actions,
                                   date_hours_bound=sessions.date_hours_in_range(START_DATE, END_DATE))


_DETAIL_COLS = ["user_id", "session_id", "page_id", "search_keyword", "click_category_id", "click_product_id",
                "order_category_ids", "order_product_ids", "pay_category_ids", "pay_product_ids", "event_id"]


def _detail_out(df: DataFrame) -> DataFrame:
    return df.withColumn("action_time", dates.format_time("action_time"))


_DETAIL_SQL_COLS = ", ".join(f"u.{c}" for c in _DETAIL_COLS) + f", {fmt_time('u.action_time')} AS action_time"


@register("date_range_scan", with_ctes(["uva"], f"""
SELECT date, user_id, session_id, page_id, {fmt_time('action_time')} AS action_time, search_keyword,
       click_category_id, click_product_id, order_category_ids, order_product_ids, pay_category_ids,
       pay_product_ids, city_id, event_id
FROM uva WHERE date BETWEEN '{SCAN_FROM}' AND '{SCAN_TO}'"""))
def q_date_range_scan(spark: SparkSession, sf: str) -> DataFrame:
    df = scans.scoped_actions(spark, sf, SCAN_FROM, SCAN_TO)
    return df.withColumn("action_time", dates.format_time("action_time"))


@register("session_aggregate", with_ctes(["uva", "user_info"], f"WITH {_SESS} SELECT {_SESS_OUT} FROM sess_u"))
def q_session_aggregate(spark: SparkSession, sf: str) -> DataFrame:
    return _sessions_out(spark, sf, SessionParams(start_date=START_DATE, end_date=END_DATE), restrict=False)


@register("session_filter_age", with_ctes(["uva", "user_info"],
                                          f"WITH {_SESS} SELECT {_SESS_OUT} FROM sess_u WHERE {_AGE}"))
def q_session_filter_age(spark: SparkSession, sf: str) -> DataFrame:
    return _sessions_out(spark, sf, AGE_PARAMS)


@register("session_filter_all", with_ctes(["uva", "user_info"],
                                          f"WITH {_SESS} SELECT {_SESS_OUT} FROM sess_u WHERE {_ALL}"))
def q_session_filter_all(spark: SparkSession, sf: str) -> DataFrame:
    return _sessions_out(spark, sf, ALL_PARAMS)


@register("session_detail", with_ctes(["uva", "user_info"], f"""
WITH {_SESS}
SELECT CAST({TASK_ID} AS BIGINT) AS task_id, {_DETAIL_SQL_COLS}
FROM uva u WHERE u.date BETWEEN '2024-01-01' AND '2024-01-31'
  AND u.session_id IN (SELECT session_id FROM sess_u WHERE {_AGE})"""))
def q_session_detail(spark: SparkSession, sf: str) -> DataFrame:
    scoped = scans.scoped_actions(spark, sf, START_DATE, END_DATE)
    return _detail_out(sessions.session_detail(scoped, _sessions(spark, sf), TASK_ID))


def _stats_sql(factor: int) -> str:
    vb = buckets.scaled(buckets.VISIT_BUCKETS, factor)
    sb = buckets.STEP_BUCKETS

    def cnt(col, lo, hi):
        cond = f"{col} >= {lo}" if hi is None else f"{col} BETWEEN {lo} AND {hi}"
        return f"sum(CASE WHEN {cond} THEN 1 ELSE 0 END)"

    parts = [f"{ratio(cnt('visit_length', lo, hi), 'count(*)')} AS visit_{n}" for n, lo, hi in vb]
    parts += [f"{ratio(cnt('step_length', lo, hi), 'count(*)')} AS step_{n}" for n, lo, hi in sb]
    return with_ctes(["uva", "user_info"], f"""
WITH {_SESS}
SELECT CAST({TASK_ID} AS BIGINT) AS task_id, count(*) AS session_count, {', '.join(parts)}
FROM sess_u WHERE {_AGE}""")


@register("session_stat_ratios", _stats_sql(1))
def q_session_stat_ratios(spark: SparkSession, sf: str) -> DataFrame:
    return sessions.session_stats(_sessions(spark, sf), TASK_ID)


@register("session_stat_ratios_hours", _stats_sql(HOURS_FACTOR))
def q_session_stat_ratios_hours(spark: SparkSession, sf: str) -> DataFrame:
    return sessions.session_stats(_sessions(spark, sf), TASK_ID,
                                  buckets.scaled(buckets.VISIT_BUCKETS, HOURS_FACTOR))


_EXTRACT_SQL = f"""
WITH {_SESS},
fs AS (SELECT *, strftime(start_ts, '%Y-%m-%d') AS d, strftime(start_ts, '%H') AS h FROM sess_u WHERE {_AGE}),
hc AS (SELECT d, h, count(*) AS hour_count FROM fs GROUP BY d, h),
hq AS (
  SELECT d, h, least(hour_count, CAST(floor(CAST(hour_count AS DOUBLE)
           / CAST(sum(hour_count) OVER (PARTITION BY d) AS DOUBLE)
           * floor({float(EXTRACT_TOTAL)} / CAST((SELECT count(DISTINCT d) FROM hc) AS DOUBLE))) AS BIGINT)) AS quota
  FROM hc),
ranked AS (
  SELECT fs.*, hq.quota,
         row_number() OVER (PARTITION BY fs.d, fs.h ORDER BY md5('clickscope' || fs.session_id), fs.session_id) AS rn
  FROM fs JOIN hq ON fs.d = hq.d AND fs.h = hq.h),
picked AS (SELECT * FROM ranked WHERE rn <= quota)"""


@register("session_random_extract", with_ctes(["uva", "user_info"], f"""{_EXTRACT_SQL}
SELECT CAST({TASK_ID} AS BIGINT) AS task_id, session_id, {fmt_time('start_ts')} AS start_time,
       nullif(array_to_string(kw_list, ','), '') AS search_keywords,
       nullif(array_to_string(cat_list, ','), '') AS click_category_ids
FROM picked"""))
def q_session_random_extract(spark: SparkSession, sf: str) -> DataFrame:
    return sessions.session_output(_extract(spark, sf, scans.scoped_actions(spark, sf, START_DATE, END_DATE)))


@register("session_random_extract_detail", with_ctes(["uva", "user_info"], f"""{_EXTRACT_SQL}
SELECT CAST({TASK_ID} AS BIGINT) AS task_id, {_DETAIL_SQL_COLS}
FROM uva u WHERE u.date BETWEEN '2024-01-01' AND '2024-01-31' AND u.session_id IN (SELECT session_id FROM picked)"""))
def q_session_random_extract_detail(spark: SparkSession, sf: str) -> DataFrame:
    scoped = scans.scoped_actions(spark, sf, START_DATE, END_DATE)
    return _detail_out(sessions.session_detail(scoped, _extract(spark, sf), TASK_ID, sessions_bound=EXTRACT_TOTAL))


# ------------------------------------------------------------ categories (on the filtered sessions' detail)

_DETAIL_CTE = f"""
WITH {_SESS},
d AS (SELECT u.* FROM uva u WHERE u.date BETWEEN '2024-01-01' AND '2024-01-31'
        AND u.session_id IN (SELECT session_id FROM sess_u WHERE {_AGE})),
cev AS (
  SELECT click_category_id AS category_id, 1 AS c, 0 AS o, 0 AS p FROM d WHERE click_category_id IS NOT NULL
  UNION ALL
  SELECT TRY_CAST(trim(x) AS BIGINT), 0, 1, 0
  FROM (SELECT unnest(string_split(order_category_ids, ',')) AS x FROM d
        WHERE order_category_ids IS NOT NULL AND trim(order_category_ids) <> '')
  UNION ALL
  SELECT TRY_CAST(trim(x) AS BIGINT), 0, 0, 1
  FROM (SELECT unnest(string_split(pay_category_ids, ',')) AS x FROM d
        WHERE pay_category_ids IS NOT NULL AND trim(pay_category_ids) <> '')),
cc AS (
  SELECT category_id, CAST(sum(c) AS BIGINT) AS click_count, CAST(sum(o) AS BIGINT) AS order_count,
         CAST(sum(p) AS BIGINT) AS pay_count
  FROM cev WHERE category_id IS NOT NULL GROUP BY category_id),
top_cat AS (
  SELECT * FROM cc ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10),
sc AS (
  SELECT click_category_id AS category_id, session_id, count(*) AS click_count
  FROM d WHERE click_category_id IS NOT NULL GROUP BY 1, 2),
top_sess AS (
  SELECT category_id, session_id, click_count FROM (
    SELECT sc.*, row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id) AS rn
    FROM sc WHERE category_id IN (SELECT category_id FROM top_cat)) WHERE rn <= 10)"""


def _detail(spark, sf) -> DataFrame:
    scoped = scans.scoped_actions(spark, sf, START_DATE, END_DATE)
    return sessions.session_detail(scoped, _sessions(spark, sf))


def _top_sessions(spark, sf, task_id: int | None = None) -> DataFrame:
    """Two passes over the pruned scan (the category ranking, then the sessions of ten categories) instead of a written
    copy of the filtered actions; what is ranked is aggregated to (category, session) before."""
    d = _detail(spark, sf)
    return categories.top_sessions(d, categories.top_categories(categories.category_counts(d), 10), 10, task_id)


@register("category_counts", with_ctes(["uva", "user_info"], f"{_DETAIL_CTE} SELECT * FROM cc"))
def q_category_counts(spark: SparkSession, sf: str) -> DataFrame:
    return categories.category_counts(_detail(spark, sf))


@register("category_counts_joined", with_ctes(["uva", "user_info"], f"{_DETAIL_CTE} SELECT * FROM cc"))
def q_category_counts_joined(spark: SparkSession, sf: str) -> DataFrame:
    # The reference's shape reads three columns of the detail in six branches: write these once.
    return categories.category_counts_joined(materialize(_detail(spark, sf).select(
        "click_category_id", "order_category_ids", "pay_category_ids")))


@register("top10_category", with_ctes(["uva", "user_info"], f"""{_DETAIL_CTE}
SELECT CAST({TASK_ID} AS BIGINT) AS task_id, category_id, click_count, order_count, pay_count FROM top_cat"""))
def q_top10_category(spark: SparkSession, sf: str) -> DataFrame:
    return categories.top_categories(categories.category_counts(_detail(spark, sf)), 10, TASK_ID)


@register("top10_session", with_ctes(["uva", "user_info"], f"""{_DETAIL_CTE}
SELECT CAST({TASK_ID} AS BIGINT) AS task_id, category_id, session_id, click_count FROM top_sess"""))
def q_top10_session(spark: SparkSession, sf: str) -> DataFrame:
    return _top_sessions(spark, sf, TASK_ID)


@register("top10_session_detail", with_ctes(["uva", "user_info"], f"""{_DETAIL_CTE}
SELECT t.category_id, {_DETAIL_SQL_COLS.replace('u.', 'u.')}
FROM top_sess t JOIN d u ON t.session_id = u.session_id"""))
def q_top10_session_detail(spark: SparkSession, sf: str) -> DataFrame:
    # The winners passed the filters already: their rows come from the plain scan.
    out = categories.top_session_detail(scans.scoped_actions(spark, sf, START_DATE, END_DATE), _top_sessions(spark, sf))
    return _detail_out(out.select("category_id", *_DETAIL_COLS, "action_time"))


@register("session_kv_text", with_ctes(["uva", "user_info"], f"""
WITH {_SESS}
SELECT session_id,
       'sessionid=' || session_id || '|searchKeywords=' || array_to_string(kw_list, ',')
       || '|clickCategoryIds=' || array_to_string(cat_list, ',') || '|visitLength=' || CAST(visit_length AS VARCHAR)
       || '|stepLength=' || CAST(step_length AS VARCHAR) || '|startTime=' || {fmt_time('start_ts')} AS kv
FROM sess"""))
def q_session_kv_text(spark: SparkSession, sf: str) -> DataFrame:
    scoped = scans.scoped_actions(spark, sf, START_DATE, END_DATE)
    s = sessions.session_aggregate(scoped)
    return s.select("session_id", sessions.kv_text().alias("kv"))

