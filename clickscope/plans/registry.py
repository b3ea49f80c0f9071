"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` plus their DuckDB twins.

Every query reads the supplied tables (or views derived from them by column expressions) in full.
Task parameters used here are the fixture values of FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..checks.oracle_sql import with_ctes
from ..operators import products
from ..plans.area_job import area_top3_job
from ..sources import tables

TASK_ID = 1
# Task parameters of the registered queries (dates cover the whole test month).
START_DATE, END_DATE = "2024-01-01", "2024-01-31"

QUERIES: dict = {}
SQL: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- J3 area top products

@register("click_city_join", with_ctes(["uva", "city_info"], """
SELECT u.city_id, c.city_name, c.area, u.click_product_id AS product_id
FROM uva u JOIN city_info c ON u.city_id = c.city_id
WHERE u.click_product_id IS NOT NULL AND u.date BETWEEN '2024-01-01' AND '2024-01-31'"""))
def q_click_city_join(spark: SparkSession, sf: str) -> DataFrame:
    actions = tables.user_visit_action(spark, sf, START_DATE, END_DATE)
    return products.click_city_join(actions, tables.city_info(spark, sf), START_DATE, END_DATE)


_AREA_CLICKS_SQL = """
area_clicks AS (
  SELECT c.area, u.click_product_id AS product_id, COUNT(*) AS click_count,
         array_to_string(list_sort(list_distinct(list(CAST(c.city_id AS VARCHAR) || ':' || c.city_name))), ',')
           AS city_infos
  FROM uva u JOIN city_info c ON u.city_id = c.city_id
  WHERE u.click_product_id IS NOT NULL AND u.date BETWEEN '2024-01-01' AND '2024-01-31'
  GROUP BY c.area, u.click_product_id)"""


@register("area_product_clicks", with_ctes(["uva", "city_info"], f"WITH {_AREA_CLICKS_SQL} SELECT * FROM area_clicks"))
def q_area_product_clicks(spark: SparkSession, sf: str) -> DataFrame:
    actions = tables.user_visit_action(spark, sf, START_DATE, END_DATE)
    cc = products.click_city_join(actions, tables.city_info(spark, sf), START_DATE, END_DATE)
    return products.area_product_clicks(cc)


@register("area_top3_product", with_ctes(["uva", "city_info", "product_info"], f"""
WITH {_AREA_CLICKS_SQL},
ranked AS (
  SELECT a.area, a.product_id, a.click_count, a.city_infos, p.product_name,
         CASE WHEN json_extract_string(p.extend_info, '$.product_status') = '0' THEN 'Self' ELSE 'Third Party' END
           AS product_status,
         row_number() OVER (PARTITION BY a.area ORDER BY a.click_count DESC, a.product_id) AS rn
  FROM area_clicks a JOIN product_info p ON a.product_id = p.product_id)
SELECT CAST({TASK_ID} AS BIGINT) AS task_id, area,
       CASE WHEN area IN ('AFRICA', 'AMERICA') THEN 'A Level' WHEN area IN ('ASIA', 'EUROPE') THEN 'B Level'
            ELSE 'D Level' END AS area_level,
       product_id, city_infos, click_count, product_name, product_status
FROM ranked WHERE rn <= 3"""))
def q_area_top3_product(spark: SparkSession, sf: str) -> DataFrame:
    actions = tables.user_visit_action(spark, sf, START_DATE, END_DATE)
    return area_top3_job(actions, tables.city_info(spark, sf), tables.product_info(spark, sf), START_DATE, END_DATE,
                         TASK_ID)


@register("area_top3_product_sql", SQL["area_top3_product"])
def q_area_top3_product_sql(spark: SparkSession, sf: str) -> DataFrame:
    from .area_sql import area_top3_sql
    actions = tables.user_visit_action(spark, sf, START_DATE, END_DATE)
    return area_top3_sql(spark, actions, tables.city_info(spark, sf), tables.product_info(spark, sf), START_DATE,
                         END_DATE, TASK_ID)


from . import reg_ads, reg_misc, reg_pages, reg_sessions, reg_stream, reg_tasks, reg_layout  # noqa: E402,F401  (register their queries)
