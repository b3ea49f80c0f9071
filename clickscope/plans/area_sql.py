"""J3 as one Spark SQL statement over named arguments, to show the SQL-level functions of
:mod:`clickscope.functions.sql_functions` (``concat_long_string``, ``json_field``) at work (UDF-1, UDF-2, UDAF-1).

The inputs are passed as DataFrames, so no view stays behind in the caller's session, and the area levels are a map
argument.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sql_functions import register_sql_functions
from ..operators.products import DEFAULT_AREA_LEVELS, DEFAULT_LEVEL

STATEMENT = """
WITH per_area AS (
  SELECT c.area, a.click_product_id AS product_id, count(*) AS click_count,
         listagg(DISTINCT c.city, ',') WITHIN GROUP (ORDER BY c.city) AS city_infos
  FROM {actions} a
  JOIN (SELECT city_id, area, concat_long_string(city_id, city_name, ':') AS city FROM {cities}) c USING (city_id)
  WHERE a.click_product_id IS NOT NULL AND a.date BETWEEN :first_day AND :last_day
  GROUP BY c.area, a.click_product_id),
placed AS (
  SELECT s.*, p.product_name, p.extend_info,
         row_number() OVER (PARTITION BY s.area ORDER BY s.click_count DESC, s.product_id) AS place
  FROM per_area s JOIN {products} p USING (product_id))
SELECT CAST(:task AS BIGINT) AS task_id, area, coalesce(try_element_at(:levels, area), :other_level) AS area_level,
       product_id, city_infos, click_count, product_name,
       CASE json_field(extend_info, 'product_status') WHEN '0' THEN 'Self' ELSE 'Third Party' END AS product_status
FROM placed WHERE place <= :n
"""


def area_top3_sql(spark: SparkSession, actions: DataFrame, cities: DataFrame, product_table: DataFrame,
                  start_date: str, end_date: str, task_id: int, n: int = 3, area_levels: dict | None = None,
                  other_level: str = DEFAULT_LEVEL) -> DataFrame:
    register_sql_functions(spark)
    levels = F.create_map(*[F.lit(x) for kv in (area_levels or DEFAULT_AREA_LEVELS).items() for x in kv])
    return spark.sql(STATEMENT, args={"first_day": start_date, "last_day": end_date, "task": int(task_id), "n": int(n),
                                      "levels": levels, "other_level": other_level},
                     actions=actions, cities=cities, products=product_table)
