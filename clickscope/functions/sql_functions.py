"""UDF-1 / UDF-2 / UDAF-1: keep the reference's SQL function names usable in ``spark.sql`` text.

They are SQL-bodied temporary functions, so they inline into the plan and stay inside whole-stage codegen;
no Python runs per row. ``group_concat_distinct`` has no SQL-function form for aggregates, so SQL text uses
``listagg(DISTINCT x, ',') WITHIN GROUP (ORDER BY x)`` (exact distinct, sorted: decision D6). ``random_prefix`` takes a row id
whose hash gives the prefix, as a drawn one would change when a task is repeated. A function named ``get_json_object`` would
hide Spark's own for the whole session, which takes a path; ``json_field`` is the one that takes a field name.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

_DEFS = [
    "CREATE OR REPLACE TEMPORARY FUNCTION concat_long_string(v1 BIGINT, v2 STRING, sep STRING) RETURNS STRING "
    "RETURN concat(coalesce(cast(v1 AS STRING), 'null'), sep, coalesce(v2, 'null'))",
    "CREATE OR REPLACE TEMPORARY FUNCTION json_field(json STRING, field STRING) RETURNS STRING "
    "RETURN get_json_object(json, concat('$.', field))",
    "CREATE OR REPLACE TEMPORARY FUNCTION remove_random_prefix(v STRING) RETURNS STRING "
    "RETURN regexp_replace(v, '^[0-9]+_', '')",
    "CREATE OR REPLACE TEMPORARY FUNCTION random_prefix(v STRING, n INT, row_id BIGINT) RETURNS STRING "
    "RETURN concat(cast(pmod(xxhash64(row_id, 0), n) AS STRING), '_', v)",
    "CREATE OR REPLACE TEMPORARY FUNCTION half_up_ratio(n BIGINT, d BIGINT) RETURNS DOUBLE "
    "RETURN CASE WHEN d <> 0 THEN "
    "floor((cast(n AS DOUBLE) * 200.0D + cast(d AS DOUBLE)) / (cast(d AS DOUBLE) * 2.0D)) / 100.0D END",
]


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Register the functions in this session; returns their names."""
    names = []
    for ddl in _DEFS:
        spark.sql(ddl)
        names.append(ddl.split("FUNCTION ", 1)[1].split("(", 1)[0].strip())
    return names
