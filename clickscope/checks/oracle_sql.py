"""DuckDB SQL for every registered query that SQL can express.

``CTES`` mirrors :mod:`clickscope.sources.tables` (the reference-shaped views derived from the test tables);
each query is ``WITH <needed ctes> <select>``. Every output column carries the same alias as the Spark side.
"""

from __future__ import annotations

CTE = {
    "ev": """ev AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         date_trunc('second', ts) AS ts_s
  FROM events)""",
    "uva": """uva AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date,
         user_id,
         CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y-%m-%d') AS session_id,
         k % 10 AS page_id,
         ts_s AS action_time,
         CASE WHEN event_type = 'view' THEN 'kw' || CAST(k % 10 AS VARCHAR) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN k END AS click_category_id,
         CASE WHEN event_type = 'click' THEN (k * 7 + 3) % 100 END AS click_product_id,
         CASE WHEN event_type = 'purchase' THEN CAST(k AS VARCHAR) || ',' || CAST((k + 7) % 100 AS VARCHAR) END
           AS order_category_ids,
         CASE WHEN event_type = 'purchase' THEN CAST((k * 7 + 3) % 100 AS VARCHAR) || ','
           || CAST((((k + 7) % 100) * 7 + 3) % 100 AS VARCHAR) END AS order_product_ids,
         CASE WHEN event_type = 'signup' THEN CAST(k AS VARCHAR) END AS pay_category_ids,
         CASE WHEN event_type = 'signup' THEN CAST((k * 7 + 3) % 100 AS VARCHAR) END AS pay_product_ids,
         user_id % 25 AS city_id,
         event_id
  FROM ev)""",
    "user_info": """user_info AS (
  SELECT c_custkey AS user_id, c_name AS username, c_name AS name, CAST(c_custkey % 60 AS INTEGER) AS age,
         c_mktsegment AS professional, 'city' || CAST(c_nationkey AS VARCHAR) AS city,
         CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer)""",
    "city_info": """city_info AS (
  SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
  FROM nation JOIN region ON n_regionkey = r_regionkey)""",
    "product_info": """product_info AS (
  SELECT p_partkey AS product_id, p_name AS product_name,
         '{"product_status": ' || CAST(p_size % 2 AS VARCHAR) || '}' AS extend_info
  FROM part)""",
    "ad_clicks": """ad_clicks AS (
  SELECT ev.ts_s AS ts, strftime(ev.ts_s, '%Y%m%d') AS date, replace(r_name, ' ', '-') AS province,
         replace(n_name, '_', '') AS city, ev.user_id, ev.k % 10 AS ad_id, ev.event_id
  FROM ev JOIN nation ON ev.user_id % 25 = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE ev.event_type = 'click')""",
}

# Dependencies between the CTEs above.
_DEPS = {"uva": ["ev"], "ad_clicks": ["ev"]}


def with_ctes(names: list[str], body: str) -> str:
    order: list[str] = []

    def add(n):
        for d in _DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = ",\n".join(CTE[n] for n in order)
    extra = body.strip()
    if extra.upper().startswith("WITH "):
        return f"WITH {ctes},\n{extra[5:]}"
    return f"WITH {ctes}\n{extra}"


def fmt_time(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def ratio(n: str, d: str) -> str:
    """Twin of :func:`clickscope.functions.numbers.ratio_half_up` (two decimals)."""
    return (f"CASE WHEN CAST({d} AS DOUBLE) <> 0 THEN floor((CAST({n} AS DOUBLE) * 200.0::DOUBLE + CAST({d} AS DOUBLE))"
            f" / (CAST({d} AS DOUBLE) * 2.0::DOUBLE)) / 100.0::DOUBLE END")
