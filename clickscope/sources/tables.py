"""Input tables.

The supplied test tables are TPC-H-like plus an ``events`` click table; the reference's inputs
(``user_visit_action``, ``user_info``, ``product_info``, ``city_info``, the ad click log) are derived from them
by column expressions only, so every derived table scales with its source and keeps parquet pushdown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# How the test tables stand in for the reference's inputs (see FIXTURES.md §2).
N_PAGES = 10          # page_id = k % 10
N_CITIES = 25         # city_id = user_id % 25 (= nation key)
N_AGES = 60           # age = custkey % 60
N_ADS = 10            # ad_id = k % 10


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k(props="props"):
    return F.get_json_object(F.col(props), "$.k").try_cast("bigint")  # a malformed value → null, not a failed job


def ts_date_range(ts_col: str, start_date: str | None, end_date: str | None):
    """``start_date <= date(ts) <= end_date`` written on the raw timestamp, so parquet row groups are skipped
    (a filter on the derived ``date`` text cannot be pushed into the scan)."""
    cond = F.lit(True)
    if start_date is not None:
        cond = cond & (F.col(ts_col) >= F.to_timestamp_ntz(F.lit(start_date)))
    if end_date is not None:
        cond = cond & (F.col(ts_col) < F.to_timestamp_ntz(F.date_add(F.to_date(F.lit(end_date)), 1)))
    return cond


def user_visit_action(spark: SparkSession, sf_dir: str, start_date: str | None = None,
                      end_date: str | None = None) -> DataFrame:
    """The action fact table, one row per event (columns of ``USER_VISIT_ACTION``).

    Date bounds (``yyyy-MM-dd``, inclusive) are applied to the raw ``ts`` before projection, so they reach
    the parquet scan as pushed filters.
    """
    ev = read_table(spark, sf_dir, "events").where(ts_date_range("ts", start_date, end_date)).withColumn("k", _k())
    k = F.col("k")
    et = F.col("event_type")
    date = F.date_format(F.col("ts"), dates.FMT_DATE)
    prod = lambda x: (x * 7 + 3) % 100  # noqa: E731  product id of a category draw
    return ev.select(
        date.alias("date"),
        F.col("user_id"),
        F.concat(F.col("user_id").cast("string"), F.lit("_"), date).alias("session_id"),
        (k % N_PAGES).alias("page_id"),
        dates.trunc_second("ts").alias("action_time"),
        F.when(et == "view", F.concat(F.lit("kw"), (k % 10).cast("string"))).alias("search_keyword"),
        F.when(et == "click", k).alias("click_category_id"),
        F.when(et == "click", prod(k)).alias("click_product_id"),
        F.when(et == "purchase", F.concat(k.cast("string"), F.lit(","), ((k + 7) % 100).cast("string")))
        .alias("order_category_ids"),
        F.when(et == "purchase", F.concat(prod(k).cast("string"), F.lit(","), prod((k + 7) % 100).cast("string")))
        .alias("order_product_ids"),
        F.when(et == "signup", k.cast("string")).alias("pay_category_ids"),
        F.when(et == "signup", prod(k).cast("string")).alias("pay_product_ids"),
        (F.col("user_id") % N_CITIES).alias("city_id"),
        F.col("event_id"),
    )


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("username"),
        F.col("c_name").alias("name"),
        (F.col("c_custkey") % N_AGES).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.concat(F.lit("city"), F.col("c_nationkey").cast("string")).alias("city"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("male")).otherwise(F.lit("female")).alias("sex"),
    )


def city_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 nations ⋈ 5 regions: fixed size by the schema's definition, so safe to broadcast."""
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").cast("bigint").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.col("r_name").alias("area"),
    )


def product_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat(F.lit('{"product_status": '), (F.col("p_size") % 2).cast("string"), F.lit("}")).alias("extend_info"),
    )


def ad_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed ad clicks (``AD_CLICK`` plus ``event_id``): click events placed in a province (region) and city
    (nation) by ``user_id % 25``. Names lose spaces/underscores because the text log splits on them (D21)."""
    ev = read_table(spark, sf_dir, "events").where(F.col("event_type") == "click")
    geo = (read_table(spark, sf_dir, "nation").alias("n")
           .join(F.broadcast(read_table(spark, sf_dir, "region").alias("r")),
                 F.col("n.n_regionkey") == F.col("r.r_regionkey"))
           .select(F.col("n_nationkey").cast("bigint").alias("geo_key"),
                   F.regexp_replace("r_name", " ", "-").alias("province"),
                   F.regexp_replace("n_name", "_", "").alias("city")))
    ts = dates.trunc_second("ts")
    return (ev.join(F.broadcast(geo), (F.col("user_id") % N_CITIES) == F.col("geo_key"))
            .select(ts.alias("ts"), F.date_format(ts, dates.FMT_DATEKEY).alias("date"), "province", "city",
                    "user_id", (_k() % N_ADS).alias("ad_id"), "event_id"))


def ad_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ad clicks as raw text lines ``epoch_ms province city user_id ad_id`` (column ``value``)."""
    c = ad_clicks(spark, sf_dir)
    return c.select(F.concat_ws(" ", dates.epoch_millis("ts").cast("string"), "province", "city",
                                F.col("user_id").cast("string"), F.col("ad_id").cast("string")).alias("value"),
                    "event_id")
