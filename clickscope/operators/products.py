"""Area top-3 products (J3): SRC-2, JOIN-7, AGG-9, UDAF-1, FN-13, JOIN-8, FN-14, PRJ-5, WIN-1, PRJ-4, FLT-8."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..sources import scans
from .topn import group_top_n

# Area → level mapping for the test tables (region names stand in for the reference's areas;
# AFRICA, AMERICA → A; ASIA, EUROPE → B; everything else → D). Labels are the reference's.
DEFAULT_AREA_LEVELS = {"AFRICA": "A Level", "AMERICA": "A Level", "ASIA": "B Level", "EUROPE": "B Level"}
DEFAULT_LEVEL = "D Level"
SELF, THIRD_PARTY = "Self", "Third Party"


def click_city_join(actions: DataFrame, cities: DataFrame, start_date: str | None = None,
                    end_date: str | None = None) -> DataFrame:
    """SRC-2 + JOIN-7: click rows with their city and area. ``cities`` is the fixed-size city table."""
    clicks = scans.click_product_scan(actions, start_date, end_date)
    return clicks.join(F.broadcast(cities), "city_id").select(
        "city_id", "city_name", "area", F.col("click_product_id").alias("product_id"))


def area_product_clicks(click_city: DataFrame) -> DataFrame:
    """AGG-9: per (area, product): click count and the sorted distinct ``city_id:city_name`` list.

    One shuffle: ``count`` and ``collect_set`` both aggregate map-side; a set holds at most one entry per city.
    """
    info = text.concat_long_string(F.col("city_id"), F.col("city_name"), ":")
    return click_city.groupBy("area", "product_id").agg(
        F.count(F.lit(1)).alias("click_count"),
        F.array_join(F.array_sort(F.collect_set(info)), ",").alias("city_infos"))


def product_status(extend_info) -> F.Column:
    """PRJ-5 + FN-14: ``Self`` when the JSON field ``product_status`` is ``0``, else (null too) ``Third Party``."""
    return text.if_else(text.json_field(extend_info, "product_status") == "0", SELF, THIRD_PARTY)


def area_top_products(area_clicks: DataFrame, products: DataFrame, n: int = 3, task_id: int | None = None,
                      area_levels: dict | None = None, default_level: str = DEFAULT_LEVEL) -> DataFrame:
    """JOIN-8 → row_number per area (ties: product id) ≤ n → area level.

    The product table grows with the data, so no broadcast hint: AQE broadcasts it only when its measured
    size is under the threshold. Products without a product row drop out before ranking (inner join).
    """
    full = area_clicks.join(products, "product_id").select(
        "area", "product_id", "click_count", "city_infos", "product_name",
        product_status(F.col("extend_info")).alias("product_status"))
    top = group_top_n(full, ["area"], [F.desc("click_count"), F.asc("product_id")], n)
    level = text.case_map(F.col("area"), area_levels or DEFAULT_AREA_LEVELS, default_level)
    cols = ["area", level.alias("area_level"), "product_id", "city_infos", "click_count", "product_name",
            "product_status"]
    if task_id is not None:
        cols = [F.lit(task_id).cast("bigint").alias("task_id"), *cols]
    return top.select(*cols)
