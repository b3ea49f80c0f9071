"""Top-n clicked products per sales area, one plan from scan to ``rank <= n``."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import products


def area_top3_job(actions: DataFrame, cities: DataFrame, product_table: DataFrame, start_date: str | None,
                  end_date: str | None, task_id: int, n: int = 3, area_levels: dict | None = None) -> DataFrame:
    click_city = products.click_city_join(actions, cities, start_date, end_date)
    counts = products.area_product_clicks(click_city)
    return products.area_top_products(counts, product_table, n, task_id, area_levels)
