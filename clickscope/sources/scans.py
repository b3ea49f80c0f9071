"""Fact-table scans (SRC-1, SRC-2, SRC-3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def date_range_scan(actions: DataFrame, start_date: str | None, end_date: str | None) -> DataFrame:
    """SRC-1: rows with ``start_date <= date <= end_date`` (``yyyy-MM-dd`` text, both ends inclusive).

    A missing bound leaves that side open. On a fact table written ``partitionBy('date')`` this is a
    partition-pruning filter; on plain parquet it is a pushed-down predicate.
    """
    cond = F.lit(True)
    if start_date is not None:
        cond = cond & (F.col("date") >= F.lit(start_date))
    if end_date is not None:
        cond = cond & (F.col("date") <= F.lit(end_date))
    return actions.where(cond)


def scoped_actions(spark, sf_dir: str, start_date: str | None, end_date: str | None) -> DataFrame:
    """SRC-1 on the derived action table, with the bounds also pushed to the raw scan."""
    from .tables import user_visit_action
    return date_range_scan(user_visit_action(spark, sf_dir, start_date, end_date), start_date, end_date)


def click_product_scan(actions: DataFrame, start_date: str | None, end_date: str | None) -> DataFrame:
    """SRC-2: ``city_id, click_product_id`` of click rows in the date range (projection + filter at the scan)."""
    return (date_range_scan(actions, start_date, end_date)
            .where(F.col("click_product_id").isNotNull())
            .select("city_id", "click_product_id"))


def write_fact_partitioned(actions: DataFrame, path: str) -> None:
    """Store the fact table partitioned by ``date`` so :func:`date_range_scan` prunes whole directories."""
    actions.write.mode("overwrite").partitionBy("date").parquet(path)
