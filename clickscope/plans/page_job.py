"""Page one-step conversion rates along a target page flow."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import pages
from ..sources.scans import date_range_scan


def run_page_job(spark: SparkSession, actions: DataFrame, flow: list[int], start_date: str | None,
                 end_date: str | None, task_id: int) -> DataFrame:
    """One row ``task_id, convert_rate`` (``a_b=rate|…``)."""
    scoped = date_range_scan(actions, start_date, end_date)
    split_pv = pages.page_split_pv(pages.page_pairs(scoped), flow)
    rates = pages.convert_rates(spark, split_pv, pages.start_page_pv(scoped, flow), flow)
    return pages.convert_rate_text(rates, task_id)
