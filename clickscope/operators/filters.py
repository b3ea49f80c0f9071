"""Session filters (FLT-1 … FLT-5) with the reference's null rules, as boolean Columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import SessionParams


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def between(c, lo, hi) -> Column:
    """FLT-1: applies only when both bounds are given; a null value fails."""
    if lo is None or hi is None:
        return F.lit(True)
    return F.coalesce(_c(c).between(lo, hi), F.lit(False))


def in_list(c, values) -> Column:
    """FLT-2, scalar field: absent parameter passes; null field fails."""
    if values is None:
        return F.lit(True)
    return F.coalesce(_c(c).isin(list(values)), F.lit(False))


def overlaps(arr, values, element_type: str = "string") -> Column:
    """FLT-2, list field: any element equals any parameter value; null/empty field fails."""
    if values is None:
        return F.lit(True)
    lits = F.array(*[F.lit(v).try_cast(element_type) for v in values]) if values else F.array().cast(
        f"array<{element_type}>")
    return F.coalesce(F.arrays_overlap(_c(arr), lits), F.lit(False))


def equal(c, value) -> Column:
    """FLT-3: absent parameter passes; null field fails."""
    if value is None:
        return F.lit(True)
    return F.coalesce(_c(c) == F.lit(value), F.lit(False))


def _hit(sessions: DataFrame, flag: str, list_col: str, values, element_type: str) -> Column:
    """FLT-2 on a list field: by the aggregate's flag where it was computed, else by the list."""
    if values is not None and flag in sessions.columns:
        return F.coalesce(F.col(flag), F.lit(False))
    return overlaps(list_col, values, element_type)


def session_predicate(sessions: DataFrame, p: SessionParams) -> Column:
    """FLT-4: the conjunction over the optional parameters (columns of the session aggregate)."""
    preds = [
        between("age", p.start_age, p.end_age),
        in_list("professional", p.professionals),
        in_list("city", p.cities),
        equal("sex", p.sex),
        _hit(sessions, "keyword_hit", "search_keyword_list", p.keywords, "string"),
        _hit(sessions, "category_hit", "click_category_list", p.category_ids, "bigint"),
    ]
    return reduce(lambda a, b: a & b, preds)


def filter_sessions(sessions: DataFrame, p: SessionParams) -> DataFrame:
    return sessions.where(session_predicate(sessions, p)).drop("keyword_hit", "category_hit")


def action_type(kind: str) -> Column:
    """FLT-5: a row *is* a click/order/pay when its column is set (blank CSV counts as unset, D8)."""
    if kind == "click":
        return F.col("click_category_id").isNotNull()
    col = {"order": "order_category_ids", "pay": "pay_category_ids"}[kind]
    return F.col(col).isNotNull() & (F.trim(F.col(col)) != "")
