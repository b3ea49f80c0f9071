"""Numeric helpers (FN-7, FN-23)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio_half_up(num, den, scale: int = 2) -> Column:
    """``num / den`` rounded half-up to ``scale`` decimals, computed on the exact fraction.

    ``floor((2·10^s·n + d) / (2·d)) / 10^s``: integer operands make the half-way cases exact, so Spark and
    DuckDB agree bit for bit (plain ``round`` on a double does not). Zero or null denominator → null.
    """
    n = _c(num).cast("double")
    d = _c(den).cast("double")
    p = float(10 ** scale)
    q = F.floor((n * F.lit(2.0 * p) + d) / (d * F.lit(2.0))) / F.lit(p)
    return F.when(d != 0, q.cast("double"))


def round_half_up(x, scale: int = 2) -> Column:
    """FN-7 for plain doubles (decimal half-up on the printed value)."""
    return F.round(_c(x), scale)


def to_long(c) -> Column:
    """FN-23: text/number → BIGINT, bad text → null."""
    return F.trim(_c(c).cast("string")).try_cast("bigint")
