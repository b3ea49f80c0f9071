"""Visit-length and step-length buckets (FN-17, FN-18) and the session histogram columns (AGG-2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket names and inclusive bounds of the reference's session statistics.
# Visit length in seconds: 1-3, 4-6, 7-9, 10-30, 31-60, 61-180, 181-600, 601-1800, above 1800. Zero falls in none.
VISIT_BUCKETS = (
    ("1s_3s", 1, 3),
    ("4s_6s", 4, 6),
    ("7s_9s", 7, 9),
    ("10s_30s", 10, 30),
    ("30s_60s", 31, 60),
    ("1m_3m", 61, 180),
    ("3m_10m", 181, 600),
    ("10m_30m", 601, 1800),
    ("30m", 1801, None),
)
# Step length in actions: 1-3, 4-6, 7-9, 10-30, 31-60, above 60.
STEP_BUCKETS = (
    ("1_3", 1, 3),
    ("4_6", 4, 6),
    ("7_9", 7, 9),
    ("10_30", 10, 30),
    ("30_60", 31, 60),
    ("60", 61, None),
)


def scaled(buckets, factor: int):
    """Same bucket names with bounds multiplied (``x1200`` makes second buckets fit hour-long sessions)."""
    out = []
    for name, lo, hi in buckets:
        out.append((name, (lo - 1) * factor + 1, None if hi is None else hi * factor))
    return tuple(out)


def in_bucket(c, lo: int, hi: int | None) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return (col >= lo) if hi is None else col.between(lo, hi)


def bucket_label(c, buckets) -> Column:
    """Name of the bucket holding ``c``; null when none does."""
    out = None
    for name, lo, hi in buckets:
        cond = in_bucket(c, lo, hi)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out


def visit_length_bucket(c) -> Column:
    return bucket_label(c, VISIT_BUCKETS)


def step_length_bucket(c) -> Column:
    return bucket_label(c, STEP_BUCKETS)
