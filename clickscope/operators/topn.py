"""Group-wise top-n (WIN-1, WIN-3, WIN-4, WIN-5, FLT-8) and global top-n (TOP-1, TOP-2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_SALTS = 64


def group_top_n(df: DataFrame, group_cols: list[str], order_cols: list[Column], n: int, rank_col: str = "rank",
                salt_col: str | None = None, salts: int = DEFAULT_SALTS) -> DataFrame:
    """``row_number() OVER (PARTITION BY group ORDER BY order) <= n``.

    ``order_cols`` must end in a unique tie-breaker (D5). Spark limits a group's rows before the shuffle for small ``n``, so
    a hot group sends at most ``n`` rows per map task. For an ``n`` of any size give ``salt_col``: the ranking then runs in two
    exact stages, top-n inside ``(group, hash(salt_col) % salts)``, then top-n of the survivors (at most ``salts × n`` rows per
    group) — a hot group is sorted in ``salts`` pieces, never whole in one task.
    """
    if salt_col is not None:
        salt = F.pmod(F.xxhash64(F.col(salt_col)), F.lit(salts))
        w1 = Window.partitionBy(*group_cols, salt).orderBy(*order_cols)
        df = df.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= F.lit(n)).drop("_r1")
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= F.lit(n))


def top_n(df: DataFrame, order_cols: list[Column], n: int) -> DataFrame:
    """Global ``ORDER BY … LIMIT n`` (planned as ``TakeOrderedAndProject``: per-task top-n, then merge)."""
    return df.orderBy(*order_cols).limit(n)


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int = 0) -> DataFrame:
    """TOP-7: Bernoulli sample by a hash of ``key``: a row stays if the first 32 bits of ``md5(seed|key)`` lie below the
    fraction. The same rows on every run, in any partitioning and in any engine; rows that share a key stay or go together,
    and a larger fraction keeps all rows of a smaller one. A null key counts as empty text."""
    if not 0 <= fraction <= 1:
        raise ValueError("fraction must be between 0 and 1")
    text = F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return df.where(draw < F.lit(int(fraction * 2 ** 32)))
