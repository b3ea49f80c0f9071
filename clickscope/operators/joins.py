"""Join strategies: size-checked broadcast (JOIN-10), salt-and-expand (JOIN-12), hot-key split (JOIN-11),
two-stage salted aggregate (AGG-10/11), union of parts (SET-2).

Spark already does most of this (AQE broadcast conversion, AQE skew-join splitting, partial aggregation);
these operators are for the cases it cannot cover (a join type AQE will not split, a holistic aggregate).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest side broadcast by :func:`broadcast_if_bounded` unless a caller passes its own bounds.
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 64 << 20


def bounded(df: DataFrame, max_rows: int, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and these, written as text, at most ``max_bytes``; reads at most
    ``max_rows + 1`` of them."""
    size = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    n, total = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return n <= max_rows and total <= max_bytes


def broadcast_if_bounded(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                         max_bytes: int = DEFAULT_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """JOIN-10: broadcast hint only after a proven bound on rows and bytes; otherwise the plain (shuffled) side."""
    if bounded(df, max_rows, max_bytes):
        return F.broadcast(df), True
    return df, False


def broadcast_join(left: DataFrame, right: DataFrame, on, how: str = "inner",
                   max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Map-side join when ``right`` is proven small, else a shuffled join that AQE may still convert."""
    r, _ = broadcast_if_bounded(right, max_rows)
    return left.join(r, on, how)


SALTABLE = ("inner", "left", "left_outer", "left_semi", "left_anti")


def _check_how(how: str) -> None:
    """Copies of the right side would come out once per salt in a right or full join."""
    if how not in SALTABLE:
        raise ValueError(f"a salted join must be one of {SALTABLE}")


def _salt_range(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_salt")


def salt(n: int, salt_col: str | None = None, seed: int = 7) -> Column:
    """Salt in ``[0, n)``: a hash of a unique column when there is one (the same value on every recomputation,
    so a retried stage is not indeterminate), else ``rand(seed)``."""
    if salt_col is not None:
        return F.pmod(F.xxhash64(F.col(salt_col)), F.lit(n)).cast("int")
    return F.floor(F.rand(seed) * n).cast("int")


def salted_join(big: DataFrame, small: DataFrame, key: str, n: int = 10, seed: int = 7,
                how: str = "inner", salt_col: str | None = None) -> DataFrame:
    """JOIN-12: salt 0..n-1 on ``big``; ``small`` copied once per salt value (``sequence``, not random, so
    every salt finds its match: decision D24). Equal to ``big.join(small, key, how)`` for inner/left.

    Both sides are shuffled and sorted, which spills: the size that Spark estimates for the copies of ``small`` is that of one,
    so without the hint it would broadcast ``n`` times what its limit allows."""
    _check_how(how)
    b = big.withColumn("_salt", salt(n, salt_col, seed))
    s = small.select("*", _salt_range(n)).hint("merge")
    return b.join(s, [key, "_salt"], how).drop("_salt")


def hot_keys(df: DataFrame, key: str, fraction: float = 0.1, seed: int = 9, top: int = 1) -> DataFrame:
    """The ``top`` most frequent keys of a Bernoulli sample (TOP-7 + AGG-6): ``key, sample_count``.

    The result has at most ``top`` rows, so it is safe to broadcast.
    """
    s = df.sample(False, fraction, seed).where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("sample_count"))
    return s.orderBy(F.desc("sample_count"), F.asc(key)).limit(top)


def skew_join(left: DataFrame, right: DataFrame, key: str, fraction: float = 0.1, seed: int = 9,
              top: int = 1, n_salts: int = 100, how: str = "inner", salt_col: str | None = None) -> DataFrame:
    """JOIN-11: split the sampled hot keys off ``left``, join them salted against ``right`` copied ``n_salts``
    times, join the rest plainly, union both parts (SET-2). Same rows as ``left.join(right, key, how)``
    for ``how`` in inner/left.

    The hot keys (at most ``top`` values) come to the driver once and split both sides with literal ``IN``
    filters, so the sample is not recomputed per branch.
    """
    _check_how(how)
    hot = [r[0] for r in hot_keys(left, key, fraction, seed, top).collect()]  # at most ``top`` values
    if not hot:
        return left.join(right, key, how)
    is_hot = F.col(key).isin(hot)
    part_hot = salted_join(left.where(is_hot), right.where(is_hot), key, n_salts, seed, how, salt_col)
    part_rest = left.where(~is_hot | F.col(key).isNull()).join(right.where(~is_hot), key, how)
    return part_hot.unionByName(part_rest)


def salted_agg(df: DataFrame, keys: list[str], n: int = 10, seed: int = 11,
               count_col: str = "cnt", sum_cols: dict[str, str] | None = None,
               salt_col: str | None = None) -> DataFrame:
    """AGG-10/11: two-stage aggregate; stage 1 groups by ``keys + salt``, stage 2 by ``keys``.

    ``sum_cols`` maps output name → input column. Stage 2 sums the partial counts (the reference's commented
    SQL used ``count`` there, which is wrong).
    """
    sum_cols = sum_cols or {}
    salted = df.withColumn("_salt", salt(n, salt_col, seed))
    stage1 = salted.groupBy(*keys, "_salt").agg(
        F.count(F.lit(1)).alias(count_col), *[F.sum(c).alias(o) for o, c in sum_cols.items()])
    return stage1.groupBy(*keys).agg(
        F.sum(count_col).cast("bigint").alias(count_col), *[F.sum(o).alias(o) for o in sum_cols])


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)
