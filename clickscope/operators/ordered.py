"""Previous row within a group by a total order (WIN-2, TOP-5), without putting a whole group in one task.

A hash-partitioned ``lag() OVER (PARTITION BY g ORDER BY o)`` needs every row of a group in one task, so one
hot group (a bot session) becomes one huge task. Here a group is cut into chunks by a column expression that
never decreases along the order (the hour of the row's time, say). The window runs per (group, chunk); only the
first row of a chunk has its predecessor elsewhere, and that predecessor is the last row of the group's previous
chunk. Those last rows come from one partial aggregate over the same input (one row per group and chunk), so the
work is one window pass and one aggregate pass, whatever the sizes and the skew: no sample, no count, no driver.

The chunk is a plain function of the row, so every evaluation, including recomputation after a lost executor,
cuts alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def previous_in_order(df: DataFrame, group_cols: list[str], order_cols: list[str], value_cols: list[str],
                      chunk: Column, prefix: str = "prev_") -> DataFrame:
    """Add ``prefix + v`` = ``v`` of the preceding row of the same group (null on a group's first row).

    ``order_cols`` must make the order total inside a group (end with a unique id). ``chunk`` must not decrease
    along that order, nulls first; it decides how finely a group is spread, never the result. Null groups form one
    group. The key is one struct, so null fields compare equal and the window's partitioning serves the join too.
    """
    keyed = df.withColumn("_key", F.struct(*group_cols, chunk.alias("_chunk")))
    w = Window.partitionBy("_key").orderBy(*order_cols)
    lagged = keyed.select("*", *[F.lag(v).over(w).alias(prefix + v) for v in value_cols],
                          (F.row_number().over(w) == 1).alias("_head"))

    last = F.max_by(F.struct(*value_cols), F.struct(*order_cols))
    tails = keyed.groupBy("_key").agg(last.alias("_last"))
    across = Window.partitionBy(*[F.col("_key")[g] for g in group_cols]).orderBy(F.col("_key")["_chunk"])
    before = tails.select("_key", F.lag("_last").over(across).alias("_before"))

    joined = lagged.join(before.where(F.col("_before").isNotNull()), "_key", "left")
    fixed = [F.when(F.col("_head"), F.col("_before")[v]).otherwise(F.col(prefix + v)).alias(prefix + v)
             for v in value_cols]
    return joined.select(*df.columns, *fixed)
