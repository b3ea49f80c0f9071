"""Helpers shared by the corpus operators: clash-free column names, lineage cuts, distributed ranks."""

from __future__ import annotations

import gc
import time
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import checkpoint_root, materialize

# ASCII white space of the contracts: space and \t \n \v \f \r
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Internal column names that clash with no column of ``df`` (column names are case-insensitive)."""
    used = {c.lower() for c in df.columns}
    out = []
    for n in names:
        c = f"_{n}"
        while c.lower() in used:
            c = "_" + c
        used.add(c.lower())
        out.append(c)
    return out


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def cut(df: DataFrame) -> DataFrame:
    """Lineage cut for slim intermediates read more than once: ``checkpoint()`` into the shared folder."""
    return materialize(df)


def free_finished_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished plans, after a lineage cut whose result doesn't need them.

    The cleaner acts on plans that neither Python nor the JVM holds any more, as often as the JVM collects its garbage
    (every half hour by default), which is too seldom for a job whose next step shuffles whole texts.
    """
    for _ in range(2):  # Python's references go first; the JVM notices them a moment later
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Queries run inside drop their shuffle files when they end (a retry within a query still has them)."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shared_folder(spark: SparkSession, kind: str) -> str:
    """A new folder name under the shared root (``spark.checkpoint.dir``)."""
    return f"{checkpoint_root(spark)}/{kind}-{uuid.uuid4().hex}"


def word_count(text: Column) -> Column:
    """Number of runs of non-space characters; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def utf8_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")


def nonnull_key(col: Column) -> Column:
    """A string key that keeps null apart from every value, so that plain equality joins keep null groups."""
    return F.when(col.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), col.cast("string")))


def gapless_rank(df: DataFrame, key: str, coarse: str, fine: str, order: list[Column], out: str) -> DataFrame:
    """``out`` = 1, 2, 3, … within ``key`` in the order (coarse, fine, *order), without sorting a key in one task.

    Rows are counted per (key, coarse, fine) cell; cell offsets are running sums over the ``fine`` cells of one
    (key, coarse) and over the ``coarse`` cells of one key (both bounded by the number of cells, not of rows);
    rows are numbered inside their cell only. All three columns must be non-null.
    """
    off, n = fresh(df, "off", "n")
    cells = df.groupBy(key, coarse, fine).agg(F.count(F.lit(1)).alias(n))
    zero = F.lit(0).cast("bigint")
    total = "_coarse" + off
    w_coarse = Window.partitionBy(key).orderBy(coarse).rowsBetween(Window.unboundedPreceding, -1)
    coarse_off = (cells.groupBy(key, coarse).agg(F.sum(n).alias(n))
                  .select(key, coarse, F.coalesce(F.sum(n).over(w_coarse), zero).alias(total)))
    w_fine = Window.partitionBy(key, coarse).orderBy(fine).rowsBetween(Window.unboundedPreceding, -1)
    fine_off = cells.select(key, coarse, fine, F.coalesce(F.sum(n).over(w_fine), zero).alias(off))
    offsets = (fine_off.join(coarse_off, [key, coarse])
               .select(key, coarse, fine, (F.col(off) + F.col(total)).alias(off)))
    ranked = df.withColumn(out, F.row_number().over(Window.partitionBy(key, coarse, fine).orderBy(*order)))
    cols = [F.col(quoted(c)) for c in df.columns]
    return (ranked.join(offsets, [key, coarse, fine])
            .select(*cols, (F.col(out) + F.col(off)).cast("bigint").alias(out)))
