"""SRC-1: the fact table stored by session and day, so that session jobs read it without a shuffle.

``write_by_session`` writes one sorted file per bucket of (session_id, date) and enters the table in the session's catalog.
What needs the rows of a session together then finds those of a day in one task already:

* the session aggregate (AGG-1) adds up per (session, day) at the scan and shuffles only these rows;
* the semi join of JOIN-2 takes the days of the wanted sessions to the buckets;
* the predecessor of WIN-2 is a window per (session, day); a day's first row takes the last one of the session's day before,
  from one small row per session and day.

A session is cut at midnight, so a hot one spreads over its days; its bound is the rows of one session and day in a task. The
number of buckets is the table's parallelism: about its bytes / 200 MB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates
from ..operators.sessions import DETAIL_COLUMNS

KEYS = ["session_id", "date"]
ORDER = ["action_time", "event_id"]


def write_by_session(actions: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    """Store ``actions`` under ``path`` as ``table``; returns the stored table. The shuffle before the write deals as buckets
    do, so a bucket is one file."""
    (actions.repartition(buckets, *KEYS).write.mode("overwrite").option("path", path)
     .bucketBy(buckets, *KEYS).sortBy(*KEYS, *ORDER).saveAsTable(table))
    return actions.sparkSession.table(table)


def session_days(fact: DataFrame) -> DataFrame:
    """AGG-1 per (session, day), at the scan."""
    return fact.groupBy(*KEYS).agg(F.min("user_id").alias("user_id"), F.min("action_time").alias("first"),
                                   F.max("action_time").alias("last"), F.count(F.lit(1)).alias("steps"))


def session_measures(fact: DataFrame) -> DataFrame:
    """AGG-1 without lists, as :func:`clickscope.operators.sessions.session_measures`, from one small row per session and
    day."""
    whole = session_days(fact).groupBy("session_id").agg(
        F.min("user_id").alias("user_id"), F.min("first").alias("start_time"), F.max("last").alias("end_time"),
        F.sum("steps").alias("step_length"))
    return whole.select("session_id", "user_id", dates.seconds_between("end_time", "start_time").alias("visit_length"),
                        "step_length", "start_time")


def session_detail(fact: DataFrame, sessions: DataFrame) -> DataFrame:
    """JOIN-2: the action rows of ``sessions``; their days go to the buckets, the facts stay."""
    wanted = session_days(fact).select(*KEYS).join(sessions.select("session_id"), "session_id", "left_semi")
    return fact.join(wanted, KEYS, "left_semi").select(*DETAIL_COLUMNS, "event_id")


def page_pairs(fact: DataFrame) -> DataFrame:
    """WIN-2 + TOP-5 as :func:`clickscope.operators.pages.page_pairs`. Rows without session id have no predecessor here, as
    they are no session."""
    line = Window.partitionBy(*KEYS).orderBy(*ORDER)
    rows = fact.where(F.col("session_id").isNotNull()).select(*KEYS, "page_id", *ORDER)
    lagged = rows.select("*", F.lag("page_id").over(line).alias("_prev"), (F.row_number().over(line) == 1).alias("_head"))
    tails = rows.groupBy(*KEYS).agg(F.max_by("page_id", F.struct(*ORDER)).alias("_tail"))
    before = tails.select(*KEYS, F.lag("_tail").over(Window.partitionBy("session_id").orderBy("date")).alias("_before"))
    joined = lagged.join(before.where(F.col("_before").isNotNull()), KEYS, "left")
    prev = F.when(F.col("_head"), F.col("_before")).otherwise(F.col("_prev"))
    return (joined.withColumn("prev_page_id", prev).where(F.col("prev_page_id").isNotNull())
            .select("session_id", "prev_page_id", "page_id", *ORDER))


def drop(spark: SparkSession, table: str) -> None:
    """Take the table out of the catalog; its files stay under their path."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
