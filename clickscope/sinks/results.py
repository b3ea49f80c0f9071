"""Result-table sinks for the batch jobs (SNK-1, SNK-2).

The reference inserts rows into MySQL tables keyed by ``task_id``. Here a job's outputs are written once, at
the end of the plan (D12): parquet tables partitioned by ``task_id`` (a re-run of a task replaces its own
partition only), or a JDBC table through Spark's batched writer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_result(df: DataFrame, path: str, partition_by_task: bool = True) -> None:
    """SNK-1: write a job output; with ``task_id`` partitions, re-running a task overwrites only that task.

    An empty output writes no partition (no files): read such a table back with an explicit schema.
    """
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if partition_by_task and "task_id" in df.columns:
        w = w.partitionBy("task_id")
    w.parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, user: str | None = None, password: str | None = None,
               driver: str | None = None, batchsize: int = 1000, num_partitions: int | None = None,
               mode: str = "append") -> None:
    """SNK-2: batched JDBC insert from the executors (``batchsize`` rows per statement batch)."""
    out = df.coalesce(num_partitions) if num_partitions else df
    w = out.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table).option("batchsize", batchsize)
    for k, v in (("user", user), ("password", password), ("driver", driver)):
        if v is not None:
            w = w.option(k, v)
    w.save()
