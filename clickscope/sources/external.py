"""External sources: JDBC tables (SRC-4), Kafka (SRC-8, SRC-9) and the file stream used in their place.

Nothing here opens a connection by itself; the readers are declared and run on the executors. The Kafka connector is
not on the class path here, so the tests replay text files, which have the same ``value`` column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .segment_log import segment_stream


def jdbc_table(spark: SparkSession, url: str, table: str, user: str | None = None, password: str | None = None,
               driver: str | None = None, partition_column: str | None = None, lower: int | None = None,
               upper: int | None = None, num_partitions: int | None = None, fetchsize: int = 10_000) -> DataFrame:
    """SRC-4: a JDBC table; with ``partition_column`` the read is split into ``num_partitions`` range queries."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetchsize)
    for k, v in (("user", user), ("password", password), ("driver", driver)):
        if v is not None:
            r = r.option(k, v)
    if partition_column is not None:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions))
    return r.load()


def kafka_stream(spark: SparkSession, brokers: str, topics: str, starting_offsets: str = "latest",
                 fail_on_data_loss: bool = True, max_offsets_per_trigger: int | None = None) -> DataFrame:
    """SRC-8/9: Kafka topics (CSV list) as a ``value`` text column.

    Resume is owned by the query's ``checkpointLocation``: the first run starts at ``starting_offsets``
    (``earliest``/``latest``, the reference's ``auto.offset.reset``), later runs continue from the committed
    offsets. Stored offsets that are gone stop the query unless ``fail_on_data_loss=False`` allows the gap.
    """
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", brokers).option("subscribe", topics)
         .option("startingOffsets", starting_offsets).option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return r.load().selectExpr("CAST(value AS STRING) AS value")


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of text files arriving in ``path`` as a ``value`` column (the Kafka stand-in)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def ad_log_stream(spark: SparkSession, *, brokers: str | None = None, topics: str | None = None,
                  path: str | None = None, log: str | None = None, max_files_per_trigger: int | None = None,
                  group: str | None = None, starting_offsets: str = "latest", fail_on_data_loss: bool = True) -> DataFrame:
    """The ad log as a stream with a ``value`` column: from Kafka (``brokers`` and ``topics``), from a segment log (``log``,
    with the offsets of ``group``) or from the text files under ``path``. Exactly one of them is named; none stands in
    for another."""
    if bool(brokers and topics) + bool(path) + bool(log) != 1:
        raise ValueError("name either Kafka brokers and topics, or a segment log, or a file path, for the ad log stream")
    if path:
        return text_stream(spark, path, max_files_per_trigger)
    if log:
        return segment_stream(spark, log, starting_offsets, group, fail_on_data_loss)
    return kafka_stream(spark, brokers, topics, starting_offsets, fail_on_data_loss)
