"""Upsert sinks as batch-tagged log tables (SNK-1 … SNK-5), without a table-format library.

Every write adds the rows of one batch under ``…/<partition cols>/batch_id=<n>/`` with dynamic partition
overwrite, so re-running batch ``n`` (a retried stream batch, a re-run job) replaces exactly its own files:
writes are idempotent. What "upsert" means is decided when reading:

* increment (SNK-3): value = sum over batches;
* replace (SNK-4): value = the one from the latest batch that wrote the key;
* replace group (SNK-5): a group's rows = the rows of the latest batch that wrote the group;
* append (SNK-1/2): all rows.

Reads can stop at a batch (``upto``) so a batch computes from the state before itself, and partition columns
(``date``) prune whole directories.

Running totals live in the streaming query's state (:mod:`clickscope.streaming.ad_state`); no batch reads these tables. They
grow by the changed rows of each batch; a table for readers alone is written from the state (``AdState.publish``) or from
one read of the log, under a path of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

BATCH = "batch_id"


class LogTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, partition_cols: tuple[str, ...] = (),
                 derived: dict[str, str] | None = None):
        """``schema``: the row columns (without ``batch_id``). ``partition_cols`` are some of them, or names in ``derived``: text
        made from the row columns by a SQL expression, of folders that hold more than one value (the months of a date)."""
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.partition_cols = tuple(partition_cols)
        self.derived = dict(derived or {})

    @property
    def full_schema(self) -> T.StructType:
        parts = [T.StructField(name, T.StringType()) for name in self.derived]
        return T.StructType([*self.schema.fields, *parts, T.StructField(BATCH, T.LongType(), False)])

    def write(self, df: DataFrame, batch_id: int) -> None:
        cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        parts = [F.expr(e).cast("string").alias(name) for name, e in self.derived.items()]
        (df.select(*cols, *parts, F.lit(int(batch_id)).cast("bigint").alias(BATCH))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*self.partition_cols, BATCH).parquet(self.path))

    def _read(self, col: str | None, values: list[str] | None) -> DataFrame | None:
        """The table's rows; only the directories of ``values`` when given; None if there are none."""
        reader, path = self.spark.read.schema(self.full_schema), self.path
        if values is not None:
            path = f"{path}/{col}={{{','.join(str(v) for v in values)}}}"
            reader = reader.option("basePath", self.path)
        try:
            return reader.parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":  # only what nobody has written yet reads as empty
                raise
            return None

    def read_log(self, upto: int | None = None, where=None, partitions: dict | None = None) -> DataFrame:
        """The rows of all batches (``batch_id <= upto`` when given). Partition columns keep their declared types.

        ``partitions`` (``{"date": [...]}`` on the first partition column) lists only those directories, so
        a reader does not enumerate the whole table.
        """
        (col, values), = (partitions or {None: None}).items()
        df = None if values is not None and not values else self._read(col, values)
        if df is None:
            df = self.spark.createDataFrame([], self.full_schema)
        if upto is not None:
            df = df.where(F.col(BATCH) <= F.lit(int(upto)))
        if where is not None:
            df = df.where(where)
        return df


def increment_upsert(table: LogTable, delta: DataFrame, batch_id: int) -> None:
    """SNK-3: ``value = value + delta`` per key (stored as the batch's delta rows)."""
    table.write(delta, batch_id)


def read_increment(table: LogTable, keys: list[str], value_cols: list[str], upto: int | None = None,
                   where=None, partitions: dict | None = None) -> DataFrame:
    """Current totals per key: sum of every batch's delta (partial sums per task, one shuffle)."""
    return table.read_log(upto, where, partitions).groupBy(*keys).agg(
        *[F.sum(c).cast("bigint").alias(c) for c in value_cols])


def replace_upsert(table: LogTable, rows: DataFrame, batch_id: int) -> None:
    """SNK-4: ``value = new value`` per key."""
    table.write(rows, batch_id)


def read_replace(table: LogTable, keys: list[str], value_cols: list[str], upto: int | None = None,
                 where=None) -> DataFrame:
    """Latest value per key (``max_by`` on the batch id, an aggregate with map-side partials)."""
    latest = F.max_by(F.struct(*value_cols), F.col(BATCH)).alias("_v")
    return table.read_log(upto, where).groupBy(*keys).agg(latest).select(*keys, *[F.col("_v." + c).alias(c)
                                                                                  for c in value_cols])


def replace_group(table: LogTable, rows: DataFrame, batch_id: int) -> None:
    """SNK-5: delete the groups present in ``rows``, insert ``rows``."""
    table.write(rows, batch_id)


def read_group(table: LogTable, group_keys: list[str], upto: int | None = None, where=None) -> DataFrame:
    """Rows of the latest batch per group: latest batch id per group (partial max), then a join back."""
    log = table.read_log(upto, where)
    last = log.groupBy(*group_keys).agg(F.max(BATCH).alias(BATCH))
    cols = [f.name for f in table.schema.fields]
    return log.join(last, [*group_keys, BATCH], "left_semi").select(*cols)


def append_rows(table: LogTable, rows: DataFrame, batch_id: int) -> None:
    """SNK-1 / SNK-2: append (idempotent per batch id)."""
    table.write(rows, batch_id)


def read_append(table: LogTable, upto: int | None = None, where=None) -> DataFrame:
    return table.read_log(upto, where).select(*[f.name for f in table.schema.fields])
