import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickscope.sinks import log_tables as lt
from helpers import rows_set

SCHEMA = T.StructType([T.StructField("date", T.StringType()), T.StructField("k", T.StringType()),
                       T.StructField("v", T.LongType())])


def test_increment_is_idempotent_per_batch(spark, tmp_root):
    t = lt.LogTable(spark, f"{tmp_root}/inc", SCHEMA, ("date",))
    assert lt.read_increment(t, ["date", "k"], ["v"]).count() == 0
    d0 = spark.createDataFrame([("20240101", "a", 1), ("20240101", "b", 2)], SCHEMA)
    d1 = spark.createDataFrame([("20240101", "a", 5), ("20240102", "c", 1)], SCHEMA)
    lt.increment_upsert(t, d0, 0)
    lt.increment_upsert(t, d1, 1)
    lt.increment_upsert(t, d1, 1)  # D12: a replayed batch changes nothing
    assert rows_set(lt.read_increment(t, ["date", "k"], ["v"])) == [("20240101", "a", 6), ("20240101", "b", 2),
                                                                    ("20240102", "c", 1)]
    assert rows_set(lt.read_increment(t, ["date", "k"], ["v"], upto=0)) == [("20240101", "a", 1),
                                                                             ("20240101", "b", 2)]
    # partition types survive (yyyyMMdd stays text)
    assert dict(lt.read_increment(t, ["date", "k"], ["v"]).dtypes)["date"] == "string"


def test_replace_and_group(spark, tmp_root):
    t = lt.LogTable(spark, f"{tmp_root}/rep", SCHEMA, ("date",))
    lt.replace_upsert(t, spark.createDataFrame([("d", "a", 1), ("d", "b", 2)], SCHEMA), 0)
    lt.replace_upsert(t, spark.createDataFrame([("d", "a", 7)], SCHEMA), 1)
    assert rows_set(lt.read_replace(t, ["date", "k"], ["v"])) == [("d", "a", 7), ("d", "b", 2)]
    g = lt.LogTable(spark, f"{tmp_root}/grp", SCHEMA, ("date",))
    lt.replace_group(g, spark.createDataFrame([("d1", "a", 1), ("d1", "b", 2), ("d2", "x", 3)], SCHEMA), 0)
    lt.replace_group(g, spark.createDataFrame([("d1", "c", 9)], SCHEMA), 1)
    assert rows_set(lt.read_group(g, ["date"])) == [("d1", "c", 9), ("d2", "x", 3)]


def test_append(spark, tmp_root):
    t = lt.LogTable(spark, f"{tmp_root}/app", SCHEMA, ())
    lt.append_rows(t, spark.createDataFrame([("d", "a", 1)], SCHEMA), 0)
    lt.append_rows(t, spark.createDataFrame([("d", "b", 1)], SCHEMA), 1)
    assert rows_set(lt.read_append(t)) == [("d", "a", 1), ("d", "b", 1)]



def test_read_selected_partitions(spark, tmp_root):
    t = lt.LogTable(spark, f"{tmp_root}/sel", SCHEMA, ("date",))
    lt.increment_upsert(t, spark.createDataFrame([("20240101", "a", 1), ("20240102", "b", 2)], SCHEMA), 0)
    got = lt.read_increment(t, ["date", "k"], ["v"], partitions={"date": ["20240102", "20240109"]})
    assert rows_set(got) == [("20240102", "b", 2)]
    assert lt.read_increment(t, ["date", "k"], ["v"], partitions={"date": ["20240109"]}).count() == 0
    assert lt.read_increment(t, ["date", "k"], ["v"], partitions={"date": []}).count() == 0


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_replayed_batches_keep_totals_under_either_overwrite_mode(spark, tmp_root, mode):
    """A write that dies and is repeated leaves the other batches and dates alone."""
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        t = lt.LogTable(spark, f"{tmp_root}/replay-{mode}", SCHEMA, ("date",))
        rows = lambda i: spark.createDataFrame([("d", "a", i + 1), ("e", "b", 1), (None, "n", 1)], SCHEMA)
        for i in range(5):
            lt.increment_upsert(t, rows(i), i)
        lost = rows(3).withColumn("v", F.when(F.col("date") == "e", F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
        with pytest.raises(Exception):  # noqa: B017
            lt.increment_upsert(t, lost, 3)
        lt.increment_upsert(t, rows(3), 3)
        key = lambda r: str(r)  # noqa: E731 - a null date sorts as text
        got = sorted((tuple(r) for r in lt.read_increment(t, ["date", "k"], ["v"]).collect()), key=key)
        assert got == sorted([("d", "a", 15), ("e", "b", 5), (None, "n", 5)], key=key)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
