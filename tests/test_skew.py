import random

from pyspark.sql import functions as F

from clickscope.operators import joins
from helpers import rows_set


def big_small(spark):
    rnd = random.Random(1)
    big = [(i, 0 if rnd.random() < 0.9 else rnd.randrange(1, 50)) for i in range(1000)]  # key 0 = 90 % of rows
    small = [(k, f"name{k}") for k in range(0, 60, 2)]
    return (spark.createDataFrame(big, "id long, k long"), spark.createDataFrame(small, "k long, name string"))


def test_salted_join_equals_plain(spark):
    b, s = big_small(spark)
    plain = rows_set(b.join(s, "k"), "id", "k", "name")
    assert rows_set(joins.salted_join(b, s, "k", n=8), "id", "k", "name") == plain
    left = rows_set(b.join(s, "k", "left"), "id", "k", "name")
    assert rows_set(joins.salted_join(b, s, "k", n=5, how="left"), "id", "k", "name") == left
    assert rows_set(joins.salted_join(b, s, "k", n=6, salt_col="id"), "id", "k", "name") == plain


def test_skew_join_equals_plain(spark):
    b, s = big_small(spark)
    hot = [r["k"] for r in joins.hot_keys(b, "k", 0.2, 9, 1).collect()]
    assert hot == [0]
    plain = rows_set(b.join(s, "k"), "id", "k", "name")
    assert rows_set(joins.skew_join(b, s, "k", 0.2, 9, 2, 10), "id", "k", "name") == plain


def test_salted_agg_equals_plain(spark):
    b, _ = big_small(spark)
    plain = rows_set(b.groupBy("k").agg(F.count(F.lit(1)).alias("cnt"), F.sum("id").alias("s")), "k", "cnt", "s")
    salted = joins.salted_agg(b, ["k"], n=7, sum_cols={"s": "id"})
    assert rows_set(salted, "k", "cnt", "s") == plain


def test_broadcast_only_when_bounded(spark):
    b, s = big_small(spark)
    _, used = joins.broadcast_if_bounded(s, 100)
    assert used
    _, used = joins.broadcast_if_bounded(b, 100)
    assert not used
    assert rows_set(joins.broadcast_join(b, s, "k", max_rows=10), "id") == rows_set(b.join(s, "k"), "id")


def test_salted_two_stage_top_n_equals_plain(spark):
    from clickscope.operators.topn import group_top_n
    b, _ = big_small(spark)
    order = [F.desc("id"), F.asc("id")]
    plain = rows_set(group_top_n(b, ["k"], order, 5), "k", "id", "rank")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "2")
    try:
        salted = group_top_n(b, ["k"], order, 5, salt_col="id", salts=7)
        assert rows_set(salted, "k", "id", "rank") == plain
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_salted_copies_are_not_broadcast(spark):
    b, s = spark.range(100).select("id", (F.col("id") % 7).alias("k")), spark.range(7).select(F.col("id").alias("k"))
    for how in ("inner", "left", "left_semi"):
        joined = joins.salted_join(b, s, "k", n=8, how=how, salt_col="id")
        plan = joined._sc._jvm.PythonSQLUtils.explainString(joined._jdf.queryExecution(), "simple")
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
        assert joined.count() == 100
