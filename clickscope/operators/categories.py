"""Top categories and top sessions per category (J1): PRJ-2/3, FLT-5, AGG-6/7/8, SET-1, JOIN-4/5/6,
TOP-1…4, WIN-5."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from .filters import action_type
from .topn import group_top_n, top_n

def category_events(actions: DataFrame) -> DataFrame:
    """PRJ-2 + PRJ-3: one row per (category, action kind) occurrence, in a single scan.

    Click rows give their category; order/pay CSV lists are exploded element by element (blanks dropped,
    duplicates counted: D8). Columns ``category_id, c, o, p`` (0/1 flags).
    """
    click = F.when(action_type("click"), F.array(F.col("click_category_id")))
    order = F.when(action_type("order"), text.csv_to_longs("order_category_ids"))
    pay = F.when(action_type("pay"), text.csv_to_longs("pay_category_ids"))
    kinds = F.stack(F.lit(3), F.lit("c"), click, F.lit("o"), order, F.lit("p"), pay).alias("kind", "ids")
    rows = actions.select(kinds).where(F.col("ids").isNotNull()).select("kind", F.explode("ids").alias("category_id"))
    return rows.select("category_id", *[(F.col("kind") == k).cast("int").alias(k) for k in ("c", "o", "p")])


def category_counts(actions: DataFrame) -> DataFrame:
    """JOIN-4 as one aggregate: ``category_id, click_count, order_count, pay_count`` for every category that
    was clicked, ordered or paid. One shuffle with map-side partial sums (the reference: distinct + three
    counts + three left joins)."""
    return category_events(actions).groupBy("category_id").agg(
        F.sum("c").cast("bigint").alias("click_count"),
        F.sum("o").cast("bigint").alias("order_count"),
        F.sum("p").cast("bigint").alias("pay_count"))


def category_counts_joined(actions: DataFrame) -> DataFrame:
    """The reference's shape of the same result: SET-1 (union of the clicked, ordered and paid category ids,
    then distinct), three AGG-6 counts, three left joins with missing → 0 (FN-22). Kept for parity;
    :func:`category_counts` is the one-shuffle form."""
    click = actions.where(action_type("click")).select(F.col("click_category_id").alias("category_id"))
    order = actions.where(action_type("order")).select(
        F.explode(text.csv_to_longs("order_category_ids")).alias("category_id"))
    pay = actions.where(action_type("pay")).select(
        F.explode(text.csv_to_longs("pay_category_ids")).alias("category_id"))
    ids = click.unionByName(order).unionByName(pay).distinct()

    def counted(df, name):
        return df.groupBy("category_id").agg(F.count(F.lit(1)).alias(name))

    out = (ids.join(counted(click, "click_count"), "category_id", "left")
           .join(counted(order, "order_count"), "category_id", "left")
           .join(counted(pay, "pay_count"), "category_id", "left"))
    return out.select("category_id", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
                                       for c in ("click_count", "order_count", "pay_count")])


def category_order() -> list[Column]:
    """TOP-1: click, order, pay descending; category id ascending breaks ties."""
    return [F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), F.asc("category_id")]


def top_categories(counts: DataFrame, n: int = 10, task_id: int | None = None) -> DataFrame:
    """TOP-2/TOP-3: the first ``n`` categories by :func:`category_order`."""
    top = top_n(counts, category_order(), n)
    cols = ["category_id", "click_count", "order_count", "pay_count"]
    if task_id is not None:
        cols = [F.lit(task_id).cast("bigint").alias("task_id"), *cols]
    return top.select(*cols)


def session_category_clicks(actions: DataFrame) -> DataFrame:
    """AGG-7: clicks per (category, session), map-side partial counts."""
    return (actions.where(action_type("click"))
            .groupBy(F.col("click_category_id").alias("category_id"), "session_id")
            .agg(F.count(F.lit(1)).alias("click_count")))


def top_sessions(actions: DataFrame, top_cats: DataFrame, n: int = 10, task_id: int | None = None) -> DataFrame:
    """TOP-4: per top category, the ``n`` sessions with most clicks on it (ties: session id, D5).

    The top-category table has at most as many rows as its own limit, so it is broadcast (JOIN-5);
    ranking uses a partial group limit before the shuffle (WIN-5).
    """
    clicks = session_category_clicks(actions).join(F.broadcast(top_cats.select("category_id")), "category_id",
                                                   "left_semi")
    top = group_top_n(clicks, ["category_id"], [F.desc("click_count"), F.asc("session_id")], n)
    cols = ["category_id", "session_id", "click_count"]
    if task_id is not None:
        cols = [F.lit(task_id).cast("bigint").alias("task_id"), *cols]
    return top.select(*cols)


def top_session_detail(actions: DataFrame, top_sess: DataFrame, distinct: bool = False) -> DataFrame:
    """JOIN-6: action rows of the top sessions; a session on top in several categories is repeated once per
    category (inner join, as the reference). ``distinct=True`` gives each session's rows once, without
    ``category_id``.

    ``top_sess`` has at most (top categories × top sessions) rows, so it is broadcast and the action table is
    read without a shuffle.
    """
    if distinct:
        return actions.join(F.broadcast(top_sess.select("session_id").distinct()), "session_id", "left_semi")
    return actions.join(F.broadcast(top_sess.select("category_id", "session_id")), "session_id", "inner")
