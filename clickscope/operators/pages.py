"""Page one-step conversion (J2): WIN-2, TOP-5, FN-19, AGG-13/14/15, SNK-8."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.numbers import ratio_half_up
from .ordered import previous_in_order


def flow_pairs(flow: list[int]) -> list[tuple[int, str]]:
    """FN-19: ``1,2,3`` → ``[(1, '1_2'), (2, '2_3')]`` (position, pair)."""
    return [(i, f"{a}_{b}") for i, (a, b) in enumerate(zip(flow, flow[1:]), start=1)]


def parse_flow(text: str) -> list[int]:
    return [int(x) for x in text.split(",") if x.strip() != ""]


def page_pairs(actions: DataFrame, chunk: Column | None = None) -> DataFrame:
    """WIN-2 + TOP-5: every action with the page of the action before it in its session.

    Order inside a session: ``action_time`` then ``event_id`` (D5). A session is cut by ``chunk`` (default: the hour
    of the action, see :mod:`.ordered`), so a session that holds a third of a month's rows still spreads over some
    700 window groups; the cut never changes the result.
    Output: ``session_id, prev_page_id, page_id, action_time, event_id`` for actions that have a predecessor.
    """
    base = actions.select("session_id", "page_id", "action_time", "event_id")
    cut = dates.hour_index("action_time") if chunk is None else chunk
    with_prev = previous_in_order(base, ["session_id"], ["action_time", "event_id"], ["page_id"], cut)
    return (with_prev.where(F.col("prev_page_id").isNotNull())
            .select("session_id", "prev_page_id", "page_id", "action_time", "event_id"))


def pair_key(prev_col="prev_page_id", cur_col="page_id"):
    return F.concat(F.col(prev_col).cast("string"), F.lit("_"), F.col(cur_col).cast("string"))


def page_split_pv(pairs: DataFrame, flow: list[int]) -> DataFrame:
    """AGG-14: occurrences of each consecutive pair that is a step of the flow (``page_pair, pv``).

    The flow's pairs are a literal set (an ``InSet`` filter in the scan stage), so no join is needed.
    """
    wanted = sorted({p for _, p in flow_pairs(flow)})
    return (pairs.select(pair_key().alias("page_pair")).where(F.col("page_pair").isin(wanted))
            .groupBy("page_pair").agg(F.count(F.lit(1)).alias("pv")))


def start_page_pv(actions: DataFrame, flow: list[int]) -> DataFrame:
    """AGG-13: every visit of the flow's first page (one row: ``page_pair='start', pv``)."""
    return actions.where(F.col("page_id") == flow[0]).agg(F.count(F.lit(1)).alias("pv")).select(
        F.lit("start").alias("page_pair"), "pv")


def convert_rates(spark: SparkSession, split_pv: DataFrame, start_pv: DataFrame, flow: list[int]) -> DataFrame:
    """AGG-15: rate of step i = pv_i / pv_{i-1}, step 1 over the start-page pv; half-up 2 decimals.

    An unseen pair has pv 0 and a zero denominator gives a null rate (D11). All inputs here have at most
    ``len(flow)`` rows, so the position window runs on a handful of rows.
    """
    positions = spark.createDataFrame([(0, "start"), *flow_pairs(flow)], "pos int, page_pair string")
    pv = split_pv.unionByName(start_pv)
    j = positions.join(pv, "page_pair", "left").withColumn("pv", F.coalesce(F.col("pv"), F.lit(0)).cast("bigint"))
    w = Window.orderBy("pos")
    return (j.withColumn("prev_pv", F.lag("pv").over(w))
            .where(F.col("pos") >= 1)
            .select("pos", "page_pair", "pv", ratio_half_up("pv", "prev_pv").alias("convert_rate")))


def convert_rate_text(rates: DataFrame, task_id: int) -> DataFrame:
    """SNK-8: ``a_b=rate|…`` in flow order (null rate prints ``null``)."""
    item = F.concat(F.col("page_pair"), F.lit("="), F.coalesce(F.col("convert_rate").cast("string"), F.lit("null")))
    text = F.expr("listagg(_item, '|') WITHIN GROUP (ORDER BY pos)")
    return (rates.select("pos", item.alias("_item")).groupBy().agg(text.alias("convert_rate"))
            .select(F.lit(task_id).cast("bigint").alias("task_id"), "convert_rate"))
