"""Session analysis (J1): AGG-1, JOIN-1, AGG-2/3, JOIN-2/3, AGG-4/5, WIN-6, TOP-6."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import buckets, dates, text
from ..functions.numbers import ratio_half_up
from .filters import overlaps
from .topn import group_top_n

# Columns of the session-detail output (reference table ``session_detail``, without date and city).
DETAIL_COLUMNS = ["user_id", "session_id", "page_id", "action_time", "search_keyword", "click_category_id",
                  "click_product_id", "order_category_ids", "order_product_ids", "pay_category_ids",
                  "pay_product_ids"]


def session_measures(actions: DataFrame, keywords: list[str] | None = None,
                     category_ids: list[str] | None = None) -> DataFrame:
    """AGG-1 without its lists: one row of fixed size per session, so a hot session costs one small partial row per
    map task. Visit length is whole seconds between first and last action, step length the number of actions.

    With ``keywords`` / ``category_ids`` (FLT-2 on a list field) the columns ``keyword_hit`` / ``category_hit`` tell
    whether any action of the session has one of them.
    """
    hits = [F.bool_or(overlaps(F.array(c), values, kind)).alias(name)
            for name, c, values, kind in (("keyword_hit", "search_keyword", keywords, "string"),
                                          ("category_hit", "click_category_id", category_ids, "bigint"))
            if values is not None]
    agg = actions.groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        F.min("action_time").alias("start_time"),
        F.max("action_time").alias("end_time"),
        F.count(F.lit(1)).alias("step_length"),
        *hits,
    )
    return agg.select("session_id", "user_id", dates.seconds_between("end_time", "start_time").alias("visit_length"),
                      "step_length", "start_time", *[c for c in ("keyword_hit", "category_hit") if c in agg.columns])


def with_lists(sessions: DataFrame, actions: DataFrame, restrict: bool = True) -> DataFrame:
    """Add ``search_keyword_list`` / ``click_category_list``: exact distinct sorted arrays (D6), empty without values.

    The distinct (session, value) rows are formed first, over all tasks, and only they are gathered, so repeated values
    of a hot session never meet in one task. Rows without session id form one session, as in the aggregate.
    ``restrict`` first keeps the actions of ``sessions`` (few of many); pass False when they are all sessions of
    ``actions``.
    """
    if restrict:
        wanted = sessions.select(F.col("session_id").alias("_wanted"))
        actions = actions.join(wanted, F.col("session_id").eqNullSafe(F.col("_wanted")), "left_semi")
    values = F.array(F.struct(F.col("search_keyword").alias("kw"), F.lit(None).cast("bigint").alias("cat")),
                     F.struct(F.lit(None).cast("string").alias("kw"), F.col("click_category_id").alias("cat")))
    distinct = (actions.select("session_id", F.explode(values).alias("v")).select("session_id", "v.*")
                .where(F.col("kw").isNotNull() | F.col("cat").isNotNull()).distinct())
    lists = distinct.groupBy(F.col("session_id").alias("_of")).agg(
        F.array_sort(F.collect_list("kw")).alias("search_keyword_list"),
        F.array_sort(F.collect_list("cat")).alias("click_category_list"))
    empty = {"search_keyword_list": "array<string>", "click_category_list": "array<bigint>"}
    return sessions.join(lists, F.col("session_id").eqNullSafe(F.col("_of")), "left").select(
        *sessions.columns, *[F.coalesce(F.col(c), F.array().cast(t)).alias(c) for c, t in empty.items()])


def session_aggregate(actions: DataFrame) -> DataFrame:
    """AGG-1: one row per session, its lists included."""
    return with_lists(session_measures(actions), actions, restrict=False)


def with_user_info(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """JOIN-1: inner join on user_id (unknown users drop out). The user table grows with the data, so the
    join is left to the planner/AQE (broadcast only when measured small; skewed users split by AQE)."""
    u = users.select("user_id", "age", "professional", "city", "sex")
    return sessions.join(u, "user_id", "inner")


def session_output(sessions: DataFrame) -> DataFrame:
    """Arrays → comma text and times → ``yyyy-MM-dd HH:mm:ss``, the reference's text shape."""
    cols = []
    for c in sessions.columns:
        if c == "search_keyword_list":
            cols.append(text.sorted_csv(F.col(c)).alias("search_keywords"))
        elif c == "click_category_list":
            cols.append(text.sorted_csv(F.col(c)).alias("click_category_ids"))
        elif c in ("start_time", "end_time", "action_time"):
            cols.append(dates.format_time(c).alias(c))
        else:
            cols.append(F.col(c))
    return sessions.select(*cols)


def session_stats(sessions: DataFrame, task_id: int, visit_buckets=buckets.VISIT_BUCKETS,
                  step_buckets=buckets.STEP_BUCKETS) -> DataFrame:
    """AGG-2 + AGG-3: session count and the share of sessions per visit/step bucket, half-up to 2 decimals.

    One aggregate pass (partial sums per task); zero sessions → null ratios. Visit length 0 is in no bucket
    (D19), so ratios need not sum to 1.
    """
    parts = [F.count(F.lit(1)).alias("session_count")]
    for name, lo, hi in visit_buckets:
        parts.append(F.sum(F.when(buckets.in_bucket("visit_length", lo, hi), 1).otherwise(0)).alias("v_" + name))
    for name, lo, hi in step_buckets:
        parts.append(F.sum(F.when(buckets.in_bucket("step_length", lo, hi), 1).otherwise(0)).alias("s_" + name))
    counts = sessions.agg(*parts)
    out = [F.lit(task_id).cast("bigint").alias("task_id"), F.col("session_count")]
    out += [ratio_half_up("v_" + n, "session_count").alias("visit_" + n) for n, _, _ in visit_buckets]
    out += [ratio_half_up("s_" + n, "session_count").alias("step_" + n) for n, _, _ in step_buckets]
    return counts.select(*out)


def session_detail(actions: DataFrame, sessions: DataFrame, task_id: int | None = None,
                   sessions_bound: int | None = None) -> DataFrame:
    """JOIN-2 / JOIN-3: action rows of the given sessions (``left_semi``: no duplication, no session columns).

    ``sessions_bound``: a proven maximum number of sessions (e.g. the random-extract total); then the session
    ids are broadcast and the action table is not shuffled. Without it the join is left to AQE (a hot session
    on the action side is split by AQE's skew handling).
    """
    ids = sessions.select("session_id")
    if sessions_bound is not None:
        ids = F.broadcast(ids)
    d = actions.join(ids, "session_id", "left_semi")
    cols = [*DETAIL_COLUMNS, "event_id"]
    if task_id is not None:
        cols = [F.lit(task_id).cast("bigint").alias("task_id"), *cols]
    return d.select(*cols)


def hour_quota(sessions: DataFrame, total: int) -> DataFrame:
    """AGG-4 + AGG-5: sessions per (date, hour) of their start, and the number to draw from each hour.

    ``per_day = total // n_days``; ``quota = min(n, floor(n / day_n * per_day))`` (the reference's formula,
    evaluated in doubles in the same order). The table has one row per date-hour.
    """
    d, h = dates.date_and_hour("start_time")
    hours = sessions.groupBy(d.alias("date"), h.alias("hour")).agg(F.count(F.lit(1)).alias("hour_count"))
    day = Window.partitionBy("date")
    all_rows = Window.partitionBy()  # date-hour rows only: bounded by 24 × days in range
    hours = (hours.withColumn("day_count", F.sum("hour_count").over(day))
             .withColumn("n_days", F.size(F.collect_set("date").over(all_rows))))
    per_day = F.floor(F.lit(float(total)) / F.col("n_days").cast("double"))
    raw = F.floor(F.col("hour_count").cast("double") / F.col("day_count").cast("double") * per_day)
    return hours.withColumn("quota", F.least(F.col("hour_count"), raw.cast("bigint")))


def random_extract(sessions: DataFrame, total: int, seed: str = "clickscope", task_id: int | None = None,
                   date_hours_bound: int | None = None, actions: DataFrame | None = None) -> DataFrame:
    """TOP-6 + WIN-6: stratified draw of about ``total`` sessions, proportional to sessions per hour.

    Inside an hour the draw is the first ``quota`` sessions ordered by ``md5(seed || session_id)``:
    reproducible, uniform, and the same in any engine. No hour can get more than ``total``, so ranking is a
    group top-``total`` (partial limit before the shuffle, or salted two-stage for large totals): a hot hour
    is never sorted whole in one task. The quota table has one row per date-hour; it is broadcast only with a
    known bound (``date_hours_bound``, e.g. 24 × days of the task's date range), else AQE decides at runtime.
    The keyword and category lists are those of ``sessions`` if it has them; with ``actions`` they are built for the
    drawn sessions only; without either they are left out.
    """
    q = hour_quota(sessions, total).select("date", "hour", "quota")
    if date_hours_bound is not None:
        q = F.broadcast(q)
    d, h = dates.date_and_hour("start_time")
    s = sessions.withColumn("date", d).withColumn("hour", h).join(q, ["date", "hour"])
    order = [F.md5(F.concat(F.lit(seed), F.col("session_id"))), F.col("session_id")]
    picked = group_top_n(s, ["date", "hour"], order, total, "_rn", salt_col="session_id")
    picked = picked.where(F.col("_rn") <= F.col("quota"))
    if actions is not None:
        picked = with_lists(picked.select("session_id", "start_time"), actions)
    lists = [c for c in ("search_keyword_list", "click_category_list") if c in picked.columns]
    cols = ["session_id", "start_time", *lists]
    if task_id is not None:
        cols = [F.lit(task_id).cast("bigint").alias("task_id"), *cols]
    return picked.select(*cols)


def date_hours_in_range(start_date: str | None, end_date: str | None) -> int | None:
    """24 × number of days in ``[start_date, end_date]``: a proven bound on the hour-quota table."""
    import datetime as _dt
    if start_date is None or end_date is None:
        return None
    days = (_dt.date.fromisoformat(end_date) - _dt.date.fromisoformat(start_date)).days + 1
    return max(0, days) * 24


def date_hour_counts(sessions: DataFrame) -> DataFrame:
    """AGG-4 as a table: ``date_hour (yyyy-MM-dd_HH), session_count``."""
    return sessions.groupBy(dates.date_hour("start_time").alias("date_hour")).agg(
        F.count(F.lit(1)).alias("session_count"))


def kv_text() -> Column:
    """The reference's ``k=v|k=v`` session record (legacy text boundary only; plans use columns)."""
    def part(k, v):
        return F.concat(F.lit(k + "="), F.coalesce(v.cast("string"), F.lit("")))
    return F.concat_ws("|",
                       part("sessionid", F.col("session_id")),
                       part("searchKeywords", F.array_join("search_keyword_list", ",")),
                       part("clickCategoryIds", F.array_join("click_category_list", ",")),
                       part("visitLength", F.col("visit_length")),
                       part("stepLength", F.col("step_length")),
                       part("startTime", dates.format_time("start_time")))
