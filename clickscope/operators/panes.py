"""Sliding windows from panes (STR-10): count once per slide, then combine.

A window of W seconds that slides by S covers W / S panes of S seconds, so a pane counts in the W / S windows that start at
or before it. Instead of copying it that often, it enters with +count at the first of these starts and leaves with -count
after the last; running sums over these edges give the counts of all windows, as runs of equal ones. Panes are cut at
day borders of the window start, so the sums run per (key, day) and a key of any size is spread over its days; a cell
holds at most two edges per pane, whatever the number of clicks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DAY = 86_400
# Seconds per unit of a duration text.
UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": DAY}


def seconds(duration: str) -> int:
    """Whole seconds of ``'10 seconds'``, ``'60 minutes'``, …"""
    number, unit = duration.split()
    return int(number) * UNITS[unit.rstrip("s")]


def per_window(window: str, slide: str) -> int:
    """Panes in a window."""
    w, s = seconds(window), seconds(slide)
    if s <= 0 or w % s or DAY % s:
        raise ValueError("a window must be a whole number of slides, and a day too")
    return w // s


def panes(events: DataFrame, ts_col: str, keys: list[str], slide: str, count: str = "click_count") -> DataFrame:
    """``pane`` (start in epoch seconds), keys and the number of events; partial counts before the shuffle."""
    step = seconds(slide)
    at = F.unix_seconds(F.col(ts_col).cast("timestamp"))
    pane = at - F.pmod(at, F.lit(step))
    return events.groupBy(pane.alias("pane"), *keys).agg(F.count(F.lit(1)).alias(count))


def window_runs(df: DataFrame, pane: str, keys: list[str], count: str, window: str, slide: str) -> DataFrame:
    """Keys, ``first_start``, ``last_start`` and ``count`` of maximal runs of consecutive windows with one non-zero count.
    ``df`` has one row per pane and key."""
    n, step = per_window(window, slide), seconds(slide)
    first, last = F.col(pane) - (n - 1) * step, F.col(pane)
    day = lambda c: c - F.pmod(c, F.lit(DAY))
    pieces = df.select(*keys, F.col(count).alias("_n"), first.alias("_a"), last.alias("_b"),
                       F.explode(F.sequence(day(first), day(last), F.lit(DAY).cast("bigint"))).alias("_day"))
    enter = F.greatest("_a", "_day")
    leave = F.least(F.col("_b"), F.col("_day") + DAY - step) + step
    edges = (pieces.select(*keys, "_day", F.explode(F.array(F.struct(enter.alias("at"), F.col("_n").alias("d")),
                                                            F.struct(leave.alias("at"), (-F.col("_n")).alias("d")))).alias("_e"))
             .groupBy(*keys, "_day", F.col("_e.at").alias("_at")).agg(F.sum("_e.d").alias("_d")).where(F.col("_d") != 0))
    line = Window.partitionBy(*keys, "_day").orderBy("_at")
    level = edges.select(*keys, "_day", F.col("_at").alias("first_start"), F.lead("_at").over(line).alias("_next"),
                         F.sum("_d").over(line.rowsBetween(Window.unboundedPreceding, 0)).alias(count))
    runs = level.where((F.col(count) > 0) & F.col("_next").isNotNull()).select(
        *keys, "_day", "first_start", (F.col("_next") - step).alias("last_start"), F.col(count).cast("bigint").alias(count))
    return _joined_at_midnight(runs, keys, count, step)


def _joined_at_midnight(runs: DataFrame, keys: list[str], count: str, step: int) -> DataFrame:
    """Runs that go on over a day border become one. Only runs that touch a border take part, one or two a day."""
    touches_end = F.col("last_start") + step == F.col("_day") + DAY
    touches_start = F.col("first_start") == F.col("_day")
    border = runs.where(touches_end | touches_start)
    line = Window.partitionBy(*keys).orderBy("first_start")
    goes_on = (F.lag("last_start").over(line) + step == F.col("first_start")) & (F.lag(count).over(line) == F.col(count))
    group = F.sum(F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)).over(line).alias("_g")
    joined = (border.select("*", group).groupBy(*keys, "_g")
              .agg(F.min("first_start").alias("first_start"), F.max("last_start").alias("last_start"),
                   F.first(count).alias(count)))
    cols = [*keys, "first_start", "last_start", count]
    return runs.where(~(touches_end | touches_start)).select(*cols).unionByName(joined.select(*cols))


def windows(runs: DataFrame, window: str, slide: str) -> DataFrame:
    """Every single window of the runs: ``window_start, window_end`` (epoch seconds) beside the other columns."""
    step, length = seconds(slide), seconds(window)
    start = F.explode(F.sequence("first_start", "last_start", F.lit(step).cast("bigint"))).alias("window_start")
    rest = [c for c in runs.columns if c not in ("first_start", "last_start")]
    return runs.select(start, *rest).select("window_start", (F.col("window_start") + length).alias("window_end"), *rest)
