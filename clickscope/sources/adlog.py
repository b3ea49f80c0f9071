"""SRC-10: the ad click text log ``epoch_ms province city user_id ad_id`` ↔ typed columns.

One parser is shared by batch and streaming inputs. Malformed lines are not thrown away silently: they go to
the reject side (:func:`parse_ad_log_rejects`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates

# Field positions of one log line.
F_TS, F_PROVINCE, F_CITY, F_USER, F_AD = 0, 1, 2, 3, 4
N_FIELDS = 5
# Epoch milliseconds of the years 1970 to 9999; a line outside them is a reject, as no date can be made of it.
MAX_EPOCH_MS = 253_402_300_799_999


def _fields(value: Column) -> Column:
    return F.split(value, " ")


def _valid(parts: Column) -> Column:
    return ((F.size(parts) == N_FIELDS)
            & parts[F_TS].try_cast("bigint").between(0, MAX_EPOCH_MS)
            & parts[F_USER].try_cast("bigint").isNotNull()
            & parts[F_AD].try_cast("bigint").isNotNull())


def parse_ad_log(lines: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse well-formed lines to ``ts, date(yyyyMMdd), province, city, user_id, ad_id`` (+ ``keep`` columns)."""
    parts = _fields(F.col(value_col))
    ts = dates.from_epoch_millis(parts[F_TS])
    return (lines.where(_valid(parts))
            .select(ts.alias("ts"),
                    F.date_format(ts, dates.FMT_DATEKEY).alias("date"),
                    parts[F_PROVINCE].alias("province"),
                    parts[F_CITY].alias("city"),
                    parts[F_USER].cast("bigint").alias("user_id"),
                    parts[F_AD].cast("bigint").alias("ad_id"),
                    *keep))


def parse_ad_log_rejects(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Lines :func:`parse_ad_log` refuses (wrong field count, non-numeric time/user/ad, or a time out of range)."""
    parts = _fields(F.col(value_col))
    return lines.where(~F.coalesce(_valid(parts), F.lit(False)))


OBSERVED = "ad_log"


def observed(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """``lines`` with their number and the number of rejects counted in passing, under the name ``ad_log``: a streaming
    query shows them per batch in ``progress.observedMetrics``, without a job of their own."""
    ok = F.coalesce(_valid(_fields(F.col(value_col))), F.lit(False))
    return lines.observe(OBSERVED, F.count(F.lit(1)).alias("lines"), F.count(F.when(~ok, 1)).alias("rejects"))


def observed_counts(query) -> tuple[int, int]:
    """(lines, rejects) of the batches that a streaming query still remembers."""
    rows = [p.observedMetrics.get(OBSERVED) for p in query.recentProgress]
    return sum(r["lines"] for r in rows if r), sum(r["rejects"] for r in rows if r)


def log_line(clicks: DataFrame) -> Column:
    """The text line of a typed click."""
    return F.concat_ws(" ", dates.epoch_millis("ts").cast("string"), "province", "city",
                       F.col("user_id").cast("string"), F.col("ad_id").cast("string"))


def format_ad_log(clicks: DataFrame) -> DataFrame:
    """Inverse of :func:`parse_ad_log`: typed clicks → one ``value`` text column."""
    return clicks.select(log_line(clicks).alias("value"))
