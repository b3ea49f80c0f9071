"""Date and time helpers (FN-1 … FN-6, FN-21).

All arithmetic stays on TIMESTAMP_NTZ, so results do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

# The reference's text formats for dates and times.
FMT_DATE = "yyyy-MM-dd"
FMT_TIME = "yyyy-MM-dd HH:mm:ss"
FMT_DATEKEY = "yyyyMMdd"
FMT_MINUTE = "yyyyMMddHHmm"
FMT_SECOND = "yyyyMMddHHmmss"
FMT_DATE_HOUR = "yyyy-MM-dd_HH"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_ntz(c) -> Column:
    """TIMESTAMP (LTZ) or NTZ → NTZ; a no-op on NTZ."""
    return _c(c).cast("timestamp_ntz")


def epoch_micros(c) -> Column:
    return F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), to_ntz(c))


def epoch_millis(c) -> Column:
    """Milliseconds since the epoch of a wall-clock (NTZ) time."""
    return F.timestamp_diff("MILLISECOND", F.expr(EPOCH_NTZ), to_ntz(c))


def from_epoch_millis(c) -> Column:
    """Epoch milliseconds (number or numeric text) → TIMESTAMP_NTZ; bad text → null."""
    ms = _c(c).try_cast("bigint")
    return F.timestamp_add("MILLISECOND", ms, F.expr(EPOCH_NTZ))


def trunc_second(c) -> Column:
    """Drop sub-second digits, keeping TIMESTAMP_NTZ (``date_trunc`` would return a zoned TIMESTAMP)."""
    ts = to_ntz(c)
    frac = F.pmod(epoch_micros(ts), F.lit(1_000_000))
    return F.timestamp_add("MICROSECOND", -frac, ts)


def seconds_between(later, earlier) -> Column:
    """FN-2: whole seconds from ``earlier`` to ``later`` (``DateUtils.minus``)."""
    return F.timestamp_diff("SECOND", to_ntz(earlier), to_ntz(later))


def before(a, b) -> Column:
    """FN-1."""
    return _c(a) < _c(b)


def after(a, b) -> Column:
    """FN-1."""
    return _c(a) > _c(b)


def format_time(c) -> Column:
    return F.date_format(_c(c), FMT_TIME)


def format_date(c) -> Column:
    return F.date_format(_c(c), FMT_DATE)


def format_datekey(c) -> Column:
    return F.date_format(_c(c), FMT_DATEKEY)


def format_minute(c) -> Column:
    return F.date_format(_c(c), FMT_MINUTE)


def format_second(c) -> Column:
    return F.date_format(_c(c), FMT_SECOND)


def date_hour(c) -> Column:
    """FN-3: ``yyyy-MM-dd_HH``; inside plans prefer the two columns of :func:`date_and_hour`."""
    return F.date_format(_c(c), FMT_DATE_HOUR)


def date_and_hour(c) -> tuple[Column, Column]:
    return F.date_format(_c(c), FMT_DATE), F.date_format(_c(c), "HH")


def hour_index(c) -> Column:
    """Hours from 1970-01-01 00:00 to a wall-clock time, counted by calendar so that no time zone enters."""
    return F.unix_date(to_ntz(c).cast("date")) * F.lit(24) + F.hour(to_ntz(c))


def minute_parts(c) -> tuple[Column, Column, Column]:
    """FN-21: date (``yyyyMMdd``), hour and minute as zero-padded text."""
    return F.date_format(_c(c), FMT_DATEKEY), F.date_format(_c(c), "HH"), F.date_format(_c(c), "mm")


def parse_time(c) -> Column:
    """FN-6: ``yyyy-MM-dd HH:mm:ss`` text → TIMESTAMP_NTZ, bad input → null."""
    return F.try_to_timestamp(_c(c), F.lit(FMT_TIME)).cast("timestamp_ntz")


def parse_datekey(c) -> Column:
    """FN-6: ``yyyyMMdd`` text → DATE, bad input → null."""
    return F.try_to_timestamp(_c(c), F.lit(FMT_DATEKEY)).cast("date")


def today() -> Column:
    """FN-4."""
    return F.current_date()


def yesterday() -> Column:
    """FN-4."""
    return F.date_sub(F.current_date(), 1)
