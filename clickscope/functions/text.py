"""String helpers (FN-8 … FN-16, FN-20, PRJ-4, PRJ-5)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_empty(c) -> Column:
    """FN-8: null or ``''``."""
    return _c(c).isNull() | (_c(c) == "")


def is_not_empty(c) -> Column:
    return ~is_empty(c)


def trim_comma(c) -> Column:
    """FN-9: drop one leading and one trailing comma."""
    return F.regexp_replace(_c(c), r"^,|,$", "")


def zero_pad2(c) -> Column:
    """FN-10: prefix ``0`` to one-character text (longer text unchanged, unlike ``lpad``)."""
    s = _c(c).cast("string")
    return F.when(F.length(s) == 1, F.concat(F.lit("0"), s)).otherwise(s)


def kv_get(text, field: str, delim: str = "|") -> Column:
    """FN-11: value of ``field`` in a ``k=v|k=v`` string; missing or empty value → null."""
    pat = rf"(?:^|{re.escape(delim)})" + re.escape(field) + rf"=([^{re.escape(delim)}=]*)(?:{re.escape(delim)}|$)"
    return F.nullif(F.regexp_extract(_c(text), pat, 1), F.lit(""))


def kv_set(text, field: str, value, delim: str = "|") -> Column:
    """FN-12: set the first ``field`` to ``value`` in a ``k=v|k=v`` string; text without it is unchanged."""
    d = re.escape(delim)
    pat = rf"(^|{d}){re.escape(field)}=[^{d}]*"
    t = _c(text)
    start = F.regexp_instr(t, F.lit(pat))  # 1-based start of the first match, 0 when absent
    matched = F.regexp_extract(t, pat, 0)
    new_pair = F.concat(F.regexp_extract(t, pat, 1), F.lit(field + "="), _c(value).cast("string"))
    out = F.concat(F.left(t, start - 1), new_pair, F.substr(t, start + F.length(matched)))
    return F.when(start > 0, out).otherwise(t)


def concat_long_string(v1, v2, sep: str = ":") -> Column:
    """FN-13 ``concat_long_string(id, name, sep)``; a null part prints as ``null`` like the Java UDF."""
    return F.concat(F.coalesce(_c(v1).cast("string"), F.lit("null")), F.lit(sep),
                    F.coalesce(_c(v2).cast("string"), F.lit("null")))


def json_field(json_text, field: str) -> Column:
    """FN-14: top-level JSON field as text; bad JSON or missing field → null."""
    return F.get_json_object(_c(json_text), f"$.{field}")


def random_prefix(c, n: int = 10, by=None, seed: int = 0) -> Column:
    """FN-15: ``r_value`` with r in [0, n). With ``by`` (a column unique per row) r is a hash of it, the same in every
    attempt of a task, as it must be ahead of a shuffle; without it r is drawn."""
    r = F.floor(F.rand(seed) * n) if by is None else F.pmod(F.xxhash64(_c(by), F.lit(seed)), F.lit(n))
    return F.concat(r.cast("int").cast("string"), F.lit("_"), _c(c).cast("string"))


def remove_random_prefix(c) -> Column:
    """FN-16: strip a leading ``<digits>_`` (the value itself may contain ``_``)."""
    return F.regexp_replace(_c(c), r"^[0-9]+_", "")


def csv_to_longs(c) -> Column:
    """CSV id list → ARRAY<BIGINT>, blanks and non-numbers dropped, duplicates kept."""
    parts = F.split(_c(c), ",")
    return F.filter(F.transform(parts, lambda x: F.trim(x).try_cast("bigint")), lambda x: x.isNotNull())


def csv_to_strings(c) -> Column:
    parts = F.split(_c(c), ",")
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")


def sorted_csv(arr) -> Column:
    """Distinct, sorted array → comma text; empty → null (how the reference reads back an empty field)."""
    return F.nullif(F.array_join(F.array_sort(F.array_distinct(_c(arr))), ","), F.lit(""))


def case_map(c, mapping: dict, default) -> Column:
    """PRJ-4: ``CASE WHEN c = k THEN v … ELSE default END``."""
    out = None
    for k, v in mapping.items():
        out = F.when(_c(c) == k, F.lit(v)) if out is None else out.when(_c(c) == k, F.lit(v))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def if_else(cond: Column, a, b) -> Column:
    """PRJ-5: ``IF(cond, a, b)``; a null condition takes ``b`` like SQL ``IF``."""
    return F.when(F.coalesce(cond, F.lit(False)), F.lit(a) if not isinstance(a, Column) else a) \
        .otherwise(F.lit(b) if not isinstance(b, Column) else b)
