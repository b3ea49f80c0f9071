"""Task parameters (SRC-5, SRC-6).

A task row carries ``task_param``: a JSON object whose values are arrays; the first element is the value
(``{"startAge": ["10"], "professionals": ["a,b"]}``). Lookup of the task row is a filter on the task table;
parsing is ``from_json`` so it runs where the table lives.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARAM_TYPE = T.MapType(T.StringType(), T.ArrayType(T.StringType()))

# The reference's parameter names.
START_DATE, END_DATE = "startDate", "endDate"
START_AGE, END_AGE = "startAge", "endAge"
PROFESSIONALS, CITIES, SEX = "professionals", "cities", "sex"
KEYWORDS, CATEGORY_IDS = "keywords", "categoryIds"
TARGET_PAGE_FLOW = "targetPageFlow"


def param_value(param_map: Column, name: str) -> Column:
    """SRC-6: first element of ``param_map[name]``; missing key, empty list or empty text → null (also under ANSI
    mode)."""
    return F.nullif(F.try_element_at(F.try_element_at(param_map, F.lit(name)), F.lit(1)), F.lit(""))


def task_params(tasks: DataFrame, task_id: int) -> DataFrame:
    """SRC-5: the task row of ``task_id`` with its parameters parsed into a map column ``params``."""
    return (tasks.where(F.col("task_id") == task_id)
            .select("task_id", "task_name", "task_type", F.from_json("task_param", PARAM_TYPE).alias("params")))


def task_params_table(tasks: DataFrame) -> DataFrame:
    """All tasks with the known parameters as typed columns (bad JSON → nulls)."""
    m = F.from_json("task_param", PARAM_TYPE)
    cols = [param_value(m, n).alias(n) for n in (START_DATE, END_DATE, START_AGE, END_AGE, PROFESSIONALS, CITIES,
                                                   SEX, KEYWORDS, CATEGORY_IDS, TARGET_PAGE_FLOW)]
    return tasks.select("task_id", *cols)


def _csv(v):
    if v is None:
        return None
    if isinstance(v, (list, tuple)):
        return [str(x) for x in v]
    return [x for x in str(v).split(",") if x != ""]


@dataclass(frozen=True)
class SessionParams:
    """Driver-side view of one session-task's parameters (all optional, like the reference)."""

    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: list[str] | None = None
    cities: list[str] | None = None
    sex: str | None = None
    keywords: list[str] | None = None
    category_ids: list[str] | None = None
    target_page_flow: list[int] | None = field(default=None)

    @staticmethod
    def from_json(text: str) -> "SessionParams":
        raw = json.loads(text) if text else {}

        def first(name):
            v = raw.get(name)
            if isinstance(v, list):
                v = v[0] if v else None
            return None if v == "" else v  # an empty parameter is an unset one

        def as_int(v):
            return None if v is None else int(v)

        flow = first(TARGET_PAGE_FLOW)
        return SessionParams(
            start_date=first(START_DATE), end_date=first(END_DATE),
            start_age=as_int(first(START_AGE)), end_age=as_int(first(END_AGE)),
            professionals=_csv(first(PROFESSIONALS)), cities=_csv(first(CITIES)), sex=first(SEX),
            keywords=_csv(first(KEYWORDS)), category_ids=_csv(first(CATEGORY_IDS)),
            target_page_flow=None if flow is None else [int(x) for x in str(flow).split(",") if x != ""],
        )
