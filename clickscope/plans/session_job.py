"""Session analysis, composed from the operators. The filtered sessions and their action rows feed several
outputs, so the job cuts their lineage once (``checkpoint`` into the shared checkpoint folder) instead of
recomputing the scan, the session aggregate and the semi join for every output."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import materialize
from ..functions import buckets
from ..operators import categories, sessions
from ..operators.filters import filter_sessions
from ..params import SessionParams
from ..sources.scans import date_range_scan


@dataclass
class SessionJobResult:
    sessions: DataFrame          # filtered sessions with user traits
    stats: DataFrame             # session_aggr_stat
    detail: DataFrame            # action rows of all filtered sessions
    extract: DataFrame           # session_random_extract, lists and times as text
    extract_detail: DataFrame
    top_categories: DataFrame    # top10_category
    top_sessions: DataFrame      # top10_session
    top_session_detail: DataFrame
    session_detail: DataFrame    # session_detail: the extracted sessions' rows and the top sessions' rows


def filtered_sessions(scoped: DataFrame, users: DataFrame, p: SessionParams) -> DataFrame:
    """Sessions of the scoped actions with user traits that pass the task's filters, without lists."""
    measures = sessions.session_measures(scoped, p.keywords, p.category_ids)
    return filter_sessions(sessions.with_user_info(measures, users), p)


def run_session_job(actions: DataFrame, users: DataFrame, p: SessionParams, task_id: int,
                    extract_total: int = 100, top_n: int = 10, cut_lineage: bool = True,
                    visit_buckets=buckets.VISIT_BUCKETS, step_buckets=buckets.STEP_BUCKETS) -> SessionJobResult:
    scoped = date_range_scan(actions, p.start_date, p.end_date)
    sess = filtered_sessions(scoped, users, p)
    if cut_lineage:
        sess = materialize(sess)
    detail = sessions.session_detail(scoped, sess)
    if cut_lineage:
        detail = materialize(detail)
    extract = sessions.random_extract(sess, extract_total, task_id=task_id, actions=detail,
                                      date_hours_bound=sessions.date_hours_in_range(p.start_date, p.end_date))
    if cut_lineage:
        extract = materialize(extract)
    top_cat = categories.top_categories(categories.category_counts(detail), top_n, task_id)
    top_sess = categories.top_sessions(detail, top_cat, top_n, task_id)
    task = F.lit(task_id).cast("bigint").alias("task_id")
    extract_detail = sessions.session_detail(detail, extract, task_id, sessions_bound=extract_total)
    top_detail = categories.top_session_detail(detail, top_sess)
    return SessionJobResult(
        sessions=sess,
        stats=sessions.session_stats(sess, task_id, visit_buckets, step_buckets),
        detail=detail.select(task, *sessions.DETAIL_COLUMNS),
        extract=sessions.session_output(extract),
        extract_detail=extract_detail,
        top_categories=top_cat,
        top_sessions=top_sess,
        top_session_detail=top_detail,
        # As the reference stores them: a session that is both drawn and on top has its rows from either.
        session_detail=extract_detail.select("task_id", *sessions.DETAIL_COLUMNS)
        .unionByName(top_detail.select(task, *sessions.DETAIL_COLUMNS)),
    )
