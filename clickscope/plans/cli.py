"""Command-line runner for the jobs, the way the reference's programs are started (task parameters as JSON).

    python -m clickscope.plans.cli session --sf-dir DIR --task-id 1 \\
        --params '{"startDate":["2024-01-01"],"endDate":["2024-01-31"],"startAge":["10"],"endAge":["50"]}' --out OUT
    python -m clickscope.plans.cli page    --sf-dir DIR --task-id 2 --params '{"targetPageFlow":["1,2,3"]}' --out OUT
    python -m clickscope.plans.cli area    --sf-dir DIR --task-id 3 \
        --params '{"startDate":[…],"endDate":[…]}' --out OUT
    python -m clickscope.plans.cli ads     --source DIR_OF_LOG_FILES --out OUT [--threshold 100] [--available-now]
    python -m clickscope.plans.cli ads     --brokers HOST:PORT --topics T --out OUT
    python -m clickscope.plans.cli ads     --log SEGMENT_LOG --group G [--starting-offsets earliest] --out OUT \
        [--window "60 minutes" --slide "10 seconds"] [--listing click]

``--tasks PATH`` reads the parameters from a task table (parquet with the ``task`` schema) instead of
``--params``. Outputs are parquet tables under ``OUT/<table>`` partitioned by ``task_id``.
"""

from __future__ import annotations

import argparse
import json

from ..config import build_session
from ..params import SessionParams
from ..sinks.results import write_result
from ..sources import tables


def _params(spark, args) -> SessionParams:
    if args.tasks:
        row = spark.read.parquet(args.tasks).where(f"task_id = {int(args.task_id)}").select("task_param").first()
        if row is None:
            raise SystemExit(f"task {args.task_id} not found in {args.tasks}")
        return SessionParams.from_json(row[0])
    return SessionParams.from_json(args.params or "{}")


def run_session(spark, args) -> None:
    from .session_job import run_session_job
    p = _params(spark, args)
    r = run_session_job(tables.user_visit_action(spark, args.sf_dir, p.start_date, p.end_date),
                        tables.user_info(spark, args.sf_dir), p, args.task_id, extract_total=args.extract_total)
    outs = {"session_aggr_stat": r.stats, "session_random_extract": r.extract, "session_detail": r.session_detail,
            "top10_category": r.top_categories, "top10_session": r.top_sessions}
    for name, df in outs.items():
        write_result(df, f"{args.out}/{name}")


def run_page(spark, args) -> None:
    from .page_job import run_page_job
    p = _params(spark, args)
    if not p.target_page_flow:
        raise SystemExit("targetPageFlow is required")
    out = run_page_job(spark, tables.user_visit_action(spark, args.sf_dir, p.start_date, p.end_date),
                       p.target_page_flow, p.start_date, p.end_date, args.task_id)
    write_result(out, f"{args.out}/page_split_convert_rate")


def run_area(spark, args) -> None:
    from .area_job import area_top3_job
    p = _params(spark, args)
    out = area_top3_job(tables.user_visit_action(spark, args.sf_dir, p.start_date, p.end_date),
                        tables.city_info(spark, args.sf_dir), tables.product_info(spark, args.sf_dir),
                        p.start_date, p.end_date, args.task_id)
    write_result(out, f"{args.out}/area_top3_product")


def run_ads(spark, args) -> None:
    from ..sources.external import ad_log_stream
    from ..streaming.ad_stream import AdClickStream
    job = AdClickStream(spark, args.out, threshold=args.threshold, watermark=args.watermark or None,
                        trend_window=args.window, trend_slide=args.slide, listing=args.listing)
    trigger = {"availableNow": True} if args.available_now else None

    def src():
        return ad_log_stream(spark, brokers=args.brokers, topics=args.topics, path=args.source, log=args.log,
                             group=args.group, starting_offsets=args.starting_offsets,
                             fail_on_data_loss=not args.allow_data_loss)

    queries = [job.start_main(src(), trigger), job.start_trend(src(), trigger), job.start_rejects(src(), trigger)]
    for q in queries:
        q.awaitTermination()


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="clickscope")
    ap.add_argument("job", choices=["session", "page", "area", "ads"])
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--task-id", type=int, default=1)
    ap.add_argument("--params")
    ap.add_argument("--tasks")
    ap.add_argument("--out", required=True)
    ap.add_argument("--extract-total", type=int, default=100)
    ap.add_argument("--threshold", type=int, default=100)
    ap.add_argument("--watermark", default="60 minutes", help="empty: keep every minute in the state")
    ap.add_argument("--window", default="1 minute")
    ap.add_argument("--slide")
    ap.add_argument("--listing", choices=["batch", "click"], default="batch")
    ap.add_argument("--log")
    ap.add_argument("--group")
    ap.add_argument("--starting-offsets", default="latest")
    ap.add_argument("--allow-data-loss", action="store_true")
    ap.add_argument("--source")
    ap.add_argument("--brokers")
    ap.add_argument("--topics")
    ap.add_argument("--available-now", action="store_true")
    ap.add_argument("--master", default="local[8]")
    args = ap.parse_args(argv)
    spark = build_session(args.master)
    {"session": run_session, "page": run_page, "area": run_area, "ads": run_ads}[args.job](spark, args)
    print(json.dumps({"job": args.job, "out": args.out}))


if __name__ == "__main__":
    main()
