"""Composed jobs end to end on the smallest supplied tables."""

from clickscope.operators import ads
from clickscope.params import SessionParams
from clickscope.plans.ad_batch_job import run_ad_batch
from clickscope.plans.area_job import area_top3_job
from clickscope.plans.page_job import run_page_job
from clickscope.plans.session_job import run_session_job
from clickscope.sources import adlog, tables

SF = "/root/testdata/sf0.001"


def test_session_job_with_lineage_cut(spark):
    p = SessionParams.from_json('{"startDate":["2024-01-01"],"endDate":["2024-01-31"],"startAge":["10"],'
                                '"endAge":["50"]}')
    r = run_session_job(tables.user_visit_action(spark, SF), tables.user_info(spark, SF), p, task_id=3,
                        extract_total=100, cut_lineage=True)
    n = r.sessions.count()
    st = r.stats.first()
    assert st["session_count"] == n > 0
    assert r.extract.count() <= 100
    assert r.top_categories.count() <= 10
    assert r.top_sessions.count() <= 100
    assert r.detail.count() >= n
    assert r.detail.columns[0] == "task_id" and r.detail.select("task_id").distinct().first()[0] == 3
    assert r.extract_detail.count() >= r.extract.count()
    assert r.top_session_detail.count() >= r.top_sessions.count()


def test_page_job_text(spark):
    out = run_page_job(spark, tables.user_visit_action(spark, SF), [1, 2, 3], None, None, 5).first()
    assert out["task_id"] == 5 and out["convert_rate"].startswith("1_2=") and "|2_3=" in out["convert_rate"]


def test_area_job(spark):
    out = area_top3_job(tables.user_visit_action(spark, SF), tables.city_info(spark, SF),
                        tables.product_info(spark, SF), None, None, 2)
    per_area = {r["area"]: r["c"] for r in out.groupBy("area").count().withColumnRenamed("count", "c").collect()}
    assert per_area and all(c <= 3 for c in per_area.values())


def test_ad_batch_job(spark):
    clicks = adlog.parse_ad_log(tables.ad_log_lines(spark, SF), keep=("event_id",))
    r = run_ad_batch(clicks, threshold=2)
    total = sum(x["click_count"] for x in r.ad_stat.collect())
    kept = ads.apply_cutoffs(clicks, ads.blacklist_cutoffs(clicks, 2)).count()
    assert total == kept <= clicks.count()
    assert r.province_top3.groupBy("date", "province").count().where("count > 3").count() == 0
    assert r.click_trend.count() > 0 and r.user_click_count.count() > 0


def test_cli_runs_jobs(spark, tmp_root):
    from clickscope.plans import cli
    out = f"{tmp_root}/cli"
    cli.main(["area", "--sf-dir", SF, "--task-id", "4", "--out", out,
              "--params", '{"startDate":["2024-01-01"],"endDate":["2024-01-31"]}'])
    cli.main(["page", "--sf-dir", SF, "--task-id", "5", "--out", out, "--params", '{"targetPageFlow":["1,2,3"]}'])
    assert spark.read.parquet(f"{out}/area_top3_product").where("task_id = 4").count() > 0
    assert spark.read.parquet(f"{out}/page_split_convert_rate").first()["convert_rate"].startswith("1_2=")


def test_cli_ads_stream(spark, tmp_root):
    import os

    from clickscope.plans import cli
    src = f"{tmp_root}/log"
    os.makedirs(src)
    with open(f"{src}/a.txt", "w") as f:
        f.write("1704103200000 P C 1 7\n1704103201000 P C 1 7\n1704103202000 P C 2 7\nnot a line\n")
    out = f"{tmp_root}/ads"
    cli.main(["ads", "--source", src, "--out", out, "--threshold", "2", "--available-now"])
    from clickscope.streaming.ad_stream import AdClickStream
    job = AdClickStream(spark, out, threshold=2)
    assert sorted(r[0] for r in job.blacklist().collect()) == [1]
    assert sum(r["click_count"] for r in job.ad_stat().collect()) == 3
    assert job.click_trend().count() == 1 and job.rejected_lines().count() == 1


def test_partitioned_fact_prunes_dates(spark, tmp_root):
    import contextlib
    import io

    from clickscope.sources import scans
    path = f"{tmp_root}/uva"
    scans.write_fact_partitioned(tables.user_visit_action(spark, SF), path)
    df = scans.date_range_scan(spark.read.parquet(path), "2024-01-05", "2024-01-06")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    plan = buf.getvalue()
    assert "PartitionFilters: [isnotnull(date" in plan and "2024-01-05" in plan
    assert df.count() == tables.user_visit_action(spark, SF, "2024-01-05", "2024-01-06").count()


def test_cli_session_job(spark, tmp_root):
    from clickscope.plans import cli
    out = f"{tmp_root}/cli_sess"
    cli.main(["session", "--sf-dir", SF, "--task-id", "6", "--out", out, "--extract-total", "3000",
              "--params", '{"startDate":["2024-01-01"],"endDate":["2024-01-31"],"startAge":["10"],"endAge":["50"]}'])
    ext = spark.read.parquet(f"{out}/session_random_extract")
    assert [f.dataType.simpleString() for f in ext.schema.fields if f.name != "task_id"] == ["string"] * 4
    # session_detail holds the rows of the drawn and of the top sessions, no others
    det = spark.read.parquet(f"{out}/session_detail").select("session_id").distinct()
    stored = ext.select("session_id").union(spark.read.parquet(f"{out}/top10_session").select("session_id")).distinct()
    assert sorted(map(tuple, det.collect())) == sorted(map(tuple, stored.collect()))
    for t in ("session_aggr_stat", "session_random_extract", "session_detail", "top10_category", "top10_session"):
        assert spark.read.parquet(f"{out}/{t}").where("task_id = 6").count() > 0, t


def test_checkpoint_root_without_conf_never_sets_core_conf(spark):
    from clickscope import config

    class NoCheckpointConf:
        def __init__(self, conf):
            self.conf = conf

        def get(self, key, default=None):
            return default if key == "spark.checkpoint.dir" else self.conf.get(key, default)

        def set(self, key, value):
            raise AssertionError("core conf set at runtime: " + key)

    class View:
        def __init__(self, s):
            self.conf = NoCheckpointConf(s.conf)
            self.sparkContext = s.sparkContext

    root = config.checkpoint_root(View(spark))
    assert root and root.rstrip("/") == spark.sparkContext.getCheckpointDir().rstrip("/")


def test_random_extract_small_total_vanishes(spark):
    """Total 100 over 30 days gives 3 per day, and every hour's share floors to 0 (FIXTURES.md §2)."""
    from clickscope.operators import sessions
    from clickscope.sources import scans
    sess = sessions.session_aggregate(scans.scoped_actions(spark, "/root/testdata/sf0.01", "2024-01-01", "2024-01-31"))
    assert sessions.random_extract(sess, 100).count() == 0
    assert sessions.random_extract(sess, 3000).count() > 0
