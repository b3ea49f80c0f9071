import json
import os
import random

import pytest
from pyspark.sql import functions as F

from clickscope.operators import ads
from clickscope.sinks import log_tables as lt
from clickscope.sources import adlog, segment_log
from clickscope.sources.external import text_stream
from clickscope.streaming.ad_state import AdState
from clickscope.streaming.ad_stream import AdClickStream, run_available, run_now, run_segments
from helpers import rows_set

MS = 1704103200000  # 2024-01-01 10:00:00 UTC


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """State operators start a worker per partition; small logs need few."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def line(sec, prov, city, user, ad):
    return f"{MS + sec * 1000} {prov} {city} {user} {ad}"


def batch(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def _write(dirpath, name, lines):
    os.makedirs(dirpath, exist_ok=True)
    with open(os.path.join(dirpath, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_stop_and_resume_keeps_totals(spark, tmp_root):
    src = f"{tmp_root}/src"
    part1 = [line(i, "P", "C", i % 3, i % 2) for i in range(0, 40)]
    part2 = [line(i, "Q", "D", i % 3, i % 2) for i in range(40, 100)]
    _write(src, "a.txt", part1)
    root = f"{tmp_root}/resume"
    run_available(AdClickStream(spark, root, threshold=10_000), src, 1)
    _write(src, "b.txt", part2)
    resumed = AdClickStream(spark, root, threshold=10_000)
    run_available(resumed, src, 1)
    one_shot_src = f"{tmp_root}/src2"
    _write(one_shot_src, "a.txt", part1 + part2)
    one = AdClickStream(spark, f"{tmp_root}/oneshot", threshold=10_000)
    run_available(one, one_shot_src)
    assert rows_set(resumed.ad_stat()) == rows_set(one.ad_stat())
    assert rows_set(resumed.click_trend()) == rows_set(one.click_trend())
    total = sum(r["click_count"] for r in resumed.ad_stat().collect())
    assert total == 100


def test_trend_with_watermark(spark, tmp_root):
    src = f"{tmp_root}/wsrc"
    _write(src, "a.txt", [line(i, "P", "C", 1, 1) for i in range(0, 120, 10)])
    job = AdClickStream(spark, f"{tmp_root}/wm", threshold=10_000, watermark="10 minutes")
    run_available(job, src, main=False)
    assert rows_set(job.click_trend()) == [("20240101", "10", "00", 1, 6), ("20240101", "10", "01", 1, 6)]


def test_trend_sliding_window(spark, tmp_root):
    src = f"{tmp_root}/ssrc"
    _write(src, "a.txt", [line(i, "P", "C", 1, 1) for i in (0, 10, 40)])
    job = AdClickStream(spark, f"{tmp_root}/slide", threshold=10_000, trend_window="60 seconds",
                        trend_slide="30 seconds")
    run_available(job, src, main=False)
    got = {r["window_start"]: r["click_count"] for r in job.click_trend_windows().collect()}
    # clicks at 10:00:00, :10, :40 in 60 s windows sliding by 30 s
    assert got == {"20240101095930": 2, "20240101100000": 3, "20240101100030": 1}


def test_ad_log_stream_names_one_source(spark, tmp_root):
    from clickscope.sources.external import ad_log_stream
    src = f"{tmp_root}/one-source"
    os.makedirs(src)
    df = ad_log_stream(spark, path=src)
    assert df.isStreaming and df.columns == ["value"]
    with pytest.raises(ValueError):
        ad_log_stream(spark)
    with pytest.raises(ValueError):
        ad_log_stream(spark, brokers="localhost:9", topics="ads", path=src)
    with pytest.raises(ValueError):
        ad_log_stream(spark, path=src, log=src)
    assert ad_log_stream(spark, log=src, group="g").columns == ["partition", "offset", "value"]


def test_line_with_an_impossible_time_is_a_reject(spark):
    lines = spark.createDataFrame([("99999999999999999 P C 1 2",), ("-5 P C 1 2",), ("1704103200000 P C 1 2",)],
                                  "value string")
    assert adlog.parse_ad_log(lines).count() == 1
    assert adlog.parse_ad_log_rejects(lines).count() == 2


def test_console_sink_runs(spark, tmp_root):
    from clickscope.streaming.ad_stream import console_sink
    src = f"{tmp_root}/console"
    _write(src, "a.txt", [line(0, "P", "C", 1, 1)])
    q = console_sink(adlog.parse_ad_log(text_stream(spark, src)), {"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None


READERS = ("ad_stat", "user_click_count", "blacklist", "province_top3")


def test_blacklist_feedback_across_batches(spark, tmp_root):
    src, root = f"{tmp_root}/fb_src", f"{tmp_root}/ads"
    _write(src, "a.txt", [line(0, "P", "C", 1, 7), line(1, "P", "C", 1, 7), line(2, "P", "C", 2, 7), "broken line"])
    job = AdClickStream(spark, root, threshold=2)
    main, rejects = run_now(job, lambda: text_stream(spark, src), trend=False, rejects=True)
    assert rows_set(job.blacklist()) == [(1,)]
    assert adlog.observed_counts(main) == (4, 1)  # counted in passing, without a job
    _write(src, "b.txt", [line(10, "P", "C", 1, 8), line(11, "P", "C", 2, 7)])
    job = AdClickStream(spark, root, threshold=2)
    run_available(job, src, trend=False)
    # user 1 is filtered from batch 1 on; user 2 reaches 2 in batch 1
    assert rows_set(job.blacklist()) == [(1,), (2,)]
    assert rows_set(job.ad_stat()) == [("20240101", "P", "C", 7, 4)]
    assert rows_set(job.user_click_count()) == [("20240101", 1, 7, 2), ("20240101", 2, 7, 2)]
    assert rows_set(job.province_top3()) == [("20240101", "P", 7, 4)]
    assert job.rejected_lines().count() == 1


def test_crash_mid_batch_then_restart_is_exactly_once(spark, tmp_root):
    """A batch that dies after some of its writes is replayed on restart; the tables end as if it ran once."""
    src = f"{tmp_root}/crash_src"
    _write(src, "a.txt", [line(i, "P", "C", i % 3, i % 2) for i in range(0, 30)])
    _write(src, "b.txt", [line(i, "P", "C", i % 3, i % 2) for i in range(30, 60)])
    _write(src, "c.txt", [line(i, "Q", "D", i % 3, i % 2) for i in range(60, 90)])

    class CrashOnce(AdState):
        crashed = False

        def write_batch(self, batch_df, batch_id):
            if batch_id == 1 and not CrashOnce.crashed:
                real = lt.replace_upsert

                def write_then_die(table, rows, b):
                    real(table, rows, b)
                    CrashOnce.crashed = True
                    raise RuntimeError("executor lost")
                lt.replace_upsert = write_then_die
                try:
                    return super().write_batch(batch_df, batch_id)
                finally:
                    lt.replace_upsert = real
            return super().write_batch(batch_df, batch_id)

    root = f"{tmp_root}/crash"
    dying = AdClickStream(spark, root, threshold=6)
    dying.main = CrashOnce(spark, root, threshold=6)
    with pytest.raises(Exception):  # noqa: B017
        run_available(dying, src, 1, trend=False)
    assert CrashOnce.crashed
    resumed = AdClickStream(spark, root, threshold=6)
    run_available(resumed, src, 1, trend=False)
    clean = AdClickStream(spark, f"{tmp_root}/nocrash", threshold=6)
    run_available(clean, src, 1, trend=False)
    for reader in READERS:
        assert rows_set(getattr(resumed, reader)()) == rows_set(getattr(clean, reader)()), reader


def _random_clicks(spark, n=400, seed=1):
    r = random.Random(seed)
    rows = [(i, r.randrange(12), line(i // 3 * 400, *r.choice([("P", "C"), ("P", "D"), ("Q", "E")]), 0, r.randrange(5)))
            for i in range(n)]
    rows = [(i, u, v[:v.rindex(" 0 ")] + f" {u} " + v[v.rindex(" ") + 1:]) for i, u, v in rows]
    return spark.createDataFrame(rows, "event_id long, user_id long, value string")


def test_listing_by_click_does_not_depend_on_batches(spark, tmp_root):
    """Equal times within and across users, a threshold that is reached inside batches, three ways to cut the log."""
    df = _random_clicks(spark)
    typed = adlog.parse_ad_log(df, keep=("event_id",))
    kept = ads.apply_cutoffs(typed, ads.blacklist_cutoffs(typed, 4))
    stat = ads.ad_stat(kept)
    for cuts in ([400], [90, 200, 400]):
        root = f"{tmp_root}/cuts{len(cuts)}"
        lo = 0
        for hi in cuts:
            part = df.where((F.col("event_id") >= lo) & (F.col("event_id") < hi))
            segment_log.append_segments(part, f"{root}/log", F.pmod("user_id", F.lit(3)), ["event_id"], F.lit(0))
            job = AdClickStream(spark, f"{root}/out", threshold=4, listing="click")  # resumes on the checkpoints
            run_segments(job, f"{root}/log")
            lo = hi
        assert rows_set(job.ad_stat()) == rows_set(stat)
        assert rows_set(job.province_top3()) == rows_set(ads.province_top(stat, 3))
        assert rows_set(job.blacklist()) == rows_set(ads.blacklist_cutoffs(typed, 4).select("user_id"))
    # the state is what the tables say
    counts = rows_set(ads.user_ad_click_counts(kept), "date", "user_id", "ad_id", "click_count")
    assert rows_set(job.user_click_count()) == counts
    keys = spark.createDataFrame([("20240101", counts[0][1], counts[0][2]), ("20240101", 999, 1)],
                                 "date string, user_id long, ad_id long")
    assert [r["click_count"] for r in job.main.lookup_click_count(keys).orderBy("user_id").collect()] == [counts[0][3], 0]
    job.main.publish(f"{root}/published")
    job.main.publish(f"{root}/published", ["20240101"])  # one date anew
    published = spark.read.schema(job.main.stat.schema).parquet(f"{root}/published")
    assert rows_set(published, *stat.columns) == rows_set(stat)
    with pytest.raises(ValueError):
        AdClickStream(spark, f"{root}/bad", listing="later").start_main(batch(spark, []))


def _log(spark, path, lo, hi, partitions=2):
    df = spark.range(lo, hi).selectExpr("id", "concat('l', id, ' é') AS value")
    segment_log.append_segments(df, path, F.pmod("id", F.lit(partitions)), ["id"], (F.col("id") / 10).cast("int"))


def _read(spark, path, out, **options):
    q = (segment_log.segment_stream(spark, path, **options).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", out + "-c").trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    rows = spark.read.schema(segment_log.SCHEMA).parquet(out) if os.path.isdir(out) else None
    return q, sorted(tuple(r) for r in rows.collect()) if rows is not None else []


def test_segment_log_offsets(spark, tmp_root):
    log = f"{tmp_root}/seg"
    _log(spark, log, 0, 40)
    _log(spark, log, 40, 60)
    line_of = lambda p, o: (p, o, f"l{2 * o + p} é")  # noqa: E731 - two partitions, by parity
    every = [line_of(p, o) for p in (0, 1) for o in range(30)]
    assert segment_log.earliest(log) == {0: 0, 1: 0} and segment_log.latest(log) == {0: 30, 1: 30}
    assert _read(spark, log, f"{tmp_root}/all")[1] == every
    # named offsets, inside a segment; a partition that isn't named starts at its first line
    assert _read(spark, log, f"{tmp_root}/some", starting_offsets={0: 17})[1] == [
        e for e in every if e[0] == 1 or e[1] >= 17]
    assert _read(spark, log, f"{tmp_root}/new", starting_offsets="latest")[1] == []
    # a group commits, more lines and a partition come, a new program goes on after the commit
    q, _ = _read(spark, log, f"{tmp_root}/g1", group="g")
    segment_log.commit_progress(q, log, "g")
    assert segment_log.group_offsets(log, "g") == {0: 30, 1: 30} and segment_log.group_offsets(log, "other") is None
    _log(spark, log, 60, 66, partitions=3)
    got = _read(spark, log, f"{tmp_root}/g2", group="g", starting_offsets="earliest")[1]
    assert [(p, o) for p, o, _ in got] == [(0, 30), (0, 31), (1, 30), (1, 31), (2, 0), (2, 1)]
    # expired offsets: stop, or go on at the first there is
    segment_log.expire(log, {0: 30, 1: 0, 2: 2})
    assert segment_log.earliest(log) == {0: 30, 1: 0, 2: 2} and segment_log.latest(log) == {0: 32, 1: 32, 2: 2}
    segment_log.commit_group(log, "old", {0: 3, 1: 31, 2: 0})
    with pytest.raises(Exception, match="expired"):
        _read(spark, log, f"{tmp_root}/g3", group="old")
    got = _read(spark, log, f"{tmp_root}/g4", group="old", fail_on_data_loss=False)[1]
    assert [(p, o) for p, o, _ in got] == [(0, 30), (0, 31), (1, 31)]
    # an emptied partition goes on after its last offset
    _log(spark, log, 68, 69, partitions=3)
    assert segment_log.latest(log)[2] == 3


def test_an_unfinished_append_is_not_read(spark, tmp_root):
    """The files of an append appear one by one; a running query that asks meanwhile must not take some of them as a batch."""
    log = f"{tmp_root}/half"
    _log(spark, log, 0, 20)
    reader = segment_log._Reader({"path": log, "startingoffsets": "latest"})
    assert reader.latestOffset() == reader.initialOffset() == {"0": 10, "1": 10}
    _write(f"{log}/p=0/base=10/n=2", "part-0.txt", ["a", "b"])  # the append's job is still moving its other files
    assert reader.latestOffset() == reader.initialOffset() == {"0": 10, "1": 10}
    _log(spark, log, 24, 30)
    assert reader.latestOffset() == {"0": 15, "1": 13}


def test_segment_reader_packs_and_checks(tmp_root, monkeypatch):
    """Offsets, tasks and pieces without a stream; a segment shorter than its name says is an error."""
    log = f"{tmp_root}/plain"
    for base, n, held in ((0, 3, 3), (3, 4, 4), (7, 2, 1)):
        _write(f"{log}/p=5/base={base}/n={n}", "part-0.txt", [f"x{base + i}" for i in range(held)])
    reader = segment_log._Reader({"path": log, "startingoffsets": json.dumps({"5": 2})})
    assert reader.initialOffset() == {"5": 2} and reader.latestOffset() == {"5": 9}
    assert [p.pieces for p in reader.partitions({"5": 2}, {"5": 6})] == [
        [(f"{log}/p=5/base=0/n=3", 0, 2, 3), (f"{log}/p=5/base=3/n=4", 3, 3, 6)]]
    monkeypatch.setattr(segment_log, "TASK_LINES", 1)
    tasks = reader.partitions({"5": 2}, {"5": 8})
    assert [len(t.pieces) for t in tasks] == [1, 1, 1]
    values = [v for t in tasks for b in reader.read(t) for v in b.column(2).to_pylist()]
    assert values == [f"x{i}" for i in range(2, 8)]
    with pytest.raises(ValueError, match="ends at 8"):
        for t in reader.partitions({"5": 7}, {"5": 9}):
            list(reader.read(t))
    assert reader.partitions({"5": 9}, {"5": 9}) == []


def test_trend_crash_then_restart_keeps_full_minutes(spark, tmp_root):
    src = f"{tmp_root}/tcrash_src"
    for f, rng in (("a.txt", range(0, 50)), ("b.txt", range(50, 100)), ("c.txt", range(100, 150))):
        _write(src, f, [line(i, "P", "C", 1, i % 2) for i in rng])

    class CrashTrendOnce(AdClickStream):
        crashed = False

        def _write_trend(self, batch_df, batch_id):
            super()._write_trend(batch_df, batch_id)
            if batch_id == 1 and not CrashTrendOnce.crashed:
                CrashTrendOnce.crashed = True
                raise RuntimeError("executor lost after the write")

    root = f"{tmp_root}/tcrash"
    with pytest.raises(Exception):
        run_available(CrashTrendOnce(spark, root, threshold=10_000), src, 1, main=False)
    resumed = AdClickStream(spark, root, threshold=10_000)
    run_available(resumed, src, 1, main=False)
    clean = AdClickStream(spark, f"{tmp_root}/tclean", threshold=10_000)
    run_available(clean, src, 1, main=False)
    assert rows_set(resumed.click_trend()) == rows_set(clean.click_trend())
    assert sum(r["click_count"] for r in resumed.click_trend().collect()) == 150


def test_trend_state_has_the_partitions_asked_for(spark, tmp_root):
    _write(f"{tmp_root}/src", "a.txt", [line(i, "P", "C", i, i % 5) for i in range(20)])
    job = AdClickStream(spark, f"{tmp_root}/out", state_partitions=3)
    run_now(job, lambda: text_stream(spark, f"{tmp_root}/src"), main=False)
    held = os.listdir(f"{tmp_root}/out/_checkpoints/ad_trend/state/0")
    assert sorted(x for x in held if x.isdigit()) == ["0", "1", "2"]
    assert spark.conf.get("spark.sql.shuffle.partitions") == "2"


def test_result_tables_do_not_get_a_file_per_date(spark, tmp_root):
    """90 dates of three months: folders follow the months, files the months and cores; a replaced total is still found."""
    src, day = f"{tmp_root}/days", 86_400
    _write(src, "a.txt", [line(d * day, "P", "C", d, 7) for d in range(90)])
    job = AdClickStream(spark, f"{tmp_root}/out", threshold=10_000)
    run_available(job, src, trend=False)
    for table in ("ad_stat", "ad_province_top3"):
        held = [(os.path.relpath(at, f"{job.root}/{table}"), [f for f in files if f.endswith(".parquet")])
                for at, _, files in os.walk(f"{job.root}/{table}") if at.endswith("batch_id=0")]
        assert sorted(at.split("/")[0] for at, _ in held) == [f"month=2024{m:02d}" for m in (1, 2, 3)]
        assert sum(len(files) for _, files in held) <= 3 + spark.sparkContext.defaultParallelism
    _write(src, "b.txt", [line(0, "P", "D", 1, 7), line(0, "P", "C", 1, 7)])
    run_available(AdClickStream(spark, job.root, threshold=10_000), src, trend=False)
    dates = sorted(r["date"] for r in job.ad_stat().where("city = 'C'").collect())
    assert len(set(dates)) == len(dates) == 90 and job.ad_stat().columns == job.main.stat.schema.names
    assert rows_set(job.ad_stat().where("date = '20240101'")) == [("20240101", "P", "C", 7, 2), ("20240101", "P", "D", 7, 1)]
    assert rows_set(job.province_top3().where("date <= '20240102'")) == [("20240101", "P", 7, 3), ("20240102", "P", 7, 1)]


def test_state_partitions_follow_the_lines(tmp_root, monkeypatch):
    from clickscope.plans import reg_stream
    log = f"{tmp_root}/plain"
    for p, n in ((0, 70), (1, 31)):
        _write(f"{log}/p={p}/base=0/n={n}", "part-0.txt", ["x"] * n)
    assert reg_stream._state_partitions(log) == reg_stream.PARTITIONS  # a small log
    monkeypatch.setattr(reg_stream, "STATE_LINES", 10)
    assert reg_stream._state_partitions(log) == 11
    monkeypatch.setattr(reg_stream, "USER_GROUPS", 7)  # a partition without keys would be of no use
    assert reg_stream._state_partitions(log) == 7
