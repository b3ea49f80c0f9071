"""Many tasks in one pass against one job per task; hash samples."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from clickscope.operators import sessions, task_stats
from clickscope.operators.task_stats import task_session_stats
from clickscope.operators.topn import hash_sample
from clickscope.params import SessionParams
from clickscope.plans.session_job import filtered_sessions
from clickscope.sources.scans import date_range_scan
from helpers import action, actions_df

DAYS = [f"2024-01-{d:02d}" for d in range(1, 8)]


def _actions(spark):
    r = random.Random(6)
    rows = []
    for i in range(260):
        s = r.randrange(40)
        day = DAYS[min(6, s % 6 + (r.randrange(3) if s % 4 == 0 else 0))]  # every fourth session spans days
        click = r.choice([None, 3, 4, 5])
        rows.append(action(f"s{s}" if s else None, DAYS.index(day) * 86_400 + r.randrange(900), i, user_id=s % 9,
                           keyword=None if click else r.choice(["kw1", "kw2"]), click=click, date=day))
    return actions_df(spark, rows)


def _users(spark):
    rows = [(u, 10 + 5 * u if u != 3 else None, ["a", "b", None][u % 3], f"city{u % 4}", ["male", "female"][u % 2])
            for u in range(8)]  # user 8 is unknown
    return spark.createDataFrame(rows, "user_id long, age int, professional string, city string, sex string")


PARAMS = [
    {}, {"startDate": ["2024-01-02"], "endDate": ["2024-01-04"]}, {"startDate": ["2024-01-03"]}, {"endDate": ["2024-01-02"]},
    {"startDate": ["2024-01-05"], "endDate": ["2024-01-02"]}, {"startDate": ["2023-01-01"], "endDate": ["2030-01-01"]},
    {"startAge": ["15"], "endAge": ["30"]}, {"startAge": ["15"]}, {"sex": ["female"], "startDate": [""]},
    {"professionals": ["a,,b"], "cities": ["city1,city2"]}, {"professionals": [","]},
    {"keywords": ["kw1"], "startDate": ["2024-01-02"], "endDate": ["2024-01-03"]}, {"categoryIds": ["3,x,5"]},
    {"keywords": ["kw2"], "categoryIds": ["4"], "startAge": ["0"], "endAge": ["99"]}, {"keywords": ["none"]},
    {"startDate": ["2025-01-01"], "endDate": ["2025-02-01"]},
]


def test_every_task_equals_its_own_job(spark):
    actions, users = _actions(spark), _users(spark)
    assert actions.groupBy("session_id").agg(F.countDistinct("date").alias("n")).where("n > 1").count() > 3
    tasks = spark.createDataFrame([(i, "t", "session", json.dumps(p)) for i, p in enumerate(PARAMS)]
                                  + [(100, "t", "session", "{not json"), (None, "t", "session", None)],
                                  "task_id long, task_name string, task_type string, task_param string")
    got = {r["task_id"]: r for r in task_session_stats(actions, users, tasks).collect()}
    assert len(got) == len(PARAMS) + 2
    for i, p in enumerate(PARAMS):
        own = SessionParams.from_json(json.dumps(p))
        scoped = date_range_scan(actions, own.start_date, own.end_date)
        expected = sessions.session_stats(filtered_sessions(scoped, users, own), i).first()
        assert {c: got[i][c] for c in expected.asDict()} == expected.asDict(), p
    for k in (100, None):  # unreadable parameters are unset
        assert got[k]["session_count"] == got[0]["session_count"] > 0
    assert got[15]["session_count"] == 0 and got[15]["step_1_3"] is None


def test_tasks_of_empty_tables(spark):
    actions, users = _actions(spark), _users(spark)
    tasks = spark.createDataFrame([(1, "{}")], "task_id long, task_param string")
    tasks = tasks.withColumn("task_name", F.lit("")).withColumn("task_type", F.lit(""))
    assert task_session_stats(actions, users, tasks.where("false")).collect() == []
    none = task_session_stats(actions.where("false"), users, tasks).collect()
    assert [(r["task_id"], r["session_count"], r["visit_30m"]) for r in none] == [(1, 0, None)]


def test_hash_sample_is_the_same_everywhere(spark):
    df = spark.range(5000).withColumn("key", F.when(F.col("id") % 100 > 0, F.col("id")))
    tenth = {r["id"] for r in hash_sample(df, "id", 0.1, 3).collect()}
    assert 400 < len(tenth) < 600
    assert {r["id"] for r in hash_sample(df.repartition(7), "id", 0.1, 3).collect()} == tenth
    assert tenth < {r["id"] for r in hash_sample(df, "id", 0.2, 3).collect()}
    assert tenth != {r["id"] for r in hash_sample(df, "id", 0.1, 4).collect()}
    assert hash_sample(df, "key", 1.0).count() == 5000 and hash_sample(df, "key", 0.0).count() == 0
    assert hash_sample(df, "key", 0.5).where("key IS NULL").count() in (0, 50)  # equal keys stay or go together
    with pytest.raises(ValueError):
        hash_sample(df, "id", 1.5)


def test_blocks_cover_every_range_once(spark):
    numbers = [(a, b) for a in range(10) for b in range(-1, 10)]
    cover = task_stats._blocks_between(F.col("a"), F.col("b"), 4)
    for r in spark.createDataFrame(numbers, "a long, b long").withColumn("blocks", cover).collect():
        held = [x for e in r["blocks"] for x in range(e["block"] << e["level"], (e["block"] + 1) << e["level"])]
        assert sorted(held) == list(range(r["a"], r["b"] + 1)) and len(r["blocks"]) <= 8


def test_sessions_do_not_meet_tasks_one_by_one(spark):
    """Tasks with lists over all days: counts per ask are joined, on all their keys, not sessions on the day. Equal task
    rows both count."""
    actions, users = _actions(spark), _users(spark)
    rows = [(i, "t", "session", json.dumps({"keywords": ["kw1"], "startAge": [str(i % 9)], "endAge": ["40"]})) for i in range(60)]
    tasks = spark.createDataFrame(rows + rows[-1:], "task_id long, task_name string, task_type string, task_param string")
    out = task_session_stats(actions, users, tasks)
    plan = out._sc._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "simple")
    assert "Join" in plan and not re.search(r"Join \[day#\d+\], \[day#", plan)
    counts = {}
    for r in out.collect():
        counts.setdefault(r["task_id"], []).append(r["session_count"])
    assert counts[59] == [2 * counts[50][0]] * 2 and counts[50][0] > 0
