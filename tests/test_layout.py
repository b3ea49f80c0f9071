"""The fact table stored by session and day: same results as the plain operators, and no exchange above its scan."""

import random
import re

import pytest
from pyspark.sql import functions as F

from clickscope.operators import pages, sessions
from clickscope.sources import layout
from helpers import action, actions_df, rows_set

DAYS = ["2024-01-01", "2024-01-02", "2024-01-04"]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    r = random.Random(8)
    rows = []
    for i in range(400):
        s, d = r.choice([0, 0, 0, *range(1, 30)]), r.randrange(3)  # session 0 is hot; sessions span days
        rows.append(action(f"s{s}", d * 86_400 + r.randrange(40) * 60, i, user_id=s, page_id=r.randrange(5), date=DAYS[d]))
    plain = actions_df(spark, rows).repartition(4)
    from clickscope.config import checkpoint_root
    fact = layout.write_by_session(plain, "fact_layout_test", f"{checkpoint_root(spark)}/fact_layout_test", 4)
    yield plain, fact
    layout.drop(spark, "fact_layout_test")


def exchanges_over_scan(df) -> int:
    """Shuffles whose input is fact rows as scanned (not yet aggregated, ranked or joined)."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    found = 0
    for i, line in enumerate(lines):
        if re.search(r"Exchange hashpartitioning", line):
            below = next((x for x in lines[i + 1:] if re.search(r"Aggregate|Window|Join|FileScan|Scan", x)), "")
            found += "Scan" in below and "Aggregate" not in below
    return found


def test_stored_fact_gives_the_same_rows(stored):
    plain, fact = stored
    assert rows_set(fact, "event_id", "session_id", "date") == rows_set(plain, "event_id", "session_id", "date")
    assert rows_set(layout.session_measures(fact)) == rows_set(sessions.session_measures(plain))
    pairs = layout.page_pairs(fact)
    assert rows_set(pairs) == rows_set(pages.page_pairs(plain)) and pairs.count() > 300
    wanted = sessions.session_measures(plain).where(F.col("step_length") > 12)
    assert rows_set(layout.session_detail(fact, wanted), "event_id") == rows_set(
        sessions.session_detail(plain, wanted), "event_id")


def test_plans_do_not_shuffle_the_fact(spark, stored):
    _, fact = stored
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if every other side were large
    try:
        wanted = layout.session_measures(fact).where("step_length > 3")
        for df in (layout.session_measures(fact), layout.page_pairs(fact), layout.session_detail(fact, wanted)):
            assert exchanges_over_scan(df) == 0, df._jdf.queryExecution().executedPlan().toString()
        plain = stored[0]
        assert exchanges_over_scan(fact.repartition(3, "user_id")) == 1 and plain.count() == 400
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
