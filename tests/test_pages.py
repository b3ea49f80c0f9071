import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from clickscope.functions import dates
from clickscope.operators import ordered, pages
from helpers import action, actions_df, rows_set


def test_flow_pairs():
    assert pages.flow_pairs([1, 2, 3]) == [(1, "1_2"), (2, "2_3")]
    assert pages.parse_flow("3,5,,2") == [3, 5, 2]


def test_same_second_tie_break(spark):
    # Two actions in the same second are ordered by event id
    rows = [action("s", 0, 2, page_id=2), action("s", 0, 1, page_id=1)]
    got = rows_set(pages.page_pairs(actions_df(spark, rows)), "prev_page_id", "page_id")
    assert got == [(1, 2)]


def test_rates_unseen_pair_and_start(spark):
    # Flow 1,2,3 where 2_3 never occurs → pv 0, and the next step's denominator is 0 → null
    rows = [action("a", 0, 1, page_id=1), action("a", 1, 2, page_id=2), action("b", 0, 3, page_id=1),
            action("b", 1, 4, page_id=2), action("c", 0, 5, page_id=1), action("c", 1, 6, page_id=4)]
    acts = actions_df(spark, rows)
    flow = [1, 2, 3, 4]
    split = pages.page_split_pv(pages.page_pairs(acts), flow)
    rates = {r["page_pair"]: (r["pv"], r["convert_rate"])
             for r in pages.convert_rates(spark, split, pages.start_page_pv(acts, flow), flow).collect()}
    assert rates == {"1_2": (2, 0.67), "2_3": (0, 0.0), "3_4": (0, None)}
    text = pages.convert_rate_text(pages.convert_rates(spark, split, pages.start_page_pv(acts, flow), flow), 9)
    assert text.first()["convert_rate"] == "1_2=0.67|2_3=0.0|3_4=null"
    # start page never seen → first rate null
    rates = pages.convert_rates(spark, pages.page_split_pv(pages.page_pairs(acts), [7, 1]),
                                pages.start_page_pv(acts, [7, 1]), [7, 1]).first()
    assert rates["pv"] == 0 and rates["convert_rate"] is None


def test_duplicate_pair_in_flow_counted_once(spark):
    rows = [action("a", 0, 1, page_id=1), action("a", 1, 2, page_id=2)]
    acts = actions_df(spark, rows)
    split = pages.page_split_pv(pages.page_pairs(acts), [1, 2, 1, 2])
    assert rows_set(split) == [("1_2", 1)]


def plain_lag(df, groups, order, value):
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn("prev_" + value, F.lag(value).over(w))


def test_chunked_lag_equals_window_with_hot_group(spark):
    # one session holds most rows and spans many chunks; sessions, times and pages may be null
    rnd = random.Random(3)
    rows = []
    for i in range(3000):
        sid = "hot" if rnd.random() < 0.8 else rnd.choice([None, *[f"s{k}" for k in range(40)]])
        rows.append(action(sid, rnd.randrange(500_000), i, page_id=rnd.choice([None, *range(9)])))
    acts = actions_df(spark, rows).select("session_id", "page_id", "event_id",
                                          F.when(F.col("event_id") % 50 != 0, F.col("action_time")).alias("action_time"))
    expect = [(e, p) for e, p in plain_lag(acts, ["session_id"], ["action_time", "event_id"], "page_id")
              .select("event_id", "prev_page_id").collect()]
    hour, day = dates.hour_index("action_time"), F.to_date("action_time")
    for chunk in (hour, day, F.lit(1)):
        got = ordered.previous_in_order(acts, ["session_id"], ["action_time", "event_id"], ["page_id"], chunk)
        assert sorted(got.select("event_id", "prev_page_id").collect(), key=str) == sorted(expect, key=str)
    # the hot session is cut into many window groups
    assert acts.where(F.col("session_id") == "hot").select(hour).distinct().count() > 100


def test_chunked_lag_plan_and_empty(spark):
    rows = [action("x", i * 1800, i, page_id=i % 3) for i in range(10)]
    acts = actions_df(spark, rows).select("session_id", "page_id", "action_time", "event_id")
    args = (["session_id"], ["action_time", "event_id"], ["page_id"], dates.hour_index("action_time"))
    a = ordered.previous_in_order(acts, *args)
    assert rows_set(a.where("event_id > 0"), "event_id", "prev_page_id") == [(i, (i - 1) % 3) for i in range(1, 10)]
    assert a.where("event_id = 0").first()["prev_page_id"] is None
    assert ordered.previous_in_order(acts.where("false"), *args).count() == 0


def test_hour_index_is_calendar_time(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'1970-01-02 03:59:59' AS t UNION ALL SELECT TIMESTAMP_NTZ'1969-12-31 23:00:00'")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert sorted(r[0] for r in df.select(dates.hour_index("t")).collect()) == [-1, 27]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
