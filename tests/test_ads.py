import datetime as dt

from clickscope.operators import ads
from clickscope.sources import adlog
from helpers import rows_set

T0 = dt.datetime(2024, 1, 1, 9, 0, 0)


def clicks(spark, rows):
    """rows: (seconds, date, province, city, user, ad, event_id)"""
    data = [(T0 + dt.timedelta(seconds=s), d, p, c, u, a, e) for s, d, p, c, u, a, e in rows]
    return spark.createDataFrame(data, "ts timestamp_ntz, date string, province string, city string, "
                                       "user_id bigint, ad_id bigint, event_id bigint")


def test_province_top3_per_day_with_ties(spark):
    # Exactly 3 per (date, province); ties broken by ad id
    rows, e = [], 0
    for day in ("20240101", "20240102"):
        for prov in ("P1", "P2"):
            for ad, n in ((1, 5), (2, 5), (3, 5), (4, 1)):
                for _ in range(n):
                    rows.append((e, day, prov, "c", 1, ad, e)); e += 1
    top = ads.province_top(ads.ad_stat(clicks(spark, rows)), 3)
    got = rows_set(top, "date", "province", "ad_id")
    assert len(got) == 12 and all(a != 4 for _, _, a in got)


def test_parse_and_rejects(spark):
    lines = spark.createDataFrame([("1704067207000 P C 3 4",), ("1704067207000 P C 3",), ("1704067207000 P C x 4",),
                                   ("zz P C 3 4",)], "value string")
    ok = adlog.parse_ad_log(lines).collect()
    assert len(ok) == 1 and ok[0]["date"] == "20240101" and ok[0]["user_id"] == 3 and ok[0]["ad_id"] == 4
    assert ok[0]["ts"] == dt.datetime(2024, 1, 1, 0, 0, 7)
    assert adlog.parse_ad_log_rejects(lines).count() == 3
    back = adlog.format_ad_log(adlog.parse_ad_log(lines)).first()["value"]
    assert back == "1704067207000 P C 3 4"


def test_blacklist_cutoff_event_order(spark):
    # user 1 reaches 2 clicks on ad 7 at t=20 (event 3); later clicks (any ad, any day) are dropped
    rows = [(10, "20240101", "P", "C", 1, 7, 1), (15, "20240101", "P", "C", 1, 8, 2),
            (20, "20240101", "P", "C", 1, 7, 3), (20, "20240101", "P", "C", 1, 8, 4),
            (90000, "20240102", "P", "C", 1, 9, 5), (30, "20240101", "P", "C", 2, 7, 6)]
    c = clicks(spark, rows)
    cut = ads.blacklist_cutoffs(c, 2).collect()
    assert [(r["user_id"], r["cut_event_id"]) for r in cut] == [(1, 3)]
    kept = rows_set(ads.apply_cutoffs(c, ads.blacklist_cutoffs(c, 2)), "event_id")
    assert kept == [(1,), (2,), (3,), (6,)]
    bl = rows_set(ads.blacklist_from_counts(ads.user_ad_click_counts(c), 2))
    assert bl == [(1,)]
    assert rows_set(ads.filter_blacklisted(c, ads.blacklist_from_counts(ads.user_ad_click_counts(c), 2)),
                    "event_id") == [(6,)]


def test_click_trend_minutes(spark):
    rows = [(0, "20240101", "P", "C", 1, 1, 1), (59, "20240101", "P", "C", 1, 1, 2),
            (60, "20240101", "P", "C", 1, 1, 3)]
    got = rows_set(ads.click_trend(clicks(spark, rows)))
    assert got == [("20240101", "09", "00", 1, 2), ("20240101", "09", "01", 1, 1)]


def test_rejects_are_the_lines_that_are_no_clicks(spark):
    lines = spark.createDataFrame([("1704103200000 P C 1 2",), ("bad",), ("1704189600000 P C 1 2",), (None,)], "value string")
    assert adlog.parse_ad_log(adlog.observed(lines)).count() == 2
    assert adlog.parse_ad_log_rejects(adlog.observed(lines)).count() == 2
