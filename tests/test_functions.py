import datetime as dt

from pyspark.sql import functions as F

from clickscope.functions import buckets, dates, numbers, text
from clickscope.operators.products import product_status


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_ratio_half_up_exact(spark):
    # 3/200 = 0.015 → 0.02 (the reference's binary BigDecimal gave 0.01); 1/3 → 0.33; 2/3 → 0.67
    assert one(spark, numbers.ratio_half_up(F.lit(3), F.lit(200))) == 0.02
    assert one(spark, numbers.ratio_half_up(F.lit(1), F.lit(3))) == 0.33
    assert one(spark, numbers.ratio_half_up(F.lit(2), F.lit(3))) == 0.67
    assert one(spark, numbers.ratio_half_up(F.lit(201), F.lit(200))) == 1.01  # 1.005 → 1.01
    assert one(spark, numbers.ratio_half_up(F.lit(5), F.lit(0))) is None


def test_visit_buckets_edges(spark):
    # 0 s is in no bucket; edges per the reference
    cases = {0: None, 1: "1s_3s", 3: "1s_3s", 30: "10s_30s", 31: "30s_60s", 60: "30s_60s", 1800: "10m_30m",
             1801: "30m"}
    df = spark.createDataFrame([(k,) for k in cases], "v long")
    got = {r["v"]: r["b"] for r in df.select("v", buckets.visit_length_bucket("v").alias("b")).collect()}
    assert got == cases
    steps = {1: "1_3", 9: "7_9", 10: "10_30", 60: "30_60", 61: "60"}
    df = spark.createDataFrame([(k,) for k in steps], "v long")
    assert {r["v"]: r["b"] for r in df.select("v", buckets.step_length_bucket("v").alias("b")).collect()} == steps


def test_scaled_buckets():
    b = buckets.scaled(buckets.VISIT_BUCKETS, 1200)
    assert b[0] == ("1s_3s", 1, 3600) and b[4] == ("30s_60s", 36001, 72000) and b[-1][2] is None


def test_kv_get_set(spark):
    df = spark.createDataFrame([("a=1|searchKeywords=|c=x,y",), ("c=3",), ("a=1=2|c=4",)], "t string")
    got = df.select(text.kv_get("t", "a").alias("a"), text.kv_get("t", "searchKeywords").alias("k"),
                    text.kv_get("t", "c").alias("c"), text.kv_set("t", "c", F.lit("9")).alias("s")).collect()
    assert [tuple(r) for r in got] == [("1", None, "x,y", "a=1|searchKeywords=|c=9"), (None, None, "3", "c=9"),
                                       (None, None, "4", "a=1=2|c=9")]
    assert one(spark, text.kv_set(F.lit("a=1"), "zz", F.lit("2"))) == "a=1"


def test_csv_ids_blank_and_duplicates(spark):
    # D8: '' and trailing commas are ignored, duplicates are counted
    df = spark.createDataFrame([("",), ("5,5",), ("5,",), (None,), ("x,7",)], "c string")
    got = [r["a"] for r in df.select(text.csv_to_longs("c").alias("a")).collect()]
    assert got == [[], [5, 5], [5], None, [7]]


def test_product_status_rules(spark):
    # PRJ-5: only product_status 0 is Self; null, {}, bad JSON, 1 → Third Party
    df = spark.createDataFrame([(None,), ("{}",), ("{bad",), ('{"product_status": 0}',), ('{"product_status": 1}',)],
                               "e string")
    got = [r["s"] for r in df.select(product_status(F.col("e")).alias("s")).collect()]
    assert got == ["Third Party", "Third Party", "Third Party", "Self", "Third Party"]


def test_text_helpers(spark):
    assert one(spark, text.concat_long_string(F.lit(1), F.lit("Beijing"))) == "1:Beijing"
    assert one(spark, text.zero_pad2(F.lit(5))) == "05"
    assert one(spark, text.zero_pad2(F.lit(123))) == "123"
    assert one(spark, text.remove_random_prefix(F.lit("7_a_b"))) == "a_b"
    assert one(spark, text.trim_comma(F.lit(",a,b,"))) == "a,b"
    assert one(spark, text.sorted_csv(F.array(F.lit(10), F.lit(1), F.lit(10)))) == "1,10"


def test_time_helpers_zone_free(spark):
    ts = dt.datetime(2024, 3, 10, 2, 30, 15, 999999)
    df = spark.createDataFrame([(ts,)], "t timestamp_ntz")
    r = df.select(dates.trunc_second("t").alias("s"), dates.epoch_millis(dates.trunc_second("t")).alias("ms"),
                  dates.format_datekey("t").alias("dk"), dates.format_minute("t").alias("m")).first()
    assert r["s"] == dt.datetime(2024, 3, 10, 2, 30, 15)
    assert r["ms"] == 1710037815000 and r["dk"] == "20240310" and r["m"] == "202403100230"
    back = spark.range(1).select(dates.from_epoch_millis(F.lit("1710037815000")).alias("b"),
                                 dates.from_epoch_millis(F.lit("oops")).alias("bad")).first()
    assert back["b"] == dt.datetime(2024, 3, 10, 2, 30, 15) and back["bad"] is None
    diff = spark.range(1).select(dates.seconds_between(F.lit(dt.datetime(2024, 1, 1, 0, 1, 0)).cast("timestamp_ntz"),
                                                       F.lit(dt.datetime(2024, 1, 1, 0, 0, 1)).cast("timestamp_ntz")))
    assert diff.first()[0] == 59


def test_sql_functions_registered(spark):
    from clickscope.functions.sql_functions import register_sql_functions
    register_sql_functions(spark)
    r = spark.sql("SELECT concat_long_string(3, 'x', ':') a, json_field('{\"k\": 1}', 'k') b, "
                  "remove_random_prefix('3_ab') c, half_up_ratio(3, 200) d").first()
    assert tuple(r) == ("3:x", "1", "ab", 0.02)


def test_remaining_helpers(spark):
    t1 = F.lit("2024-01-02 03:04:05")
    row = spark.range(1).select(
        dates.parse_time(t1).alias("pt"), dates.parse_time(F.lit("bad")).alias("bad"),
        dates.parse_datekey(F.lit("20240102")).alias("dk"), dates.parse_datekey(F.lit("2024")).alias("dk_bad"),
        dates.date_hour(dates.parse_time(t1)).alias("dh"), dates.format_second(dates.parse_time(t1)).alias("sec"),
        dates.before(dates.parse_time(t1), dates.parse_time(F.lit("2024-01-02 03:04:06"))).alias("b"),
        dates.after(dates.parse_time(t1), dates.parse_time(F.lit("2024-01-02 03:04:06"))).alias("a"),
        (dates.yesterday() < dates.today()).alias("y"),
        text.is_empty(F.lit("")).alias("e1"), text.is_empty(F.lit(None).cast("string")).alias("e2"),
        text.is_not_empty(F.lit("x")).alias("ne"),
        numbers.to_long(F.lit(" 42 ")).alias("l"), numbers.to_long(F.lit("4x")).alias("lbad"),
        numbers.round_half_up(F.lit(2.345), 2).alias("r"),
    ).first()
    assert row["pt"] == dt.datetime(2024, 1, 2, 3, 4, 5) and row["bad"] is None
    assert row["dk"] == dt.date(2024, 1, 2) and row["dk_bad"] is None
    assert row["dh"] == "2024-01-02_03" and row["sec"] == "20240102030405"
    assert row["b"] is True and row["a"] is False and row["y"] is True
    assert row["e1"] and row["e2"] and row["ne"]
    assert row["l"] == 42 and row["lbad"] is None and row["r"] == 2.35
