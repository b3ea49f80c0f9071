"""Explicit schemas of the reference-shaped inputs and the text log (no inference anywhere)."""

from pyspark.sql import types as T

USER_VISIT_ACTION = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("page_id", T.LongType()),
    T.StructField("action_time", T.TimestampNTZType()),
    T.StructField("search_keyword", T.StringType()),
    T.StructField("click_category_id", T.LongType()),
    T.StructField("click_product_id", T.LongType()),
    T.StructField("order_category_ids", T.StringType()),
    T.StructField("order_product_ids", T.StringType()),
    T.StructField("pay_category_ids", T.StringType()),
    T.StructField("pay_product_ids", T.StringType()),
    T.StructField("city_id", T.LongType()),
    T.StructField("event_id", T.LongType()),
])

USER_INFO = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("username", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("professional", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("sex", T.StringType()),
])

PRODUCT_INFO = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("extend_info", T.StringType()),
])

CITY_INFO = T.StructType([
    T.StructField("city_id", T.LongType()),
    T.StructField("city_name", T.StringType()),
    T.StructField("area", T.StringType()),
])

TASK = T.StructType([
    T.StructField("task_id", T.LongType()),
    T.StructField("task_name", T.StringType()),
    T.StructField("create_time", T.StringType()),
    T.StructField("start_time", T.StringType()),
    T.StructField("finish_time", T.StringType()),
    T.StructField("task_type", T.StringType()),
    T.StructField("task_status", T.StringType()),
    T.StructField("task_param", T.StringType()),
])

# Parsed ad click (one log line ``epoch_ms province city user_id ad_id``).
AD_CLICK = T.StructType([
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("date", T.StringType()),
    T.StructField("province", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("ad_id", T.LongType()),
])

AD_LOG_LINE = T.StructType([T.StructField("value", T.StringType())])
