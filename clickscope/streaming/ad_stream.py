"""Real-time ad click statistics (J4, STR-1 … STR-10) on Structured Streaming.

Queries over the same log stream (segment log, Kafka, or text files in their place):

* **main** (STR-3/4/5/6): blacklist, running totals and province top-n in keyed state, :mod:`.ad_state`;
* **rejects** (SRC-10): the lines that are no clicks, appended as text. Their number is also counted by the main query
  itself, in passing;
* **trend** (STR-7/10): clicks per (minute, ad), a streaming aggregation in update mode, written as replace-upserts. Each minute
  holds its full count (D23). The watermark bounds the state (D13): minutes that ended longer ago than that are final. With
  ``trend_slide`` the state holds one count per slide and ad (a *pane*); windows are combined from panes when they are
  read (:mod:`clickscope.operators.panes`), so no click is copied into the windows that cover it.

Result tables are batch-tagged (:mod:`clickscope.sinks.log_tables`): a retried batch rewrites identical files, so results are
exactly once over an at-least-once ``foreachBatch``.

Recovery (STR-2): the queries keep offsets and state under ``<root>/_checkpoints``; restarting with the same root
continues where they stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import ads, panes
from ..sinks import log_tables as lt
from ..sources import adlog
from .ad_state import AdState, finished, settings

_S, _L = T.StringType(), T.LongType()
TREND_SCHEMA = T.StructType([T.StructField("date", _S), T.StructField("hour", _S), T.StructField("minute", _S),
                             T.StructField("ad_id", _L), T.StructField("click_count", _L)])
PANE_SCHEMA = T.StructType([T.StructField("date", _S), T.StructField("pane", _L), T.StructField("ad_id", _L),
                            T.StructField("click_count", _L)])

TREND_KEYS = ["date", "hour", "minute", "ad_id"]
PANE_KEYS = ["date", "pane", "ad_id"]
WATERMARK = "60 minutes"


class AdClickStream:
    def __init__(self, spark: SparkSession, root: str, threshold: int = ads.DEFAULT_THRESHOLD, top_n: int = 3,
                 watermark: str | None = WATERMARK, trend_window: str = "1 minute", trend_slide: str | None = None,
                 listing: str = "batch", state_partitions: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.watermark = watermark  # None keeps every minute in the state, for logs that are far out of order
        self.trend_window = trend_window
        self.trend_slide = trend_slide  # e.g. window 60 min sliding 10 s; None = tumbling windows
        # of either query, fixed when it first starts (default: the session's shuffle partitions)
        self.state_partitions = state_partitions
        self.main = AdState(spark, self.root, threshold, top_n, listing, state_partitions)
        self.trend = lt.LogTable(spark, f"{self.root}/ad_click_trend", TREND_SCHEMA, ("date",))
        self.trend_panes = lt.LogTable(spark, f"{self.root}/ad_click_pane", PANE_SCHEMA, ("date",))

    def _checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"

    # ------------------------------------------------------------------ main query and rejects
    def start_main(self, source: DataFrame, trigger: dict | None = None):
        return self.main.start(source, trigger)

    def start_rejects(self, source: DataFrame, trigger: dict | None = None):
        w = (adlog.parse_ad_log_rejects(source).select("value").writeStream.format("text")
             .option("path", f"{self.root}/rejects").option("checkpointLocation", self._checkpoint("rejects")))
        return w.trigger(**(trigger or {"processingTime": "5 seconds"})).start()

    # ------------------------------------------------------------------ trend query
    def trend_frame(self, source: DataFrame) -> DataFrame:
        clicks = adlog.parse_ad_log(source).withColumn("ts", F.col("ts").cast("timestamp"))
        if self.watermark:
            clicks = clicks.withWatermark("ts", self.watermark)
        win = F.window("ts", self.trend_slide or self.trend_window)
        return clicks.groupBy(win.alias("w"), "ad_id").agg(F.count(F.lit(1)).alias("click_count"))

    def _write_trend(self, batch: DataFrame, batch_id: int) -> None:
        start = F.col("w.start").cast("timestamp_ntz")
        date = F.date_format(start, "yyyyMMdd").alias("date")
        if self.trend_slide:
            rows = batch.select(date, F.unix_seconds(F.col("w.start")).alias("pane"), "ad_id", "click_count")
            lt.replace_upsert(self.trend_panes, rows, batch_id)
        else:
            rows = batch.select(date, F.date_format(start, "HH").alias("hour"), F.date_format(start, "mm").alias("minute"),
                                "ad_id", "click_count")
            lt.replace_upsert(self.trend, rows, batch_id)

    def start_trend(self, source: DataFrame, trigger: dict | None = None, name: str = "ad_trend"):
        if self.trend_slide:
            panes.per_window(self.trend_window, self.trend_slide)  # a window is a whole number of slides
        parts = {"spark.sql.shuffle.partitions": str(self.state_partitions)} if self.state_partitions else {}
        with settings(self.spark, parts):
            w = (self.trend_frame(source).writeStream.outputMode("update").foreachBatch(self._write_trend)
                 .option("checkpointLocation", self._checkpoint(name)))
            return w.trigger(**(trigger or {"processingTime": "5 seconds"})).start()

    # ------------------------------------------------------------------ result tables
    def user_click_count(self) -> DataFrame:
        return self.main.user_click_count()

    def blacklist(self) -> DataFrame:
        return self.main.blacklist()

    def ad_stat(self) -> DataFrame:
        return self.main.ad_stat()

    def province_top3(self) -> DataFrame:
        return self.main.province_top3()

    def click_trend(self) -> DataFrame:
        return lt.read_replace(self.trend, TREND_KEYS, ["click_count"])

    def panes(self) -> DataFrame:
        """Counts per slide and ad (when ``trend_slide`` is set): ``pane`` (its start in epoch seconds), ``ad_id``."""
        return lt.read_replace(self.trend_panes, PANE_KEYS, ["click_count"]).drop("date")

    def click_trend_runs(self) -> DataFrame:
        """Sliding windows with equal neighbours as one row: ``ad_id, first_start, last_start`` (epoch seconds),
        ``click_count``."""
        return panes.window_runs(self.panes(), "pane", ["ad_id"], "click_count", self.trend_window, self.trend_slide)

    def click_trend_windows(self) -> DataFrame:
        """Sliding-window counts: ``window_start, window_end`` (yyyyMMddHHmmss), ``ad_id, click_count``."""
        w = panes.windows(self.click_trend_runs(), self.trend_window, self.trend_slide)
        text = lambda c: F.date_format(F.timestamp_seconds(c).cast("timestamp_ntz"), "yyyyMMddHHmmss")
        return w.select(text("window_start").alias("window_start"), text("window_end").alias("window_end"), "ad_id",
                        "click_count")

    def rejected_lines(self) -> DataFrame:
        return self.spark.read.schema("value string").text(f"{self.root}/rejects")


def console_sink(df: DataFrame, trigger: dict | None = None):
    """SRC-11: print each micro-batch (debug)."""
    return df.writeStream.format("console").trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def run_now(job: AdClickStream, source, main: bool = True, trend: bool = True, rejects: bool = False) -> list:
    """Process what the source has now (``availableNow``) and stop; returns the finished queries. ``source()`` gives a new
    reader of the log for each query."""
    now = {"availableNow": True}
    starts = [(main, job.start_main), (trend, job.start_trend), (rejects, job.start_rejects)]
    return [finished(q) for q in [start(source(), now) for wanted, start in starts if wanted]]


def run_available(job: AdClickStream, source_path: str, max_files_per_trigger: int | None = None,
                  main: bool = True, trend: bool = True) -> None:
    """Process every text file in ``source_path`` now and stop."""
    from ..sources.external import text_stream
    run_now(job, lambda: text_stream(job.spark, source_path, max_files_per_trigger), main, trend, rejects=main)


def run_segments(job: AdClickStream, path: str, group: str | None = None, main: bool = True, trend: bool = False) -> list:
    """Process what the segment log under ``path`` has now, as one batch of each query, and commit its end for ``group``."""
    from ..sources import segment_log
    queries = run_now(job, lambda: segment_log.segment_stream(job.spark, path, "earliest", group), main, trend)
    if group:
        for q in queries:
            segment_log.commit_progress(q, path, group)
    return queries
