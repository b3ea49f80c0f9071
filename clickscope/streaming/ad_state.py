"""Real-time ad click statistics with keyed state (J4, STR-3 … STR-6): nothing stored is read back by a batch.

One streaming query of three state operators (``transformWithState`` on the RocksDB provider):

* :class:`ClickGate`, keyed by a group of users (STR-3, STR-4, JOIN-9, FLT-6): the listed ones and the click counts per date and
  (user, ad). It drops the clicks of listed users and lists a user whose
  count reaches the threshold. With ``listing="click"`` that holds from the
  crossing click on, in (time, partition, offset) order, so the result does not depend on where batches end (the stored
  form is :func:`clickscope.operators.ads.apply_cutoffs`, given a log whose time does not fall from batch to batch); with
  ``listing="batch"`` it holds from the next batch on, as if the list were a table that is read when a batch begins;
* :class:`RunningTotals`, keyed by a group of (date, province, ad) (STR-5): the total of every city, and from them the province's;
* :class:`TopAds`, keyed by a group of (date, province) (STR-6, WIN-3): the ``top_n`` ads with most clicks. Totals never fall, so an ad
  outside the list can only come back by a total that changed; the list needs no more rows than it has.

A key's counts are stored by date in pages (:class:`DatedCounts`), of which a batch reads and writes those with its dates, so
the calls of operators and of their state grow with groups and rows, not with dates, places or users.

Between the operators each task adds up what it holds per key, so a hot user, city or ad is combined before it is shuffled:
clicks of one user, place and ad become one row (with ``listing="click"`` only clicks after a user's own crossing in that
piece go, as order counts), their counts one row per place and ad, and the changed totals of one province its ``top_n``.
The operators get and give pandas frames (:class:`InFrames`).

Each batch writes changed rows only, tagged with its id, to the tables of :mod:`clickscope.sinks.log_tables`; a repeated
batch starts from the same state version and writes the same files. ``user_click_count`` and ``lookup_click_count``
(SNK-6) read the state itself (``format("statestore")``) as of the last finished batch.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections import namedtuple
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import dates
from ..operators import ads
from ..sinks import log_tables as lt
from ..sources import adlog

_S, _L = T.StringType(), T.LongType()
BLACKLIST_SCHEMA = T.StructType([T.StructField("user_id", _L)])
STAT_SCHEMA = T.StructType([T.StructField("date", _S), T.StructField("province", _S), T.StructField("city", _S),
                            T.StructField("ad_id", _L), T.StructField("click_count", _L)])
TOP_SCHEMA = T.StructType([T.StructField("date", _S), T.StructField("province", _S), T.StructField("ad_id", _L),
                           T.StructField("click_count", _L)])
STAT_KEYS = ["date", "province", "city", "ad_id"]
MONTH = "substring(date, 1, 6)"  # folder of a batch's rows in the result tables: a folder and file cost more than a date's rows

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_CONF = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB,
              # a batch uploads its changes, not a snapshot
              "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}
LISTINGS = ("batch", "click")
SLOTS = 64  # groups that finished rows of one (date, province) pass the last operator in
# keys of the gate, and of the two other operators; fixed when the query first starts
USER_GROUPS = 1024
PLACE_GROUPS = 1024
PAGE_COUNTS = 1024  # counts of a page of the state, unless one date has more; a state call costs about as much as reading them

CLICKS = "user_id bigint, ts bigint, part int, at bigint, date string, province string, city string, ad_id bigint, n bigint"
CLICK_COLUMNS = ["user_id", "ts", "part", "at", "date", "province", "city", "ad_id", "n"]
ROWS = "kind string, date string, province string, city string, ad_id bigint, n bigint, slot int"
ROW_COLUMNS = ["kind", "date", "province", "city", "ad_id", "n", "slot"]
COMBINED_ROWS = 1 << 16  # rows that a task holds to add up those of one key
CLICK, LISTED, STAT, CHANGED, TOP = "click", "listed", "stat", "changed", "top"


Out = Row(*ROW_COLUMNS)  # no field is null: pandas has no null for numbers and keys


class InFrames(StatefulProcessor):
    """Runs ``rows_of``, which takes and gives rows, on frames: a row costs Spark's conversion of frames a small part of what
    that of rows does."""

    def __init__(self, rows_of: StatefulProcessor, columns: list[str]):
        self.rows_of, self.columns = rows_of, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows_of.init(handle)
        self.row = namedtuple("Each", self.columns)

    def handleInputRows(self, key, rows, timerValues):
        import pandas as pd
        each = (self.row._make(r) for f in rows for r in zip(*(f[c].tolist() for c in self.columns), strict=True))
        out = list(self.rows_of.handleInputRows(key, each, timerValues))
        if out:
            yield pd.DataFrame(dict(zip(ROW_COLUMNS, map(list, zip(*out, strict=True)), strict=True)))

    def close(self) -> None:
        self.rows_of.close()


class DatedCounts:
    """Counts that one key of an operator holds, ``{date: {fields: n}}``, in pages of whole neighbouring dates.

    A call of the state costs far more than a count, so a page takes dates until it has ``PAGE_COUNTS`` counts. It holds the dates
    from its own first one up to the next page's; earlier dates than any begin a page of their own. ``fields`` are (name, type)."""

    def __init__(self, handle: StatefulProcessorHandle, name: str, fields: list[tuple[str, str]]):
        columns = [("dates", "string"), *fields, ("n", "bigint")]
        self.pages = handle.getMapState(name, "date string", ", ".join(f"{c} array<{t}>" for c, t in columns))
        self.index = handle.getValueState(f"{name}_pages", "dates array<string>")

    def begin(self) -> None:
        """For every call of the operator, as its key is another one."""
        stored = self.index.get()
        self.starts = list(stored[0]) if stored is not None else []
        self.read: set[int] = set()
        self.held: dict[str, dict[tuple, int]] = {}

    def _page(self, date: str) -> int:
        return bisect_right(self.starts, date) - 1  # -1: before all pages

    def of(self, date: str) -> dict[tuple, int]:
        """The counts of a date; what is changed in them is stored by ``end``."""
        page = self._page(date)
        if page >= 0 and page not in self.read:
            self.read.add(page)
            dates, *fields, counts = self.pages.getValue((self.starts[page],))
            for d, k, n in zip(dates, zip(*fields, strict=True), counts, strict=True):
                self.held.setdefault(d, {})[k] = n
        return self.held.setdefault(date, {})

    def end(self, changed) -> None:
        """Store the pages of the dates ``changed``; one that has become too large is cut between dates."""
        pages = {self._page(d) for d in changed}
        mine: dict[int, list[str]] = {}
        for d in sorted(self.held):
            if self.held[d] and self._page(d) in pages:
                mine.setdefault(self._page(d), []).append(d)
        starts = set(self.starts)
        for page, dates in mine.items():
            start, cut, size = self.starts[page] if page >= 0 else dates[0], [], 0
            for d in dates:
                if cut and size + len(self.held[d]) > PAGE_COUNTS:
                    self._write(start, cut)
                    start, cut, size = d, [], 0
                starts.add(start)
                cut.append(d)
                size += len(self.held[d])
            self._write(start, cut)
            starts.add(start)
        if len(starts) > len(self.starts):
            self.index.update((sorted(starts),))

    def _write(self, start: str, dates: list[str]) -> None:
        rows = [(d, *k, n) for d in dates for k, n in self.held[d].items()]
        self.pages.updateValue((start,), tuple(map(list, zip(*rows, strict=True))))


class ClickGate(StatefulProcessor):
    """Its key is a group of users: a call of an operator and each of its state calls cost far more than a click, so the
    users of a group share them. The state of a group is its listed users, and per date the counts of its (user, ad)."""

    def __init__(self, threshold: int, listing: str):
        self.threshold, self.by_click = threshold, listing == "click"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.listed = handle.getValueState("listed", "users array<bigint>")
        self.stored = DatedCounts(handle, "counts", [("users", "bigint"), ("ads", "bigint")])
        self.counts = self.stored.pages

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        stored = self.listed.get()
        listed = list(stored[0]) if stored is not None else []
        shut = set(listed)
        crossed: dict[int, None] = {}
        self.stored.begin()
        counts: dict[str, dict[tuple, int]] = {}
        kept: dict[tuple, int] = {}
        for r in sorted(rows, key=lambda r: (r.ts, r.part, r.at)) if self.by_click else rows:
            if r.user_id in shut:
                continue
            of_day = counts.get(r.date)
            if of_day is None:
                of_day = counts[r.date] = self.stored.of(r.date)
            k = (r.user_id, r.ad_id)
            of_day[k] = now = of_day.get(k, 0) + r.n
            place = (r.date, r.province, r.city, r.ad_id)
            kept[place] = kept.get(place, 0) + r.n
            if now >= self.threshold:
                crossed[r.user_id] = None
                if self.by_click:
                    shut.add(r.user_id)
        self.stored.end(counts)
        for (date, province, city, ad_id), n in kept.items():
            yield Out(CLICK, date, province, city, ad_id, n, 0)
        if crossed:
            self.listed.update((listed + list(crossed),))
            for user in crossed:
                # spread over a few keys of the operators that it only passes
                yield Out(LISTED, "", str(user % SLOTS), "", user, 0, 1)

    def close(self) -> None:
        pass


class RunningTotals(StatefulProcessor):
    """All cities of a (date, province, ad) are in one key."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.cities = DatedCounts(handle, "cities", [("provinces", "string"), ("cities", "string"), ("ads", "bigint")])

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        added: dict[str, dict[tuple, int]] = {}
        for r in rows:
            if r.kind == LISTED:
                yield r
            else:
                of_day, place = added.setdefault(r.date, {}), (r.province, r.city, r.ad_id)
                of_day[place] = of_day.get(place, 0) + r.n
        if not added:
            return
        self.cities.begin()
        for date, of_day in added.items():
            stored = self.cities.of(date)
            for place, n in of_day.items():
                stored[place] = now = stored.get(place, 0) + n
                yield Out(STAT, date, *place, now, 1 + place[2] % SLOTS)
            totals = dict.fromkeys([(province, ad_id) for province, _, ad_id in of_day], 0)
            for (province, _, ad_id), n in stored.items():
                if (province, ad_id) in totals:
                    totals[province, ad_id] += n
            for (province, ad_id), n in totals.items():
                yield Out(CHANGED, date, province, "", ad_id, n, 0)
        self.cities.end(added)

    def close(self) -> None:
        pass


class TopAds(StatefulProcessor):
    """All changed totals of a (date, province) are in one key; finished rows pass."""

    def __init__(self, n: int):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.top = DatedCounts(handle, "top", [("provinces", "string"), ("ads", "bigint")])

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        changed: dict[str, dict[str, dict[int, int]]] = {}
        for r in rows:
            if r.kind == CHANGED:
                changed.setdefault(r.date, {}).setdefault(r.province, {})[r.ad_id] = r.n
            else:
                yield r
        if not changed:
            return
        self.top.begin()
        written = set()
        for date, of_day in changed.items():
            stored = self.top.of(date)
            held: dict[str, dict[int, int]] = {}
            for (province, ad_id), n in stored.items():
                held.setdefault(province, {})[ad_id] = n
            for province, totals in of_day.items():
                before = held.get(province, {})
                now = sorted({**before, **totals}.items(), key=lambda e: (-e[1], e[0]))[:self.n]
                if dict(now) == before:
                    continue
                written.add(date)
                for ad_id in before:
                    del stored[province, ad_id]
                for ad_id, n in now:
                    stored[province, ad_id] = n
                    yield Out(TOP, date, province, "", ad_id, n, 0)
        self.top.end(written)

    def close(self) -> None:
        pass


def _clicks_combined(threshold: int, listing: str):
    """Per piece of a task: clicks of one user, place and ad as one row; by click, those at or before the piece's own
    crossing of the (user, date, ad)."""
    def run(frames):
        for f in frames:
            if listing == "click":
                f = f.sort_values(["ts", "part", "at"], kind="stable")
                yield f[f.groupby(["user_id", "date", "ad_id"], sort=False, dropna=False).cumcount() < threshold]
            else:
                keys = ["user_id", "date", "province", "city", "ad_id"]
                g = f.groupby(keys, sort=False, dropna=False, as_index=False).agg(
                    {"ts": "min", "part": "min", "at": "min", "n": "sum"})
                yield g[list(f.columns)]
    return run


def _counts_combined(frames):
    """Per task: the kept clicks of one place and ad as one row. What has been added up is held while it is at most half of
    ``COMBINED_ROWS``, so that places which many groups of users share leave the task once."""
    import pandas as pd

    keys = [c for c in ROW_COLUMNS if c != "n"]

    def summed(held):
        return pd.concat(held).groupby(keys, sort=False, as_index=False)["n"].sum()[ROW_COLUMNS]
    held, rows = [], 0
    for f in frames:
        if not len(f):
            continue
        yield f.loc[f["kind"] != CLICK, ROW_COLUMNS]
        held.append(f.loc[f["kind"] == CLICK, ROW_COLUMNS])
        rows += len(held[-1])
        if rows > COMBINED_ROWS:
            held = [summed(held)]
            rows = len(held[0])
            if rows > COMBINED_ROWS // 2:
                yield held.pop()
                rows = 0
    if held:
        yield summed(held)


def _tops_combined(n: int):
    """Per piece of a task: of the changed totals of one (date, province) the ``n`` largest."""
    import pandas as pd

    def run(frames):
        for f in frames:
            totals = f[f["kind"] == CHANGED].sort_values(["n", "ad_id"], ascending=[False, True])
            first = totals[totals.groupby(["date", "province"], sort=False, dropna=False).cumcount() < n]
            yield pd.concat([first, f[f["kind"] != CHANGED]], ignore_index=True)
    return run


def ad_rows(lines: DataFrame, threshold: int, listing: str, top_n: int) -> DataFrame:
    """The state operators over log lines (``value``, and ``partition``, ``offset`` where the source has them)."""
    if listing not in LISTINGS:
        raise ValueError(f"listing must be one of {LISTINGS}")
    keep = tuple(c for c in ("partition", "offset") if c in lines.columns)
    parsed = adlog.parse_ad_log(adlog.observed(lines), keep=keep)
    col = lambda name, kind: (F.col(name) if name in keep else F.lit(0)).cast(kind)
    clicks = parsed.select("user_id", dates.epoch_micros("ts").alias("ts"), col("partition", "int").alias("part"),
                           col("offset", "bigint").alias("at"), "date", "province", "city", "ad_id",
                           F.lit(1).cast("bigint").alias("n"))

    def state(df, keys, processor, columns=ROW_COLUMNS):
        return df.groupBy(*keys).transformWithStateInPandas(InFrames(processor, columns), ROWS, "Append", "None")

    combined = clicks.mapInPandas(_clicks_combined(threshold, listing), CLICKS).withColumn(
        "users", F.pmod(F.xxhash64("user_id"), F.lit(USER_GROUPS)).cast("int"))
    kept = state(combined, ["users"], ClickGate(threshold, listing), CLICK_COLUMNS)
    def group(*of):
        return F.pmod(F.xxhash64(*of), F.lit(PLACE_GROUPS)).cast("int")
    # listed users only pass: those of one slot under one key
    counts = kept.mapInPandas(_counts_combined, ROWS).withColumn(
        "places", group("date", "province", F.when(F.col("kind") == CLICK, F.col("ad_id")).otherwise(F.lit(0))))
    totals = state(counts, ["places"], RunningTotals())
    ranked = totals.mapInPandas(_tops_combined(top_n), ROWS).withColumn("places", group("date", "province", "slot"))
    return state(ranked, ["places"], TopAds(top_n))


class AdState:
    """The query, its result tables under ``root`` and its checkpoint."""

    def __init__(self, spark: SparkSession, root: str, threshold: int = ads.DEFAULT_THRESHOLD, top_n: int = 3,
                 listing: str = "batch", state_partitions: int | None = None):
        """``state_partitions``: partitions of the state, fixed when the query first starts (default: the session's
        ``spark.sql.shuffle.partitions``); each costs a Python worker per operator and batch."""
        self.spark, self.root = spark, root.rstrip("/")
        self.state_partitions = state_partitions
        self.threshold, self.top_n, self.listing = threshold, top_n, listing
        self.checkpoint = f"{self.root}/_checkpoints/ad_state"
        t = lambda name, schema, **parts: lt.LogTable(spark, f"{self.root}/{name}", schema, tuple(parts), parts)
        self.blacklist_table = t("ad_blacklist", BLACKLIST_SCHEMA)
        self.stat = t("ad_stat", STAT_SCHEMA, month=MONTH)
        self.top = t("ad_province_top3", TOP_SCHEMA, month=MONTH)

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # one run of the operators feeds three tables
        try:
            def of(kind):
                return batch.where(F.col("kind") == kind)
            lt.append_rows(self.blacklist_table, of(LISTED).select(F.col("ad_id").alias("user_id")), batch_id)
            def by_date(kind):
                """Neighbouring dates in one task: files grow with months and cores, not with dates."""
                return of(kind).withColumnRenamed("n", "click_count").repartitionByRange(
                    self.spark.sparkContext.defaultParallelism, "date")
            lt.replace_upsert(self.stat, by_date(STAT), batch_id)
            lt.replace_group(self.top, by_date(TOP), batch_id)
        finally:
            batch.unpersist()

    def start(self, lines: DataFrame, trigger: dict | None = None):
        parts = {"spark.sql.shuffle.partitions": str(self.state_partitions)} if self.state_partitions else {}
        with settings(self.spark, {**STATE_CONF, **parts}):
            w = (ad_rows(lines, self.threshold, self.listing, self.top_n).writeStream.outputMode("append")
                 .foreachBatch(self.write_batch).option("checkpointLocation", self.checkpoint))
            return w.trigger(**(trigger or {"processingTime": "5 seconds"})).start()

    # ------------------------------------------------------------------ results
    def blacklist(self) -> DataFrame:
        return lt.read_append(self.blacklist_table)

    def ad_stat(self) -> DataFrame:
        return lt.read_replace(self.stat, STAT_KEYS, ["click_count"])

    def province_top3(self) -> DataFrame:
        return lt.read_group(self.top, ["date", "province"])

    def _state(self, variable: str) -> DataFrame:
        return state_variable(self.spark, self.checkpoint, variable)

    def _counts(self, variable: str, **columns: str) -> DataFrame:
        """The counts that a :class:`DatedCounts` of this name holds, a row each: ``columns`` from its arrays."""
        held = F.arrays_zip(*[F.col(f"user_map_value.{c}").alias(c) for c in columns.values()])
        return self._state(variable).select(F.explode(held).alias("e")).select(
            *[F.col(f"e.{c}").alias(name) for name, c in columns.items()])

    def user_click_count(self) -> DataFrame:
        """``date, user_id, ad_id, click_count``: the clicks that the gate counted, read from its state."""
        return self._counts("counts", date="dates", user_id="users", ad_id="ads", click_count="n")

    def lookup_click_count(self, keys: DataFrame) -> DataFrame:
        """SNK-6: ``keys`` (``date, user_id, ad_id``) with their ``click_count``, 0 where nothing was counted."""
        found = self.user_click_count().withColumnRenamed("click_count", "_found")
        return keys.join(found, ["date", "user_id", "ad_id"], "left").select(
            *keys.columns, F.coalesce("_found", F.lit(0)).cast("bigint").alias("click_count"))

    def publish(self, path: str, dates: list[str] | None = None) -> None:
        """Write ``ad_stat`` from the state as a plain table, one folder per date; only the named dates are written anew.
        The job reads the state once; a repeated one writes the same rows."""
        rows = self.running_totals()
        if dates is not None:
            rows = rows.where(F.col("date").isin(dates))
        (rows.repartition("date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("date").parquet(path))

    def running_totals(self) -> DataFrame:
        """``ad_stat`` read from the state instead of the result table."""
        return self._counts("cities", date="dates", province="provinces", city="cities", ad_id="ads", click_count="n")


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """A query started inside takes a copy of the session's settings with these ``values``."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def state_variable(spark: SparkSession, checkpoint: str, variable: str) -> DataFrame:
    """Rows of one state variable of a query as of its last finished batch; the operator that has it is looked up."""
    operators = spark.read.format("state-metadata").load(checkpoint).select("operatorId", "operatorProperties").distinct()
    for r in operators.collect():  # one row per state operator of the query
        properties = json.loads(r["operatorProperties"] or "{}")
        known = properties.get("stateVariables", [])
        names = {(json.loads(v) if isinstance(v, str) else v).get("stateName") for v in known}
        if variable in names:
            return (spark.read.format("statestore").option("operatorId", r["operatorId"])
                    .option("stateVarName", variable).load(checkpoint))
    raise ValueError(f"no state variable {variable} under {checkpoint}")


def finished(query):
    """Wait for a query that ends by itself; its failure is raised."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query
