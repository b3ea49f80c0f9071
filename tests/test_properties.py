"""Property tests: each example is checked in one Spark job over many generated rows."""

import datetime as dt
from collections import Counter
from fractions import Fraction

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row, Window
from pyspark.sql import functions as F

from clickscope.functions import numbers, text
from clickscope.operators import ordered
from clickscope.operators.topn import group_top_n
from clickscope.streaming import ad_state
from clickscope.streaming.ad_state import ClickGate, InFrames, RunningTotals, TopAds, _clicks_combined
from helpers import rows_set


def half_up(n, d):
    q = Fraction(n, d) * 100
    return float((q.numerator * 2 + q.denominator) // (2 * q.denominator)) / 100


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(1, 10**6)), min_size=1, max_size=300))
def test_ratio_half_up_matches_fraction(spark, pairs):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [(r["n"], r["d"], r["r"]) for r in df.select("n", "d", numbers.ratio_half_up("n", "d").alias("r")).collect()]
    for n, d, r in got:
        assert r == half_up(n, d), (n, d, r)


def kv_model(s, field):
    """The reference's getter: split on '|', keep pairs that split on '=' into exactly two parts."""
    for part in s.split("|"):
        kv = part.split("=")
        if len(kv) == 2 and kv[0] == field and kv[1] != "":
            return kv[1]
        if len(kv) == 2 and kv[0] == field:
            return None
    return None


names = st.sampled_from(["a", "bb", "c", "searchKeywords"])
values = st.text(alphabet="xyz,0123", max_size=4)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.tuples(names, values), min_size=1, max_size=4, unique_by=lambda t: t[0]),
                min_size=1, max_size=50))
def test_kv_get_set_match_model(spark, records):
    texts = ["|".join(f"{k}={v}" for k, v in rec) for rec in records]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", text.kv_get("t", "bb").alias("g"), text.kv_set("t", "c", F.lit("N")).alias("s")).collect()
    for r in rows:
        assert r["g"] == kv_model(r["t"], "bb")
        parts = r["t"].split("|")
        expect = "|".join("c=N" if p.split("=")[0] == "c" else p for p in parts)
        assert r["s"] == expect


events = st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b", "c"]), st.integers(0, 50),
                            st.integers(0, 9)), min_size=1, max_size=200)


@settings(max_examples=4, deadline=None)
@given(events, st.integers(1, 9))
def test_chunked_lag_equals_window(spark, rows, seconds):
    t0 = dt.datetime(2024, 1, 1)
    data = [(g, t0 + dt.timedelta(seconds=s), i, p) for i, (g, s, p) in enumerate(rows)]
    df = spark.createDataFrame(data, "g string, t timestamp_ntz, id long, p long")
    chunk = F.floor(F.second("t") / F.lit(seconds))
    a = ordered.previous_in_order(df, ["g"], ["t", "id"], ["p"], chunk)
    b = df.withColumn("prev_p", F.lag("p").over(Window.partitionBy("g").orderBy("t", "id")))
    assert sorted(a.select("id", "prev_p").collect(), key=str) == sorted(b.select("id", "prev_p").collect(), key=str)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 1000)), min_size=1, max_size=300), st.integers(1, 6))
def test_salted_top_n_equals_plain(spark, rows, n):
    df = spark.createDataFrame([(g, v, i) for i, (g, v) in enumerate(rows)], "g long, v long, id long")
    order = [F.desc("v"), F.asc("id")]
    plain = rows_set(group_top_n(df, ["g"], order, n), "g", "id", "rank")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "0")
    try:
        salted = rows_set(group_top_n(df, ["g"], order, n, salt_col="id", salts=5), "g", "id", "rank")
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert salted == plain


class FakeState:
    """State of one key as the processors see it: a value, or a map."""

    def __init__(self):
        self.value, self.map = None, {}

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def getValue(self, k):  # noqa: N802 - Spark's name
        return self.map.get(k)

    def updateValue(self, k, v):  # noqa: N802
        self.map[k] = v


class Keyed:
    """Runs a processor over batches of rows as a state operator does: grouped by key, each with its own state."""

    def __init__(self, make, keys):
        self.make, self.keys, self.known = make, keys, {}

    def run(self, rows):
        groups, out = {}, []
        for r in rows:
            groups.setdefault(tuple(r[k] for k in self.keys), []).append(r)
        for key, mine in groups.items():
            if key not in self.known:
                states = {}
                self.known[key] = self.make()
                self.known[key].init(type("Handle", (), {
                    "getValueState": lambda _, name, *a, s=states: s.setdefault(name, FakeState()),
                    "getMapState": lambda _, name, *a, s=states: s.setdefault(name, FakeState())})())
            out += list(self.known[key].handleInputRows(key, iter(mine), None))
        return out


clicks_of_days = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2), st.integers(0, 90000)), min_size=4, max_size=40)


def _cut(rows, n):
    size = -(-len(rows) // n)
    return [rows[i:i + size] for i in range(0, len(rows), size)]


def _click_rows(clicks):
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i, (u, a, s) in enumerate(sorted(clicks, key=lambda c: c[2])):
        ts = t0 + dt.timedelta(seconds=s)
        rows.append(Row(user_id=u, ts=ts, part=0, at=i, date=ts.strftime("%Y%m%d"), province="PQ"[a % 2], city=f"C{u % 2}",
                        ad_id=a, n=1))
    return rows


@settings(max_examples=60, deadline=None)
@given(clicks_of_days, st.integers(1, 3), st.sampled_from(["batch", "click"]))
def test_stream_blacklist_independent_of_batching(clicks, n_batches, listing):
    """SURVEY §4.3: the listed users do not depend on where the micro-batches are cut."""
    rows = _click_rows(clicks)
    gate = Keyed(lambda: ClickGate(2, listing), ["user_id"])
    listed = [r.ad_id for part in _cut(rows, n_batches) for r in gate.run(part) if r.kind == "listed"]
    count = Counter((r.date, r.user_id, r.ad_id) for r in rows)
    assert sorted(listed) == sorted({u for (_, u, _), n in count.items() if n >= 2})


@settings(max_examples=60, deadline=None)
@given(clicks_of_days, st.integers(1, 5), st.integers(1, 3), st.integers(1, 4), st.randoms())
def test_state_operators_equal_the_batch_forms(clicks, n_batches, threshold, top_n, shuffled):
    """Gate, totals and top list over any batches, rows of a batch in any order, against one pass in event order."""
    rows = _click_rows(clicks)
    gate = Keyed(lambda: ClickGate(threshold, "click"), ["user_id"])
    totals = Keyed(RunningTotals, ["date", "province", "ad_id"])
    top = Keyed(lambda: TopAds(top_n), ["date", "province", "slot"])
    stat, tops = {}, {}
    for part in _cut(rows, n_batches):
        part = list(part)
        shuffled.shuffle(part)
        out = top.run(totals.run(gate.run(part)))
        stat.update({(r.date, r.province, r.city, r.ad_id): r.n for r in out if r.kind == "stat"})
        for group in {(r.date, r.province) for r in out if r.kind == "top"}:
            tops[group] = [(r.ad_id, r.n) for r in out if r.kind == "top" and (r.date, r.province) == group]
    counts, listed, kept = Counter(), set(), Counter()
    for r in rows:
        if r.user_id not in listed:
            kept[r.date, r.province, r.city, r.ad_id] += 1
            counts[r.user_id, r.date, r.ad_id] += 1
            if counts[r.user_id, r.date, r.ad_id] >= threshold:
                listed.add(r.user_id)
    assert stat == kept
    per_group = {}
    for (date, province, _, ad), n in kept.items():
        per_group.setdefault((date, province), Counter())[ad] += n
    assert tops == {g: sorted(c.items(), key=lambda e: (-e[1], e[0]))[:top_n] for g, c in per_group.items()}


@settings(max_examples=30, deadline=None)
@given(clicks_of_days, st.integers(1, 4), st.integers(1, 3), st.sampled_from(["batch", "click"]))
def test_users_of_one_group_share_a_key(clicks, n_batches, threshold, listing):
    """The same kept clicks and listed users as with a key per user, with two state calls per date of a batch."""
    rows = _click_rows(clicks)
    alone, together = Keyed(lambda: ClickGate(threshold, listing), ["user_id"]), Keyed(lambda: ClickGate(threshold, listing), [])
    for part in _cut(rows, n_batches):
        a, b = alone.run(part), together.run(part)
        assert sorted(r.ad_id for r in a if r.kind == "listed") == sorted(r.ad_id for r in b if r.kind == "listed")
        sums = [Counter(), Counter()]
        for of, out in zip(sums, (a, b), strict=True):
            for r in out:
                if r.kind == "click":
                    of[r.date, r.province, r.city, r.ad_id] += r.n
        assert sums[0] == sums[1]
    assert set(together.known[()].counts.map) <= {(r.date,) for r in rows}


@settings(max_examples=30, deadline=None)
@given(clicks_of_days, st.integers(1, 3), st.sampled_from(["batch", "click"]))
def test_combining_before_the_shuffle_changes_nothing(clicks, threshold, listing):
    rows = _click_rows(clicks)
    frame = pd.DataFrame([r.asDict() for r in rows])
    combined = [Row(**r) for f in _clicks_combined(threshold, listing)(iter([frame])) for r in f.to_dict("records")]
    plain, less = (Keyed(lambda: ClickGate(threshold, listing), ["user_id"]) for _ in range(2))
    key = lambda r: str(tuple(r))
    assert sorted(plain.run(rows), key=key) == sorted(less.run(combined), key=key)


def _frames(rows, columns, size):
    return (pd.DataFrame([[r[c] for c in columns] for r in rows[i:i + size]], columns=columns) for i in range(0, len(rows), size))


@settings(max_examples=30, deadline=None)
@given(clicks_of_days, st.integers(1, 3), st.integers(1, 3), st.integers(1, 7), st.sampled_from(["batch", "click"]))
def test_operators_on_frames_equal_those_on_rows(clicks, n_batches, threshold, size, listing):
    """The three operators get and give pandas frames; no value turns into a float or null on the way."""
    steps = [(lambda: ClickGate(threshold, listing), [], ad_state.CLICK_COLUMNS),
             (RunningTotals, ["date", "province", "ad_id"], ad_state.ROW_COLUMNS),
             (lambda: TopAds(2), ["date", "province", "slot"], ad_state.ROW_COLUMNS)]
    by_row = [Keyed(make, keys) for make, keys, _ in steps]
    known = [{} for _ in steps]
    for part in _cut(_click_rows(clicks), n_batches):
        rows, frames = part, part
        for (make, keys, columns), plain, mine in zip(steps, by_row, known, strict=True):
            rows = plain.run(rows)
            groups, out = {}, []
            for r in frames:
                groups.setdefault(tuple(r[k] for k in keys), []).append(r)
            for key, held in groups.items():
                if key not in mine:
                    states = {}
                    mine[key] = InFrames(make(), columns)
                    mine[key].init(type("Handle", (), {
                        "getValueState": lambda _, name, *a, s=states: s.setdefault(name, FakeState()),
                        "getMapState": lambda _, name, *a, s=states: s.setdefault(name, FakeState())})())
                for f in mine[key].handleInputRows(key, _frames(held, columns, size), None):
                    assert list(f.columns) == ad_state.ROW_COLUMNS and not f.isna().any().any()
                    out += [Row(**r) for r in f.to_dict("records")]
            frames = out
            assert [tuple(r[c] for c in ad_state.ROW_COLUMNS) for r in frames] == [
                tuple(r[c] for c in ad_state.ROW_COLUMNS) for r in rows]


class CountedState(FakeState):
    calls = 0

    def __getattribute__(self, name):
        if name in ("get", "update", "getValue", "updateValue"):
            CountedState.calls += 1
        return super().__getattribute__(name)


def _one_key(processor):
    states = {}
    handle = lambda _, name, *a: states.setdefault(name, CountedState())
    processor.init(type("Handle", (), {"getValueState": handle, "getMapState": handle})())
    return processor


def test_state_calls_do_not_grow_with_dates_or_places():
    """A few clicks on each of 300 dates: a key's state calls follow its rows, 1,024 counts at a time."""
    dates = [(dt.date(2024, 1, 1) + dt.timedelta(days=i)).strftime("%Y%m%d") for i in range(300)]
    clicks = [Row(user_id=u, ts=i, part=0, at=0, date=d, province="P", city=f"C{u}", ad_id=7, n=1)
              for i, d in enumerate(dates) for u in range(3)]
    rows, tops = clicks, []
    for processor in (ClickGate(100, "batch"), RunningTotals(), TopAds(3)):
        processor = _one_key(processor)
        for _ in range(2):  # the second batch reads what the first one stored
            CountedState.calls = 0
            out = list(processor.handleInputRows((0,), iter(rows), None))
            tops += [(r.date, r.ad_id, r.n) for r in out if r.kind == "top"]
            assert CountedState.calls <= 6, (processor, CountedState.calls)
        rows = out
    assert tops == [(d, 7, 6) for d in dates]  # once: the second time they are not new


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 4), st.integers(1, 3)), max_size=12), max_size=8),
       st.integers(1, 12))
def test_dated_counts_equal_a_plain_map(batches, size):
    """Dates in any order, pages of any size: what is read is what was stored, and every page ends before the next one."""
    before, ad_state.PAGE_COUNTS = ad_state.PAGE_COUNTS, size
    states, plain = {}, {}
    try:
        handle = lambda _, name, *a: states.setdefault(name, FakeState())
        counts = ad_state.DatedCounts(type("Handle", (), {"getValueState": handle, "getMapState": handle})(), "c", [("ads", "bigint")])
        for batch in batches:
            counts.begin()
            for day, ad, n in batch:
                of_day, mine = counts.of(f"202401{day:02d}"), plain.setdefault(f"202401{day:02d}", {})
                assert of_day == mine
                of_day[ad,] = mine[ad,] = mine.get((ad,), 0) + n
            counts.end({f"202401{day:02d}" for day, _, _ in batch})
    finally:
        ad_state.PAGE_COUNTS = before
    pages = {start: page for (start,), page in states["c"].map.items()}
    stored = [(d, a, n) for page in pages.values() for d, a, n in zip(*page, strict=True)]
    assert sorted(stored) == sorted((d, a, n) for d, of_day in plain.items() for (a,), n in of_day.items())
    starts = sorted(pages)
    assert starts == (states["c_pages"].value[0] if starts else [])
    for start, end in zip(starts, [*starts, "9"][1:], strict=True):
        assert all(start <= d < end for d in pages[start][0])
        assert len(pages[start][0]) <= size or len(set(pages[start][0])) == 1


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["click", "click", "listed"]), st.integers(0, 3), st.integers(0, 5), st.integers(1, 4)),
                min_size=1, max_size=60), st.integers(1, 20), st.sampled_from([4, 16, 1 << 16]))
def test_kept_clicks_of_a_place_leave_a_task_once(rows, size, held):
    """Over all frames of a task, not per frame; a task that holds too many places gives them in parts."""
    rows = [Row(kind=k, date="20240101", province="P", city=f"C{c}", ad_id=a, n=n, slot=0) for k, c, a, n in rows]
    before, ad_state.COMBINED_ROWS = ad_state.COMBINED_ROWS, held
    try:
        got = [Row(**r) for f in ad_state._counts_combined(_frames(rows, ad_state.ROW_COLUMNS, size)) for r in f.to_dict("records")]
    finally:
        ad_state.COMBINED_ROWS = before
    sums = [Counter(), Counter()]
    for of, some in zip(sums, (rows, got), strict=True):
        for r in some:
            if r.kind == "click":
                of[r.city, r.ad_id] += r.n
    assert sums[0] == sums[1]
    if held == 1 << 16:
        assert len([r for r in got if r.kind == "click"]) == len(sums[0])
    assert sorted(tuple(r) for r in rows if r.kind == "listed") == sorted(
        (r.kind, r.date, r.province, r.city, r.ad_id, r.n, r.slot) for r in got if r.kind == "listed")


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["u1", "u1", "u2"]), st.sampled_from(["d1", "d2"]), st.integers(0, 30),
                          st.integers(0, 9)), min_size=1, max_size=150), st.integers(2, 7))
def test_chunked_lag_two_group_columns(spark, rows, seconds):
    t0 = dt.datetime(2024, 1, 1)
    data = [(u, d, t0 + dt.timedelta(seconds=s), i, p) for i, (u, d, s, p) in enumerate(rows)]
    df = spark.createDataFrame(data, "u string, d string, t timestamp_ntz, id long, p long")
    chunk = F.floor(F.second("t") / F.lit(seconds))
    a = ordered.previous_in_order(df, ["u", "d"], ["t", "id"], ["p"], chunk)
    b = df.withColumn("prev_p", F.lag("p").over(Window.partitionBy("u", "d").orderBy("t", "id")))
    assert sorted(a.select("id", "prev_p").collect(), key=str) == sorted(b.select("id", "prev_p").collect(), key=str)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**10), st.sampled_from(["AFRICA", "MIDDLE-EAST", "x"]),
                          st.sampled_from(["NATION1", "c"]), st.integers(0, 10**6), st.integers(0, 99)),
                min_size=1, max_size=60))
def test_ad_log_format_parse_roundtrip(spark, rows):
    from clickscope.sources import adlog
    t0 = dt.datetime(2024, 1, 1)
    data = [(t0 + dt.timedelta(seconds=s), p, c, u, a) for s, p, c, u, a in rows]
    clicks = spark.createDataFrame(data, "ts timestamp_ntz, province string, city string, user_id long, ad_id long")
    back = adlog.parse_ad_log(adlog.format_ad_log(clicks))
    cols = ["ts", "province", "city", "user_id", "ad_id"]
    assert rows_set(back, *cols) == rows_set(clicks, *cols)
    assert adlog.parse_ad_log_rejects(adlog.format_ad_log(clicks)).count() == 0
