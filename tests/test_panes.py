import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clickscope.operators import panes

T0 = dt.datetime(2024, 1, 1, 22, 0, 0)


@pytest.mark.parametrize("window,slide,seed", [("60 minutes", "10 seconds", 1), ("3 hours", "5 minutes", 2),
                                               ("60 seconds", "3 seconds", 3), ("2 days", "6 hours", 4)])
def test_windows_equal_counting_each(spark, window, slide, seed):
    """Every window over events before and after midnight, ties and gaps included, against counting it by itself."""
    r = random.Random(seed)
    w, s = panes.seconds(window), panes.seconds(slide)
    span = max(4 * w, 3 * 86_400 if w > 86_400 else 4 * 3600)
    secs = [r.randrange(span) // (1 + i % 2 * 60) * (1 + i % 2 * 60) for i in range(60)]
    events = [(T0 + dt.timedelta(seconds=x), x % 3) for x in secs]
    df = spark.createDataFrame(events, "ts timestamp_ntz, ad_id long")
    counted = panes.panes(df, "ts", ["ad_id"], slide)
    runs = panes.window_runs(counted, "pane", ["ad_id"], "click_count", window, slide)
    got = Counter()
    for x in panes.windows(runs, window, slide).collect():
        assert x["window_end"] - x["window_start"] == w
        assert (x["ad_id"], x["window_start"]) not in got
        got[x["ad_id"], x["window_start"]] = x["click_count"]
    expected = Counter()
    for ts, ad in events:
        at = int(ts.replace(tzinfo=dt.timezone.utc).timestamp())
        first = at - at % s - w + s
        for start in range(first, at + 1, s):
            expected[ad, start] += 1
    assert got == expected
    # runs are as long as they can be
    ordered = sorted(tuple(x) for x in runs.select("ad_id", "first_start", "last_start", "click_count").collect())
    for a, b in zip(ordered, ordered[1:], strict=False):
        assert (a[0], a[2] + s, a[3]) != (b[0], b[1], b[3])


def test_a_window_is_a_whole_number_of_slides(spark):
    for window, slide in (("60 seconds", "7 seconds"), ("1 minute", "0 seconds")):
        with pytest.raises(ValueError):
            panes.per_window(window, slide)
    none = spark.createDataFrame([], "pane long, ad_id long, click_count long")
    assert panes.window_runs(none, "pane", ["ad_id"], "click_count", "1 minute", "10 seconds").collect() == []
    assert none.agg(F.count(F.lit(1))).first()[0] == 0
