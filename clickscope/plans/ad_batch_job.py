"""J4 in batch form: the ad click tables computed from a whole log at once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators import ads


@dataclass
class AdBatchResult:
    user_click_count: DataFrame
    blacklist: DataFrame
    ad_stat: DataFrame
    province_top3: DataFrame
    click_trend: DataFrame


def run_ad_batch(clicks: DataFrame, threshold: int = ads.DEFAULT_THRESHOLD, top_n: int = 3) -> AdBatchResult:
    """Event-time semantics: a user's clicks after the click that listed them are not counted (the stream with
    one click per micro-batch). The trend is on the unfiltered log, as in the reference."""
    counts = ads.user_ad_click_counts(clicks)
    kept = ads.apply_cutoffs(clicks, ads.blacklist_cutoffs(clicks, threshold))
    stat = ads.ad_stat(kept)
    return AdBatchResult(
        user_click_count=ads.user_ad_click_counts(kept),
        blacklist=ads.blacklist_from_counts(counts, threshold),
        ad_stat=stat,
        province_top3=ads.province_top(stat, top_n),
        click_trend=ads.click_trend(clicks),
    )
