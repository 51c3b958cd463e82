"""The daily refresh: raw tables in, marts and test results out."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession

from tallyloom.operators import (
    check_row_counts,
    mart_row_summary,
    observe_checks,
    run_checks,
    with_address,
)
from tallyloom.plans.marts import MART_MODELS, youtube_videos_enriched
from tallyloom.plans.staging import STAGING_MODELS, youtube_channel_rows
from tallyloom.plans.suite import SUITE
from tallyloom.session import configure, sized_for
from tallyloom.sources import materialize_table, materialize_view, read_sources
from tallyloom.sources.schemas import EVENT_TABLES

# The marts whose row counts close a run.
SUMMARY_MARTS = [
    "mart_facebook_insights",
    "mart_youtube_videos",
    "mart_tiktok_live_perfomance",
    "mart_posts_perfomance",
    "mart_social_overview",
]


# Frames between staging and marts.
SHARED_PARTS = {
    "youtube_channel_rows": youtube_channel_rows,
    "youtube_videos_enriched": youtube_videos_enriched,
}
# What is written in which order: frames of one list do not read each other. The first
# list holds what several marts read; it is stored once so that it is computed once.
WAVES = [
    ["stg_facebook_insights", "stg_youtube_channel", "youtube_videos_enriched"],
    [
        "mart_youtube_perfomance",
        "mart_youtube_videos",
        "mart_facebook_insights",
        "mart_facebook_metrics",
        "mart_facebook_posts",
        "mart_posts_perfomance",
        "mart_tiktok_followers",
        "mart_tiktok_live_perfomance",
    ],
    [
        "mart_tiktok_activity_overlap",
        "mart_social_followers_snapshot",
        "mart_social_overview",
        "mart_executive_summary",
    ],
]
# Raw tables whose rows are much wider than the keys and times they are chosen by, and are not
# shuffled after that: only addresses are.
CHOSEN_WHERE_STORED = ["facebook_posts", "tiktok_live_history", "tiktok_posts", "youtube_comments"]
THREADS = 4  # fixed value: models built at the same time


class ModelFrames(dict):
    """Frames by name; a model is put together when it is first asked for.

    Raw tables come from ``read_raw``. The calls between model functions are the
    lineage, and everything stays lazy until a result is written or read.
    """

    def __init__(self, read_raw: Callable[[str], DataFrame], as_of: date | None = None) -> None:
        super().__init__()
        self._read_raw = read_raw
        self._as_of = as_of

    def __missing__(self, name: str) -> DataFrame:
        if name in STAGING_MODELS:
            self[name] = STAGING_MODELS[name](self)
        elif name in MART_MODELS:
            self[name] = MART_MODELS[name](self, as_of=self._as_of)
        elif name in SHARED_PARTS:
            self[name] = SHARED_PARTS[name](self)
        else:
            self[name] = self._read_raw(name)
        return self[name]


def refresh_marts(
    spark: SparkSession,
    raw_root: str,
    mart_root: str,
    as_of: date | None = None,
    views: bool = False,
    missing: str = "fail",
    observed: dict[str, Observation] | None = None,
) -> dict[str, DataFrame]:
    """Rebuild every mart below ``mart_root`` and return the stored tables.

    What feeds later marts is computed once: those read the stored rows. With ``views``
    the staging models are also registered as temporary views. ``missing='empty'`` lets
    raw tables be absent, as on a first day with only some sources. ``observed`` is filled with
    what the write of each mart has counted for its tests; give it to ``check_marts``.
    """
    configure(spark)

    def read_raw(name: str) -> DataFrame:
        # Live events land by a job of their own, which may not have run yet.
        absent = "empty" if name in EVENT_TABLES else missing
        rows = read_sources(spark, raw_root, [name], absent)[name]
        return with_address(rows) if name in CHOSEN_WHERE_STORED else rows

    models = ModelFrames(read_raw, as_of)
    if views:
        for name in STAGING_MODELS:
            materialize_view(models[name], name)

    def store(name: str, df: DataFrame) -> DataFrame:
        folder = name if name in MART_MODELS else f"_shared/{name}"
        if observed is not None and name in MART_MODELS:
            df, observed[name] = observe_checks(df, SUITE.get(name, {}))
        return materialize_table(df, f"{mart_root.rstrip('/')}/{folder}")

    with sized_for(spark, raw_root), ThreadPoolExecutor(THREADS) as pool:
        for wave in WAVES:
            # Plans are made here, only the writes run side by side.
            frames = [models[name] for name in wave]
            models.update(zip(wave, pool.map(store, wave, frames)))
    return {name: models[name] for name in MART_MODELS}


def check_marts(
    stored: Mapping[str, DataFrame], observed: Mapping[str, Observation] | None = None
) -> DataFrame:
    """Result of all declared tests; what a write has ``observed`` is not counted again."""
    return run_checks(stored, SUITE, observed)


def check_mart_rows(
    stored: Mapping[str, DataFrame], observed: Mapping[str, Observation] | None = None
) -> DataFrame:
    """A warning for every mart without rows, whose other tests all pass."""
    return check_row_counts(stored, observed=observed)


def summarize_marts(stored: Mapping[str, DataFrame]) -> DataFrame:
    return mart_row_summary({name: stored[name] for name in SUMMARY_MARTS})
