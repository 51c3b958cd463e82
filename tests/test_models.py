"""Models on handwritten raw rows, and the whole daily run."""

from datetime import date, datetime, timedelta

import pytest

from tallyloom.operators import check_row_counts, observe_checks, run_checks
from tallyloom.plans.landing import BATCH
from tallyloom.plans.marts import MART_MODELS, mart_social_followers_snapshot
from tallyloom.plans.refresh import (
    WAVES,
    ModelFrames,
    check_mart_rows,
    check_marts,
    refresh_marts,
    summarize_marts,
)
from tallyloom.plans.staging import STAGING_MODELS
from tallyloom.plans.suite import SUITE
from tallyloom.sources import attach_row_key, materialize_table
from tallyloom.sources.schemas import EVENT_TABLES, INVENTORY_TABLES, KEYED_TABLES, RAW_TABLES
from tests.conftest import rows

T1 = datetime(2024, 1, 10, 6)
T2 = T1 + timedelta(days=1)
SCHEMAS = {**RAW_TABLES, **EVENT_TABLES}


def landed(spark, name, data):
    """Rows as they land: with a row key where the table has one."""
    if name not in KEYED_TABLES:
        return spark.createDataFrame(data, SCHEMAS[name])
    return attach_row_key(spark.createDataFrame(data, SCHEMAS[name].removesuffix(", row_key string")))


RAW = {
    "facebook": [
        ("page_follows", "2024-01-03", "100", T1),
        ("page_follows", "2024-01-03", "110", T2),
        ("page_impressions_unique", "2024-01-01", "7", T1),
        ("page_actions_post_reactions_total", "2024-01-01", "{'like': 3, 'love': None}", T1),
        ("page_actions_post_reactions_total", "2024-01-05", "{}", T1),
        ("page_video_views", "2024-01-06", None, T1),
        (None, "2024-01-06", "4", T1),
        ("page_follows", "2024-01-06", "99", T1),
    ],
    "facebook_posts": [
        ("1", "RECAP of the day", "2024-01-01", "video_inline", T1),
        ("1", "see you there", "2024-01-01", None, T2),
        ("2", None, "2024-01-07", "native_templates", T1),
    ],
    "youtube_channel": [
        ("c", "T", "5", "50", "3", T1),
        ("c", "T", "8", "80", None, T2),
    ],
    "youtube_videos": [
        ("v1", None, "2024-01-01", "0", "1", "1", "0", "PT3M", 180, None, "HD", "LIVE", "1", None, None, T1),
        ("v2", "two", "2024-01-07", "8", "1", "0", "0", None, None, "true", None, None, "1", None, "a,b", T1),
        ("v2", "two", "2024-01-07", "16", "1", "0", "0", None, None, "true", None, None, "1", None, "a,b", T2),
    ],
    "youtube_comments": [
        ("v2", "ann", "hi", 2, "2024-01-08", T1),
        ("v2", "ann", "hi again", 3, "2024-01-08", T2),
        ("v2", None, None, None, "2024-01-09", T1),
        ("gone", "x", "y", 1, "2024-01-09", T1),
    ],
    "tiktok_followers": [
        ("2024-01-01 10:00:00 UTC", "a", T1),
        ("2024-01-01 10:00:00 UTC", "a", T2),
        ("2024-01-01 23:59:59 UTC", "b", T1),
        ("2024-01-04 00:00:00 UTC", "c", T1),
    ],
    "tiktok_live_history": [
        ("r1", "N/A", "2024-01-02 10:00:00 UTC - 2024-01-02 10:30:00 UTC (30 minutes)", "1,000", "N/A", "250", T1),
        ("r2", "late", "2024-01-03 10:00:00 UTC - 2024-01-03 10:00:10 UTC (0 minutes)", "0", "1", "5", T1),
    ],
    "tiktok_live_comments": [
        ("r1", "2024-01-02 10:01:00 UTC", "x", T1),
        ("r1", "2024-01-02 10:01:00 UTC", "x", T1),
    ],
    "tiktok_posts": [
        ("2024-01-02 09:00:00 UTC", "51", "Everyone", "s", "N/A", "t", T1),
        ("2024-01-02 11:00:00 UTC", "N/A", "Everyone", "N/A", "N/A", "t", T1),
        ("2024-01-05 11:00:00 UTC", "5001", "Everyone", "s", "N/A", "t", T1),
    ],
    "tiktok_watch_live_history": [
        ("2024-01-02 09:00:00", "", "[2024-01-02 09:00:01] a\n[2024-01-02 09:00:02] b", T1),
        ("2024-01-03 09:00:00", "u", None, T1),
    ],
    "facebook_csv_insights": [(date(2024, 1, 1), 5, "page_views", T1)],
    "raw_tiktok_live_events": [
        ("e1", "s", "comment", T1, T1, " ann ", "1", "  ", None, None, None, None, None),
        ("e1", "s", "comment", T1, T2, " ann ", "1", "  ", None, None, None, None, None),
        ("e2", "s", "gift", T1, T2, "", None, None, None, None, "g", 40, None),
    ],
    "raw_youtube_live_events": [],
}


@pytest.fixture(scope="module")
def built(spark):
    return ModelFrames(
        lambda name: landed(spark, name, RAW[name]), as_of=date(2024, 1, 11)
    )


def pick(df, *cols):
    return rows(df.select(*cols))


def test_inventory():
    assert len(STAGING_MODELS) == 11 and len(MART_MODELS) == 12
    assert {n for wave in WAVES for n in wave if n in MART_MODELS} == set(MART_MODELS)
    assert set(BATCH) == {*RAW_TABLES, *INVENTORY_TABLES}
    counts = [sum(len(t.get(k, ())) for t in SUITE.values())
              for k in ("not_null", "unique", "accepted", "at_least_zero")]
    assert counts == [55, 9, 7, 13] and sum(len(t.get("warn", ())) for t in SUITE.values()) == 4


def test_insights_staging(built):
    assert pick(built["stg_facebook_insights"], "date", "metric_name", "metric_value") == sorted(
        [
            (date(2024, 1, 3), "page_follows", 110),
            (date(2024, 1, 1), "page_impressions_unique", 7),
            (date(2024, 1, 1), "reaction_like", 3),
            (date(2024, 1, 1), "reaction_love", None),
            (date(2024, 1, 5), "reaction_like", None),
            (date(2024, 1, 5), "reaction_love", None),
            (date(2024, 1, 6), "page_video_views", 0),
            (date(2024, 1, 6), "unknown", 4),
            (date(2024, 1, 6), "page_follows", 99),
        ],
        key=lambda r: [str(v) for v in r],
    )


def test_insights_mart_fills_gaps(built):
    got = pick(
        built["mart_facebook_insights"], "date", "total_followers", "unique_impressions",
        "total_reactions", "day_of_week", "year_week",
    )
    assert [r[0].day for r in got] == [1, 2, 3, 4, 5, 6]
    assert [r[1] for r in got] == [None, None, 110, 110, 110, 99]
    assert [r[2] for r in got] == [7, 0, 0, 0, 0, 0]
    assert [r[3] for r in got] == [3, 0, 0, 0, 0, 0]
    assert got[0][4:] == ("Monday", "2024-01")


def test_facebook_posts(built):
    got = pick(
        built["mart_facebook_posts"], "post_id", "post_message", "content_type",
        "content_category", "post_category", "year",
    )
    assert got == [
        ("1", "see you there", "unknown", "other", "announcement", "2024"),
        ("2", "", "native_templates", "link", "general", "2024"),
    ]


def test_youtube_marts(built):
    got = pick(
        built["mart_youtube_perfomance"], "video_id", "video_title", "engagement_rate_pct",
        "total_comments_ingested", "total_comment_likes", "latest_comment_date",
        "days_since_published",
    )
    assert got == [
        ("v1", "unknown", None, 0, 0, None, 10),
        ("v2", "two", 6.25, 2, 3, date(2024, 1, 9), 4),
    ]
    videos = pick(
        built["mart_youtube_videos"], "video_id", "content_type", "duration_minutes",
        "duration_bucket", "definition", "caption", "day_of_week_num",
    )
    assert videos == [
        ("v1", "Live Stream", 3.0, "Short clips (< 30 min)", "hd", "false", 1),
        ("v2", "Uploaded", None, "Unknown", "unknown", "true", 7),
    ]


def test_tiktok_marts(built):
    followers = pick(built["mart_tiktok_followers"], "follow_date", "new_followers", "cumulative_followers")
    assert [(r[0].day, r[1], r[2]) for r in followers] == [(1, 2, 2), (2, 0, 2), (3, 0, 2), (4, 1, 3)]
    lives = pick(
        built["mart_tiktok_live_perfomance"], "room_id", "live_title", "duration_hours",
        "total_views", "total_gifters", "live_duration_bucket", "like_rate",
    )
    assert lives == [
        ("r1", None, 0.5, 1000, None, "Medium", 0.25), ("r2", "late", 0.0, 0, 1, "Short", None),
    ]
    assert pick(built["mart_posts_perfomance"], "likes", "sound", "like_bucket") == [
        (0, None, "0-50"), (5001, "s", "5000+"), (51, "s", "51-100"),
    ]
    overlap = pick(
        built["mart_tiktok_activity_overlap"], "activity_date", "activity_type", "posts_on_day",
        "avg_post_likes", "live_views_on_day", "day_number",
    )
    assert [(r[0].day, *r[1:]) for r in overlap] == [
        (2, "Post + Live", 2, 25.5, 1000, "2"), (3, "Live Only", 0, 0.0, 0, "3"),
        (5, "Post Only", 1, 5001.0, 0, "5"),
    ]
    assert built["stg_tiktok_live_comments"].count() == 2
    watched = pick(built["stg_tiktok_watch_live_history"], "comments_sent", "link")
    assert watched == [(0, "u"), (2, None)]


def test_livestream(built):
    got = pick(
        built["stg_tiktok_livestream"], "event_id", "username", "content", "value",
        "ingested_at", "is_gift", "day_of_week",
    )
    assert got == [
        ("e1", "ann", None, None, T1, False, "Wednesday"),
        ("e2", None, None, 40, T2, True, "Thursday"),
    ]


def test_snapshot(built):
    got = pick(
        built["mart_social_followers_snapshot"], "platform", "snapshot_date", "follower_count",
        "prev_period_followers", "pct_growth_mom",
    )
    facebook = [r[2:] for r in got if r[0] == "Facebook"]
    assert facebook == [(None, None, None), (110, None, None), (99, 110, -10.0)]
    assert [r[2:] for r in got if r[0] == "YouTube"] == [(8, None, None)]
    history = mart_social_followers_snapshot(built, youtube_history=True)
    youtube = pick(history.where("platform = 'YouTube'"), "follower_count", "pct_growth_mom")
    assert youtube == [(5, None), (8, 60.0)]


def test_scorecards(built):
    cols = ["platform", "total_followers", "total_posts", "total_views", "total_likes",
            "total_live_sessions", "avg_engagement_rate"]
    assert pick(built["mart_executive_summary"], *cols) == [
        ("facebook", 110, 2, 7, 3, None, 42.86),
        ("tiktok", 3, 3, 1000, 255, 2, 0.25),
        ("youtube", 8, 0, 80, 2, None, 6.25),
    ]
    assert pick(built["mart_social_overview"], *cols, "total_comments") == [
        ("facebook", 110, 0, 0, 0, 0, 0.0, 0),
        ("tiktok", 3, 0, 1000, 255, 2, 0.25, 0),
        ("youtube", 8, 2, 16, 2, 1, 6.25, 1),
    ]


def test_everything_on_empty_input(spark):
    empty = ModelFrames(lambda name: landed(spark, name, []))
    for name in (*STAGING_MODELS, *MART_MODELS):
        want = 3 if name in ("mart_social_overview", "mart_executive_summary") else 0
        assert empty[name].count() == want, name
    overview = {r.platform: r for r in empty["mart_social_overview"].collect()}
    assert overview["tiktok"].total_followers is None
    assert overview["youtube"].total_posts == 0 and overview["youtube"].total_likes is None


@pytest.mark.parametrize("name", [n for n in STAGING_MODELS if n != "stg_tiktok_live_comments"])
def test_a_repeated_batch_changes_nothing_but_its_time(spark, built, name):
    def again(table):
        df = landed(spark, table, RAW[table])
        if table == "raw_tiktok_live_events":
            return df.unionByName(df)
        return df.unionByName(df.withColumn("ingested_at", df.ingested_at + (T2 - T1) * 10))

    once = built[name].drop("ingested_at")
    assert rows(ModelFrames(again)[name].drop("ingested_at")) == rows(once)


def test_daily_run(spark, tmp_path):
    for table, data in RAW.items():
        landed(spark, table, data).write.parquet(str(tmp_path / "raw" / table))
    observed = {}
    stored = refresh_marts(
        spark, str(tmp_path / "raw"), str(tmp_path / "marts"), date(2024, 1, 11), views=True, observed=observed
    )
    lazy = ModelFrames(
        lambda name: landed(spark, name, RAW[name]), as_of=date(2024, 1, 11)
    )
    for name in MART_MODELS:
        assert rows(stored[name]) == rows(lazy[name]), name
    assert spark.table("stg_facebook_posts").count() == 2
    checks = check_marts(stored)
    failing = {(r.table, r.column, r.status) for r in checks.collect() if r.status != "PASS"}
    assert checks.count() == 84
    assert failing == {
        ("mart_facebook_insights", "total_followers", "ERROR"),
        ("mart_facebook_metrics", "metric_value", "WARN"),
        ("mart_social_followers_snapshot", "follower_count", "ERROR"),
        ("mart_social_followers_snapshot", "total_views", "WARN"),
    }
    assert dict(rows(summarize_marts(stored)))["mart_social_overview"] == 3
    # What the writes have seen is what a scan finds, and spares it.
    seen = check_marts(stored, observed)
    uniqueness = sum(len(spec.get("unique", ())) for spec in SUITE.values())
    assert plan(seen).count("FileScan") == uniqueness
    assert plan(check_marts(stored)).count("FileScan") == uniqueness + len(SUITE)
    assert rows(seen) == rows(checks)
    counts = check_mart_rows(stored, observed)
    assert plan(counts).count("FileScan") == 0
    assert rows(counts) == rows(check_mart_rows(stored))
    assert {r.table for r in counts.collect()} == set(MART_MODELS)
    again = refresh_marts(spark, str(tmp_path / "raw"), str(tmp_path / "marts"), date(2024, 1, 11))
    assert rows(again["mart_executive_summary"]) == rows(lazy["mart_executive_summary"])


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_mart_without_rows_warns_though_its_tests_pass(spark, tmp_path):
    spec = {"not_null": ["a"], "accepted": {"b": ["x"]}, "at_least_zero": ["a"], "warn": [("a", "not_null")]}
    full = spark.createDataFrame([(1, "x"), (-1, "y"), (None, None)], "a int, b string").repartition(3)
    for name, df, failures, short in (("full", full, [1, 1, 1], 0), ("none", full.where("false"), [0, 0, 0], 1)):
        watched, seen = observe_checks(df, spec)
        stored = materialize_table(watched, str(tmp_path / name))
        found = run_checks({name: stored}, {name: spec}, {name: seen})
        assert rows(found) == rows(run_checks({name: stored}, {name: spec}))
        assert [r.failures for r in found.collect()] == failures
        counted = check_row_counts({name: stored}, observed={name: seen}).first()
        assert (counted.failures, counted.status) == (short, "WARN" if short else "PASS")
    unnamed, seen = observe_checks(full, {})
    materialize_table(unnamed, str(tmp_path / "unnamed"))
    assert seen.get == {"rows": 3}
