"""Physical plans: what must hold when the tables are a million times larger."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import agg_global, join_cross_scalar, numbered, running_sum
from tallyloom.plans.marts import MART_MODELS
from tallyloom.plans.staging import STAGING_MODELS
from tallyloom.sources.schemas import RAW_TABLES
from tallyloom.streaming import session_kpis, top_engagers
from tallyloom.workloads.data import raw_frame, table
from tallyloom.workloads.models import models


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


DEDUPED = [n for n in STAGING_MODELS if n != "stg_tiktok_live_comments"]


@pytest.mark.parametrize("name", DEDUPED)
def test_dedup_cuts_rows_before_its_shuffle(spark, sf_dir, name):
    text = plan(models(spark, sf_dir)[name])
    assert text.count("Exchange") == 1
    after = text[text.index("Exchange") :]
    assert re.search(r"WindowGroupLimit .* 1, Partial", after)


def test_staging_without_dedup_does_not_shuffle(spark, sf_dir):
    assert "Exchange" not in plan(models(spark, sf_dir)["stg_tiktok_live_comments"])


@pytest.mark.parametrize("name", list(MART_MODELS))
def test_nothing_is_crossed_broadcast_or_run_in_python(spark, sf_dir, no_broadcast, name):
    text = plan(models(spark, sf_dir)[name])
    for operator in ("CartesianProduct", "NestedLoop", "BroadcastExchange", "Python"):
        assert operator not in text


def test_one_row_aggregates_are_subqueries(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    top = agg_global(orders, low=F.min("o_orderkey"), high=F.max("o_orderkey"))
    text = plan(join_cross_scalar(orders, top))
    assert text.count("- Subquery subquery") == 1 and "Join" not in text
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        join_cross_scalar(orders, orders.withColumnRenamed("o_orderkey", "k")).collect()


def test_enriching_videos_reuses_the_partitioning_of_dedup(spark, sf_dir, no_broadcast):
    text = plan(models(spark, sf_dir)["mart_youtube_videos"])
    # Videos: one shuffle for dedup and join together. Comments: dedup, then totals per video.
    assert text.count("Exchange hashpartitioning") == 3
    assert "SortMergeJoin" in text


def test_daily_marts_reduce_to_days_before_the_single_task(spark, sf_dir):
    for name in ("mart_facebook_insights", "mart_tiktok_followers"):
        text = plan(models(spark, sf_dir)[name])
        assert text.count("Exchange SinglePartition") == 1
        below = text[text.index("Exchange SinglePartition") :].splitlines()[1]
        assert "HashAggregate" in below


def test_columns_are_pruned_to_the_scan(spark, sf_dir):
    text = plan(models(spark, sf_dir)["mart_facebook_posts"].agg(F.count("*")))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert schemas and all("lang" not in s and "source" not in s for s in schemas)


@pytest.mark.parametrize(
    "name, columns",
    [
        ("facebook_posts", {"post_id", "ingested_at", "row_key"}),
        ("youtube_videos", {"video_id", "ingested_at", "row_key"}),
        ("youtube_comments", {"video_id", "author", "published_at", "ingested_at", "row_key"}),
        ("tiktok_posts", {"date_raw", "sound_raw", "ingested_at", "row_key"}),
        ("tiktok_watch_live_history", {"watched_at_raw", "link_raw", "ingested_at", "row_key"}),
    ],
)
def test_choosing_the_newest_row_reads_no_text(spark, sf_dir, tmp_path, name, columns):
    path = str(tmp_path / name)
    raw_frame(spark, sf_dir, name).limit(5).write.parquet(path)
    stored = {name: spark.read.schema(RAW_TABLES[name]).parquet(path)}
    text = plan(STAGING_MODELS[f"stg_{name}"](stored).agg(F.count("*")))
    (scanned,) = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert {c.split(":")[0] for c in scanned.split(",")} == columns


@pytest.mark.parametrize(
    "name", ["facebook_posts", "youtube_videos", "youtube_comments", "tiktok_posts", "tiktok_watch_live_history"]
)
def test_row_keys_are_shuffled_as_bytes(spark, sf_dir, tmp_path, name):
    """Hex digits take twice the room; the largest key of a time still wins, whatever its form."""
    path = str(tmp_path / name)
    raw = raw_frame(spark, sf_dir, name).limit(1)
    at = F.timestamp_seconds(F.lit(1_700_000_000))
    low, high = (raw.withColumns({"ingested_at": at, "row_key": F.lit(c * 32)}) for c in ("0f"))
    low.unionByName(high).repartition(2).write.parquet(path)
    staged = STAGING_MODELS[f"stg_{name}"]({name: spark.read.schema(RAW_TABLES[name]).parquet(path)})
    assert staged.count() == 1 and "row_key" not in " ".join(staged.columns)
    shuffled = staged._jdf.queryExecution().executedPlan().toString().split("Exchange")[1]
    assert "unhex" in shuffled and "row_key_bytes" in shuffled


def test_the_largest_row_key_of_a_time_wins(spark):
    keys = [["00" * 16, "7f" * 16, "80" * 16, "ff" * 16], ["a", "b", "z"], [None, "k"], [None, "0a" * 16], ["é", "e"]]
    for given in keys:
        wanted = max(k for k in given if k is not None)
        posts = [("p", k, "2024-01-01", None, datetime(2024, 1, 1), k) for k in given]
        frame = spark.createDataFrame(posts, RAW_TABLES["facebook_posts"]).repartition(3)
        (found,) = STAGING_MODELS["stg_facebook_posts"]({"facebook_posts": frame}).collect()
        assert found.post_message == wanted


def test_filters_reach_the_scan(spark, sf_dir):
    events = table(spark, sf_dir, "events").where(F.col("event_type") == "view")
    assert "EqualTo(event_type,view)" in plan(events)


def test_split_calculations_shuffle_the_rows_once(spark, sf_dir, no_broadcast):
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_linenumber")
    month = F.date_trunc("month", "l_shipdate")
    for df in (
        running_sum(lines, "l_linenumber", "l_shipdate", ["l_suppkey"], split=month),
        numbered(lines, ["l_suppkey"], ["l_shipdate"], month),
    ):
        big = plan(df).split("SortMergeJoin")[1].split("\n      +- Sort [__key")[0]
        assert big.count("Exchange") == 1 and "Exchange SinglePartition" not in plan(df)


def test_session_reports_count_before_they_shuffle(spark, sf_dir):
    events = raw_frame(spark, sf_dir, "raw_tiktok_live_events")
    assert "partial_count" in plan(session_kpis(events))
    engagers = plan(top_engagers(events))
    assert "partial_count" in engagers and "WindowGroupLimit" in engagers
