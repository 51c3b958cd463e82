"""Landed API payload files flattened to raw table rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.numbers import parse_iso_duration
from tallyloom.sources.tables import attach_ingested_at


def read_payloads(
    spark: SparkSession, path: str, schema: str, multiline: bool = False
) -> DataFrame:
    """Payload pages under a declared schema: one per line, or one per file with ``multiline``.

    A page that is no JSON, as a truncated one, or holds a value of another type fails the job.
    """
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    return reader.option("multiLine", multiline).json(path)


def _items(payload: DataFrame, field: str = "items") -> DataFrame:
    return payload.select(F.explode(field).alias("i"))


def flatten_insights(payload: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    metrics = _items(payload, "data").select("i.name", F.explode("i.values").alias("v"))
    rows = metrics.select(
        F.col("name").alias("METRIC"),
        F.substring("v.end_time", 1, 10).alias("DATE"),
        F.col("v.value").alias("VALUE"),
    )
    return attach_ingested_at(rows, ingested_at)


def flatten_feed(
    payload: DataFrame, ingested_at: Column | None = None, max_chars: int | None = None
) -> DataFrame:
    """Posts with message, else story, else ''; a post's type is that of its first attachment.

    Texts are whole unless ``max_chars`` gives a limit.
    """
    text = F.coalesce("i.message", "i.story", F.lit(""))
    if max_chars is not None:
        text = F.substring(text, 1, max_chars)
    rows = _items(payload, "data").select(
        F.col("i.id").alias("post_id"),
        text.alias("message"),
        F.substring("i.created_time", 1, 10).alias("created_time"),
        F.get(F.col("i.attachments.data"), 0)["type"].alias("content_type"),
    )
    return attach_ingested_at(rows, ingested_at)


def flatten_channel(payload: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Every channel of all pages, counts as text."""
    rows = _items(payload).where("i is not null").select(
        F.col("i.id").alias("channel_id"),
        F.col("i.snippet.title").alias("channel_title"),
        F.col("i.statistics.subscriberCount").alias("subscriber_count"),
        F.col("i.statistics.viewCount").alias("view_count"),
        F.col("i.statistics.videoCount").alias("video_count"),
    )
    return attach_ingested_at(rows, ingested_at)


def flatten_playlist(payload: DataFrame) -> DataFrame:
    """Every video id of all playlist pages."""
    return _items(payload).select(F.col("i.contentDetails.videoId").alias("video_id"))


def flatten_videos(payload: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    def count(name: str) -> Column:
        return F.coalesce(F.col(f"i.statistics.{name}"), F.lit("0"))

    duration = F.col("i.contentDetails.duration")
    rows = _items(payload).select(
        F.col("i.id").alias("video_id"),
        F.col("i.snippet.title").alias("title"),
        F.substring("i.snippet.publishedAt", 1, 10).alias("published_at"),
        count("viewCount").alias("view_count"),
        count("likeCount").alias("like_count"),
        count("commentCount").alias("comment_count"),
        count("favoriteCount").alias("favorite_count"),
        duration.alias("duration_raw"),
        parse_iso_duration(duration).alias("duration_seconds"),
        F.col("i.contentDetails.caption").alias("caption"),
        F.col("i.contentDetails.definition").alias("definition"),
        F.col("i.snippet.liveBroadcastContent").alias("live_broadcast_content"),
        F.col("i.snippet.categoryId").alias("category_id"),
        F.col("i.snippet.defaultLanguage").alias("default_language"),
        F.when(F.size("i.snippet.tags") > 0, F.array_join("i.snippet.tags", ",")).alias(
            "tags_raw"
        ),
    )
    return attach_ingested_at(rows, ingested_at)


def flatten_comments(payload: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Top-level comments of comment threads."""
    comment = "i.snippet.topLevelComment.snippet"
    rows = _items(payload).select(
        F.coalesce("i.snippet.videoId", f"{comment}.videoId").alias("video_id"),
        F.col(f"{comment}.authorDisplayName").alias("author"),
        F.col(f"{comment}.textDisplay").alias("comment"),
        F.coalesce(F.col(f"{comment}.likeCount"), F.lit(0)).cast("bigint").alias("like_count"),
        F.substring(f"{comment}.publishedAt", 1, 10).alias("published_at"),
    )
    return attach_ingested_at(rows, ingested_at)
