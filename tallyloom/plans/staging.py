"""Staging models: typed, null-normalised, one row per key. All are lazy frames.

``raw`` maps raw table names to frames (see ``sources.read_sources``). Where two rows
of a key carry the same ``ingested_at``, the largest remaining values win, so a rerun
gives the same row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import (
    clean_number,
    count_matches,
    day_name,
    default_nulls,
    event_flags,
    event_hour,
    lower_norm,
    null_sentinels,
    regexp_or_null,
    sunday_day_num,
    surrogate_key,
    to_bigint,
    trim_blank,
    utc_timestamp,
)
from tallyloom.operators import (
    address_columns,
    dedup_earliest,
    dedup_latest,
    dedup_latest_stored,
    unpivot_reactions,
)

Raw = Mapping[str, DataFrame]

# Fixed values.
REACTIONS_METRIC = "page_actions_post_reactions_total"
REACTION_KEYS = ["like", "love"]
FLAGGED_EVENTS = ["comment", "like", "gift", "viewer_count"]

_DAY = r"\d{4}-\d{2}-\d{2}"
_SECOND = rf"{_DAY} \d{{2}}:\d{{2}}:\d{{2}}"


# A row key of 32 hex digits goes through the shuffle as its 16 bytes, which sort alike; another as it is.
ROW_KEY_TIES = ["row_key_bytes", "row_key_text"]


def _row_key() -> list[Column]:
    digest = F.col("row_key").rlike(r"\A[0-9a-f]{32}\z")
    packed = [F.when(digest, F.unhex("row_key")), F.when(~digest, F.col("row_key"))]
    return [c.alias(name) for c, name in zip(packed, ROW_KEY_TIES, strict=True)]


def _latest_landed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The newest row per key; of rows of one time that with the largest row key."""
    packed = rows.select("*", *_row_key()).drop("row_key")
    # Of stored rows the first 28 bits are enough to choose by; those that share them are compared whole.
    digits = F.conv(F.substring(F.hex(ROW_KEY_TIES[0]), 1, 7), 16, 10).cast("int")
    return dedup_latest_stored(packed, keys, "ingested_at", ROW_KEY_TIES, digits).drop(*ROW_KEY_TIES)


def _ingested() -> Column:
    return F.col("ingested_at").cast("timestamp").alias("ingested_at")


def stg_facebook_insights(raw: Raw, on_error: str = "fail") -> DataFrame:
    """One row per day and metric; reaction payloads become one metric per reaction."""
    named = raw["facebook"].select(
        F.col("DATE").cast("date").alias("date"),
        default_nulls("METRIC", "unknown").alias("metric_name"),
        default_nulls(F.col("VALUE").cast("string"), "0").alias("metric_value"),
        _ingested(),
    )
    rows = unpivot_reactions(
        named,
        "metric_value",
        REACTION_KEYS,
        only_when=F.col("metric_name") == REACTIONS_METRIC,
    )
    typed = rows.select(
        "date",
        "metric_name",
        to_bigint("metric_value", on_error).alias("metric_value"),
        "ingested_at",
    )
    return dedup_latest(typed, ["date", "metric_name"], "ingested_at", ["metric_value"])


def stg_facebook_posts(raw: Raw) -> DataFrame:
    typed = raw["facebook_posts"].select(
        "post_id",
        default_nulls("message", "").alias("post_message"),
        F.col("created_time").cast("date").alias("post_date"),
        default_nulls("content_type", "unknown").alias("content_type"),
        _ingested(),
        "row_key",
        *address_columns(raw["facebook_posts"]),
    )
    return _latest_landed(typed, ["post_id"])


def youtube_channel_rows(raw: Raw) -> DataFrame:
    """Typed channel rows of every batch."""
    return raw["youtube_channel"].select(
        "channel_id",
        default_nulls("channel_title", "unknown").alias("channel_title"),
        default_nulls(to_bigint("subscriber_count"), 0).alias("subscriber_count"),
        default_nulls(to_bigint("view_count"), 0).alias("total_view_count"),
        default_nulls(to_bigint("video_count"), 0).alias("total_video_count"),
        _ingested(),
    )


def stg_youtube_channel(raw: Raw) -> DataFrame:
    ties = ["subscriber_count", "total_view_count", "total_video_count", "channel_title"]
    return dedup_latest(youtube_channel_rows(raw), ["channel_id"], "ingested_at", ties)


def stg_youtube_videos(raw: Raw) -> DataFrame:
    typed = raw["youtube_videos"].select(
        "video_id",
        default_nulls("title", "unknown").alias("video_title"),
        F.col("published_at").cast("date").alias("published_at"),
        *[
            default_nulls(to_bigint(c), 0).alias(c)
            for c in ("view_count", "like_count", "comment_count", "favorite_count")
        ],
        "duration_raw",
        to_bigint("duration_seconds").alias("duration_seconds"),
        lower_norm("live_broadcast_content", "none").alias("live_broadcast_content"),
        lower_norm("definition", "unknown").alias("definition"),
        lower_norm("caption", "false").alias("caption"),
        "category_id",
        "default_language",
        "tags_raw",
        _ingested(),
        "row_key",
    )
    return _latest_landed(typed, ["video_id"])


def stg_youtube_comments(raw: Raw) -> DataFrame:
    typed = raw["youtube_comments"].select(
        "video_id",
        default_nulls("author", "anonymous").alias("comment_author"),
        default_nulls("comment", "").alias("comment_text"),
        default_nulls(to_bigint("like_count"), 0).alias("like_count"),
        F.col("published_at").cast("date").alias("published_at"),
        _ingested(),
        "row_key",
        *address_columns(raw["youtube_comments"]),
    )
    keys = ["video_id", "comment_author", "published_at"]
    return _latest_landed(typed, keys)


def stg_tiktok_followers(raw: Raw) -> DataFrame:
    latest = dedup_latest(raw["tiktok_followers"], ["username", "followed_at_raw"], "ingested_at")
    return latest.select(
        surrogate_key("username", "followed_at_raw").alias("follower_id"),
        utc_timestamp("followed_at_raw").alias("followed_at"),
        "username",
        "ingested_at",
    )


def stg_tiktok_live(raw: Raw) -> DataFrame:
    rows = raw["tiktok_live_history"]
    ties = [
        "duration_raw", "live_title_raw", "total_view_raw", "total_gifter_raw", "total_likes_raw",
    ]
    latest = dedup_latest_stored(rows, ["room_id"], "ingested_at", ties)
    span = F.col("duration_raw")
    return latest.select(
        "room_id",
        null_sentinels("live_title_raw").alias("live_title"),
        regexp_or_null(span, rf"^({_DAY})").cast("date").alias("live_date"),
        regexp_or_null(span, rf"^({_SECOND})").cast("timestamp").alias("start_time"),
        regexp_or_null(span, rf"- ({_SECOND})").cast("timestamp").alias("end_time"),
        to_bigint(regexp_or_null(span, r"\((\d+) minutes?\)")).alias("duration_mins"),
        clean_number("total_view_raw").alias("total_views"),
        clean_number("total_gifter_raw").alias("total_gifters"),
        clean_number("total_likes_raw").alias("total_likes"),
        "ingested_at",
    )


def stg_tiktok_live_comments(raw: Raw) -> DataFrame:
    """Every comment row; this table is not de-duplicated."""
    return raw["tiktok_live_comments"].select(
        surrogate_key("room_id", "comment_time_raw", "comment_text").alias("comment_id"),
        "room_id",
        utc_timestamp("comment_time_raw").alias("comment_time"),
        "comment_text",
        "ingested_at",
    )


def stg_tiktok_posts(raw: Raw) -> DataFrame:
    rows = raw["tiktok_posts"]
    latest = _latest_landed(rows, ["date_raw", "sound_raw"])
    return latest.select(
        surrogate_key("date_raw", "sound_raw").alias("post_id"),
        regexp_or_null("date_raw", rf"^({_DAY})").cast("date").alias("post_date"),
        utc_timestamp("date_raw").alias("posted_at"),
        # Likes with thousands separators fail the cast, on purpose.
        default_nulls(to_bigint(null_sentinels("likes_raw")), 0).alias("likes"),
        *[
            null_sentinels(f"{c}_raw").alias(c)
            for c in ("visibility", "sound", "location", "title")
        ],
        "ingested_at",
    )


def stg_tiktok_watch_live_history(raw: Raw) -> DataFrame:
    rows = raw["tiktok_watch_live_history"]
    keys = ["watched_at_raw", "link_raw"]
    latest = _latest_landed(rows, keys)
    return latest.select(
        surrogate_key(*keys).alias("watch_id"),
        F.col("watched_at_raw").cast("timestamp").alias("watched_at"),
        null_sentinels("link_raw", [""]).alias("link"),
        count_matches("raw_comments_blob", rf"\[{_DAY}").alias("comments_sent"),
        F.col("raw_comments_blob").alias("comments_raw"),
        "ingested_at",
    )


def map_live_columns(events: DataFrame) -> DataFrame:
    """Collector events in the column names the livestream model reads."""
    return events.select(
        "event_id",
        "event_type",
        "username",
        F.col("comment_text").alias("content"),
        F.coalesce("like_count", "viewer_count", "diamond_count").alias("value"),
        F.col("session_id").alias("stream_session_id"),
        "ingested_at",
    )


def type_live_columns(rows: DataFrame) -> DataFrame:
    """Cleaned event columns with date parts and flags; works on streams too."""
    at = F.col("ingested_at").cast("timestamp")
    return rows.select(
        "event_id",
        "event_type",
        trim_blank("username").alias("username"),
        trim_blank("content").alias("content"),
        "value",
        "stream_session_id",
        at.alias("ingested_at"),
        at.cast("date").alias("event_date"),
        event_hour(at).alias("event_hour"),
        sunday_day_num(at).alias("day_of_week_num"),
        day_name(at).alias("day_of_week"),
        *event_flags("event_type", FLAGGED_EVENTS),
    )


def stg_tiktok_livestream(raw: Raw) -> DataFrame:
    """One row per live event, the first delivery of each."""
    rows = map_live_columns(raw["raw_tiktok_live_events"])
    ties = ["stream_session_id", "event_type", "username", "content", "value"]
    return type_live_columns(dedup_earliest(rows, ["event_id"], "ingested_at", ties))


STAGING_MODELS = {
    f.__name__: f
    for f in (
        stg_facebook_insights,
        stg_facebook_posts,
        stg_youtube_channel,
        stg_youtube_videos,
        stg_youtube_comments,
        stg_tiktok_followers,
        stg_tiktok_live,
        stg_tiktok_live_comments,
        stg_tiktok_livestream,
        stg_tiktok_posts,
        stg_tiktok_watch_live_history,
    )
}
