"""Mart models: one business question each, at a stated grain.

``models`` maps names to frames: staging models, earlier marts and, for the overview,
two raw tables.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import (
    bucket_likes,
    bucket_live_duration,
    bucket_video_duration,
    classify_keywords,
    content_type_label,
    day_name,
    days_between,
    exact_avg,
    iso_day_num,
    map_category,
    ratio_pct,
    safe_ratio,
    to_bigint,
    year_label,
    year_month,
    year_week,
)
from tallyloom.operators import (
    agg_global,
    expand_days,
    forward_fill,
    join_cross_scalar,
    join_full_outer,
    join_left_enrich,
    lag_change,
    pivot_metrics,
    qualify_row_number,
    running_sum,
    union_all,
)

Models = Mapping[str, DataFrame]

# Metric names, categories and keyword rules that results must show exactly.
DAILY_METRICS = {
    "page_follows": "total_followers",
    "page_impressions_unique": "unique_impressions",
    "page_posts_impressions": "post_impressions",
    "page_video_views": "video_views",
    "page_views_total": "page_views",
    "page_total_actions": "total_actions",
    "reaction_like": "reaction_likes",
    "reaction_love": "reaction_loves",
}
METRIC_CATEGORIES = {
    "reach": ["page_impressions_unique", "page_posts_impressions"],
    "engagement": ["reaction_like", "reaction_love"],
    "video": ["page_video_views"],
    "growth": ["page_follows"],
    "activity": ["page_views_total", "page_total_actions"],
}
ATTACHMENT_CATEGORIES = {
    "video": ["video_inline"],
    "album": ["album"],
    "photo": ["photo"],
    "share": ["share"],
    "link": ["native_templates"],
}
POST_RULES = [
    ("sermon_recap", ["recap", "sunday service", "ministered by", "title:"]),
    ("live_announcement", ["we are live", "join us live", "live tonight"]),
    ("announcement", ["join us", "see you", "you are invited"]),
    ("celebration", ["happy birthday", "we celebrate"]),
]
SNAPSHOT_METRICS = {
    "page_follows": "follower_count",
    "page_views_total": "total_views",
    "page_impressions_unique": "total_reach",
}
OVERLAP_LABELS = ("Post + Live", "Post Only", "Live Only")


def _big(value: int | None) -> Column:
    return F.lit(value).cast("bigint")


def mart_facebook_insights(models: Models, as_of: date | None = None) -> DataFrame:
    """One row per day, no gaps; followers carry the last reading forward."""
    daily = pivot_metrics(
        models["stg_facebook_insights"], ["date"], "metric_name", "metric_value", DAILY_METRICS
    )
    zeroed = [c for c in DAILY_METRICS.values() if c != "total_followers"]
    days = expand_days(daily, "date", fill=dict.fromkeys(zeroed, 0))
    filled = forward_fill(days, ["total_followers"], "date")
    return filled.select(
        "date",
        year_week("date").alias("year_week"),
        year_month("date").alias("year_month"),
        day_name("date").alias("day_of_week"),
        *DAILY_METRICS.values(),
        (F.col("reaction_likes") + F.col("reaction_loves")).alias("total_reactions"),
    )


def mart_facebook_metrics(models: Models, as_of: date | None = None) -> DataFrame:
    return models["stg_facebook_insights"].select(
        "date",
        year_week("date").alias("year_week"),
        year_month("date").alias("year_month"),
        day_name("date").alias("day_of_week"),
        "metric_name",
        "metric_value",
        map_category("metric_name", METRIC_CATEGORIES, "other").alias("metric_category"),
        "ingested_at",
    )


def mart_facebook_posts(models: Models, as_of: date | None = None) -> DataFrame:
    return models["stg_facebook_posts"].select(
        "post_id",
        "post_date",
        year_month("post_date").alias("year_month"),
        day_name("post_date").alias("day_of_week"),
        year_label("post_date").alias("year"),
        "post_message",
        "content_type",
        map_category("content_type", ATTACHMENT_CATEGORIES, "other").alias("content_category"),
        classify_keywords("post_message", POST_RULES, "general").alias("post_category"),
        "ingested_at",
    )


def mart_posts_perfomance(models: Models, as_of: date | None = None) -> DataFrame:
    return models["stg_tiktok_posts"].select(
        "post_id",
        "post_date",
        "posted_at",
        "likes",
        "sound",
        "location",
        "title",
        "ingested_at",
        bucket_likes("likes").alias("like_bucket"),
    )


def mart_tiktok_followers(models: Models, as_of: date | None = None) -> DataFrame:
    """New and cumulative followers per day, no gaps."""
    daily = (
        models["stg_tiktok_followers"]
        .groupBy(F.col("followed_at").cast("date").alias("follow_date"))
        .agg(F.count("*").alias("new_followers"))
    )
    days = expand_days(daily, "follow_date", fill={"new_followers": 0})
    return running_sum(days, "new_followers", "follow_date", name="cumulative_followers")


def mart_tiktok_live_perfomance(models: Models, as_of: date | None = None) -> DataFrame:
    return models["stg_tiktok_live"].select(
        "room_id",
        "live_title",
        "live_date",
        "start_time",
        "end_time",
        "duration_mins",
        F.round(F.col("duration_mins") / F.lit(60), 2).alias("duration_hours"),
        day_name("live_date").alias("live_day_name"),
        "total_views",
        "total_gifters",
        "total_likes",
        "ingested_at",
        bucket_live_duration("duration_mins").alias("live_duration_bucket"),
        ratio_pct("total_likes", "total_views", 2, scale=1).alias("like_rate"),
    )


def mart_tiktok_activity_overlap(models: Models, as_of: date | None = None) -> DataFrame:
    """Posts and live sessions per day, with which of the two happened."""
    posts = (
        models["mart_posts_perfomance"]
        .groupBy(F.col("post_date").alias("activity_date"))
        .agg(
            F.count("*").alias("posts_on_day"),
            F.sum("likes").alias("total_post_likes"),
            F.avg("likes").alias("avg_post_likes"),
        )
    )
    lives = (
        models["mart_tiktok_live_perfomance"]
        .groupBy(F.col("live_date").alias("activity_date"))
        .agg(
            F.count("*").alias("live_sessions_on_day"),
            F.sum("total_views").alias("live_views_on_day"),
            F.sum("total_likes").alias("live_likes_on_day"),
        )
    )
    joined = join_full_outer(posts, lives, "activity_date", OVERLAP_LABELS, "activity_type")
    measures = [c for c in (*posts.columns, *lives.columns) if c != "activity_date"]
    return joined.select(
        "activity_date",
        day_name("activity_date").alias("day_of_week"),
        iso_day_num("activity_date").cast("string").alias("day_number"),
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in measures],
        "activity_type",
    )


def youtube_videos_enriched(models: Models) -> DataFrame:
    """Videos with their comment totals, which two marts read."""
    return join_left_enrich(
        models["stg_youtube_videos"],
        models["stg_youtube_comments"],
        "video_id",
        [
            F.count("*").alias("total_comments_ingested"),
            F.sum("like_count").alias("total_comment_likes"),
            F.max("published_at").alias("latest_comment_date"),
        ],
        zero_cols=["total_comments_ingested", "total_comment_likes"],
    )


def _engagement_rate() -> Column:
    return ratio_pct(F.col("like_count") + F.col("comment_count"), "view_count", 2)


def mart_youtube_perfomance(models: Models, as_of: date | None = None) -> DataFrame:
    """One row per video; age counts up to ``as_of``, or to today."""
    today = F.current_date() if as_of is None else F.lit(as_of)
    return models["youtube_videos_enriched"].select(
        "video_id",
        "video_title",
        "published_at",
        year_month("published_at").alias("year_month"),
        day_name("published_at").alias("day_of_week"),
        "view_count",
        "like_count",
        "comment_count",
        _engagement_rate().alias("engagement_rate_pct"),
        "total_comments_ingested",
        "total_comment_likes",
        "latest_comment_date",
        days_between(today, "published_at").alias("days_since_published"),
        "ingested_at",
    )


def mart_youtube_videos(models: Models, as_of: date | None = None) -> DataFrame:
    return models["youtube_videos_enriched"].select(
        "video_id",
        "video_title",
        "published_at",
        year_month("published_at").alias("year_month"),
        day_name("published_at").alias("day_of_week"),
        iso_day_num("published_at").cast("bigint").alias("day_of_week_num"),
        "view_count",
        "like_count",
        "comment_count",
        "favorite_count",
        _engagement_rate().alias("engagement_rate_pct"),
        content_type_label("live_broadcast_content").alias("content_type"),
        F.round(F.col("duration_seconds") / F.lit(60), 1).alias("duration_minutes"),
        bucket_video_duration("duration_seconds").alias("duration_bucket"),
        "total_comments_ingested",
        "total_comment_likes",
        "latest_comment_date",
        "live_broadcast_content",
        "tags_raw",
        "definition",
        "caption",
        "category_id",
        "default_language",
        "ingested_at",
    )


def mart_social_followers_snapshot(
    models: Models, as_of: date | None = None, youtube_history: bool = False
) -> DataFrame:
    """Followers, views and reach per platform and day, with change from the row before.

    Channel rows are one per channel after staging. With ``youtube_history`` the
    typed rows of every batch (``youtube_channel_rows``) are read in their place.
    """
    channel = models["youtube_channel_rows" if youtube_history else "stg_youtube_channel"]
    day = F.col("ingested_at").cast("date")
    order = ["ingested_at", "subscriber_count", "total_view_count", "channel_id"]
    youtube = qualify_row_number(
        channel, [day], [F.col(c).desc_nulls_last() for c in order]
    ).select(
        F.lit("YouTube").alias("platform"),
        day.alias("snapshot_date"),
        F.col("subscriber_count").alias("follower_count"),
        F.col("total_view_count").alias("total_views"),
        _big(None).alias("total_reach"),
    )
    tiktok = models["mart_tiktok_followers"].select(
        F.lit("TikTok").alias("platform"),
        F.col("follow_date").alias("snapshot_date"),
        F.col("cumulative_followers").alias("follower_count"),
        _big(None).alias("total_views"),
        _big(None).alias("total_reach"),
    )
    insights = models["stg_facebook_insights"]
    facebook = pivot_metrics(
        insights.where(F.col("metric_name").isin(list(SNAPSHOT_METRICS))),
        [F.col("date").alias("snapshot_date")],
        "metric_name",
        "metric_value",
        SNAPSHOT_METRICS,
    ).withColumn("platform", F.lit("Facebook"))

    # One row per platform and day: the window groups are as long as the calendar.
    rows = union_all(youtube, tiktok, facebook)
    grown = lag_change(
        rows, "follower_count", ["platform"], "snapshot_date", 1,
        "prev_period_followers", "pct_growth_mom",
    )
    return lag_change(
        grown, "total_views", ["platform"], "snapshot_date", 1,
        "prev_period_views", "pct_views_growth",
    )


def mart_social_overview(models: Models, as_of: date | None = None) -> DataFrame:
    """One row per platform. Two follower counts come from the raw rows of all batches."""
    zero = _big(0)
    page = models["facebook"].where(F.col("METRIC") == "page_follows")
    facebook = agg_global(page, total_followers=F.max(to_bigint("VALUE"))).select(
        F.lit("facebook").alias("platform"),
        "total_followers",
        zero.alias("total_posts"),
        zero.alias("total_likes"),
        zero.alias("total_views"),
        zero.alias("total_comments"),
        F.lit(0.0).alias("avg_engagement_rate"),
        zero.alias("total_live_sessions"),
    )

    lives = agg_global(
        models["mart_tiktok_live_perfomance"],
        total_likes=F.sum("total_likes"),
        total_views=F.sum("total_views"),
        avg_engagement_rate=F.round(exact_avg("like_rate", 2), 2),
        total_live_sessions=F.count_distinct("room_id"),
        sessions=F.count("*"),
    )
    followers = agg_global(
        models["mart_tiktok_followers"], total_followers=F.max("cumulative_followers")
    )
    # Without any live session there is no row for the followers to be attached to.
    tiktok = join_cross_scalar(lives, followers).select(
        F.lit("tiktok").alias("platform"),
        F.when(F.col("sessions") > 0, F.col("total_followers")).alias("total_followers"),
        zero.alias("total_posts"),
        "total_likes",
        "total_views",
        zero.alias("total_comments"),
        "avg_engagement_rate",
        "total_live_sessions",
    )

    videos = agg_global(
        models["mart_youtube_videos"],
        total_posts=F.count_distinct("video_id"),
        total_likes=F.sum("like_count"),
        total_views=F.sum("view_count"),
        total_comments=F.sum("comment_count"),
        avg_engagement_rate=F.round(exact_avg("engagement_rate_pct", 2), 2),
        total_live_sessions=F.count_if(F.col("live_broadcast_content") == "live"),
    )
    subscribers = agg_global(
        models["youtube_channel"], total_followers=F.max(to_bigint("subscriber_count"))
    )
    youtube = join_cross_scalar(videos, subscribers).withColumn("platform", F.lit("youtube"))
    return union_all(facebook, tiktok, youtube)


def mart_executive_summary(models: Models, as_of: date | None = None) -> DataFrame:
    """One row per platform; page views and likes are those of the best single day."""
    columns = [
        "platform",
        "total_followers",
        "total_posts",
        "total_views",
        "total_likes",
        "total_live_sessions",
        "avg_engagement_rate",
    ]
    channel = agg_global(
        models["stg_youtube_channel"],
        total_followers=F.max("subscriber_count"),
        total_posts=F.max("total_video_count"),
        total_views=F.max("total_view_count"),
    )
    videos = agg_global(
        models["mart_youtube_perfomance"],
        total_likes=F.sum("like_count"),
        avg_engagement_rate=F.round(exact_avg("engagement_rate_pct", 2), 2),
    )
    youtube = join_cross_scalar(videos, channel).select(
        "*", F.lit("youtube").alias("platform"), _big(None).alias("total_live_sessions")
    )

    best_days = agg_global(
        models["mart_facebook_insights"],
        total_followers=F.max("total_followers"),
        total_views=F.max("unique_impressions"),
        total_likes=F.max("total_reactions"),
    )
    posts = agg_global(models["mart_facebook_posts"], total_posts=F.count("*"))
    facebook = join_cross_scalar(best_days, posts).select(
        "*",
        F.lit("facebook").alias("platform"),
        _big(None).alias("total_live_sessions"),
        F.round(safe_ratio("total_likes", "total_views") * F.lit(100), 2).alias(
            "avg_engagement_rate"
        ),
    )

    lives = agg_global(
        models["mart_tiktok_live_perfomance"],
        total_views=F.sum("total_views"),
        total_likes=F.sum("total_likes"),
        total_live_sessions=F.count("*"),
        avg_engagement_rate=F.round(exact_avg("like_rate", 2), 2),
    )
    followers = agg_global(
        models["mart_tiktok_followers"], total_followers=F.max("cumulative_followers")
    )
    clips = agg_global(models["mart_posts_perfomance"], total_posts=F.count("*"))
    tiktok = join_cross_scalar(join_cross_scalar(lives, followers), clips).withColumn(
        "platform", F.lit("tiktok")
    )
    return union_all(*[df.select(*columns) for df in (youtube, facebook, tiktok)])


# In dependency order.
MART_MODELS = {
    f.__name__: f
    for f in (
        mart_facebook_insights,
        mart_facebook_metrics,
        mart_facebook_posts,
        mart_posts_perfomance,
        mart_tiktok_followers,
        mart_tiktok_live_perfomance,
        mart_tiktok_activity_overlap,
        mart_youtube_perfomance,
        mart_youtube_videos,
        mart_social_followers_snapshot,
        mart_social_overview,
        mart_executive_summary,
    )
}
