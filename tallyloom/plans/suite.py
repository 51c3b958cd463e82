"""The declared data tests of the marts: 84 tests on 11 tables.

Fixed values: which column has which test, the accepted values, and the four tests
that only warn.
"""

from __future__ import annotations

WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
PLATFORMS = ["facebook", "youtube", "tiktok", "instagram"]
AT_LEAST_ZERO = "expression: >= 0"

SUITE: dict[str, dict[str, object]] = {
    "mart_facebook_insights": {
        "not_null": [
            "date", "year_week", "year_month", "day_of_week", "total_followers",
            "unique_impressions",
        ],
        "unique": ["date"],
        "accepted": {"day_of_week": WEEKDAYS},
    },
    "mart_facebook_metrics": {
        "not_null": ["date", "day_of_week", "metric_name", "metric_value"],
        "accepted": {"day_of_week": WEEKDAYS},
        "warn": [("metric_value", "not_null")],
    },
    "mart_facebook_posts": {
        "not_null": ["post_id", "post_date", "year_month", "day_of_week", "year"],
        "unique": ["post_id"],
        "accepted": {"day_of_week": WEEKDAYS},
    },
    "mart_posts_perfomance": {
        "not_null": ["post_id", "post_date", "posted_at", "likes"],
        "unique": ["post_id"],
        "at_least_zero": ["likes"],
    },
    "mart_tiktok_activity_overlap": {
        "not_null": [
            "activity_date", "day_of_week", "day_number", "posts_on_day", "total_post_likes",
            "avg_post_likes",
        ],
        "unique": ["activity_date"],
        "accepted": {"day_of_week": WEEKDAYS},
        "at_least_zero": ["posts_on_day", "total_post_likes"],
    },
    "mart_tiktok_followers": {
        "not_null": ["follow_date", "new_followers", "cumulative_followers"],
        "unique": ["follow_date"],
        "at_least_zero": ["cumulative_followers"],
    },
    "mart_tiktok_live_perfomance": {
        "not_null": ["room_id", "live_date", "start_time", "end_time", "duration_mins"],
        "unique": ["room_id"],
        "at_least_zero": ["duration_mins"],
        "warn": [("duration_mins", AT_LEAST_ZERO)],
    },
    "mart_youtube_perfomance": {
        "not_null": [
            "video_id", "video_title", "published_at", "year_month", "day_of_week", "view_count",
        ],
        "unique": ["video_id"],
        "accepted": {"day_of_week": WEEKDAYS},
        "at_least_zero": ["view_count"],
    },
    "mart_youtube_videos": {
        "not_null": [
            "video_id", "video_title", "published_at", "year_month", "day_of_week",
            "day_of_week_num",
        ],
        "unique": ["video_id"],
        "accepted": {"day_of_week": WEEKDAYS},
    },
    "mart_social_overview": {
        "not_null": [
            "platform", "total_followers", "total_posts", "total_likes", "total_views",
            "total_comments",
        ],
        "unique": ["platform"],
        "accepted": {"platform": PLATFORMS},
        "at_least_zero": [
            "total_followers", "total_posts", "total_likes", "total_views", "total_comments",
        ],
    },
    "mart_social_followers_snapshot": {
        "not_null": ["platform", "snapshot_date", "follower_count", "total_views"],
        "at_least_zero": ["follower_count", "total_views"],
        "warn": [("total_views", "not_null"), ("total_views", AT_LEAST_ZERO)],
    },
}
