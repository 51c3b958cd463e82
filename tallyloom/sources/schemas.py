"""Declared schemas of raw tables, live events and payload files. Nothing is inferred."""

from __future__ import annotations

# Raw tables: append-only, with repeated batches. A row key is a hash of the row's values,
# made once when it lands, so that choosing between rows of one time reads no texts.
RAW_TABLES: dict[str, str] = {
    "facebook": "METRIC string, DATE string, VALUE string, ingested_at timestamp",
    "facebook_csv_insights": "date date, value bigint, metric_name string, ingested_at timestamp",
    "facebook_posts": (
        "post_id string, message string, created_time string, content_type string, "
        "ingested_at timestamp, row_key string"
    ),
    "tiktok_followers": "followed_at_raw string, username string, ingested_at timestamp",
    "tiktok_live_history": (
        "room_id string, live_title_raw string, duration_raw string, total_view_raw string, "
        "total_gifter_raw string, total_likes_raw string, ingested_at timestamp"
    ),
    "tiktok_live_comments": (
        "room_id string, comment_time_raw string, comment_text string, ingested_at timestamp"
    ),
    "tiktok_posts": (
        "date_raw string, likes_raw string, visibility_raw string, sound_raw string, "
        "location_raw string, title_raw string, ingested_at timestamp, row_key string"
    ),
    "tiktok_watch_live_history": (
        "watched_at_raw string, link_raw string, raw_comments_blob string, ingested_at timestamp, row_key string"
    ),
    "youtube_channel": (
        "channel_id string, channel_title string, subscriber_count string, view_count string, "
        "video_count string, ingested_at timestamp"
    ),
    "youtube_comments": (
        "video_id string, author string, comment string, like_count bigint, published_at string, "
        "ingested_at timestamp, row_key string"
    ),
    "youtube_videos": (
        "video_id string, title string, published_at string, view_count string, "
        "like_count string, comment_count string, favorite_count string, duration_raw string, "
        "duration_seconds bigint, caption string, definition string, "
        "live_broadcast_content string, category_id string, default_language string, "
        "tags_raw string, ingested_at timestamp, row_key string"
    ),
}

KEYED_TABLES = [name for name, schema in RAW_TABLES.items() if schema.endswith("row_key string")]

# Live events. The first five columns are required; a not_null test checks that,
# because file reads make every column nullable.
EVENT_REQUIRED = ["event_id", "session_id", "event_type", "event_ts", "ingested_at"]

TIKTOK_LIVE_EVENTS = (
    "event_id string, session_id string, event_type string, event_ts timestamp, "
    "ingested_at timestamp, username string, user_id string, comment_text string, "
    "like_count bigint, viewer_count bigint, gift_name string, diamond_count bigint, "
    "room_id string"
)
YOUTUBE_LIVE_EVENTS = (
    "event_id string, session_id string, event_type string, event_ts timestamp, "
    "ingested_at timestamp, username string, user_id string, comment_text string, "
    "viewer_count bigint, like_count bigint, video_id string, live_chat_id string"
)
EVENT_TABLES = {
    "raw_tiktok_live_events": TIKTOK_LIVE_EVENTS,
    "raw_youtube_live_events": YOUTUBE_LIVE_EVENTS,
}

# The full inventory of video ids; no model reads it.
INVENTORY_TABLES = {"youtube_playlist": "video_id string, ingested_at timestamp"}

# Payload files.
INSIGHTS_PAYLOAD = (
    "data array<struct<name: string, values: array<struct<end_time: string, value: string>>>>"
)
FEED_PAYLOAD = (
    "data array<struct<id: string, message: string, story: string, created_time: string, "
    "attachments: struct<data: array<struct<type: string, media_type: string>>>>>, "
    "paging struct<next: string>"
)
CHANNEL_PAYLOAD = (
    "items array<struct<id: string, snippet: struct<title: string>, "
    "statistics: struct<subscriberCount: string, viewCount: string, videoCount: string>, "
    "contentDetails: struct<relatedPlaylists: struct<uploads: string>>>>"
)
PLAYLIST_PAYLOAD = "items array<struct<contentDetails: struct<videoId: string>>>"
VIDEOS_PAYLOAD = (
    "items array<struct<id: string, "
    "snippet: struct<title: string, publishedAt: string, liveBroadcastContent: string, "
    "categoryId: string, defaultLanguage: string, tags: array<string>>, "
    "statistics: struct<viewCount: string, likeCount: string, commentCount: string, "
    "favoriteCount: string>, "
    "contentDetails: struct<duration: string, caption: string, definition: string>>>"
)
COMMENTS_PAYLOAD = (
    "items array<struct<snippet: struct<videoId: string, topLevelComment: struct<"
    "snippet: struct<videoId: string, authorDisplayName: string, textDisplay: string, "
    "likeCount: bigint, publishedAt: string>>>>>"
)
