"""One ingest batch: landed files of all platforms to raw tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.plans.refresh import THREADS
from tallyloom.sources import (
    append_raw,
    attach_ingested_at,
    attach_row_key,
    flatten_channel,
    flatten_comments,
    flatten_feed,
    flatten_insights,
    flatten_playlist,
    flatten_videos,
    parse_followers,
    parse_live_comments,
    parse_live_history,
    parse_posts,
    parse_watch_history,
    read_blocks_delim,
    read_blocks_lookahead,
    read_metric_csvs,
    read_payloads,
)
from tallyloom.sources import schemas as S
from tallyloom.sources.exports import (
    FOLLOWERS_HEADER,
    LIVE_COMMENTS_DELIMITER,
    LIVE_HISTORY_DELIMITER,
    POSTS_HEADER,
    REQUIRED_EXPORTS,
    WATCH_HISTORY_HEADER,
)

_HISTORY, _COMMENTS, _POSTS, _WATCHED, _FOLLOWERS = REQUIRED_EXPORTS

Reader = Callable[[SparkSession, str, Column, str | None], DataFrame]

# Raw table -> (path below the landing folder, reader).
BATCH: dict[str, tuple[str, Reader]] = {
    "tiktok_live_history": (
        f"tiktok/{_HISTORY}",
        lambda s, p, at, nl: parse_live_history(read_blocks_delim(s, p, LIVE_HISTORY_DELIMITER), at),
    ),
    "tiktok_live_comments": (
        f"tiktok/{_COMMENTS}",
        lambda s, p, at, nl: parse_live_comments(read_blocks_delim(s, p, LIVE_COMMENTS_DELIMITER), at),
    ),
    "tiktok_posts": (
        f"tiktok/{_POSTS}",
        lambda s, p, at, nl: parse_posts(read_blocks_lookahead(s, p, POSTS_HEADER, newline=nl), at),
    ),
    "tiktok_watch_live_history": (
        f"tiktok/{_WATCHED}",
        lambda s, p, at, nl: parse_watch_history(
            read_blocks_lookahead(s, p, WATCH_HISTORY_HEADER, blank_lines=0, newline=nl), at
        ),
    ),
    "tiktok_followers": (
        f"tiktok/{_FOLLOWERS}",
        lambda s, p, at, nl: parse_followers(read_blocks_lookahead(s, p, FOLLOWERS_HEADER, newline=nl), at),
    ),
    "facebook_csv_insights": (
        "facebook/csv",
        lambda s, p, at, nl: read_metric_csvs(s, p, ingested_at=at),
    ),
    "facebook": (
        "facebook/insights",
        lambda s, p, at, nl: flatten_insights(read_payloads(s, p, S.INSIGHTS_PAYLOAD), at),
    ),
    "facebook_posts": (
        "facebook/feed",
        lambda s, p, at, nl: flatten_feed(read_payloads(s, p, S.FEED_PAYLOAD), at),
    ),
    "youtube_channel": (
        "youtube/channel",
        lambda s, p, at, nl: flatten_channel(read_payloads(s, p, S.CHANNEL_PAYLOAD), at),
    ),
    "youtube_videos": (
        "youtube/videos",
        lambda s, p, at, nl: flatten_videos(read_payloads(s, p, S.VIDEOS_PAYLOAD), at),
    ),
    "youtube_playlist": (
        "youtube/playlist",
        lambda s, p, at, nl: attach_ingested_at(
            flatten_playlist(read_payloads(s, p, S.PLAYLIST_PAYLOAD)), at
        ),
    ),
    "youtube_comments": (
        "youtube/comments",
        lambda s, p, at, nl: flatten_comments(read_payloads(s, p, S.COMMENTS_PAYLOAD), at),
    ),
}


def land_batch(
    spark: SparkSession,
    landing: str,
    raw_root: str,
    at: datetime | None = None,
    newline: str | None = None,
) -> dict[str, str]:
    """Append every source that has landed to its raw table.

    All rows of the batch carry one ingest time. A source whose files are missing is
    skipped, and so is one without rows; the outcome per table is returned. Large
    text exports are split by the line end that each file has, or by ``newline``; any line end
    is read.
    """
    stamp = F.lit(at or datetime.now(timezone.utc))

    def land(table: str) -> str:
        path, read = BATCH[table]
        try:
            rows = read(spark, f"{landing.rstrip('/')}/{path}", stamp, newline)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return "missing"
        if table in S.KEYED_TABLES:
            rows = attach_row_key(rows)
        return "appended" if append_raw(rows, f"{raw_root.rstrip('/')}/{table}") else "empty"

    with ThreadPoolExecutor(THREADS) as pool:
        return dict(zip(BATCH, pool.map(land, BATCH)))


def videos_not_landed(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Ids of the playlist inventory for which no video row has landed."""
    known = raw["youtube_videos"].select("video_id").distinct()
    return raw["youtube_playlist"].select("video_id").distinct().join(known, "video_id", "left_anti")
