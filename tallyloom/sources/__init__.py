"""Readers for landed files and raw tables, and the sinks."""

from tallyloom.sources.csvs import read_metric_csvs
from tallyloom.sources.exports import (
    parse_followers,
    parse_live_comments,
    parse_live_history,
    parse_posts,
    parse_watch_history,
    read_blocks_delim,
    read_blocks_lookahead,
)
from tallyloom.sources.payloads import (
    flatten_channel,
    flatten_comments,
    flatten_feed,
    flatten_insights,
    flatten_playlist,
    flatten_videos,
    read_payloads,
)
from tallyloom.sources.sinks import (
    append_raw,
    materialize_table,
    materialize_view,
    serialize_events,
    sink_events,
    write_event_jsonl,
)
from tallyloom.sources.tables import (
    attach_ingested_at,
    attach_row_key,
    read_event_jsonl,
    read_sources,
)

__all__ = [
    "append_raw",
    "attach_ingested_at",
    "attach_row_key",
    "flatten_channel",
    "flatten_comments",
    "flatten_feed",
    "flatten_insights",
    "flatten_playlist",
    "flatten_videos",
    "materialize_table",
    "materialize_view",
    "parse_followers",
    "parse_live_comments",
    "parse_live_history",
    "parse_posts",
    "parse_watch_history",
    "read_blocks_delim",
    "read_blocks_lookahead",
    "read_event_jsonl",
    "read_metric_csvs",
    "read_payloads",
    "read_sources",
    "serialize_events",
    "sink_events",
    "write_event_jsonl",
]
