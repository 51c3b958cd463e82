"""Live events: streaming dedup, windows and KPIs, and the end-of-session report."""

from tallyloom.streaming.frequent import (
    frequent_engagers,
    land_recent,
    land_summaries,
    merge_recent,
    merge_summaries,
    read_recent,
    read_summaries,
    summarize_engagers,
)
from tallyloom.streaming.live import (
    activity_sessions,
    closing_event,
    first_deliveries,
    land_first_deliveries,
    latest_upserts,
    normalize_live_events,
    read_first_deliveries,
    session_kpis,
    stream_dedup,
    stream_events,
    upsert_batches,
    viewer_windows,
    windowed_activity,
)
from tallyloom.streaming.reports import (
    recent_comments,
    session_report,
    top_engagers,
    viewer_curve,
)
from tallyloom.streaming.sessions import closing_sessions, merge_sessions

__all__ = [
    "activity_sessions",
    "closing_event",
    "closing_sessions",
    "first_deliveries",
    "frequent_engagers",
    "land_first_deliveries",
    "land_recent",
    "land_summaries",
    "latest_upserts",
    "merge_recent",
    "merge_sessions",
    "merge_summaries",
    "normalize_live_events",
    "read_first_deliveries",
    "read_recent",
    "read_summaries",
    "recent_comments",
    "session_kpis",
    "session_report",
    "stream_dedup",
    "stream_events",
    "summarize_engagers",
    "top_engagers",
    "upsert_batches",
    "viewer_curve",
    "viewer_windows",
    "windowed_activity",
]
