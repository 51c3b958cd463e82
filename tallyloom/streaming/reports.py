"""End-of-session report frames, computed over the landed event table.

Ranking needs all events of a session, which an unbounded stream never has, so
these are batch jobs, run when a session has ended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators import last_n, sample_every_nth, top_k_by_count
from tallyloom.streaming.live import session_kpis

ORDER = ["event_ts", "event_id"]


def top_engagers(df: DataFrame, event_type: str = "comment", k: int = 5) -> DataFrame:
    """The k users with most events of a type per session; a NULL name is one user."""
    chosen = df.where(F.col("event_type") == event_type)
    return top_k_by_count(chosen, ["session_id"], "username", ORDER, k)


def recent_comments(df: DataFrame, n: int = 8, event_type: str = "comment") -> DataFrame:
    """The last n comments of each session."""
    chosen = df.where(F.col("event_type") == event_type).select(
        "session_id", "event_id", "event_ts", "username", "comment_text"
    )
    return last_n(chosen, ["session_id"], ORDER, n)


def viewer_curve(
    df: DataFrame, step: int = 5, min_rows: int = 5, split_unit: str = "minute"
) -> DataFrame:
    """Every ``step``-th viewer reading of a session as (HH:mm, viewers).

    A session is numbered minute by minute (``split_unit``), so a long or busy one is
    spread over many tasks.
    """
    readings = df.where(F.col("event_type") == "viewer_count").select(
        "session_id", "event_id", "event_ts", "viewer_count"
    )
    sampled = sample_every_nth(
        readings, ["session_id"], ORDER, step, min_rows, F.date_trunc(split_unit, "event_ts")
    )
    return sampled.select(
        "session_id",
        "event_ts",
        F.date_format("event_ts", "HH:mm").alias("label"),
        F.coalesce("viewer_count", F.lit(0)).alias("viewers"),
    )


def session_report(df: DataFrame, chat: bool = False) -> dict[str, DataFrame]:
    """All frames of the end-of-session report, for every session in ``df``.

    With ``chat`` the messages are those of a chat stream, which has no likes.
    """
    messages = "chat_message" if chat else "comment"
    report = {
        "figures": session_kpis(df),
        "top_commenters": top_engagers(df, messages),
        "recent_comments": recent_comments(df, event_type=messages),
        "viewer_curve": viewer_curve(df),
    }
    if not chat:
        report["top_likers"] = top_engagers(df, "like")
    return report
