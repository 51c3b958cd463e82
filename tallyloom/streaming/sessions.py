"""Live sessions that close: keyed state with event-time timers.

The events of a micro-batch are first reduced to one row per session and task, so a session that
holds a third of all events sends a few rows to its state. The state is that row's figures. A
session comes out once, when event time has passed its end event by ``delay``, or its last event by
``gap`` and ``delay``; then its state is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallyloom.streaming.live import WATERMARK, session_report_columns

# Fixed value: the event that says that a live session is over.
END_EVENT = "live_end"
#: Event types that are counted, by the name of their figure.
COUNTED = {
    "total_likes": "like",
    "total_comments": "comment",
    "total_follows": "follow",
    "total_shares": "share",
    "total_gifts": "gift",
    "total_messages": "chat_message",
    "__connects": "connect",
}
# Figure -> how two of them make one. Times are microseconds.
MERGES = {
    "started_at": "min",
    "ended_at": "max",
    "closed_at": "max",
    "peak_viewers": "max",
    "__viewers": "sum",
    "__readings": "sum",
    **dict.fromkeys(COUNTED, "sum"),
    "total_published": "sum",
    "diamond_total": "sum",
}
_PARTS = ", ".join(["session_id string", *[f"{c} long" for c in MERGES], "video_id string"])
#: Groups that a task holds before it adds them up.
HELD_BATCHES = 64


def _measures(events: DataFrame, end_event: str) -> DataFrame:
    kind = F.col("event_type")
    at = F.unix_micros("event_ts")
    number = lambda c: F.coalesce(F.col(c), F.lit(0)) if c in events.columns else F.lit(0)
    reading = kind == "viewer_count"
    columns = {
        "started_at": at,
        "ended_at": at,
        "closed_at": F.when(kind == end_event, at),
        "peak_viewers": F.when(reading, number("viewer_count")),
        "__viewers": F.when(reading, number("viewer_count")).otherwise(0),
        "__readings": reading.cast("long"),
        **{name: F.coalesce((kind == value).cast("long"), F.lit(0)) for name, value in COUNTED.items()},
        "total_published": F.lit(1),
        "diamond_total": F.when(kind == "gift", number("diamond_count")).otherwise(0),
    }
    video = F.col("video_id") if "video_id" in events.columns else F.lit(None)
    return events.where("event_ts is not null").select(
        "session_id",
        *[c.cast("long").alias(name) for name, c in columns.items()],
        video.cast("string").alias("video_id"),
    )


def _added(table: pa.Table) -> pa.Table:
    """One row per session."""
    summed = table.group_by("session_id").aggregate([*MERGES.items(), ("video_id", "max")])
    names = [f"{c}_{how}" for c, how in MERGES.items()]
    return pa.table(
        [summed["session_id"], *[summed[n] for n in names], summed["video_id_max"]],
        names=["session_id", *MERGES, "video_id"],
    )


def _per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    for batch in batches:
        held.append(_added(pa.Table.from_batches([batch])))
        if len(held) == HELD_BATCHES:
            held = [_added(pa.concat_tables(held))]
    if held:
        yield from _added(pa.concat_tables(held)).to_batches()


def closing_sessions(
    events: DataFrame,
    gap: str = "30 minutes",
    delay: str = WATERMARK,
    late: str = "1 day",
    end_event: str = END_EVENT,
) -> DataFrame:
    """Figures of sessions as they close, in append mode: the columns of ``session_kpis`` and closed_by.

    ``closed_by`` is 'end' if the end event was the last one, else 'gap'. Events up to ``late`` behind
    the newest one are counted as long as their session is open; Spark drops later ones, so what
    must not miss any is calculated over the landed events. An event that comes after its session has
    closed opens it again, and what it counts comes out as a row of its own: ``merge_sessions`` adds
    such rows up. Events without a session make none, but move event time on; rows without a time
    count for nothing. A source that has ended closes its last sessions by ``closing_event``.
    """
    gap_ms, delay_ms, late_ms = (int(pd.Timedelta(x).total_seconds() * 1000) for x in (gap, delay, late))
    names = list(MERGES)

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            held = dict(zip([*names, "video_id"], state.get, strict=True))
            state.remove()
            ended = held["closed_at"] is not None and held["closed_at"] >= held["ended_at"]
            yield pd.DataFrame([{"session_id": key[0], **held, "closed_by": "end" if ended else "gap"}])
            return
        rows = [list(state.get)] if state.exists else []
        for frame in frames:
            for row in frame[[*names, "video_id"]].itertuples(index=False):
                rows.append([None if pd.isna(x) else x for x in row])
        if key[0] is None:
            return
        merged = []
        for i, name in enumerate([*names, "video_id"]):
            values = [r[i] for r in rows if r[i] is not None]
            how = {"min": min, "max": max, "sum": sum}[MERGES.get(name, "max")]
            value = how(values) if values else None
            merged.append(value if value is None or name == "video_id" else int(value))
        held = dict(zip(names, merged, strict=False))
        last = held["ended_at"] // 1000
        ended = held["closed_at"] is not None and held["closed_at"] >= held["ended_at"]
        state.update(tuple(merged))
        # The newest event lies ``late`` above the watermark, so that timers run on its time.
        timer = last + delay_ms + (0 if ended else gap_ms) - late_ms
        state.setTimeoutTimestamp(max(timer, state.getCurrentWatermarkMs() + 1, 1))

    parts = _measures(events, end_event).mapInArrow(_per_task, _PARTS)
    timed = parts.withColumn("clock", F.timestamp_micros("ended_at")).withWatermark("clock", late)
    state = ", ".join([*[f"{c} long" for c in names], "video_id string"])
    closed = timed.groupBy("session_id").applyInPandasWithState(
        step, f"{_PARTS}, closed_by string", state, "append", GroupStateTimeout.EventTimeTimeout
    )
    return _reported(closed, events)


def _reported(figures: DataFrame, events: DataFrame) -> DataFrame:
    """Times as timestamps, and the columns of ``session_kpis`` with those it is made from behind."""
    times = {c: F.timestamp_micros(c) for c in ("started_at", "ended_at")}
    kept = ["__viewers", "__readings", "__connects", "closed_by"]
    extra = [c for c, needs in (("diamond_total", "diamond_count"), ("video_id", "video_id")) if needs in events.columns]
    full = figures.withColumns({**times, "peak_viewers": F.coalesce("peak_viewers", F.lit(0))})
    return full.select(*session_report_columns(extra), *[F.col(c).alias(c.replace("__", "sum_")) for c in kept])


def merge_sessions(closed: DataFrame) -> DataFrame:
    """One row per session of what ``closing_sessions`` has put out, in the columns of ``session_kpis``."""
    extra = [c for c in ("diamond_total", "video_id") if c in closed.columns]
    total = [c for c in closed.columns if c.startswith("total_") or c == "diamond_total"]
    merged = closed.groupBy("session_id").agg(
        F.min("started_at").alias("started_at"),
        F.max("ended_at").alias("ended_at"),
        F.max("peak_viewers").alias("peak_viewers"),
        *[F.sum(c).alias(c) for c in total],
        *[F.sum(f"sum_{c}").alias(f"__{c}") for c in ("viewers", "readings", "connects")],
        *[F.max(c).alias(c) for c in extra if c == "video_id"],
    )
    return merged.select(*session_report_columns(extra))
