"""Live events: streams over landed files and reports over landed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.functions import gift_value
from tallyloom.operators import dedup_earliest
from tallyloom.session import scratch_path
from tallyloom.sources import (
    materialize_table,
    read_event_jsonl,
    sink_events,
    write_event_jsonl,
)
from tallyloom.sources.schemas import TIKTOK_LIVE_EVENTS, YOUTUBE_LIVE_EVENTS
from tallyloom.sources.sinks import FLUSH_ROWS
from tallyloom.streaming import (
    activity_sessions,
    closing_event,
    closing_sessions,
    first_deliveries,
    frequent_engagers,
    land_first_deliveries,
    land_recent,
    land_summaries,
    latest_upserts,
    normalize_live_events,
    read_first_deliveries,
    read_recent,
    read_summaries,
    recent_comments,
    session_kpis,
    stream_dedup,
    stream_events,
    top_engagers,
    upsert_batches,
    viewer_curve,
    viewer_windows,
    windowed_activity,
)
from tallyloom.workloads.data import raw_frame, table
from tallyloom.workloads.models import over_models

QUERIES: dict[str, tuple] = {}

TIKTOK, YOUTUBE = "raw_tiktok_live_events", "raw_youtube_live_events"

# The first delivery of each event.
_ONCE = f"""
    once as (select * from {TIKTOK}
             qualify row_number() over (partition by event_id order by ingested_at) = 1)"""


def query(name: str, sql: str | None):
    def register(run):
        QUERIES[name] = (run, sql)
        return run

    return register


def over_events(body: str) -> str:
    return over_models([TIKTOK], "").rstrip() + "," + _ONCE + body


def _once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_earliest(raw_frame(spark, sf_dir, TIKTOK), ["event_id"], "ingested_at")


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, written down: reports that read the events twice start from a table."""
    return materialize_table(_once(spark, sf_dir), scratch_path(spark, "landed"))


def _landed(spark: SparkSession, sf_dir: str, name: str = TIKTOK) -> str:
    """Write the live events as JSON-lines files."""
    path = scratch_path(spark, "live-events")
    write_event_jsonl(raw_frame(spark, sf_dir, name), path)
    return path


def _drained(stream: DataFrame, label: str) -> DataFrame:
    """Run a stream over all landed files into a Parquet table and read that."""
    spark = stream.sparkSession
    path = scratch_path(spark, label)
    sink_events(
        stream, path, scratch_path(spark, f"{label}-checkpoint"), interval=None, fmt="parquet"
    ).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def _upserted(updates: DataFrame, label: str, keys: list[str]) -> DataFrame:
    """Run an update-mode stream to the end and read the newest row per key."""
    spark = updates.sparkSession
    path = scratch_path(spark, label)
    upsert_batches(updates, path, scratch_path(spark, f"{label}-checkpoint")).awaitTermination()
    return latest_upserts(spark, path, updates.schema, keys)


# --- streams --------------------------------------------------------------------------


@query("stream_events", over_models([TIKTOK], f"select * from {TIKTOK}"))
def q_stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = stream_events(spark, _landed(spark, sf_dir), TIKTOK_LIVE_EVENTS)
    return _drained(stream, "stream-events")


_DELIVERED_ONCE = """
    select event_id, session_id, event_type, event_ts, username, user_id, comment_text,
           like_count, viewer_count, gift_name, diamond_count, room_id
    from once"""


@query("stream_dedup", over_events(_DELIVERED_ONCE))
def q_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event lands twice; which of the two deliveries stays is open."""
    stream = stream_events(spark, _landed(spark, sf_dir), TIKTOK_LIVE_EVENTS)
    return _drained(stream_dedup(stream), "stream-dedup").drop("ingested_at")


@query(
    "normalize_live_events",
    over_models(["stg_tiktok_livestream"], "select * from stg_tiktok_livestream"),
)
def q_normalize_live_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_live_events(raw_frame(spark, sf_dir, TIKTOK))


@query(
    "normalize_live_events_stream",
    over_models(["stg_tiktok_livestream"], "select * from stg_tiktok_livestream"),
)
def normalize_live_events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later deliveries land first; all columns of the earliest one come out."""
    path = scratch_path(spark, "live-events")
    every = raw_frame(spark, sf_dir, TIKTOK)
    second = F.row_number().over(Window.partitionBy("event_id").orderBy("ingested_at")) > 1
    ranked = every.withColumn("later", second)
    for later in (True, False):
        write_event_jsonl(ranked.where(F.col("later") == later).drop("later"), path)
    stream = stream_events(spark, path, TIKTOK_LIVE_EVENTS, max_files=4)
    return first_deliveries(_drained(normalize_live_events(stream), "normalized"))


@query("late_events_landed", over_events("\n    select * from once"))
def late_events_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third event arrives after all others, up to months late; none is lost."""
    path = scratch_path(spark, "late-events")
    every = raw_frame(spark, sf_dir, TIKTOK)
    late = F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0
    for chosen in (~late, late):
        write_event_jsonl(every.where(chosen), path)
    stream = stream_events(spark, path, TIKTOK_LIVE_EVENTS, max_files=2)
    return dedup_earliest(_drained(stream, "late-events"), ["event_id"], "ingested_at")


def _late(spark: SparkSession, sf_dir: str) -> str:
    """Every third delivery lands after all others, up to months late; later copies land first."""
    path = scratch_path(spark, "late-deliveries")
    every = raw_frame(spark, sf_dir, TIKTOK)
    late = F.pmod(F.xxhash64("event_id", "ingested_at"), F.lit(3)) == 0
    for chosen in (~late, late):
        write_event_jsonl(every.where(chosen), path)
    return path


def _first_of_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = stream_events(spark, _late(spark, sf_dir), TIKTOK_LIVE_EVENTS, max_files=2)
    path = scratch_path(spark, "first-deliveries")
    land_first_deliveries(stream, path, scratch_path(spark, "first-checkpoint")).awaitTermination()
    return read_first_deliveries(spark, path, stream.schema)


@query("stream_dedup_late", over_events("\n    select * from once"))
def stream_dedup_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first delivery of each event by a stream, none too late, the earliest whatever came first."""
    return _first_of_late(spark, sf_dir)


@query("sink_events", over_models([YOUTUBE], f"select * from {YOUTUBE}"))
def q_sink_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream to JSON lines with a final flush, then the batch load of those files."""
    stream = stream_events(spark, _landed(spark, sf_dir, YOUTUBE), YOUTUBE_LIVE_EVENTS)
    path = scratch_path(spark, "flushed")
    sink_events(
        stream, path, scratch_path(spark, "flushed-checkpoint"), interval=None
    ).awaitTermination()
    return read_event_jsonl(spark, path, YOUTUBE_LIVE_EVENTS)


@query("flush_microbatch", over_models([TIKTOK], f"select * from {TIKTOK}"))
def flush_microbatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events in several micro-batches, one landed file each."""
    stream = stream_events(spark, _landed(spark, sf_dir), TIKTOK_LIVE_EVENTS, max_files=1)
    return _drained(stream, "flush")


@query("flush_rows", over_models([TIKTOK], f"select *, true as bounded from {TIKTOK}"))
def flush_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flushes of at most FLUSH_ROWS rows; each row says whether its own flush kept to that."""
    stream = stream_events(spark, _landed(spark, sf_dir), TIKTOK_LIVE_EVENTS)
    path = scratch_path(spark, "flush-rows")
    sink_events(
        stream, path, scratch_path(spark, "flush-rows-checkpoint"), interval=None, fmt="parquet", max_rows=FLUSH_ROWS
    ).awaitTermination()
    landed = spark.read.schema(stream.schema).parquet(path).withColumn("flush", F.input_file_name())
    size = F.count("*").over(Window.partitionBy("flush"))
    return landed.withColumn("bounded", size <= FLUSH_ROWS).drop("flush")


@query(
    "gift_value",
    f"""
    select event_id, cast(ifnull(floor(value), 0) * ifnull(nullif(user_id % 4, 0), 1) as bigint)
               as diamonds
    from events where event_type = 'purchase'""",
)
def q_gift_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    gifts = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    price = F.floor("value")
    repeats = F.nullif(F.col("user_id") % 4, F.lit(0).cast("bigint"))
    return gifts.select("event_id", gift_value(price, repeats).alias("diamonds"))


# --- session figures --------------------------------------------------------------------


def _kpi_sql(source: str, last: str) -> str:
    return f"""
    select session_id, min(event_ts) as started_at, max(event_ts) as ended_at,
           strftime(min(event_ts), '%d %B %Y') as session_date,
           strftime(min(event_ts), '%H:%M UTC') as session_start,
           strftime(max(event_ts), '%H:%M UTC') as session_end,
           cast(date_sub('second', min(event_ts), max(event_ts)) // 60 as varchar) || 'm '
               || cast(date_sub('second', min(event_ts), max(event_ts)) % 60 as varchar) || 's'
               as duration,
           ifnull(max(viewer_count) filter (where event_type = 'viewer_count'), 0)
               as peak_viewers,
           cast(ifnull(trunc(avg(ifnull(viewer_count, 0))
                filter (where event_type = 'viewer_count')), 0) as bigint) as avg_viewers,
           count(*) filter (where event_type = 'like') as total_likes,
           count(*) filter (where event_type = 'comment') as total_comments,
           count(*) filter (where event_type = 'follow') as total_follows,
           count(*) filter (where event_type = 'share') as total_shares,
           count(*) filter (where event_type = 'gift') as total_gifts,
           count(*) filter (where event_type = 'chat_message') as total_messages,
           count(*) as total_published,
           greatest(count(*) filter (where event_type = 'connect') - 1, 0) as reconnections,
           {last}
    from {source} group by session_id"""


_DIAMONDS = """cast(ifnull(sum(diamond_count) filter (where event_type = 'gift'), 0) as bigint)
               as diamond_total"""


@query("session_kpis", over_events(_kpi_sql("once", _DIAMONDS)))
def q_session_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_kpis(_once(spark, sf_dir))


@query(
    "session_kpis_chat",
    over_models([YOUTUBE], _kpi_sql(YOUTUBE, "max(video_id) as video_id")),
)
def session_kpis_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_kpis(raw_frame(spark, sf_dir, YOUTUBE))


@query("session_kpis_stream", over_events(_kpi_sql("once", _DIAMONDS)))
def session_kpis_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First stream: drop repeats and land. Second stream: figures over what has landed."""
    events = stream_events(spark, _landed(spark, sf_dir), TIKTOK_LIVE_EVENTS)
    path = scratch_path(spark, "deduplicated")
    sink_events(
        stream_dedup(events), path, scratch_path(spark, "deduplicated-checkpoint"), interval=None
    ).awaitTermination()
    landed = stream_events(spark, path, TIKTOK_LIVE_EVENTS)
    return _upserted(session_kpis(landed), "session-kpis", ["session_id"])


@query("session_kpis_closed", over_events(_kpi_sql("once", _DIAMONDS)))
def session_kpis_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of a day each, put out once as they close; a last event without a session closes the rest."""
    path = scratch_path(spark, "session-events")
    once = _stored(spark, sf_dir)
    write_event_jsonl(once, path)
    write_event_jsonl(closing_event(once, "3 days"), path)
    closed = closing_sessions(stream_events(spark, path, TIKTOK_LIVE_EVENTS), gap="1 day")
    rows = _drained(closed, "closed-sessions")
    return rows.drop("closed_by", *[c for c in rows.columns if c.startswith("sum_")])


@query("session_kpis_late", over_events(_kpi_sql("once", _DIAMONDS)))
def session_kpis_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures over first deliveries that a stream has kept, late ones included."""
    return session_kpis(_first_of_late(spark, sf_dir))


# --- report frames ------------------------------------------------------------------------


@query(
    "viewer_curve",
    over_events(
        """,
    readings as (
        select *, row_number() over (partition by session_id order by event_ts, event_id) as r,
               count(*) over (partition by session_id) as n
        from once where event_type = 'viewer_count')
    select session_id, event_ts, strftime(event_ts, '%H:%M') as label,
           ifnull(viewer_count, 0) as viewers
    from readings where n <= 5 or r % 5 = 1"""
    ),
)
def q_viewer_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return viewer_curve(_stored(spark, sf_dir))


def _engagers_sql(event_type: str) -> str:
    return f""",
    counted as (
        select session_id, username, count(*) as events, min((event_ts, event_id)) as seen
        from once where event_type = '{event_type}' group by all)
    select session_id, username, events,
           cast(row_number() over (partition by session_id order by events desc, seen) as int)
               as rank
    from counted
    qualify row_number() over (partition by session_id order by events desc, seen) <= 5"""


@query("top_engagers", over_events(_engagers_sql("comment")))
def q_top_engagers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_engagers(_once(spark, sf_dir), "comment")


@query("top_engagers_stream", over_events(_engagers_sql("comment")))
def top_engagers_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries by session and hour of a stream with late and repeated deliveries, counted exactly."""
    landed = _first_of_late(spark, sf_dir)
    stream = stream_events(spark, _late(spark, sf_dir), TIKTOK_LIVE_EVENTS, max_files=2)
    path = scratch_path(spark, "engagers")
    land_summaries(stream, path, scratch_path(spark, "engagers-checkpoint")).awaitTermination()
    return frequent_engagers(read_summaries(spark, path), landed).drop("proven")


@query("top_likers", over_events(_engagers_sql("like")))
def top_likers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_engagers(_once(spark, sf_dir), "like")


@query(
    "top_chatters",
    over_models(
        [YOUTUBE],
        """
        select session_id, username, events, cast(rank as int) as rank from (
            select session_id, username, count(*) as events,
                   row_number() over (partition by session_id
                                      order by count(*) desc, min((event_ts, event_id))) as rank
            from raw_youtube_live_events where event_type = 'chat_message'
            group by session_id, username)
        where rank <= 5""",
    ),
)
def top_chatters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_engagers(raw_frame(spark, sf_dir, YOUTUBE), "chat_message")


_RECENT = """
    select session_id, event_id, event_ts, username, comment_text from once
    where event_type = 'comment'
    qualify row_number() over (partition by session_id order by event_ts desc, event_id desc) <= 8"""


@query("recent_comments", over_events(_RECENT))
def q_recent_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recent_comments(_once(spark, sf_dir))


@query("recent_comments_stream", over_events(_RECENT))
def recent_comments_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of a stream with late and repeated deliveries, merged batch by batch."""
    stream = stream_events(spark, _late(spark, sf_dir), TIKTOK_LIVE_EVENTS, max_files=2)
    path = scratch_path(spark, "recent")
    land_recent(stream, path, scratch_path(spark, "recent-checkpoint")).awaitTermination()
    return read_recent(spark, path, stream.schema)


# --- windows ------------------------------------------------------------------------------

_MINUTES = """
    select date_trunc('minute', event_ts) as window_start,
           date_trunc('minute', event_ts) + interval 1 minute as window_end,
           session_id, event_type, count(*) as events
    from once group by all"""


@query("windowed_activity", over_events(_MINUTES))
def q_windowed_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windowed_activity(_once(spark, sf_dir))


@query(
    "windowed_activity_stream",
    over_models([YOUTUBE], _MINUTES.replace("from once", f"from {YOUTUBE}")),
)
def windowed_activity_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update mode, so windows still open at the end of the input are there as well."""
    stream = stream_events(spark, _landed(spark, sf_dir, YOUTUBE), YOUTUBE_LIVE_EVENTS)
    keys = ["window_start", "session_id", "event_type"]
    return _upserted(windowed_activity(stream), "minutes", keys)


@query(
    "windowed_activity_merged",
    over_models([YOUTUBE], _MINUTES.replace("from once", f"from {YOUTUBE}")),
)
def windowed_activity_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per micro-batch; the folders of changed rows are merged as they come."""
    stream = stream_events(spark, _landed(spark, sf_dir, YOUTUBE), YOUTUBE_LIVE_EVENTS, max_files=1)
    # As late as files come: every file holds events of all days.
    updates = windowed_activity(stream, delay="1000 days")
    keys = ["window_start", "session_id", "event_type"]
    path = scratch_path(spark, "merged-minutes")
    upsert_batches(updates, path, scratch_path(spark, "merged-checkpoint"), keys=keys).awaitTermination()
    return latest_upserts(spark, path, updates.schema, keys)


@query(
    "viewer_windows",
    over_events(
        """,
    steps as (
        select date_trunc('minute', event_ts) as step, session_id, viewer_count from once
        where event_type = 'viewer_count'),
    spread as (
        select *, unnest([0, 1, 2, 3, 4]) as back from steps)
    select step - back * interval 1 minute as window_start,
           step - back * interval 1 minute + interval 5 minute as window_end, session_id,
           max(viewer_count) as peak_viewers,
           cast(sum(viewer_count) // count(viewer_count) as bigint) as avg_viewers,
           count(viewer_count) as readings
    from spread group by all"""
    ),
)
def q_viewer_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return viewer_windows(_once(spark, sf_dir))


def _session_sql() -> str:
    return """
    with marked as (
        select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts)
                   < interval 30 minute then 0 else 1 end as fresh
        from events),
    numbered as (
        select *, sum(fresh) over (partition by user_id order by ts) as session from marked)
    select min(ts) as session_start, max(ts) + interval 30 minute as session_end,
           user_id, count(*) as events
    from numbered group by user_id, session"""


def _by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.col("ts").cast("timestamp").alias("event_ts")
    )


@query("activity_sessions", _session_sql())
def q_activity_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity_sessions(_by_time(spark, sf_dir))


@query("activity_sessions_stream", _session_sql())
def activity_sessions_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append mode; a last row without a user closes the sessions that are open at the end."""
    path = scratch_path(spark, "user-events")
    events = _by_time(spark, sf_dir)
    write_event_jsonl(events, path)
    write_event_jsonl(closing_event(events), path)
    schema = "event_id bigint, user_id bigint, event_ts timestamp"
    return _drained(activity_sessions(stream_events(spark, path, schema)), "sessions")
