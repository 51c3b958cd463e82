"""Live events as streams; every function also takes a batch frame of landed events."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from tallyloom.operators import dedup_earliest, dedup_latest
from tallyloom.plans.staging import map_live_columns, type_live_columns
from tallyloom.sources.versions import (
    commit,
    current_version,
    drop_unused,
    read_version,
    write_folder,
)

WATERMARK = "10 minutes"


def stream_events(
    spark: SparkSession, path: str, schema: str, max_files: int | None = None
) -> DataFrame:
    """Landed JSON-lines files as a stream; ``max_files`` bounds one micro-batch.

    Files must appear whole (written elsewhere and moved in). A line that is no JSON
    stops the stream.
    """
    reader = spark.readStream.schema(schema).option("mode", "FAILFAST")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def stream_dedup(
    df: DataFrame,
    id_col: str = "event_id",
    ts_col: str = "event_ts",
    delay: str = WATERMARK,
    hot_splits: int = 8,
) -> DataFrame:
    """Drop repeated deliveries of an event that arrive within ``delay``.

    For figures that must follow events closely. First deliveries later than ``delay`` are
    lost, so events are landed without this step, and landed rows are deduplicated in batch.

    An id delivered very often would send all copies to one task. With ``hot_splits``
    copies are first dropped per (id, input partition bucket), so at most that many
    reach the final step.
    """
    out = df.withWatermark(ts_col, delay)
    if hot_splits > 1:
        out = (
            out.withColumn("__part", F.spark_partition_id() % hot_splits)
            .dropDuplicatesWithinWatermark([id_col, "__part"])
            .drop("__part")
        )
    return out.dropDuplicatesWithinWatermark([id_col])


def normalize_live_events(df: DataFrame) -> DataFrame:
    """Typed events; in a batch one row per event id, the first delivery.

    A stream cannot know the first delivery before the last one is in, so it keeps all of
    them and no state. ``first_deliveries`` over what it has landed gives the batch's rows,
    whatever the order of arrival.
    """
    typed = type_live_columns(map_live_columns(df))
    return typed if df.isStreaming else first_deliveries(typed)


def first_deliveries(rows: DataFrame) -> DataFrame:
    """One row per event id of normalised events: the earliest ingested, then the smallest."""
    ties = ["stream_session_id", "event_type", "username", "content", "value"]
    return dedup_earliest(rows, ["event_id"], "ingested_at", ties)


def session_kpis(df: DataFrame) -> DataFrame:
    """One row of figures per live session.

    Counts are events, whatever number they carry. Reconnections are the connects
    after the first one. On a stream this runs in update mode.
    """
    kind = F.col("event_type")

    def events(name: str) -> Column:
        return F.count_if(kind == name)

    def readings(col: str, name: str) -> Column:
        return F.when(kind == name, F.coalesce(F.col(col), F.lit(0)))

    aggs = [
        F.min("event_ts").alias("started_at"),
        F.max("event_ts").alias("ended_at"),
        F.coalesce(F.max(readings("viewer_count", "viewer_count")), F.lit(0)).alias(
            "peak_viewers"
        ),
        F.coalesce(F.sum(readings("viewer_count", "viewer_count")), F.lit(0)).alias("__viewers"),
        events("viewer_count").alias("__readings"),
        events("like").alias("total_likes"),
        events("comment").alias("total_comments"),
        events("follow").alias("total_follows"),
        events("share").alias("total_shares"),
        events("gift").alias("total_gifts"),
        events("chat_message").alias("total_messages"),
        events("connect").alias("__connects"),
        F.count("*").alias("total_published"),
    ]
    if "diamond_count" in df.columns:
        diamonds = F.sum(readings("diamond_count", "gift"))
        aggs.append(F.coalesce(diamonds, F.lit(0)).alias("diamond_total"))
    if "video_id" in df.columns:
        aggs.append(F.max("video_id").alias("video_id"))
    summed = df.groupBy("session_id").agg(*aggs)

    extra = [c for c in ("diamond_total", "video_id") if c in summed.columns]
    return summed.select(*session_report_columns(extra))


def session_report_columns(extra: Sequence[str] = ()) -> list[Column | str]:
    """The report's columns from a session's sums; those it derives from more are named __viewers,
    __readings and __connects.
    """
    seconds = F.expr("(unix_micros(ended_at) - unix_micros(started_at)) div 1000000")
    return [
        "session_id",
        "started_at",
        "ended_at",
        F.date_format("started_at", "dd MMMM yyyy").alias("session_date"),
        F.date_format("started_at", "HH:mm 'UTC'").alias("session_start"),
        F.date_format("ended_at", "HH:mm 'UTC'").alias("session_end"),
        F.format_string("%dm %ds", F.floor(seconds / 60), seconds % 60).alias("duration"),
        "peak_viewers",
        F.coalesce(F.expr("__viewers div nullif(__readings, 0)"), F.lit(0)).alias("avg_viewers"),
        "total_likes",
        "total_comments",
        "total_follows",
        "total_shares",
        "total_gifts",
        "total_messages",
        "total_published",
        F.greatest(F.col("__connects") - 1, F.lit(0)).alias("reconnections"),
        *extra,
    ]


def windowed_activity(
    df: DataFrame,
    size: str = "1 minute",
    slide: str | None = None,
    delay: str = WATERMARK,
) -> DataFrame:
    """Events per session, type and time window."""
    window = F.window("event_ts", size, slide or size)
    counted = (
        df.withWatermark("event_ts", delay)
        .groupBy(window.alias("w"), "session_id", "event_type")
        .agg(F.count("*").alias("events"))
    )
    return counted.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "session_id",
        "event_type",
        "events",
    )


def viewer_windows(
    df: DataFrame,
    size: str = "5 minutes",
    slide: str = "1 minute",
    delay: str = WATERMARK,
) -> DataFrame:
    """Peak and mean viewers per session in sliding windows.

    Readings are reduced to one row per slide step first; only those are copied
    into the overlapping windows.
    """
    steps = (
        df.where(F.col("event_type") == "viewer_count")
        .withWatermark("event_ts", delay)
        .groupBy(F.window("event_ts", slide).alias("step"), "session_id")
        .agg(
            F.max("viewer_count").alias("peak"),
            F.sum("viewer_count").alias("total"),
            F.count("viewer_count").alias("readings"),
        )
    )
    summed = steps.groupBy(
        F.window(F.window_time("step"), size, slide).alias("w"), "session_id"
    ).agg(
        F.max("peak").alias("peak_viewers"),
        F.sum("total").alias("total"),
        F.sum("readings").alias("readings"),
    )
    return summed.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "session_id",
        "peak_viewers",
        F.expr("total div nullif(readings, 0)").alias("avg_viewers"),
        "readings",
    )


def activity_sessions(
    df: DataFrame, key: str = "user_id", gap: str = "30 minutes", delay: str = WATERMARK
) -> DataFrame:
    """Sessions by a gap in time, for events that carry no session id.

    On a stream this runs in append mode: a session comes out once it is closed. A row
    without a key makes no session but moves event time on, so a source that has ended
    closes its last sessions by one row that lies more than ``gap`` and ``delay`` later
    (``closing_event``).
    """
    counted = (
        df.withWatermark("event_ts", delay)
        .groupBy(F.session_window("event_ts", gap).alias("w"), key)
        .agg(F.count("*").alias("events"))
    )
    sessions = counted.select(
        F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), key, "events"
    )
    # The count keeps the condition above the watermark, which has to see rows without a key.
    return sessions.where(F.col(key).isNotNull() | (F.col("events") < 0))


def closing_event(df: DataFrame, after: str = "1 day") -> DataFrame:
    """One row like those of ``df`` (a batch) with a later ``event_ts`` and nothing else."""
    last = df.agg((F.max("event_ts") + F.expr(f"interval {after}")).alias("event_ts"))
    rest = [
        F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields if f.name != "event_ts"
    ]
    return last.where("event_ts is not null").select(*rest, "event_ts").select(*df.columns)


def upsert_batches(
    updates: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = None,
    keys: Sequence[str] | None = None,
    first_by: Sequence[str] = (),
    combine: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Write the changed rows of an update-mode stream, one folder per micro-batch.

    A batch that is run again after a failure replaces its own folder. Read the
    newest row per key back with ``latest_upserts``. With ``keys`` folders are merged as
    they come: after n batches there are as many as n has binary ones, and a row has been
    rewritten log2(n) times at most. A merge shows when its manifest is in place, so a run
    that dies loses nothing. With ``first_by`` the row of a key that is smallest by those
    columns stays, instead of the newest batch's. ``combine`` takes the place of ``keys`` where
    rows are merged otherwise: it turns rows of one or more folders into those of one, and is
    used once per batch and merge, also when a batch is run again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        base = current_version(spark, path)
        if base and base.notes["last"] >= batch_id:
            # Run again after its manifest was in place: its state still has to be written.
            batch.write.format("noop").mode("overwrite").save()
            return
        runs = base.notes["runs"] if base else []  # [part, batches in it], oldest first
        rows, size = batch.withColumn("batch_id", F.lit(batch_id).cast("long")), 1
        merged = []
        while runs and runs[-1][1] == size:
            part, n = runs[-1]
            merged, runs, size = [*merged, part], runs[:-1], size + n
        if merged:
            rows = rows.unionByName(read_version(spark, path, rows.schema, base, merged))
        if combine:
            rows = combine(rows.drop("batch_id")).withColumn("batch_id", F.lit(batch_id).cast("long"))
        elif merged:
            rows = _one_per_key(rows, keys, first_by)
        kept = {part: base.parts[part] for part, _ in runs}
        folder = write_folder(rows, path)[""]
        notes = {"last": batch_id, "runs": [*runs, [str(batch_id), size]]}
        commit(spark, path, base, {**kept, str(batch_id): folder}, notes)
        drop_unused(spark, path)

    writer = (
        updates.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(merge if keys or combine else write)
    )
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def _one_per_key(rows: DataFrame, keys: Sequence[str], first_by: Sequence[str]) -> DataFrame:
    if first_by:
        return dedup_earliest(rows, keys, first_by[0], first_by[1:])
    return dedup_latest(rows, keys, "batch_id")


def latest_upserts(
    spark: SparkSession, path: str, schema, keys: list[str], first_by: Sequence[str] = ()
) -> DataFrame:
    """Newest row per key of a folder written by ``upsert_batches``, or the first by ``first_by``."""
    stored = StructType([*schema.fields, StructField("batch_id", LongType())])
    version = current_version(spark, path)
    rows = read_version(spark, path, stored, version) if version else spark.read.schema(stored).parquet(path)
    return _one_per_key(rows, keys, first_by).drop("batch_id")


# Which of several deliveries of an event counts: the earliest, then the smallest.
DELIVERY_ORDER = ("ingested_at", "session_id", "event_type", "username", "comment_text")


def land_first_deliveries(
    stream: DataFrame, path: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Keep the first delivery of every event, however late it comes and whatever came before.

    Nothing is held in state and no event is too late: deliveries go into merged runs by event id
    (``upsert_batches``), and a delivery that turns out to be earlier replaces the one that was
    taken for the first. ``read_first_deliveries`` gives what ``dedup_earliest`` over all deliveries
    so far would give.
    """
    return upsert_batches(stream, path, checkpoint, interval, ["event_id"], DELIVERY_ORDER)


def read_first_deliveries(spark: SparkSession, path: str, schema) -> DataFrame:
    return latest_upserts(spark, path, schema, ["event_id"], DELIVERY_ORDER)
