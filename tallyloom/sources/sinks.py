"""Writing raw batches, marts and live events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# Events are flushed this often, or when so many wait, and times are written in this form.
FLUSH_INTERVAL = "30 seconds"
FLUSH_ROWS = 200
#: Of stored tables. Row keys and surrogate keys are hex digits, which snappy cannot pack.
COMPRESSION = "zstd"
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def append_raw(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> bool:
    """Append a batch to a raw table; an empty batch writes nothing and gives False."""
    if df.isEmpty():
        return False
    df.write.mode("append").option("compression", COMPRESSION).partitionBy(*partition_by).parquet(path)
    return True


def materialize_view(df: DataFrame, name: str) -> DataFrame:
    """Staging models are views: a name for a plan, no stored data."""
    df.createOrReplaceTempView(name)
    return df


def materialize_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Marts are fully rewritten tables; the stored table is returned.

    Later marts read the stored rows, so a lost executor costs a file read and not
    the whole chain of models before it.
    """
    df.write.mode("overwrite").option("compression", COMPRESSION).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def serialize_events(df: DataFrame) -> DataFrame:
    """Events as message rows: session id as key, JSON value, type and session as attributes."""
    return df.select(
        F.col("session_id").alias("key"),
        F.to_json(F.struct("*"), {"timestampFormat": EVENT_TIME_FORMAT}).alias("value"),
        F.create_map(
            F.lit("event_type"), "event_type", F.lit("session_id"), "session_id"
        ).alias("attributes"),
    )


def write_event_jsonl(df: DataFrame, path: str) -> None:
    """Land a batch of events as JSON lines."""
    df.write.mode("append").option("timestampFormat", EVENT_TIME_FORMAT).json(path)


def sink_events(
    stream_df: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = FLUSH_INTERVAL,
    fmt: str = "json",
    max_rows: int | None = None,
) -> StreamingQuery:
    """Append a stream of events to files.

    With an ``interval`` the query flushes on that timer until stopped. With
    ``interval=None`` it drains what has landed, flushes a last time and ends. ``max_rows``
    bounds the rows of a landed file, which is the unit that readers and loaders take: a
    micro-batch with more of them lands as several files in one commit.
    """
    writer = (
        stream_df.writeStream.format(fmt)
        .outputMode("append")
        .option("maxRecordsPerFile", max_rows or 0)
        .option("timestampFormat", EVENT_TIME_FORMAT)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()
