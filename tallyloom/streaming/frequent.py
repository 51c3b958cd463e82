"""Report frames of a stream without state: what each micro-batch adds is merged as it comes.

The latest comments of a session merge exactly: those of a union are among those of its parts. Top
users come from bounded summaries that merge, with an exact second pass. Such a summary holds
at most ``capacity`` users per session and hour, each with a count that is never too high, and one
error: how much any count, that of a user who is not held included, can be too low. When more users
than that meet, the count of the first one too many is taken off all of them and added to the error
(Misra and Gries; merged as in Agarwal et al., Mergeable Summaries, 2012). Every unit of error takes
capacity + 1 off the counts, so an hour of n deliveries has an error of n / (capacity + 1) at most,
whatever the order and number of merges.

A user who is in no summary of a period has at most the sum of its errors. So the users held are
counted exactly, and where the k-th of them has more than that, nobody can be missing. Sessions
without this proof are counted in full.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyloom.operators import dedup_earliest, last_n, top_k_by_count
from tallyloom.sources.versions import read_version
from tallyloom.streaming.live import DELIVERY_ORDER, upsert_batches
from tallyloom.streaming.reports import ORDER

#: Users held per session and hour.
CAPACITY = 1024
GROUP = ["session_id", "hour"]
#: Rows with ``is_user`` false hold a part of the error of their session and hour.
SUMMARY = "session_id string, hour timestamp, username string, is_user boolean, events bigint"


def merge_summaries(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One summary per session and hour from any number of them, or from single events.

    Counts are added per user first, and ``capacity`` + 1 users a group and task are ranked, so a
    session with a third of all events is no single task's work. A NULL name is a user.
    """
    summed = rows.groupBy(*GROUP, "username", "is_user").agg(F.sum("events").alias("events"))
    order = Window.partitionBy(*GROUP, "is_user").orderBy(F.desc("events"), F.asc("username"))
    kept = summed.withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= capacity + 1)
    # The user who is one too many turns into the error that leaving it out makes.
    over = F.col("is_user") & (F.col("__rank") == capacity + 1)
    cut = F.max(F.when(over, F.col("events"))).over(Window.partitionBy(*GROUP))
    held = F.col("is_user") & ~over
    return (
        kept.withColumn("__cut", F.coalesce(cut, F.lit(0)))
        .select(
            *GROUP,
            F.when(held, F.col("username")).alias("username"),
            held.alias("is_user"),
            F.when(held, F.col("events") - F.col("__cut")).otherwise(F.col("events")).alias("events"),
        )
        .where("events > 0")
    )


def summarize_engagers(df: DataFrame, event_type: str = "comment") -> DataFrame:
    """Events of a type as summary rows of one event each; ``merge_summaries`` makes them small."""
    return df.where(F.col("event_type") == event_type).select(
        "session_id",
        F.date_trunc("hour", "event_ts").alias("hour"),
        "username",
        F.lit(True).alias("is_user"),
        F.lit(1).cast("bigint").alias("events"),
    )


def land_summaries(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    event_type: str = "comment",
    capacity: int = CAPACITY,
    interval: str | None = None,
) -> StreamingQuery:
    """Keep summaries of a stream's events without any state; late events count in their hour.

    Folders are merged as in ``upsert_batches``. A repeated delivery raises counts, which can
    only cost a proof.
    """
    rows = summarize_engagers(stream, event_type)
    merge = partial(merge_summaries, capacity=capacity)
    return upsert_batches(rows, path, checkpoint, interval, combine=merge)


def read_summaries(spark: SparkSession, path: str) -> DataFrame:
    """All stored summary rows; a session and hour may have several that are not merged yet."""
    return read_version(spark, path, SUMMARY)


def merge_recent(rows: DataFrame, n: int = 8) -> DataFrame:
    """The first delivery of each event, of those the n latest of each session."""
    once = dedup_earliest(rows, ["session_id", "event_id"], DELIVERY_ORDER[0], DELIVERY_ORDER[2:])
    return last_n(once, ["session_id"], ORDER, n)


def land_recent(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    n: int = 8,
    event_type: str = "comment",
    interval: str | None = None,
) -> StreamingQuery:
    """Keep the n latest comments of each session, however late and often events come.

    A repeat of an event that n later ones have pushed out stays out, so its deliveries must agree
    in session and event time, as those of the collectors do.
    """
    chosen = stream.where(F.col("event_type") == event_type)
    return upsert_batches(chosen, path, checkpoint, interval, combine=partial(merge_recent, n=n))


def read_recent(spark: SparkSession, path: str, schema, n: int = 8) -> DataFrame:
    """The rows of ``recent_comments`` over all that ``land_recent`` has seen; at most n as there."""
    latest = merge_recent(read_version(spark, path, schema), n)
    return latest.select("session_id", "event_id", "event_ts", "username", "comment_text")


def _in_period(col: str, since: str | None, until: str | None) -> Column:
    inside = F.lit(True)
    if since is not None:
        inside = inside & (F.col(col) >= F.lit(since).cast("timestamp"))
    if until is not None:
        inside = inside & (F.col(col) < F.lit(until).cast("timestamp"))
    return inside


def frequent_engagers(
    summaries: DataFrame,
    landed: DataFrame,
    event_type: str = "comment",
    k: int = 5,
    since: str | None = None,
    until: str | None = None,
) -> DataFrame:
    """The rows of ``top_engagers``, and whether the summary proved that they are all (``proven``).

    ``landed`` holds each event once; ``summaries`` must have seen all of them. A period goes from
    whole hour to whole hour. Only events of users in a summary are counted, and all events of the
    sessions where that is no proof. Empty tables give no rows.
    """
    within = summaries.where(_in_period("hour", since, until))
    errors = within.groupBy("session_id").agg(
        F.sum(F.when(~F.col("is_user"), F.col("events")).otherwise(F.lit(0))).alias("__error")
    )
    held = within.where("is_user").select("session_id", "username").distinct()
    events = landed.where((F.col("event_type") == event_type) & _in_period("event_ts", since, until))
    events = events.select("session_id", "username", "event_ts", "event_id")

    same = [F.col(f"e.{c}").eqNullSafe(F.col(f"h.{c}")) for c in ("session_id", "username")]
    of_held = events.alias("e").join(held.alias("h"), same, "left_semi")
    first = top_k_by_count(of_held, ["session_id"], "username", ORDER, k)

    kth = first.where(F.col("rank") == k).select("session_id", F.col("events").alias("__kth"))
    matched = F.col("r.session_id").eqNullSafe(F.col("t.session_id"))
    missing = (F.col("__error") > 0) & (F.coalesce("__kth", F.lit(0)) <= F.col("__error"))
    open_sessions = (
        errors.alias("r").join(kth.alias("t"), matched, "left").where(missing).select("r.session_id")
    )

    def by_session(df: DataFrame, how: str) -> DataFrame:
        same_session = F.col("d.session_id").eqNullSafe(F.col("o.session_id"))
        return df.alias("d").join(open_sessions.alias("o"), same_session, how)

    proven = by_session(first, "left_anti").withColumn("proven", F.lit(True))
    full = top_k_by_count(
        by_session(events, "left_semi"), ["session_id"], "username", ORDER, k
    )
    return proven.unionByName(full.withColumn("proven", F.lit(False)))
