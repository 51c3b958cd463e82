"""The daily refresh from what is new: newest rows by key in hash buckets, marts in versions.

A staging model that takes the newest row per key does not need every batch that ever landed, only
the newest raw row per key. Those rows are kept in hash buckets of the key. The last batches are read in
the files where they have landed, which must stay for so long. When there are more than so many, they go
into the buckets that they touch as one run, without a shuffle and without moving what those hold; readers
keep the newest row per key over all runs. A bucket with more than so many runs is merged into one. The
other buckets are carried over by reference. Which files are new is told by their modification time, which Spark takes from the
listing, so files of older batches are not opened, and rows that arrive late with an old ingest time
count like any other. Reading a file twice changes nothing.

A mart is rebuilt when something that it reads has changed, and put in place as a new version. One
whose inputs are as they were keeps its version.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators import observe_checks
from tallyloom.plans.marts import MART_MODELS
from tallyloom.plans.refresh import CHOSEN_WHERE_STORED, THREADS, WAVES, ModelFrames
from tallyloom.plans.suite import SUITE
from tallyloom.session import configure, sized_for
from tallyloom.sources.schemas import EVENT_TABLES, RAW_TABLES
from tallyloom.sources.versions import (
    Version,
    changed_at,
    commit,
    current_version,
    drop_unused,
    folders,
    materialize_version,
    read_landed,
    read_version,
    write_folder,
)

#: Hash buckets of a new table of newest rows: as many as tasks should share a full merge.
BUCKETS = 32
BUCKET = "__bucket"
#: Batches that stay where they have landed, and runs of a bucket that stay apart: rows are copied into
#: their buckets once in so many batches, and those of a bucket written again once in so many copies.
RUNS = 8

#: Raw table -> (keys, ties) of the rows that staging can choose. The keys are those of the staging
#: model or finer: where staging ranks or merges typed values, the raw values are keys as well.
NEWEST: dict[str, tuple[list[str], list[str]]] = {
    "facebook": (["DATE", "METRIC", "VALUE"], []),
    "facebook_posts": (["post_id"], ["row_key"]),
    "tiktok_followers": (["username", "followed_at_raw"], []),
    "tiktok_live_history": (
        ["room_id"],
        ["duration_raw", "live_title_raw", "total_view_raw", "total_gifter_raw", "total_likes_raw"],
    ),
    "tiktok_posts": (["date_raw", "sound_raw"], ["row_key"]),
    "tiktok_watch_live_history": (["watched_at_raw", "link_raw"], ["row_key"]),
    "youtube_channel": (
        ["channel_id", "channel_title", "subscriber_count", "view_count", "video_count"],
        [],
    ),
    "youtube_comments": (["video_id", "author", "published_at"], ["row_key"]),
    "youtube_videos": (["video_id"], ["row_key"]),
}


def _with_span(spans: list[dict], landed: dict) -> list[dict]:
    """Spans of landed batches with one more; it is one span with the last if that ends where it begins."""
    *earlier, last = spans or [None]
    if last and (last["path"], last["until"]) == (landed["path"], landed["since"]):
        return [*earlier, {**last, "until": landed["until"], "batches": last["batches"] + 1}]
    return [*spans, {**landed, "batches": 1}]


def merge_newest(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    order_col: str,
    tie_cols: Sequence[str] = (),
    buckets: int = BUCKETS,
    notes: dict | None = None,
    landed: dict | None = None,
) -> Version | None:
    """Merge a batch into the table of newest rows per key at ``path``; the version after it.

    The table equals ``dedup_latest`` over all batches so far, whatever their order, repeated rows
    and batches included. Only buckets that a key of the batch falls into are written; each of them is
    merged and written whole when it has more than ``RUNS`` runs. The number of buckets is that of the
    first batch. An empty batch changes nothing but the notes.

    A batch that is stored already may say so: ``landed`` has its table's folder (``path``) and the
    modification times of its files (``since`` and ``until``, in milliseconds). It is not written until there
    are more than ``RUNS`` such batches.
    """
    spark = batch.sparkSession
    base = current_version(spark, path)
    count = base.notes["buckets"] if base else buckets
    by = {"keys": list(keys), "order": order_col, "ties": list(tie_cols)}
    noted = {**(notes or {}), "buckets": count, "newest": by}

    def placed(rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(count)).cast("int"))

    parts = dict(base.parts) if base else {}
    spans = base.notes.get("landed", []) if base else []
    if landed:
        spans = _with_span(spans, landed)
        if sum(s["batches"] for s in spans) <= RUNS:
            version = commit(spark, path, base, parts, {**noted, "landed": spans})
            drop_unused(spark, path)
            return version
        batch = reduce(DataFrame.unionByName, read_landed(spark, Version(0, {}, {"landed": spans}), batch.schema))
    elif spans:
        noted["landed"] = spans
    for bucket, run in write_folder(placed(batch), path, BUCKET).items():
        parts[bucket] = [*folders(parts.get(bucket, [])), run]
    full = [bucket for bucket, runs in parts.items() if len(folders(runs)) > RUNS]
    if full:
        rows = read_version(spark, path, batch.schema, Version(0, parts, noted), full)
        parts |= write_folder(placed(rows), path, BUCKET)
    version = commit(spark, path, base, parts, noted)
    drop_unused(spark, path)
    return version


def _landed(spark: SparkSession, raw_root: str, name: str, missing: str) -> DataFrame | None:
    schema = {**RAW_TABLES, **EVENT_TABLES}[name]
    try:
        return spark.read.schema(schema).parquet(f"{raw_root.rstrip('/')}/{name}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND" or missing != "empty" and name not in EVENT_TABLES:
            raise
        return None


def _state_since(rows: DataFrame, since: int) -> list[int]:
    """The newest modification time of files not older than ``since``, and their rows."""
    found = rows.where(changed_at() >= since).agg(F.max(changed_at()).alias("at"), F.count("*").alias("n")).first()
    return [found["at"] or 0, found["n"]]


class _Inputs:
    """Raw tables as models read them, and a state per table that tells whether it has changed."""

    def __init__(self, spark: SparkSession, raw_root: str, store: str, missing: str, buckets: int) -> None:
        self.spark, self.raw_root, self.store = spark, raw_root, store
        self.missing, self.buckets = missing, buckets
        self.states: dict[str, list[int]] = {}

    def advance(self, name: str) -> None:
        """Take in what has landed in a raw table since the last refresh."""
        rows = _landed(self.spark, self.raw_root, name, self.missing)
        if rows is None:
            self.states[name] = [0, 0]
            return
        path = f"{self.store}/{name}"
        base = current_version(self.spark, path)
        seen, held = base.notes["state"] if base else [0, 0]
        newest_at, count = _state_since(rows, seen)
        if base and (newest_at, count) == (seen, held):
            self.states[name] = [base.number]
            return
        # Files of the newest time seen are counted again next time: more may land in that moment.
        noted = {"state": [newest_at, _state_since(rows, newest_at)[1]]}
        if name in NEWEST:
            keys, ties = NEWEST[name]
            new = rows.where(changed_at().between(seen, newest_at))
            span = {"path": f"{self.raw_root.rstrip('/')}/{name}", "since": seen, "until": newest_at}
            version = merge_newest(new, path, keys, "ingested_at", ties, self.buckets, noted, span if newest_at else None)
        else:
            version = commit(self.spark, path, base, {}, noted)
        self.states[name] = [version.number]

    def read(self, name: str) -> DataFrame:
        schema = {**RAW_TABLES, **EVENT_TABLES}[name]
        if name in NEWEST:
            # Runs are not merged here: every staging model keeps the newest row per key anyway.
            path, addressed = f"{self.store}/{name}", name in CHOSEN_WHERE_STORED
            return read_version(self.spark, path, schema, merged=False, addressed=addressed)
        rows = _landed(self.spark, self.raw_root, name, self.missing)
        return self.spark.createDataFrame([], schema) if rows is None else rows


def _lineage(name: str, as_of: date | None, spark: SparkSession) -> set[str]:
    """Everything that a frame is made from, itself included."""
    schemas = {**RAW_TABLES, **EVENT_TABLES}
    frames = ModelFrames(lambda raw: spark.createDataFrame([], schemas[raw]), as_of)
    frames[name]
    return set(frames)


def refresh_incremental(
    spark: SparkSession,
    raw_root: str,
    mart_root: str,
    as_of: date | None = None,
    marts: Sequence[str] | None = None,
    missing: str = "fail",
    buckets: int = BUCKETS,
    observed: dict[str, Observation] | None = None,
) -> dict[str, DataFrame]:
    """Bring the marts below ``mart_root`` up to date and return them as stored.

    The marts are those of a full rebuild over all landed rows. ``marts`` names some of them; the
    others, and raw tables that only they read, are left alone. A mart that shows ages is also
    rebuilt when ``as_of`` (or today) differs from its last one. ``observed`` is filled with what
    the writes of rebuilt marts have counted for their tests; the others are not in it.
    """
    configure(spark)
    mart_root = mart_root.rstrip("/")
    wanted = list(marts or MART_MODELS)
    lineage = {name: _lineage(name, as_of, spark) for name in [*(n for w in WAVES for n in w)]}
    needed = {x for name in wanted for x in lineage[name]}
    schemas = {**RAW_TABLES, **EVENT_TABLES}
    raw_names = sorted(needed & set(schemas))
    inputs = _Inputs(spark, raw_root, f"{mart_root}/_newest", missing, buckets)
    models = ModelFrames(inputs.read, as_of)

    def store(name: str, df: DataFrame) -> DataFrame:
        path = f"{mart_root}/{name if name in MART_MODELS else f'_shared/{name}'}"
        notes = {"inputs": {n: inputs.states[n] for n in sorted(lineage[name] & set(schemas))}}
        if "mart_youtube_perfomance" in lineage[name]:
            notes["as_of"] = str(as_of or date.today())
        base = current_version(spark, path)
        if base and base.notes == notes:
            return read_version(spark, path, df.schema, base)
        if observed is not None and name in MART_MODELS:
            df, observed[name] = observe_checks(df, SUITE.get(name, {}))
        return materialize_version(df, path, notes)

    with sized_for(spark, raw_root), ThreadPoolExecutor(THREADS) as pool:
        list(pool.map(inputs.advance, raw_names))
        for wave in WAVES:
            names = [n for n in wave if n in needed]
            frames = [models[n] for n in names]
            models.update(zip(names, pool.map(store, names, frames)))
    return {name: models[name] for name in wanted}
