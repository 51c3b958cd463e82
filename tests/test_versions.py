"""Table versions, newest rows in buckets, and the incremental refresh against a full rebuild."""

import random
from datetime import date, datetime, timedelta

import pytest
import run_daily
from pyspark.sql import functions as F

from tallyloom.operators import dedup_latest
from tallyloom.plans import incremental
from tallyloom.plans.incremental import merge_newest, refresh_incremental
from tallyloom.plans.marts import MART_MODELS
from tallyloom.plans.refresh import refresh_marts
from tallyloom.sources import append_raw, materialize_table
from tallyloom.sources.schemas import RAW_TABLES
from tallyloom.sources.versions import (
    commit,
    current_version,
    materialize_version,
    read_version,
    write_folder,
)
from tallyloom.workloads.data import RAW_SQL, raw_frame
from tests.conftest import rows

SCHEMA = "id string, part bigint, at timestamp, tie bigint, text string"
KEYS = ["id", "part"]
START = datetime(2024, 1, 1)


def test_readers_keep_their_version(spark, tmp_path):
    path = str(tmp_path / "t")
    assert current_version(spark, path) is None
    with pytest.raises(ValueError):
        read_version(spark, path)
    old = materialize_version(spark.range(10).toDF("n"), path)
    new = materialize_version(spark.range(20, 25).toDF("n"), path)
    assert [len(old.collect()), len(new.collect())] == [10, 5]
    assert rows(read_version(spark, path)) == rows(new)
    for _ in range(4):
        materialize_version(spark.range(3).toDF("n"), path)
    names = sorted(x.name for x in (tmp_path / "t").iterdir() if x.name.startswith("data-"))
    assert len(names) == 3 and current_version(spark, path).number == 6


def test_a_write_that_dies_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    stored = materialize_version(spark.range(10).toDF("n"), path)
    before = rows(stored)
    broken = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("n"))
    with pytest.raises(Exception, match="lost"):
        materialize_version(broken.select(F.col("n").cast("long").alias("n")), path)
    write_folder(spark.range(7).toDF("n"), path)  # a writer that died before its manifest
    assert rows(read_version(spark, path)) == before and rows(stored) == before


def test_the_second_writer_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    materialize_version(spark.range(1).toDF("n"), path)
    base = current_version(spark, path)
    commit(spark, path, base, {}, {"by": "one"})
    with pytest.raises(Exception, match="exists"):
        commit(spark, path, base, {}, {"by": "two"})
    assert current_version(spark, path).notes == {"by": "one"}


def batches(n=10):
    """Late, repeated and tied rows, nulls in keys."""
    rng = random.Random(3)
    out, landed = [], []
    for b in range(n):
        batch = []
        for _ in range(25):
            key = rng.choice(["a", "b", "c", "d", None, f"k{rng.randrange(40)}"])
            at = START + timedelta(hours=rng.randrange(6) + 2 * b - rng.choice([0, 0, 0, 9]))
            batch.append((key, rng.choice([1, 2, None]), at, rng.randrange(3), f"{b}-{len(batch)}-{rng.randrange(99)}"))
        batch += rng.sample(landed, min(5, len(landed)))
        landed += batch
        out.append(batch)
    return [*out, [], out[2]]


def test_merged_batches_equal_one_dedup(spark, tmp_path):
    path, landed = str(tmp_path / "newest"), []
    for batch in batches():
        landed += batch
        merge_newest(spark.createDataFrame(batch, SCHEMA), path, KEYS, "at", ["tie", "text"], buckets=8)
        whole = dedup_latest(spark.createDataFrame(landed, SCHEMA), KEYS, "at", ["tie", "text"])
        assert rows(read_version(spark, path, SCHEMA)) == rows(whole)


def test_a_batch_rewrites_only_its_buckets(spark, tmp_path):
    path = str(tmp_path / "newest")
    many = spark.range(2_000).selectExpr("cast(id as string) as id", "id as part", "timestamp '2024-01-01' as at", "id as tie", "'x' as text")
    first = merge_newest(many, path, KEYS, "at", ["tie"], buckets=16)
    assert len(first.parts) == 16
    one = spark.createDataFrame([("5", 5, START + timedelta(days=1), 0, "new")], SCHEMA)
    second = merge_newest(one, path, KEYS, "at", ["tie"])
    changed = [p for p in first.parts if first.parts[p] != second.parts[p]]
    assert len(changed) == 1
    again = read_version(spark, path, SCHEMA, parts=changed)
    assert again.where("text = 'new'").count() == 1 and again.count() < 400
    assert rows(read_version(spark, path, SCHEMA)) == rows(dedup_latest(many.unionByName(one), KEYS, "at", ["tie"]))


def test_a_batch_moves_none_of_the_rows_before_it(spark, tmp_path, monkeypatch):
    """Its rows are added as runs; a bucket with too many is merged into one folder again."""
    monkeypatch.setattr(incremental, "RUNS", 3)
    path, landed, moved = str(tmp_path / "newest"), [], []
    write = incremental.write_folder
    monkeypatch.setattr(incremental, "write_folder", lambda df, *a: moved.append(df.count()) or write(df, *a))
    for batch in batches()[:6]:
        landed += batch
        before = current_version(spark, path)
        moved.clear()
        version = merge_newest(spark.createDataFrame(batch, SCHEMA), path, KEYS, "at", ["tie", "text"], buckets=2)
        assert moved[0] == len(batch)
        runs = {p: [f] if isinstance(f, str) else f for p, f in version.parts.items()}
        assert max(len(f) for f in runs.values()) <= 3
        if len(moved) == 1 and before:
            held = {p: [f] if isinstance(f, str) else f for p, f in before.parts.items()}
            assert all(runs[p][: len(f)] == f for p, f in held.items())
        whole = dedup_latest(spark.createDataFrame(landed, SCHEMA), KEYS, "at", ["tie", "text"])
        assert rows(read_version(spark, path, SCHEMA)) == rows(whole)
    assert any(isinstance(f, str) or len(f) < 6 for f in version.parts.values())


def test_runs_go_onto_a_table_of_merged_buckets(spark, tmp_path):
    """A table as earlier releases left it: one folder per bucket, no keys in its notes."""
    path, (old, new, *_) = str(tmp_path / "newest"), batches()
    first = dedup_latest(spark.createDataFrame(old, SCHEMA), KEYS, "at", ["tie", "text"])
    placed = first.withColumn(incremental.BUCKET, F.pmod(F.xxhash64(*KEYS), F.lit(4)).cast("int"))
    commit(spark, path, None, write_folder(placed, path, incremental.BUCKET), {"buckets": 4})
    merge_newest(spark.createDataFrame(new, SCHEMA), path, KEYS, "at", ["tie", "text"])
    whole = dedup_latest(spark.createDataFrame(old + new, SCHEMA), KEYS, "at", ["tie", "text"])
    assert rows(read_version(spark, path, SCHEMA)) == rows(whole)


def test_stored_tables_are_packed_with_zstandard(spark, tmp_path):
    """Row keys and surrogate keys are hex digits, which take a byte each in snappy."""
    keyed = spark.range(1_000).select(F.md5(F.col("id").cast("string")).alias("row_key"))
    append_raw(keyed, str(tmp_path / "raw"))
    materialize_table(keyed, str(tmp_path / "mart"))
    materialize_version(keyed, str(tmp_path / "version"))
    names = [f.name for f in tmp_path.rglob("*.parquet")]
    assert names and all(".zstd." in n for n in names)


def land(spark, sf_dir, root, names, step, steps):
    """A third of each raw table; rows of all ingest times are in each."""
    for name in names:
        raw = raw_frame(spark, sf_dir, name)
        chosen = F.pmod(F.xxhash64(*raw.columns), F.lit(steps)) == step
        append_raw(raw.where(chosen), f"{root}/{name}")


def same(a, b):
    return a.schema == b.schema and rows(a) == rows(b)


def test_incremental_marts_equal_a_full_rebuild(spark, sf_dir, tmp_path, monkeypatch):
    """Three rounds, rows of all times in each; then a round in which one source alone has news."""
    raw, marts = str(tmp_path / "raw"), str(tmp_path / "marts")
    names = [n for n in RAW_TABLES if n in RAW_SQL]
    day = date(2024, 1, 1)
    for step in range(2):
        land(spark, sf_dir, raw, names, step, 2)
        stored = refresh_incremental(spark, raw, marts, as_of=day, missing="empty", buckets=4)
    full = refresh_marts(spark, raw, str(tmp_path / "full"), as_of=day, missing="empty")
    assert set(stored) == set(full) == set(MART_MODELS)
    for name in full:
        assert same(stored[name], full[name]), name
    numbers = {n: current_version(spark, f"{marts}/{n}").number for n in full}
    refresh_incremental(spark, raw, marts, as_of=day, missing="empty", buckets=4)
    assert numbers == {n: current_version(spark, f"{marts}/{n}").number for n in full}

    append_raw(
        spark.createDataFrame(
            [("post_1", "edited", "2022-02-02", "photo", datetime(2025, 1, 1), "k")], RAW_TABLES["facebook_posts"]
        ),
        f"{raw}/facebook_posts",
    )
    read = []
    merge = incremental.merge_newest
    monkeypatch.setattr(incremental, "merge_newest", lambda batch, path, *a: read.append(batch.count()) or merge(batch, path, *a))
    before = stored["mart_facebook_posts"]
    held = rows(before)
    stored = refresh_incremental(spark, raw, marts, as_of=day, missing="empty", buckets=4)
    # Files of the newest time seen are read once more, nothing else of older batches is.
    assert len(read) == 1 and read[0] < raw_frame(spark, sf_dir, "facebook_posts").count()
    assert rows(before) == held  # a reader of the version before
    full = refresh_marts(spark, raw, str(tmp_path / "full2"), as_of=day, missing="empty")
    for name in full:
        assert same(stored[name], full[name]), name
    after = {n: current_version(spark, f"{marts}/{n}").number for n in full}
    assert after["mart_facebook_posts"] == numbers["mart_facebook_posts"] + 1
    assert after["mart_youtube_videos"] == numbers["mart_youtube_videos"]


def test_some_marts_on_a_first_day(spark, tmp_path):
    """Nothing but one source has landed; the marts asked for are there, other tables are not read."""
    raw, marts = str(tmp_path / "raw"), str(tmp_path / "marts")
    append_raw(
        spark.createDataFrame([("2024-01-01 10:00:00 UTC", "u", START)], RAW_TABLES["tiktok_followers"]),
        f"{raw}/tiktok_followers",
    )
    stored = refresh_incremental(spark, raw, marts, marts=["mart_tiktok_followers"])
    assert set(stored) == {"mart_tiktok_followers"} and stored["mart_tiktok_followers"].count() == 1
    stored = refresh_incremental(spark, raw, marts, marts=["mart_youtube_videos"], missing="empty")
    assert stored["mart_youtube_videos"].count() == 0


def test_incremental_daily_run(spark, tmp_path):
    """Two days of one export; the second day's run merges what the first has stored."""
    raw, marts, landing = (str(tmp_path / x) for x in ("raw", "marts", "in"))
    folder = tmp_path / "in/tiktok"
    folder.mkdir(parents=True)
    for day in (1, 2):
        (folder / "Follower.txt").write_text(f"Date: 2024-01-0{day} 10:00:00 UTC\nUsername: user{day}\n\n")
        assert run_daily.main(landing, raw, marts, "incremental") in (0, 1)
    rebuilt = refresh_marts(spark, raw, str(tmp_path / "full"), missing="empty")
    for name in ("mart_tiktok_followers", "mart_social_overview"):
        assert rows(read_version(spark, f"{marts}/{name}")) == rows(rebuilt[name])
    assert read_version(spark, f"{marts}/mart_tiktok_followers").count() == 2
