"""Batches that an incremental refresh reads where they have landed."""

import random
from datetime import date, datetime, timedelta

from tallyloom.operators import dedup_latest
from tallyloom.plans import incremental
from tallyloom.plans.incremental import merge_newest, refresh_incremental
from tallyloom.plans.refresh import ModelFrames
from tallyloom.sources import append_raw, read_sources
from tallyloom.sources.schemas import RAW_TABLES
from tallyloom.sources.versions import current_version, read_version
from tests.conftest import rows

START = datetime(2024, 1, 1)
DAY = date(2024, 1, 1)


def post(i, text, at, key):
    return (f"p{i}", text, "2024-01-01", None, at, key)


def test_landed_batches_are_not_copied(spark, tmp_path, monkeypatch):
    """They are read where they lie until there are too many; marts equal a rebuild at every step."""
    monkeypatch.setattr(incremental, "RUNS", 2)
    raw, marts, rng = str(tmp_path / "raw"), str(tmp_path / "marts"), random.Random(8)
    copied, sent = [], []
    write = incremental.write_folder
    monkeypatch.setattr(incremental, "write_folder", lambda df, *a: copied.append(df.count()) or write(df, *a))
    for step in range(4):
        batch = [
            post(rng.randrange(30), f"{step}-{i}", START + timedelta(hours=rng.randrange(4)), f"{rng.randrange(16):x}" * 32)
            for i in range(25)
        ] + rng.sample(sent, min(4, len(sent)))
        sent += batch
        append_raw(spark.createDataFrame(batch, RAW_TABLES["facebook_posts"]), f"{raw}/facebook_posts")
        copied.clear()
        found = refresh_incremental(spark, raw, marts, DAY, ["mart_facebook_posts"], buckets=4)["mart_facebook_posts"]
        assert bool(copied) == (step == 2)
        if copied:
            assert copied[0] >= 3 * 25
        landed_now = current_version(spark, f"{marts}/_newest/facebook_posts").notes.get("landed", [])
        assert sum(s["batches"] for s in landed_now) == (step + 1 if step < 2 else step - 2)
        whole = read_sources(spark, raw, ["facebook_posts"])["facebook_posts"]
        newest = dedup_latest(whole, ["post_id"], "ingested_at", ["row_key"]).select("post_id", "ingested_at", "row_key")
        kept = read_version(spark, f"{marts}/_newest/facebook_posts", RAW_TABLES["facebook_posts"])
        assert rows(kept.select(newest.columns)) == rows(newest)
        full = ModelFrames({"facebook_posts": whole}.__getitem__)["mart_facebook_posts"]
        assert rows(found.select("post_id", "ingested_at")) == rows(full.select("post_id", "ingested_at"))
    # What has no place of its own yet is written as it was before.
    more = spark.createDataFrame([post(1, "late", START + timedelta(days=9), "f" * 32)], RAW_TABLES["facebook_posts"])
    merge_newest(more, f"{marts}/_newest/facebook_posts", ["post_id"], "ingested_at", ["row_key"])
    kept = read_version(spark, f"{marts}/_newest/facebook_posts", RAW_TABLES["facebook_posts"])
    assert kept.where("message = 'late'").count() == 1 and kept.count() == newest.count()
