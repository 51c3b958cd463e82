"""Rows chosen where they are stored: equal to dedup_latest, and not shuffled whole."""

import random
import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import dedup, dedup_latest, dedup_latest_stored, with_address
from tallyloom.plans import refresh
from tallyloom.plans.refresh import CHOSEN_WHERE_STORED, refresh_marts
from tallyloom.session import INITIAL_KEY, PARTITIONS_KEY, sized_for
from tallyloom.sources import append_raw
from tallyloom.workloads.data import raw_frame
from tests.conftest import rows

SCHEMA = "id string, part bigint, at timestamp, tie string, text string"
KEYS = ["id", "part"]
START = datetime(2024, 1, 1)
DAY = date(2024, 1, 1)


def landed(n=400):
    """Late, tied and repeated rows; nulls in keys, times and ties."""
    rng = random.Random(5)
    made = []
    for i in range(n):
        at = rng.choice([None, *[START + timedelta(hours=h) for h in range(3)]])
        tie = rng.choice([None, "", "b", f"a{rng.randrange(3)}", f"c{rng.randrange(9)}"])
        made.append((rng.choice(["a", "b", None, f"k{rng.randrange(60)}"]), rng.choice([1, None]), at, tie, f"{i}"))
    return made + rng.sample(made, n // 4)


@pytest.mark.parametrize("hinted, most", [(True, 64), (False, 64), (True, 3), (False, 2)])
def test_rows_chosen_by_address_equal_dedup(spark, tmp_path, monkeypatch, hinted, most):
    monkeypatch.setattr(dedup, "MAX_TIED", most)
    given, paths = landed(), [str(tmp_path / "one file's"), str(tmp_path / "two")]
    spark.createDataFrame(given[:300], SCHEMA).repartition(3).write.parquet(paths[0])
    spark.createDataFrame(given[300:], SCHEMA).repartition(2).write.parquet(paths[1])
    frames = [spark.read.schema(SCHEMA).parquet(p) for p in paths]
    placed = with_address(*frames)
    assert placed.columns[-2:] == dedup.ADDRESS and placed.distinct().count() == len(given)
    hint = F.ascii("tie") if hinted else None
    found = dedup_latest_stored(placed, KEYS, "at", ["tie", "text"], hint)
    wanted = dedup_latest(frames[0].unionByName(frames[1]), KEYS, "at", ["tie", "text"])
    assert found.columns == wanted.columns and rows(found) == rows(wanted)


def test_bitmaps_of_long_files(spark, tmp_path):
    """More rows in a file than a bitmap has places; every place of a byte, the first and last rows."""
    path = str(tmp_path / "t")
    n = 100_000
    ids = spark.range(n).selectExpr("id % 50000 as id", "id as at", "cast(id as string) as text")
    ids.coalesce(1).write.parquet(path)
    placed = with_address(spark.read.parquet(path))
    found = dedup_latest_stored(placed, ["id"], "at")
    assert found.agg(F.count("*"), F.min("at"), F.sum("at")).first() == (50_000, 50_000, sum(range(50_000, n)))
    odd = dedup_latest_stored(placed.withColumn("id", F.floor(F.col("at") / 2)), ["id"], "at")
    assert odd.agg(F.count("*"), F.sum(F.col("at") % 2), F.max("at")).first() == (50_000, 50_000, n - 1)


def test_a_hot_key_sends_few_rows_of_each_partition(spark, tmp_path):
    """All of its rows have one time, as those of one landed batch do."""
    path = str(tmp_path / "t")
    spark.range(40_000).selectExpr("1 as id", "0 as at", "lpad(id % 7777, 5, '0') as tie").repartition(2).write.parquet(path)
    found = dedup_latest_stored(with_address(spark.read.parquet(path)), ["id"], "at", ["tie"])
    assert [r.tie for r in found.collect()] == ["07776"]
    final = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    made = re.findall(r"(?m)^[ :]*\+- Exchange hashpartitioning\(id", final)
    assert len(made) <= 2 and "ReusedExchange" in final
    assert re.search(r"Exchange hashpartitioning\(id.*\n.*WindowGroupLimit .* 64, Partial", found._jdf.queryExecution().executedPlan().toString())


def test_rows_of_no_file_and_very_many_rows_have_no_address(spark, tmp_path, monkeypatch):
    frame = spark.createDataFrame(landed(), SCHEMA)
    assert with_address(frame).columns == frame.columns
    frame.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    monkeypatch.setattr(dedup, "MAX_BLOCKS", 0)
    assert with_address(stored).columns == frame.columns
    assert rows(dedup_latest_stored(with_address(stored), KEYS, "at", ["tie", "text"])) == rows(
        dedup_latest(frame, KEYS, "at", ["tie", "text"])
    )


def shuffled(df):
    """Columns that go through the shuffles of a plan, by name."""
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    found = re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", text)
    return {c.split("#")[0].strip() for columns in found for c in columns.split(",")}


#: The few rows that share key and time are compared in full, so bytes of row keys may be there.
WIDE = {
    "mart_facebook_posts": {"post_message", "message", "row_key"},
    "mart_posts_perfomance": {"title_raw", "likes_raw", "location_raw", "row_key"},
}


def test_a_refresh_shuffles_no_wide_rows(spark, sf_dir, tmp_path, monkeypatch):
    raw, plans = str(tmp_path / "raw"), {}
    for name in CHOSEN_WHERE_STORED:
        append_raw(raw_frame(spark, sf_dir, name), f"{raw}/{name}")
    store = refresh.materialize_table
    monkeypatch.setattr(refresh, "materialize_table", lambda df, path: plans.update({path.split("/")[-1]: df}) or store(df, path))
    refresh_marts(spark, raw, str(tmp_path / "marts"), as_of=DAY, missing="empty")
    for name, wide in WIDE.items():
        columns = shuffled(plans[name])
        assert dedup.ADDRESS[0] in columns
        assert not columns & wide


def test_shuffle_partitions_grow_with_the_tables(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "raw")
    spark.range(1_000).write.parquet(path)
    own = int(spark.conf.get(PARTITIONS_KEY))
    with sized_for(spark, path):
        assert int(spark.conf.get(INITIAL_KEY)) == own
    monkeypatch.setattr("tallyloom.session.PARTITION_BYTES", 100)
    with sized_for(spark, path):
        assert int(spark.conf.get(INITIAL_KEY)) > own
    with sized_for(spark, str(tmp_path / "none")):
        assert int(spark.conf.get(INITIAL_KEY)) == own
    assert spark.conf.get(INITIAL_KEY, None) is None
