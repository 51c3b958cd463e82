"""Carried series against windows over the whole of it."""

import random
from datetime import date, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyloom.plans.carried import advance_series, read_series
from tallyloom.sources.versions import current_version
from tests.conftest import rows

SCHEMA = "page string, kind string, day date, v bigint"
ARGS = (["page", "kind"], "day", "v")


def whole(spark, state):
    df = spark.createDataFrame([(*k, v) for k, v in state.items()], SCHEMA)
    up_to = Window.partitionBy("page", "kind").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return rows(df.withColumns({"filled": F.last("v", ignorenulls=True).over(up_to), "total": F.sum("v").over(up_to)}))


def test_thirty_daily_runs(spark, tmp_path):
    """A day per run across three months, with gaps, NULLs, repeated days and corrected old ones."""
    rng, path, state = random.Random(9), str(tmp_path / "s"), {}
    groups = [("a", "x"), ("a", "y"), (None, "x"), ("b", None), ("late", "x")]
    start = date(2024, 1, 20)
    for run in range(30):
        today = start + timedelta(days=2 * run)
        batch = {(*g, today): rng.choice([None, rng.randrange(20)]) for g in groups if rng.random() < 0.6 and (g[0] != "late" or run > 20)}
        if run == 12:  # an old day gets another value, and a day that was missing comes in
            batch[("a", "x", start)] = 1_000
            batch[("b", None, start + timedelta(days=3))] = 7
        if run == 20:
            batch[("a", "y", start + timedelta(days=14))] = None
        state.update(batch)
        given = [*((*k, v) for k, v in batch.items()), ("a", "x", None, 5)]
        advance_series(spark.createDataFrame(given, SCHEMA), path, *ARGS)
        if run in (0, 5, 12, 13, 20, 29):
            assert rows(read_series(spark, path, spark.createDataFrame([], SCHEMA), *ARGS)) == whole(spark, state)


def test_a_new_day_leaves_older_periods_alone(spark, tmp_path):
    path = str(tmp_path / "s")
    old = [("a", "x", date(2024, m, 5), m) for m in range(1, 7)]
    first = advance_series(spark.createDataFrame(old, SCHEMA), path, *ARGS)
    second = advance_series(spark.createDataFrame([("a", "x", date(2024, 6, 6), 10)], SCHEMA), path, *ARGS)
    changed = {p for p in second.parts if first.parts[p] != second.parts[p]}
    assert changed == {"2024-06-01", "2024-06-01/out"}
    third = advance_series(spark.createDataFrame([("a", "x", date(2024, 5, 6), None)], SCHEMA), path, *ARGS)
    changed = {p for p in third.parts if second.parts[p] != third.parts[p]}
    assert changed == {f"2024-0{m}-01{x}" for m in (5, 6) for x in ("", "/out")}
    last = read_series(spark, path, spark.createDataFrame([], SCHEMA), *ARGS).orderBy(F.desc("day")).first()
    assert (last.filled, last.total) == (10, 31)
    empty = spark.createDataFrame([], SCHEMA)
    assert advance_series(empty, path, *ARGS).number == third.number == current_version(spark, path).number
    assert advance_series(empty, str(tmp_path / "none"), *ARGS) is None
