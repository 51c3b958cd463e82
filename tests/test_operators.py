"""Operators against plain Python on small frames."""

import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tallyloom import operators as op
from tests.conftest import rows


@pytest.fixture(scope="module")
def ticks(spark):
    """300 rows, a hot group with most of them, a NULL group, NULL values, one row per second."""
    rng = random.Random(5)
    data = []
    for n in range(300):
        group = rng.choice(["hot"] * 8 + ["b", None])
        value = None if rng.random() < 0.4 else rng.randint(-5, 20)
        data.append((group, datetime(2024, 1, 1) + timedelta(minutes=7 * n), n, value))
    rng.shuffle(data)
    df = spark.createDataFrame(data, "g string, ts timestamp, n long, v long").repartition(4)
    return data, df


def grouped(data):
    out = defaultdict(list)
    for row in sorted(data, key=lambda r: r[1]):
        out[row[0]].append(row)
    return out


def by_n(df, *cols):
    return {r["n"]: tuple(r[c] for c in cols) for r in df.collect()}


SPLITS = [None, "hour", "day", "year"]


def half_up(x):
    """Round to one digit, half up on the decimal digits."""
    return Decimal(repr(x)).quantize(Decimal("0.1"), ROUND_HALF_UP)


def split_of(unit):
    return None if unit is None else F.date_trunc(unit, "ts")


@pytest.mark.parametrize("unit", SPLITS)
def test_forward_fill(ticks, unit):
    data, df = ticks
    want = {}
    for members in grouped(data).values():
        last = None
        for _, _, n, v in members:
            last = v if v is not None else last
            want[n] = (last,)
    assert by_n(op.forward_fill(df, ["v"], "ts", ["g"], split_of(unit)), "v") == want


@pytest.mark.parametrize("unit", SPLITS)
def test_running_sum(ticks, unit):
    data, df = ticks
    want = {}
    for members in grouped(data).values():
        total = None
        for _, _, n, v in members:
            total = total if v is None else (total or 0) + v
            want[n] = (total,)
    got = op.running_sum(df, "v", "ts", ["g"], "total", split_of(unit))
    assert by_n(got, "total") == want


def test_running_sum_ties_share_total(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 3)], "o int, v int")
    assert sorted(r.s for r in op.running_sum(df, "v", "o", name="s").collect()) == [3, 3, 6]
    split = op.running_sum(df, "v", "o", name="s", split=F.col("o"))
    assert sorted(r.s for r in split.collect()) == [3, 3, 6]


@pytest.mark.parametrize("unit", SPLITS)
def test_lag_change(ticks, unit):
    data, df = ticks
    want = {}
    for members in grouped(data).values():
        for before, (_, _, n, v) in zip([None, *members], members):
            p = before[3] if before else None
            pct = None
            if v is not None and p:
                pct = float(half_up((v - p) / p * 100))
            want[n] = (p, pct)
    got = op.lag_change(df, "v", ["g"], "ts", 1, split=split_of(unit))
    assert by_n(got, "prev_v", "pct_v") == want


@pytest.mark.parametrize("unit", SPLITS)
@pytest.mark.parametrize("step,min_rows", [(5, 5), (3, 40)])
def test_sample_every_nth(ticks, unit, step, min_rows):
    data, df = ticks
    want = set()
    for members in grouped(data).values():
        kept = members[::step] if len(members) > min_rows else members
        want |= {m[2] for m in kept}
    got = op.sample_every_nth(df, ["g"], ["ts", "n"], step, min_rows, split_of(unit))
    assert {r.n for r in got.collect()} == want
    assert got.columns == df.columns


@pytest.mark.parametrize("unit", SPLITS)
def test_numbered(ticks, unit):
    data, df = ticks
    want = {}
    for members in grouped(data).values():
        for i, m in enumerate(members):
            want[m[2]] = (i + 1, len(members))
    got = op.numbered(df, ["g"], ["ts", "n"], split_of(unit), size="size")
    assert by_n(got, "position", "size") == want


def test_last_n_and_qualify(ticks):
    data, df = ticks
    want = set()
    for members in grouped(data).values():
        want |= {m[2] for m in members[-8:]}
    assert {r.n for r in op.last_n(df, ["g"], ["ts", "n"], 8).collect()} == want


def test_dedup(spark):
    data = [("a", 1, 5), ("a", 2, 1), ("a", 2, 9), ("b", None, 1), ("b", 1, 0), (None, 3, 3)]
    df = spark.createDataFrame(data, "k string, at int, v int")
    assert rows(op.dedup_latest(df, ["k"], "at", ["v"])) == [
        (None, 3, 3), ("a", 2, 9), ("b", 1, 0),
    ]
    assert rows(op.dedup_earliest(df, ["k"], "at", ["v"])) == [
        (None, 3, 3), ("a", 1, 5), ("b", None, 1),
    ]


def test_top_k_ties_go_to_first_seen(spark):
    rng = random.Random(3)
    data = [
        (rng.choice("st"), rng.choice(["a", "b", "c", "d", "e", "f", "g", None]), n)
        for n in range(60)
    ]
    df = spark.createDataFrame(data, "s string, u string, n int").repartition(3)
    got = rows(op.top_k_by_count(df, ["s"], "u", ["n"]).select("s", "rank", "u", "events"))
    want = []
    for s in "st":
        users = Counter(u for g, u, _ in data if g == s).most_common(5)
        want += [(s, i + 1, u, c) for i, (u, c) in enumerate(users)]
    assert got == sorted(want, key=lambda r: [str(v) for v in r])


def test_date_spine_and_gap_fill(spark):
    days = [("a", date(2024, 1, 30), 5), ("a", date(2024, 2, 2), 7), ("b", date(2024, 1, 1), 1)]
    df = spark.createDataFrame(days, "k string, d date, v int")
    spine = op.date_spine(df, "d", ["k"])
    assert spine.count() == 5
    filled = rows(op.gap_fill(df, spine, ["k", "d"], {"v": 0}))
    assert filled == rows(op.expand_days(df, "d", ["k"], {"v": 0}))
    assert [r[2] for r in filled] == [5, 0, 0, 7, 1]
    unfilled = rows(op.expand_days(df, "d", ["k"]))
    assert [r[2] for r in unfilled] == [5, None, None, 7, 1]


def test_spine_of_nothing(spark):
    empty = spark.createDataFrame([], "d date, v int")
    nulls = spark.createDataFrame([(None, 1)], "d date, v int")
    for df in (empty, nulls):
        assert op.date_spine(df, "d").count() == 0
        assert op.expand_days(df, "d").count() == 0


def test_join_left_enrich(spark):
    one = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    many = spark.createDataFrame([("a", 1), ("a", 2), (None, 9), ("z", 1)], "k string, v int")
    got = op.join_left_enrich(
        one, many, "k", [F.count("*").alias("c"), F.sum("v").alias("s"), F.max("v").alias("m")],
        zero_cols=["c", "s"],
    )
    assert rows(got) == [(None, 0, 0, None), ("a", 2, 3, 2), ("b", 0, 0, None)]


def test_join_full_outer(spark):
    left = spark.createDataFrame([(1, 10), (2, 20), (None, 30)], "d int, x int")
    right = spark.createDataFrame([(2, 200), (3, 300), (None, 400)], "d int, y int")
    got = op.join_full_outer(left, right, "d", ("both", "left", "right"), "kind")
    assert rows(got) == [
        (1, 10, None, "left"), (2, 20, 200, "both"), (3, None, 300, "right"),
        (None, 30, None, None), (None, None, 400, None),
    ]


def test_agg_global_on_empty(spark):
    empty = spark.createDataFrame([], "v int")
    assert rows(op.agg_global(empty, s=F.sum("v"), c=F.count("*"))) == [(None, 0)]
    other = spark.createDataFrame([(1,)], "w int")
    crossed = op.join_cross_scalar(other, op.agg_global(empty, s=F.sum("v")))
    assert rows(crossed) == [(1, None)]


def test_unpivot_keeps_other_rows(spark):
    df = spark.createDataFrame(
        [("n", "5"), ("r", "{'like': 2, 'love': None}"), (None, "7")],
        "metric_name string, metric_value string",
    )
    got = op.unpivot_reactions(
        df, "metric_value", ["like", "love"], only_when=F.col("metric_name") == "r"
    )
    want = [("n", "5"), (None, "7"), ("reaction_like", "2"), ("reaction_love", None)]
    assert rows(got) == sorted(want, key=lambda r: [str(v) for v in r])


def test_pivot_metrics(spark):
    df = spark.createDataFrame(
        [(1, "a", 5), (1, "a", 7), (1, "b", 1), (2, "c", 9)], "d int, m string, v int"
    )
    got = op.pivot_metrics(df, ["d"], "m", "v", {"a": "first", "b": "second"})
    assert rows(got) == [(1, 7, 1), (2, None, None)]
    assert rows(op.pivot_metrics(df, ["d"], "m", "v", ["a"], "sum")) == [(1, 12), (2, None)]


def test_union_all_matches_names(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([("x", 1)], "s string, i int")
    assert rows(op.union_all(a, b)) == [(1, "x"), (1, "x")]


def test_merged_sketches_count_distinct_values(spark):
    """Days overlap, so their counts do not add up; NULLs and a day without values count nothing."""
    rows_ = [(d, None if i % 50 == 0 else (i * 7 + d * 400) % 9_000) for d in range(6) for i in range(3_000)]
    df = spark.createDataFrame([*rows_, (9, None)], "day int, user bigint")
    days = op.distinct_sketches(df, ["day"], "user")
    assert days.count() == 7 and max(len(r.sketch) for r in days.collect()) <= 2**14 + 64
    exact = len({u for _, u in rows_ if u is not None})
    got = op.distinct_over(days, [], "users").first().users
    assert abs(got - exact) <= op.distinct_error() * exact
    by_half = {r.half: r.users for r in op.distinct_over(days, [(F.col("day") >= 3).alias("half")], "users").collect()}
    for half in (False, True):
        want = len({u for d, u in rows_ if u is not None and (d >= 3) == half})
        assert abs(by_half[half] - want) <= op.distinct_error() * want
    assert op.distinct_over(days.where("day = 9"), [], "users").first().users == 0
