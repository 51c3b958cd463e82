"""Report frames merged from a stream, against the same over all events."""

import os
import random
from collections import Counter
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import functions as F

from tallyloom import session
from tallyloom.session import clear_scratch, scratch_path
from tallyloom.sources import write_event_jsonl
from tallyloom.sources.schemas import TIKTOK_LIVE_EVENTS
from tallyloom.sources.versions import read_version
from tallyloom.streaming import (
    frequent_engagers,
    land_recent,
    land_summaries,
    merge_summaries,
    read_recent,
    read_summaries,
    recent_comments,
    stream_events,
    summarize_engagers,
    top_engagers,
)
from tests.conftest import rows

START = datetime(2024, 1, 1, 10)


def event(n, session, user, minutes, kind="comment"):
    at = START + timedelta(minutes=minutes)
    return (f"e{n:05}", session, kind, at, at, user, *[None] * 7)


def skewed(seed=1, n=1500):
    """Session s has users of falling frequency, f has all users alike, q has few users."""
    draw = random.Random(seed)
    out = []
    for i in range(n):
        session = draw.choice("sssfq")
        if session == "s":
            user = f"u{min(int(draw.expovariate(0.5)), 40)}"
        elif session == "f":
            user = f"u{draw.randrange(60)}"
        else:
            user = draw.choice([None, "x", "y"])
        out.append(event(i, session, user, draw.randrange(180), draw.choice(["comment"] * 9 + ["like"])))
    return out


def exact(data, since=None, until=None):
    found = Counter()
    for _, session, kind, at, _, user, *_ in data:
        if kind == "comment" and (since is None or at >= since) and (until is None or at < until):
            found[session, user] += 1
    return found


def test_errors_stay_within_the_bound_however_summaries_are_merged(spark):
    capacity, data = 7, skewed()
    single = [
        merge_summaries(summarize_engagers(spark.createDataFrame(data[i::5], TIKTOK_LIVE_EVENTS)), capacity)
        for i in range(5)
    ]
    left = reduce(lambda a, b: merge_summaries(a.unionByName(b), capacity), single)
    at_once = merge_summaries(reduce(lambda a, b: a.unionByName(b), single), capacity)
    true, size = Counter(), Counter()
    for _, session, kind, at, _, user, *_ in data:
        if kind == "comment":
            hour = at.replace(minute=0)
            true[session, hour, user] += 1
            size[session, hour] += 1
    for summary in (left, at_once):
        users, errors = Counter(), Counter()
        for r in summary.collect():
            if r.is_user:
                users[r.session_id, r.hour, r.username] += r.events
            else:
                errors[r.session_id, r.hour] += r.events
        assert max(Counter(k[:2] for k in users).values()) <= capacity
        assert errors
        for group, error in errors.items():
            assert error * (capacity + 1) <= size[group]
        for key, n in true.items():
            assert users[key] <= n <= users[key] + errors[key[:2]]


def landed_and_summaries(spark, tmp_path, data, capacity):
    """Five landings, with repeated deliveries, a micro-batch each."""
    for i in range(5):
        batch = data[i::5] + data[i : i + 40]
        write_event_jsonl(spark.createDataFrame(batch, TIKTOK_LIVE_EVENTS).coalesce(1), f"{tmp_path}/in")
    stream = stream_events(spark, f"{tmp_path}/in", TIKTOK_LIVE_EVENTS, max_files=1)
    land_summaries(stream, f"{tmp_path}/out", f"{tmp_path}/cp", capacity=capacity).awaitTermination()
    return spark.createDataFrame(data, TIKTOK_LIVE_EVENTS), read_summaries(spark, f"{tmp_path}/out")


def test_a_stream_gives_the_exact_report_with_and_without_proof(spark, tmp_path):
    data = skewed()
    landed, summaries = landed_and_summaries(spark, tmp_path, data, 12)
    found = frequent_engagers(summaries, landed)
    assert rows(found.drop("proven")) == rows(top_engagers(landed))
    proven = {r.session_id: r.proven for r in found.collect()}
    assert proven == {"s": True, "f": False, "q": True}
    # Few rows per session and hour, though f has 60 users; each stored run has its own.
    assert summaries.where("session_id = 'f'").groupBy("hour").count().agg(F.max("count")).first()[0] < 40


def test_a_period_of_hours(spark, tmp_path):
    data = skewed(2)
    landed, summaries = landed_and_summaries(spark, tmp_path, data, 12)
    since, until = "2024-01-01 11:00:00", "2024-01-01 12:00:00"
    found = frequent_engagers(summaries, landed, k=3, since=since, until=until)
    inside = landed.where(f"event_ts >= '{since}' and event_ts < '{until}'")
    assert rows(found.drop("proven")) == rows(top_engagers(inside, k=3))
    counts = exact(data, datetime(2024, 1, 1, 11), datetime(2024, 1, 1, 12))
    assert all(counts[r.session_id, r.username] == r.events for r in found.collect())


def test_ties_nulls_and_empty_tables(spark, tmp_path):
    tied = [event(i, "t", f"u{i % 6}", i) for i in range(24)] + [event(90 + i, None, None, i) for i in range(3)]
    landed, summaries = landed_and_summaries(spark, tmp_path, tied, 5)
    found = frequent_engagers(summaries, landed, k=2)
    assert rows(found.drop("proven")) == rows(top_engagers(landed, k=2))
    empty = landed.where("false")
    nothing = merge_summaries(summarize_engagers(empty))
    assert frequent_engagers(nothing, empty).collect() == []


def test_recent_comments_of_a_stream(spark, tmp_path):
    data = skewed(3, 300) + [event(900 + i, "new", None, 500 - i) for i in range(3)] + [event(990, None, "x", 1)]
    for i in range(6):
        batch = data[i::6] + data[3 * i : 3 * i + 30]  # late, out of order, repeated
        write_event_jsonl(spark.createDataFrame(batch, TIKTOK_LIVE_EVENTS).coalesce(1), f"{tmp_path}/in")
    stream = stream_events(spark, f"{tmp_path}/in", TIKTOK_LIVE_EVENTS, max_files=1)
    land_recent(stream, f"{tmp_path}/out", f"{tmp_path}/cp", 4).awaitTermination()
    found = read_recent(spark, f"{tmp_path}/out", stream.schema, 4)
    assert rows(found) == rows(recent_comments(spark.createDataFrame(data, TIKTOK_LIVE_EVENTS), 4))
    # Six batches are two stored runs, each with four rows a session at most.
    stored = read_version(spark, f"{tmp_path}/out", stream.schema)
    assert stored.groupBy("session_id").count().agg(F.max("count")).first()[0] <= 2 * 4


def test_scratch_is_removed_on_request(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_GIVEN", {})  # that of other tests stays
    used, unused = scratch_path(spark, "used"), scratch_path(spark, "unused")
    spark.range(3).write.parquet(used)
    spark.range(3).write.parquet(str(tmp_path / "other"))
    assert clear_scratch(spark) == 1 and clear_scratch(spark) == 0
    assert not os.path.exists(used) and not os.path.exists(unused)
    assert spark.read.parquet(str(tmp_path / "other")).count() == 3
