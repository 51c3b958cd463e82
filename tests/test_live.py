"""Streams against the same calculation over a batch, and report frames."""

from collections import Counter
from datetime import datetime, timedelta

import pytest

from tallyloom.sources import read_event_jsonl, sink_events, write_event_jsonl
from tallyloom.sources.schemas import TIKTOK_LIVE_EVENTS, YOUTUBE_LIVE_EVENTS
from tallyloom.streaming import (
    activity_sessions,
    first_deliveries,
    latest_upserts,
    normalize_live_events,
    recent_comments,
    session_kpis,
    session_report,
    stream_dedup,
    stream_events,
    top_engagers,
    upsert_batches,
    viewer_curve,
    viewer_windows,
    windowed_activity,
)
from tests.conftest import rows

START = datetime(2024, 1, 1, 10, 0, 0, 123456)


def event(n, session, kind, seconds, **fields):
    at = START + timedelta(seconds=seconds)
    names = ["username", "user_id", "comment_text", "like_count", "viewer_count", "gift_name",
             "diamond_count", "room_id"]
    return (f"e{n}", session, kind, at, at, *[fields.get(f) for f in names])


@pytest.fixture(scope="module")
def data():
    out = [event(0, "a", "connect", 0, room_id="1"), event(1, "a", "connect", 200, room_id="1")]
    for n in range(12):
        out.append(event(10 + n, "a", "viewer_count", 30 * n, viewer_count=[3, 10, None][n % 3]))
    for n in range(10):
        name = [None, "x", "y", "y"][n % 4]
        out.append(event(30 + n, "a", "comment", 40 * n, username=name, comment_text=f"c{n}"))
    out.append(event(50, "a", "gift", 100, username="x", diamond_count=30))
    out.append(event(51, "a", "gift", 101, username="x"))
    out.append(event(52, "a", "like", 102, username="x", like_count=9))
    for n in range(4):
        out.append(event(60 + n, "b", "viewer_count", 10 * n, viewer_count=n))
    out.append(event(70, "c", "follow", 0, username="z"))
    return out


@pytest.fixture(scope="module")
def events(spark, data):
    return spark.createDataFrame(data, TIKTOK_LIVE_EVENTS)


@pytest.fixture(scope="module")
def landed(tmp_path_factory, events):
    """Every event delivered twice."""
    path = str(tmp_path_factory.mktemp("live") / "events")
    write_event_jsonl(events.repartition(3), path)
    write_event_jsonl(events.repartition(2), path)
    return path


def test_jsonl_round_trip_keeps_microseconds(spark, events, landed):
    assert rows(read_event_jsonl(spark, landed, TIKTOK_LIVE_EVENTS).distinct()) == rows(events)


def test_session_kpis(events):
    got = {r.session_id: r for r in session_kpis(events).collect()}
    a = got["a"]
    assert (a.peak_viewers, a.avg_viewers) == (10, 4)  # 52 / 12, NULL readings count as 0
    assert (a.total_likes, a.total_comments, a.total_gifts, a.diamond_total) == (1, 10, 2, 30)
    assert (a.duration, a.reconnections, a.total_published) == ("6m 0s", 1, 27)
    assert (a.session_date, a.session_start, a.session_end) == (
        "01 January 2024", "10:00 UTC", "10:06 UTC",
    )
    c = got["c"]
    assert (c.peak_viewers, c.avg_viewers, c.duration, c.total_follows) == (0, 0, "0m 0s", 1)
    assert c.reconnections == 0 and c.diamond_total == 0


def test_reports(events, data):
    comments = [e for e in data if e[2] == "comment"]
    want = [("a", i + 1, u, n) for i, (u, n) in enumerate(Counter(e[5] for e in comments).most_common(5))]
    got = rows(top_engagers(events).select("session_id", "rank", "username", "events"))
    assert got == want
    assert {r.comment_text for r in recent_comments(events).collect()} == {
        f"c{n}" for n in range(2, 10)
    }
    curve = rows(viewer_curve(events).select("session_id", "event_ts", "label", "viewers"))
    assert [(r[0], r[2], r[3]) for r in curve] == [
        ("a", "10:00", 3), ("a", "10:02", 0), ("a", "10:05", 10),
        ("b", "10:00", 0), ("b", "10:00", 1), ("b", "10:00", 2), ("b", "10:00", 3),
    ]
    assert rows(viewer_curve(events, split_unit="hour")) == rows(viewer_curve(events))


def test_session_report(events):
    report = session_report(events)
    assert set(report) == {
        "figures", "top_commenters", "top_likers", "recent_comments", "viewer_curve",
    }
    assert rows(report["top_likers"].select("username", "events")) == [("x", 1)]
    assert "top_likers" not in session_report(events, chat=True)


@pytest.mark.parametrize("hot_splits", [0, 8])
def test_stream_dedup(spark, tmp_path, events, landed, hot_splits):
    stream = stream_dedup(
        stream_events(spark, landed, TIKTOK_LIVE_EVENTS), hot_splits=hot_splits
    )
    out = str(tmp_path / "out")
    sink_events(stream, out, str(tmp_path / "cp"), interval=None).awaitTermination()
    assert rows(read_event_jsonl(spark, out, TIKTOK_LIVE_EVENTS)) == rows(events)


def test_stream_resumes_from_its_checkpoint(spark, tmp_path, events):
    """Files landed after a first drain are added once, earlier ones are not read again."""
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    halves = events.randomSplit([1.0, 1.0], seed=4)
    for part in halves:
        write_event_jsonl(part, source)
        stream = stream_events(spark, source, TIKTOK_LIVE_EVENTS, max_files=1)
        sink_events(stream, out, checkpoint, interval=None).awaitTermination()
    assert rows(read_event_jsonl(spark, out, TIKTOK_LIVE_EVENTS)) == rows(events)


def test_kpis_stream_over_several_batches(spark, tmp_path, events):
    """Later batches replace the figures of a session."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_event_jsonl(events.repartition(5), source)
    stream = session_kpis(stream_events(spark, source, TIKTOK_LIVE_EVENTS, max_files=1))
    upsert_batches(stream, out, str(tmp_path / "cp")).awaitTermination()
    got = latest_upserts(spark, out, stream.schema, ["session_id"])
    assert rows(got) == rows(session_kpis(events))
    assert spark.read.parquet(out).count() > got.count()


def test_windows_stream_equals_batch(spark, tmp_path, events):
    source = str(tmp_path / "in")
    write_event_jsonl(events, source)
    stream = windowed_activity(stream_events(spark, source, TIKTOK_LIVE_EVENTS))
    out = str(tmp_path / "out")
    upsert_batches(stream, out, str(tmp_path / "cp")).awaitTermination()
    keys = ["window_start", "session_id", "event_type"]
    assert rows(latest_upserts(spark, out, stream.schema, keys)) == rows(windowed_activity(events))


def test_viewer_windows(events, data):
    got = {
        (r.session_id, r.window_start): (r.peak_viewers, r.avg_viewers, r.readings)
        for r in viewer_windows(events).collect()
    }
    want = {}
    base = datetime(2024, 1, 1, 10)
    for session in "ab":
        for k in range(-4, 7):
            lo = base + timedelta(minutes=k)
            seen = [
                e[9] for e in data
                if e[2] == "viewer_count" and e[1] == session
                and lo <= e[3] < lo + timedelta(minutes=5)
            ]
            values = [v for v in seen if v is not None]
            if seen:
                mean = sum(values) // len(values) if values else None
                want[(session, lo)] = (max(values, default=None), mean, len(values))
    assert got == want


def test_activity_sessions(spark):
    data = [("u", START + timedelta(minutes=m)) for m in (0, 10, 39, 70, 200)]
    df = spark.createDataFrame(data, "user_id string, event_ts timestamp")
    got = rows(activity_sessions(df).select("session_start", "events"))
    assert [r[1] for r in got] == [3, 1, 1]


def test_late_events_are_left_out_of_closed_windows(spark, tmp_path):
    """The default watermark lets events be ten minutes late, no more."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = YOUTUBE_LIVE_EVENTS

    def land(n, minutes):
        at = datetime(2024, 1, 1, 10) + timedelta(minutes=minutes)
        row = (f"y{n}", "s", "chat_message", at, at, None, None, None, None, None, None, None)
        write_event_jsonl(spark.createDataFrame([row], schema), source)
        stream = windowed_activity(stream_events(spark, source, schema))
        sink_events(stream, out, str(tmp_path / "cp"), None, "parquet").awaitTermination()

    for n, minutes in enumerate((0, 30, 5, 60)):  # the third is 25 minutes late
        land(n, minutes)
    got = rows(spark.read.parquet(out).select("window_start", "events"))
    assert [r[0].minute for r in got] == [0, 30]


def test_normalize_stream_equals_batch(spark, tmp_path, events, landed):
    stream = normalize_live_events(stream_events(spark, landed, TIKTOK_LIVE_EVENTS))
    out = str(tmp_path / "out")
    sink_events(stream, out, str(tmp_path / "cp"), None, "parquet").awaitTermination()
    batch = normalize_live_events(events.unionByName(events))
    assert rows(first_deliveries(spark.read.parquet(out))) == rows(batch)


def test_earliest_delivery_wins_whatever_the_order(spark, tmp_path):
    """The copy ingested just before midnight lands last, and an hour late."""
    late, early = datetime(2024, 1, 2, 0, 0, 2), datetime(2024, 1, 1, 23, 59, 59)
    names = [None] * 8
    deliveries = [
        [("e0", "a", "like", START, late, *names), ("e1", "a", "like", START + timedelta(hours=2), late, *names)],
        [("e0", "a", "like", START, early, *names), ("e2", "a", "like", START + timedelta(minutes=5), late, *names)],
    ]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in deliveries:
        write_event_jsonl(spark.createDataFrame(part, TIKTOK_LIVE_EVENTS).coalesce(1), source)
    stream = normalize_live_events(stream_events(spark, source, TIKTOK_LIVE_EVENTS, max_files=1))
    sink_events(stream, out, str(tmp_path / "cp"), None, "parquet").awaitTermination()
    got = {r.event_id: r for r in first_deliveries(spark.read.parquet(out)).collect()}
    assert set(got) == {"e0", "e1", "e2"}
    assert (str(got["e0"].event_date), got["e0"].event_hour) == ("2024-01-01", 23)


def test_latest_upserts_leaves_the_schema_alone(spark, tmp_path, events, landed):
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    stream = windowed_activity(stream_events(spark, landed, TIKTOK_LIVE_EVENTS))
    upsert_batches(stream, out, cp).awaitTermination()
    schema, keys = stream.schema, ["window_start", "session_id", "event_type"]
    first = rows(latest_upserts(spark, out, schema, keys))
    assert rows(latest_upserts(spark, out, schema, keys)) == first and "batch_id" not in schema.names
