"""Sessions that close, flushes of bounded size, upserts that are merged."""

import math
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tallyloom.sources import sink_events, write_event_jsonl
from tallyloom.sources.schemas import TIKTOK_LIVE_EVENTS, YOUTUBE_LIVE_EVENTS
from tallyloom.sources.versions import current_version
from tallyloom.streaming import (
    closing_event,
    closing_sessions,
    latest_upserts,
    merge_sessions,
    session_kpis,
    stream_events,
    upsert_batches,
    windowed_activity,
)
from tests.conftest import rows

START = datetime(2024, 1, 1, 10)


def event(n, session, kind, minutes, **fields):
    at = START + timedelta(minutes=minutes)
    names = ["username", "user_id", "comment_text", "like_count", "viewer_count", "gift_name", "diamond_count", "room_id"]
    return (f"e{n}", session, kind, at, at, *[fields.get(f) for f in names])


class Live:
    """A folder of events, and the sessions that a stream over it has closed so far."""

    def __init__(self, spark, path, schema=TIKTOK_LIVE_EVENTS, **options):
        self.spark, self.path, self.schema, self.options = spark, path, schema, options
        self.all = []

    def add(self, *events):
        self.all += events
        write_event_jsonl(self.spark.createDataFrame(events, self.schema), f"{self.path}/in")
        return self.run()

    def run(self):
        stream = closing_sessions(stream_events(self.spark, f"{self.path}/in", self.schema), **self.options)
        query = sink_events(stream, f"{self.path}/out", f"{self.path}/cp", None, "parquet")
        query.awaitTermination()
        self.state = query.lastProgress["stateOperators"][0]["numRowsTotal"]
        return {r.session_id: r for r in self.closed().collect()}

    def closed(self):
        return self.spark.read.parquet(f"{self.path}/out")

    def batch(self):
        return self.spark.createDataFrame(self.all, self.schema)


def test_sessions_close_once(spark, tmp_path):
    live = Live(spark, str(tmp_path))
    got = live.add(
        event(0, "ended", "connect", 0), event(1, "ended", "viewer_count", 1, viewer_count=7),
        event(2, "ended", "gift", 2, diamond_count=5), event(3, "ended", "live_end", 3),
        event(4, "quiet", "connect", 1), event(5, "quiet", "like", 4),
        event(6, None, "like", 4),
    )
    assert got == {} and live.state == 2
    # Twelve minutes later: the end event closes its session, the quiet one may still go on.
    got = live.add(event(7, "open", "connect", 16), event(8, "open", "live_end", 17), event(9, "open", "like", 18))
    assert set(got) == {"ended"} and got["ended"].closed_by == "end" and live.state == 2
    # A gap closes the quiet session; what follows an end event keeps its session open.
    got = live.add(event(10, "open", "comment", 46))
    assert set(got) == {"ended", "quiet"} and got["quiet"].closed_by == "gap" and live.state == 1
    got = live.add(event(11, None, "like", 500))
    assert set(got) == {"ended", "quiet", "open"} and live.state == 0
    closed = live.closed()
    assert closed.count() == 3
    wanted = session_kpis(live.batch().where("session_id is not null"))
    assert rows(closed.select(wanted.columns)) == rows(wanted) == rows(merge_sessions(closed))


def test_late_sessions(spark, tmp_path):
    """A whole session that arrives late is counted; one that comes back is added up."""
    live = Live(spark, str(tmp_path))
    live.add(event(0, "a", "like", 0))
    got = live.add(event(1, "b", "like", 300))
    assert set(got) == {"a"}
    got = live.add(event(2, "late", "comment", 100), event(3, "late", "live_end", 101), event(4, "a", "gift", 20, diamond_count=3))
    got = live.add(event(5, None, "like", 301))
    assert set(got) == {"a", "late"} and live.closed().count() == 3
    live.add(event(6, None, "like", 900))
    assert live.state == 0
    merged = merge_sessions(live.closed())
    assert rows(merged) == rows(session_kpis(live.batch().where("session_id is not null")))


def test_other_columns(spark, tmp_path):
    """Events of the other platform have no diamonds, but a video; a null time counts for nothing."""
    def chat(n, session, kind, minutes):
        at = None if minutes is None else START + timedelta(minutes=minutes)
        return (f"y{n}", session, kind, at, at, "u", "1", "hi", 4 if kind == "viewer_count" else None, None, "v1", "c")

    live = Live(spark, str(tmp_path), YOUTUBE_LIVE_EVENTS, end_event="stream_end", gap="5 minutes")
    got = live.add(chat(0, "s", "viewer_count", 0), chat(1, "s", "chat_message", 1), chat(2, "s", "chat_message", None), chat(3, None, "like", 60))
    timed = live.batch().where("session_id is not null and event_ts is not null")
    assert rows(merge_sessions(live.closed())) == rows(session_kpis(timed)) and got["s"].closed_by == "gap"


def test_closing_event_closes_all(spark, tmp_path):
    live = Live(spark, str(tmp_path))
    events = [event(i, f"s{i % 7}", "like" if i % 3 else "gift", i, diamond_count=i) for i in range(60)]
    live.add(*events)
    write_event_jsonl(closing_event(live.batch(), "3 days"), f"{tmp_path}/in")
    live.run()
    closed = live.closed()
    assert live.state == 0 and closed.count() == 7
    assert rows(merge_sessions(closed)) == rows(session_kpis(live.batch()))


def test_flushes_are_bounded(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    events = spark.createDataFrame([event(i, "s", "like", i) for i in range(1_050)], TIKTOK_LIVE_EVENTS)
    write_event_jsonl(events.coalesce(1), source)
    sink_events(stream_events(spark, source, TIKTOK_LIVE_EVENTS), out, str(tmp_path / "cp"), None, max_rows=200).awaitTermination()
    landed = spark.read.schema(TIKTOK_LIVE_EVENTS).json(out)
    assert rows(landed) == rows(events)
    sizes = [r["count"] for r in landed.groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) == 200 and len(sizes) == 6


def test_upserts_are_merged(spark, tmp_path):
    """Folders stay few, the result is that of all batches, and a batch that runs again changes nothing."""
    source, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    keys = ["window_start", "session_id", "event_type"]
    events = []
    for n in range(13):
        part = [event(10 * n + i, f"s{i % 2}", "like", n // 3 + i) for i in range(4)]
        events += part
        write_event_jsonl(spark.createDataFrame(part, TIKTOK_LIVE_EVENTS).coalesce(1), source)
    stream = windowed_activity(stream_events(spark, source, TIKTOK_LIVE_EVENTS, max_files=1))
    upsert_batches(stream, out, cp, keys=keys).awaitTermination()
    version = current_version(spark, out)
    done = version.notes["last"] + 1
    assert done >= 13 and len(version.parts) == bin(sum(n for _, n in version.notes["runs"])).count("1")
    assert len(version.parts) <= math.log2(done) + 1
    want = rows(windowed_activity(spark.createDataFrame(events, TIKTOK_LIVE_EVENTS)))
    assert rows(latest_upserts(spark, out, stream.schema, keys)) == want
    # The same batches once more, as after a lost checkpoint: numbers that are in are not written again.
    upsert_batches(stream, out, str(tmp_path / "cp2"), keys=keys).awaitTermination()
    assert current_version(spark, out).number == version.number
    assert rows(latest_upserts(spark, out, stream.schema, keys)) == want
