"""Inputs that must not lose rows without a word, and the daily and live jobs on a first day."""

import json
from datetime import datetime, timedelta

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

import run_daily
import run_live
from tallyloom.plans.landing import land_batch
from tallyloom.sources import read_metric_csvs, read_payloads, read_sources, write_event_jsonl
from tallyloom.sources import schemas as S
from tallyloom.sources.payloads import flatten_channel, flatten_feed
from tests.conftest import rows

POSTS = "Date: 2024-01-0{} 10:00:00 UTC\nLike(s): {}\nSound: s{}\n\n"
FOLLOWERS = "Date: 2024-01-0{} 10:00:00 UTC\nUsername: u{}\n\n"


def exports(folder, end):
    folder.mkdir(parents=True)
    posts = "".join(POSTS.format(n, n, n) for n in (1, 2, 3))
    followers = "".join(FOLLOWERS.format(n, n) for n in (1, 2, 3))
    for name, text in (("Posts.txt", posts), ("Follower.txt", followers)):
        (folder / name).write_bytes(text.replace("\n", end).encode())


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_any_line_end_lands_all_blocks(spark, tmp_path, end, newline):
    exports(tmp_path / "in/tiktok", end)
    outcome = land_batch(spark, str(tmp_path / "in"), str(tmp_path / "raw"), newline=newline)
    assert outcome["tiktok_posts"] == outcome["tiktok_followers"] == "appended"
    raw = read_sources(spark, str(tmp_path / "raw"), ["tiktok_posts", "tiktok_followers"])
    assert {r.likes_raw for r in raw["tiktok_posts"].collect()} == {"1", "2", "3"}
    assert {r.username for r in raw["tiktok_followers"].collect()} == {"u1", "u2", "u3"}


def test_unreadable_date_of_a_reading_fails(spark, tmp_path):
    head = 'sep=,\r\n"Page"\r\n"Date","Primary"\r\n'
    (tmp_path / "Views.csv").write_bytes((head + "13/01/2024,5\r\n2024-01-02,6\r\n").encode("utf-16"))
    with pytest.raises(PySparkException, match="no date in a metric file"):
        read_metric_csvs(spark, str(tmp_path)).collect()


def test_truncated_page_fails(spark, tmp_path):
    page = json.dumps({"items": [{"id": "c1"}, {"id": "c2"}]})
    (tmp_path / "whole.json").write_text(page)
    got = flatten_channel(read_payloads(spark, str(tmp_path), S.CHANNEL_PAYLOAD))
    assert {r.channel_id for r in got.collect()} == {"c1", "c2"}
    (tmp_path / "broken.json").write_text(page[:-5])
    with pytest.raises((PySparkException, Py4JJavaError)):
        flatten_channel(read_payloads(spark, str(tmp_path), S.CHANNEL_PAYLOAD)).collect()


def test_feed_keeps_whole_texts(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"data": [{"id": "1", "message": "m" * 2_000}]}))
    feed = read_payloads(spark, str(tmp_path), S.FEED_PAYLOAD)
    assert len(flatten_feed(feed).first().message) == 2_000
    assert len(flatten_feed(feed, max_chars=500).first().message) == 500


def test_daily_run_with_one_source(spark, tmp_path):
    exports(tmp_path / "in/tiktok", "\n")
    listed = tmp_path / "in/youtube/playlist"
    listed.mkdir(parents=True)
    (listed / "p.json").write_text(json.dumps({"items": [{"contentDetails": {"videoId": "v1"}}]}))
    marts = str(tmp_path / "marts")
    code = run_daily.main(str(tmp_path / "in"), str(tmp_path / "raw"), marts)
    checks = spark.read.parquet(f"{marts}/_checks")
    assert code in (0, 1) and checks.where("check = 'row_count >= 1'").count() == len(S.RAW_TABLES) + 1
    assert spark.read.parquet(f"{marts}/_inputs").where("present").count() == 2
    assert rows(spark.read.parquet(f"{marts}/_missing_videos")) == [("v1",)]
    assert spark.read.parquet(f"{marts}/mart_tiktok_followers").count() > 0
    without = {r.table for r in spark.read.parquet(f"{marts}/_mart_rows").where("status = 'WARN'").collect()}
    assert "mart_facebook_posts" in without and "mart_tiktok_followers" not in without


def test_live_run_lands_late_events_and_reports(spark, tmp_path):
    start, none = datetime(2024, 1, 1, 10), [None] * 6
    source, raw, reports = (str(tmp_path / x) for x in ("in", "raw", "reports"))

    def land(*events):
        made = [
            (f"e{n}", "a", "comment", start + timedelta(minutes=m), start + timedelta(minutes=at), "u", *none, "1")
            for n, m, at in events
        ]
        write_event_jsonl(spark.createDataFrame(made, S.TIKTOK_LIVE_EVENTS).coalesce(1), source)

    land((0, 0, 0), (1, 120, 120))
    assert run_live.main(source, raw, reports)["figures"].first().total_comments == 2
    land((2, 5, 200), (1, 120, 119))  # an hour late, and an earlier copy
    frames = run_live.main(source, raw, reports)
    assert frames["figures"].first().total_comments == 3
    assert {r.event_id for r in frames["stg_tiktok_livestream"].collect()} == {"e0", "e1", "e2"}
    assert frames["recent_comments"].count() == 3
