import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyloom import sources as src
from tallyloom.operators import check_inputs_present
from tallyloom.plans.landing import BATCH, land_batch
from tallyloom.plans.refresh import refresh_marts
from tallyloom.sources import schemas as S
from tallyloom.sources.exports import LIVE_COMMENTS_DELIMITER, LIVE_HISTORY_DELIMITER
from tests.conftest import rows

AT = datetime(2024, 5, 1, 6)

HISTORY = """LIVE duration: 2024-01-01 10:00:00 UTC - 2024-01-01 10:30:00 UTC (30 minutes)
Room Id: 11
LIVE title: Morning
Total view: 1,234
Total gifter: N/A
Total likes received: 56
------------
Room Id: 12
LIVE title: no duration
------------

------------
LIVE duration: x
Room Id:  13\t
"""


def at():
    return F.lit(AT)


def write(path, text, newline="\n"):
    path.write_bytes(text.replace("\n", newline).encode())
    return str(path)


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_live_history(spark, tmp_path, newline):
    path = write(tmp_path / "h.txt", HISTORY, newline)
    blocks = src.read_blocks_delim(spark, path, LIVE_HISTORY_DELIMITER)
    assert blocks.count() == 3
    span = "2024-01-01 10:00:00 UTC - 2024-01-01 10:30:00 UTC (30 minutes)"
    assert rows(src.parse_live_history(blocks, at())) == [
        ("11", "Morning", span, "1,234", "N/A", "56", AT),
        ("13", None, "x", None, None, None, AT),
    ]


def test_live_comments(spark, tmp_path):
    sep = "\n" + LIVE_COMMENTS_DELIMITER + "\n"
    text = sep.join(
        [
            "Room ID: 1\nComment Time: 2024-01-01 10:00:00 UTC\nComment: hello there",
            "Room ID: 2\nComment Time: 2024-01-01 10:00:01 UTC",
            "Comment: alone",
            "Room ID: 4\nComment:    ",
        ]
    )
    blocks = src.read_blocks_delim(spark, write(tmp_path / "c.txt", text), LIVE_COMMENTS_DELIMITER)
    assert rows(src.parse_live_comments(blocks, at())) == [
        ("1", "2024-01-01 10:00:00 UTC", "hello there", AT), (None, None, "alone", AT),
    ]


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_posts(spark, tmp_path, newline):
    text = (
        "\n\nDate: 2024-01-01 10:00:00 UTC\nLike(s): 12\nSound: a\n\nTitle: after a blank line"
        "\n\nDate: 2024-01-02 10:00:00 UTC\nWho can view: Friends\nLocation: Here\n"
    )
    path = write(tmp_path / "p.txt", text, newline)
    blocks = src.read_blocks_lookahead(spark, path, "Date:", newline=newline)
    assert rows(src.parse_posts(blocks, at())) == [
        ("2024-01-01 10:00:00 UTC", "12", None, "a", None, "after a blank line", AT),
        ("2024-01-02 10:00:00 UTC", None, "Friends", None, "Here", None, AT),
    ]


def test_preamble_before_first_header_is_no_post(spark, tmp_path):
    path = write(tmp_path / "p.txt", "Your posts\n\nDate: 2024-01-01 10:00:00 UTC\nSound: s")
    blocks = src.read_blocks_lookahead(spark, path, "Date:")
    assert [r.date_raw for r in src.parse_posts(blocks).collect()] == ["2024-01-01 10:00:00 UTC"]


def test_watch_history(spark, tmp_path):
    text = (
        "Date and time: 2024-01-01 10:00:00\nLink: http://x/1\n[2024-01-01 10:00:05] hi\nnoise\n"
        "[2024-01-01 10:00:09] you\nDate and time: 2024-01-02 10:00:00\nLink: http://x/2\n"
    )
    path = write(tmp_path / "w.txt", text)
    blocks = src.read_blocks_lookahead(spark, path, "Date and time:", blank_lines=0)
    assert rows(src.parse_watch_history(blocks, at())) == [
        (
            "2024-01-01 10:00:00", "http://x/1",
            "[2024-01-01 10:00:05] hi\n[2024-01-01 10:00:09] you", AT,
        ),
        ("2024-01-02 10:00:00", "http://x/2", None, AT),
    ]


def test_followers(spark, tmp_path):
    text = "Date: 2024-01-01 10:00:00 UTC\nUsername: a\n\nDate: 2024-01-02\n\nDate: x\nUsername: b"
    blocks = src.read_blocks_lookahead(spark, write(tmp_path / "f.txt", text), "Date:")
    assert rows(src.parse_followers(blocks, at())) == [
        ("2024-01-01 10:00:00 UTC", "a", AT), ("x", "b", AT),
    ]


def test_one_big_export_is_read_in_splits(spark, tmp_path):
    block = "Date: {}\nTitle: some words to fill the block\n\n"
    path = write(tmp_path / "big.txt", "".join(block.format(n) for n in range(20000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        posts = src.parse_posts(src.read_blocks_lookahead(spark, path, "Date:"))
        assert posts.rdd.getNumPartitions() > 8
        assert posts.select("date_raw").distinct().count() == posts.count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("encoding,order", [("utf-16", None), ("utf-16-le", "LE"), ("utf-16-be", "BE")])
def test_metric_csvs(spark, tmp_path, encoding, order):
    head = 'sep=,\r\n"Page"\r\n"Date","Primary"\r\n'
    views = head + '"2024-01-01T00:00:00","5"\r\n"2024-01-02T00:00:00","x"\r\n'
    (tmp_path / "Views.csv").write_bytes(views.encode(encoding))
    (tmp_path / "Link clicks.csv").write_bytes(
        (head + "2024-01-03T00:00:00,7.9\r\n").encode(encoding)
    )
    (tmp_path / "Other.csv").write_bytes((head + "2024-01-03T00:00:00,1\r\n").encode(encoding))
    got = src.read_metric_csvs(spark, str(tmp_path), ingested_at=at(), byte_order=order)
    assert rows(got) == [
        (date(2024, 1, 1), 5, "page_views", AT),
        (date(2024, 1, 2), 0, "page_views", AT),
        (date(2024, 1, 3), 7, "page_link_clicks", AT),
    ]


def payload(spark, tmp_path, schema, *pages):
    path = tmp_path / "payload"
    path.mkdir()
    (path / "p.json").write_text("\n".join(json.dumps(p) for p in pages))
    return src.read_payloads(spark, str(path), schema)


def test_insights_payload(spark, tmp_path):
    page = {
        "data": [
            {"name": "m", "values": [
                {"value": 5, "end_time": "2024-01-01T08:00:00+0000"},
                {"value": {"like": 3}, "end_time": "2024-01-02T08:00:00+0000"},
            ]},
            {"name": "empty", "values": []},
        ]
    }
    got = src.flatten_insights(payload(spark, tmp_path, S.INSIGHTS_PAYLOAD, page), at())
    flat = rows(got)
    assert [(r[0], r[1], r[3]) for r in flat] == [("m", "2024-01-01", AT), ("m", "2024-01-02", AT)]
    assert flat[0][2] == "5" and json.loads(flat[1][2]) == {"like": 3}


def test_feed_payload(spark, tmp_path):
    long = "x" * 700
    page = {"data": [
        {"id": "1", "message": long, "created_time": "2024-01-01T00:00:00",
         "attachments": {"data": [{"type": "photo"}, {"type": "album"}]}},
        {"id": "2", "story": "told", "created_time": "2024-01-02T00:00:00",
         "attachments": {"data": []}},
        {"id": "3", "created_time": "2024-01-03T00:00:00"},
    ], "paging": {"next": "u"}}
    got = src.flatten_feed(payload(spark, tmp_path, S.FEED_PAYLOAD, page, {"data": []}), at())
    assert rows(got) == [
        ("1", long, "2024-01-01", "photo", AT), ("2", "told", "2024-01-02", None, AT),
        ("3", "", "2024-01-03", None, AT),
    ]


def test_video_and_channel_payloads(spark, tmp_path):
    page = {"items": [
        {"id": "v1", "snippet": {"title": "t", "publishedAt": "2024-01-01T00:00:00Z",
                                 "tags": ["a", "b"]},
         "statistics": {"viewCount": "9"}, "contentDetails": {"duration": "PT1M5S"}},
        {"id": "v2", "snippet": {"publishedAt": "2024-01-02T00:00:00Z", "tags": []}},
    ]}
    got = src.flatten_videos(payload(spark, tmp_path, S.VIDEOS_PAYLOAD, page), at())
    assert rows(got.select(
        "video_id", "title", "published_at", "view_count", "like_count", "duration_seconds", "tags_raw"
    )) == [
        ("v1", "t", "2024-01-01", "9", "0", 65, "a,b"),
        ("v2", None, "2024-01-02", "0", "0", None, None),
    ]
    landed = spark.createDataFrame([], S.RAW_TABLES["youtube_videos"]).columns
    assert {*got.columns, "row_key"} == set(landed)
    other = tmp_path / "channel"
    other.mkdir()
    items = {"items": [{"id": "c", "snippet": {"title": "T"}, "statistics": {"viewCount": "1"}}]}
    channel = src.flatten_channel(payload(spark, other, S.CHANNEL_PAYLOAD, items), at())
    assert rows(channel) == [("c", "T", None, "1", None, AT)]


def test_append_skips_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1,)], "i int")
    assert src.append_raw(df, path) and src.append_raw(df, path)
    assert not src.append_raw(df.where("i > 5"), path)
    assert spark.read.parquet(path).count() == 2


def test_inputs_present(spark, tmp_path):
    (tmp_path / "Posts.txt").write_text("x")
    (tmp_path / "Link clicks.csv").write_text("x")
    got = check_inputs_present(spark, str(tmp_path), ["Posts.txt", "Link clicks.csv", "Gone.txt"])
    assert rows(got) == [
        ("Gone.txt", False, "WARN"), ("Link clicks.csv", True, "PASS"), ("Posts.txt", True, "PASS"),
    ]


def test_bad_event_line_fails(spark, tmp_path):
    (tmp_path / "e.jsonl").write_text('{"event_id": "1"}\nnot json\n')
    with pytest.raises(Exception):
        src.read_event_jsonl(spark, str(tmp_path), S.TIKTOK_LIVE_EVENTS).collect()


def test_land_batch_tolerates_missing_sources(spark, tmp_path):
    tiktok = tmp_path / "landing" / "tiktok"
    tiktok.mkdir(parents=True)
    write(tiktok / "Go_LIVE_History.txt", HISTORY)
    write(tiktok / "Posts.txt", "nothing here")
    raw = tmp_path / "raw"
    outcome = land_batch(spark, str(tmp_path / "landing"), str(raw), AT)
    assert outcome.pop("tiktok_live_history") == "appended"
    assert outcome.pop("tiktok_posts") == "empty"
    assert set(outcome.values()) == {"missing"} and len(outcome) == len(BATCH) - 2
    name = "tiktok_live_history"
    table = src.read_sources(spark, str(raw), [name])[name]
    assert table.count() == 2 and rows(table.select("ingested_at").distinct()) == [(AT,)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        src.read_sources(spark, str(raw))
    assert src.read_sources(spark, str(raw), missing="empty")["facebook"].count() == 0
    stored = refresh_marts(spark, str(raw), str(tmp_path / "marts"), missing="empty")
    assert rows(stored["mart_tiktok_live_perfomance"].select("room_id", "total_views")) == [
        ("11", 1234), ("13", None),
    ]


@pytest.fixture()
def small_splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "4096")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_large_exports_split_by_their_own_line_end(spark, tmp_path, small_splits, end):
    text = "".join(f"Date: 2024-01-01 10:00:00 UTC\nUsername: user{i}\n\n" for i in range(2_000))
    write(tmp_path / "Follower.txt", text, end)
    blocks = src.read_blocks_lookahead(spark, str(tmp_path / "Follower.txt"), "Date:")
    assert blocks.rdd.getNumPartitions() > 8
    assert {b.block.split("user")[1] for b in blocks.collect()} == {str(i) for i in range(2_000)}
    largest = blocks.select(F.spark_partition_id().alias("p")).groupBy("p").count().agg(F.max("count")).first()[0]
    assert largest < 400  # no task has the whole file


def test_files_of_several_line_ends(spark, tmp_path, small_splits):
    """Large files of every line end, a small one, and one whose line end changes on the way."""
    text = "".join(f"Date: {{0}}-{i}\nUsername: u\n\n" for i in range(800))
    for name, end in (("a", "\n"), ("b", "\r\n"), ("c", "\r")):
        write(tmp_path / f"{name}.txt", text.replace("{0}", name), end)
    write(tmp_path / "small.txt", "Date: s-0\nUsername: u\n\n", "\r\n")
    half = text.replace("{0}", "m")
    (tmp_path / "mixed.txt").write_bytes((half[:15_000] + half[15_000:].replace("\n", "\r\n")).encode())
    blocks = src.read_blocks_lookahead(spark, str(tmp_path), "Date:").collect()
    got = sorted(b.block.split("\n")[0].removeprefix("Date: ") for b in blocks)
    assert got == sorted([f"{f}-{i}" for f in "abcm" for i in range(800)] + ["s-0"])


def test_large_metric_files_of_both_byte_orders(spark, tmp_path, small_splits):
    """Files of either order split by what their mark says, through the landing job's defaults."""
    folder = tmp_path / "in/facebook/csv"
    folder.mkdir(parents=True)
    start = date(2020, 1, 1)
    days = [(start + timedelta(days=i)).isoformat() for i in range(1_000)]
    lines = "sep=,\r\n\"Page\"\r\n\"Date\",\"Primary\"\r\n" + "".join(f'"{d}","{i}"\r\n' for i, d in enumerate(days))
    (folder / "Views.csv").write_bytes(b"\xff\xfe" + lines.encode("utf-16-le"))
    (folder / "Visits.csv").write_bytes(b"\xfe\xff" + lines.encode("utf-16-be"))
    (folder / "Follows.csv").write_bytes("\"Date\",\"Primary\"\r\n2024-01-01,5\r\n".encode("utf-16"))
    read = src.read_metric_csvs(spark, str(folder), ingested_at=F.lit(datetime(2024, 1, 1)))
    assert read.rdd.getNumPartitions() > 8
    assert land_batch(spark, str(tmp_path / "in"), str(tmp_path / "raw"))["facebook_csv_insights"] == "appended"
    landed = spark.read.parquet(str(tmp_path / "raw/facebook_csv_insights"))
    want = {(m, d, i) for m in ("page_views", "page_visits") for i, d in enumerate(days)}
    assert {(r.metric_name, str(r.date), r.value) for r in landed.collect()} == want | {("page_follows_daily", "2024-01-01", 5)}
