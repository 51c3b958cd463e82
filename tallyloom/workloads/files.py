"""Readers and sinks: test tables written as the platforms' files, then read back.

The files are written by Spark from whole tables into the session's shared scratch
folder, one new folder per run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators import check_inputs_present, count_by, mart_row_summary
from tallyloom.session import scratch_path
from tallyloom.sources import (
    append_raw,
    attach_ingested_at,
    flatten_channel,
    flatten_comments,
    flatten_feed,
    flatten_insights,
    flatten_playlist,
    flatten_videos,
    materialize_table,
    materialize_view,
    parse_followers,
    parse_live_comments,
    parse_live_history,
    parse_posts,
    parse_watch_history,
    read_blocks_delim,
    read_blocks_lookahead,
    read_event_jsonl,
    read_metric_csvs,
    read_payloads,
    read_sources,
    serialize_events,
    write_event_jsonl,
)
from tallyloom.sources import schemas as S
from tallyloom.sources.csvs import METRIC_FILES
from tallyloom.sources.exports import (
    FOLLOWERS_HEADER,
    LIVE_COMMENTS_DELIMITER,
    LIVE_HISTORY_DELIMITER,
    POSTS_HEADER,
    REQUIRED_EXPORTS,
    WATCH_HISTORY_HEADER,
)
from tallyloom.workloads.data import RAW_SQL, raw_frame, table
from tallyloom.workloads.models import over_models

QUERIES: dict[str, tuple] = {}

LANDED = "2024-03-01 06:00:00"
_STAMP = f"timestamp '{LANDED}' as ingested_at"


def query(name: str, sql: str | None):
    def register(run):
        QUERIES[name] = (run, sql)
        return run

    return register


def _at() -> Column:
    return F.lit(LANDED).cast("timestamp")


def _lines(**fields: str) -> Column:
    """``Label: value`` lines; a NULL value has no line. Keys are columns."""
    parts = [F.concat(F.lit(f"{label}: "), F.col(col)) for col, label in fields.items()]
    return F.concat_ws("\n", *parts)


def _write_blocks(df: DataFrame, block: Column, separator: str, path: str) -> str:
    df.select(block.alias("value")).write.option("lineSep", separator).text(path)
    return path


# --- text exports -------------------------------------------------------------------


@query(
    "read_blocks_delim",
    """
    select block, count(*) as blocks from (
        select regexp_replace(text, '^\\s+|\\s+$', '', 'g') as block from documents)
    where block <> '' group by block""",
)
def q_read_blocks_delim(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "blocks")
    documents = table(spark, sf_dir, "documents")
    _write_blocks(documents, F.col("text"), f"\n{LIVE_HISTORY_DELIMITER}\n", path)
    return count_by(read_blocks_delim(spark, path, LIVE_HISTORY_DELIMITER), ["block"], "blocks")


@query(
    "read_blocks_lookahead",
    """
    select 'Date: turn ' || cast(turn as varchar) || chr(10) || 'Title: '
               || regexp_replace(text, '\\s+$', '') as block, count(*) as blocks
    from conversations group by all""",
)
def q_read_blocks_lookahead(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with CR LF line ends."""
    path = scratch_path(spark, "lookahead")
    talk = table(spark, sf_dir, "conversations")
    block = F.concat(
        F.lit("Date: turn "), F.col("turn").cast("string"), F.lit("\nTitle: "), F.col("text")
    )
    _write_blocks(talk, F.replace(block, F.lit("\n"), F.lit("\r\n")), "\r\n\r\n", path)
    blocks = read_blocks_lookahead(spark, path, POSTS_HEADER, newline="\r\n")
    return count_by(blocks, ["block"], "blocks")


@query(
    "parse_live_history",
    over_models(
        ["tiktok_live_history"],
        f"""
        select room_id, live_title_raw, duration_raw, total_view_raw, total_gifter_raw,
               total_likes_raw, {_STAMP}
        from tiktok_live_history""",
    ),
)
def q_parse_live_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    block = _lines(
        duration_raw="LIVE duration", room_id="Room Id", live_title_raw="LIVE title",
        total_view_raw="Total view", total_gifter_raw="Total gifter",
        total_likes_raw="Total likes received",
    )
    path = _write_blocks(
        raw_frame(spark, sf_dir, "tiktok_live_history"), block,
        f"\n{LIVE_HISTORY_DELIMITER}\n", scratch_path(spark, "live-history"),
    )
    return parse_live_history(read_blocks_delim(spark, path, LIVE_HISTORY_DELIMITER), _at())


@query(
    "parse_live_comments",
    over_models(
        ["tiktok_live_comments"],
        f"""
        select room_id, comment_time_raw,
               regexp_replace(split_part(comment_text, chr(10), 1), '^\\s+|\\s+$', '', 'g')
                   as comment_text, {_STAMP}
        from tiktok_live_comments where split_part(comment_text, chr(10), 1) <> ''""",
    ),
)
def q_parse_live_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    block = _lines(room_id="Room ID", comment_time_raw="Comment Time", comment_text="Comment")
    path = _write_blocks(
        raw_frame(spark, sf_dir, "tiktok_live_comments"), block,
        f"\n{LIVE_COMMENTS_DELIMITER}\n", scratch_path(spark, "live-comments"),
    )
    return parse_live_comments(read_blocks_delim(spark, path, LIVE_COMMENTS_DELIMITER), _at())


@query(
    "parse_posts",
    over_models(
        ["tiktok_posts"],
        f"""
        select date_raw, likes_raw, visibility_raw, sound_raw, location_raw, title_raw, {_STAMP}
        from tiktok_posts""",
    ),
)
def q_parse_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    block = _lines(
        date_raw="Date", likes_raw="Like(s)", visibility_raw="Who can view", sound_raw="Sound",
        location_raw="Location", title_raw="Title",
    )
    posts = raw_frame(spark, sf_dir, "tiktok_posts")
    path = _write_blocks(posts, block, "\n\n", scratch_path(spark, "posts"))
    return parse_posts(read_blocks_lookahead(spark, path, POSTS_HEADER), _at())


@query(
    "parse_watch_history",
    over_models(
        ["tiktok_watch_live_history"],
        f"""
        select watched_at_raw, nullif(link_raw, '') as link_raw,
               rtrim(raw_comments_blob, chr(10)) as raw_comments_blob, {_STAMP}
        from tiktok_watch_live_history""",
    ),
)
def q_parse_watch_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.concat_ws(
        "\n", _lines(watched_at_raw="Date and time", link_raw="Link"), "raw_comments_blob"
    )
    watched = raw_frame(spark, sf_dir, "tiktok_watch_live_history")
    path = _write_blocks(watched, lines, "\n", scratch_path(spark, "watched"))
    blocks = read_blocks_lookahead(spark, path, WATCH_HISTORY_HEADER, blank_lines=0)
    return parse_watch_history(blocks, _at())


@query(
    "parse_followers",
    over_models(
        ["tiktok_followers"],
        f"""
        select followed_at_raw, username, {_STAMP}
        from tiktok_followers where username is not null""",
    ),
)
def q_parse_followers(spark: SparkSession, sf_dir: str) -> DataFrame:
    block = _lines(followed_at_raw="Date", username="Username")
    followers = raw_frame(spark, sf_dir, "tiktok_followers")
    path = _write_blocks(followers, block, "\n\n", scratch_path(spark, "followers"))
    return parse_followers(read_blocks_lookahead(spark, path, FOLLOWERS_HEADER), _at())


@query(
    "check_inputs_present",
    """
    select file, n > 0 as present, if(n > 0, 'PASS', 'WARN') as status from (
        select 'Go_LIVE_History.txt' as file, count(*) as n from orders
        union all select 'LiveStream_Comment.txt', count(*) from conversations
        union all select 'Posts.txt', count(*) from lineitem
        union all select 'Watch_LIVE_History.txt', count(*) from events
        union all select 'Follower.txt', 0)""",
)
def q_check_inputs_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four of five exports have landed."""
    root = scratch_path(spark, "exports")
    for name, source, col in (
        (REQUIRED_EXPORTS[0], "orders", "o_orderpriority"),
        (REQUIRED_EXPORTS[1], "conversations", "text"),
        (REQUIRED_EXPORTS[2], "lineitem", "l_returnflag"),
        (REQUIRED_EXPORTS[3], "events", "props"),
    ):
        table(spark, sf_dir, source).select(col).write.text(f"{root}/{name}")
    return check_inputs_present(spark, root, REQUIRED_EXPORTS)


_METRIC_OF_EVENT = """
    case event_type when 'view' then 'Views.csv' when 'signup' then 'Follows.csv'
        when 'click' then 'Link clicks.csv' when 'purchase' then 'Interactions.csv'
        else case when event_id % 2 = 0 then 'Visits.csv' else 'Viewers.csv' end end"""


_METRIC_SQL = f"""
    select cast(ts as date) as date,
           case when event_id % 9 = 0 then 0 else cast(trunc(value) as bigint) end as value,
           case {_METRIC_OF_EVENT} when 'Views.csv' then 'page_views'
               when 'Visits.csv' then 'page_visits' when 'Follows.csv' then 'page_follows_daily'
               when 'Viewers.csv' then 'page_viewers'
               when 'Interactions.csv' then 'page_interactions'
               else 'page_link_clicks' end as metric_name, {_STAMP}
    from events"""


def _write_metric_csvs(spark: SparkSession, sf_dir: str, encoding: str) -> str:
    root = scratch_path(spark, "metric-csv")
    days = table(spark, sf_dir, "events").select(
        F.expr(_METRIC_OF_EVENT).alias("file"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("day"),
        F.when(F.col("event_id") % 9 == 0, F.lit("n/a"))
        .otherwise(F.col("value").cast("string"))
        .alias("amount"),
    )
    head = spark.createDataFrame(
        [("sep=,", None), ("Page totals", None), ("Date", "Primary")], "day string, amount string"
    )
    for name in METRIC_FILES:
        rows = days.where(F.col("file") == name).select("day", "amount")
        head.unionByName(rows).write.option("encoding", encoding).csv(f"{root}/{name}")
    return root


@query("read_metric_csvs", _METRIC_SQL)
def q_read_metric_csvs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte order from the mark in each file."""
    root = _write_metric_csvs(spark, sf_dir, "UTF-16")
    return read_metric_csvs(spark, root, ingested_at=_at())


@query("read_metric_csvs_split", _METRIC_SQL)
def read_metric_csvs_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known byte order, so that large files are split."""
    root = _write_metric_csvs(spark, sf_dir, "UTF-16LE")
    return read_metric_csvs(spark, root, ingested_at=_at(), byte_order="LE")


# --- payloads -----------------------------------------------------------------------


def _write_json(df: DataFrame, payload: Column, path: str) -> str:
    """One payload page per line."""
    df.select(F.to_json(payload).alias("value")).write.text(path)
    return path


def _page(field: str, *items: Column) -> Column:
    return F.struct(F.array(*items).alias(field))


@query(
    "flatten_insights",
    f"""
    select 'page_' || event_type as METRIC, cast(cast(ts as date) as varchar) as DATE,
           cast(user_id as varchar) as VALUE, {_STAMP}
    from events
    union all
    select 'page_' || event_type, cast(cast(ts as date) + 1 as varchar), props,
           timestamp '{LANDED}'
    from events""",
)
def q_flatten_insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A number and an object as values of each metric."""
    path = scratch_path(spark, "insights")
    day = F.col("ts").cast("date")
    page = F.concat(
        F.lit('{"data": [{"name": "page_'), "event_type", F.lit('", "values": [{"end_time": "'),
        day.cast("string"), F.lit('T08:00:00+0000", "value": '), F.col("user_id").cast("string"),
        F.lit('}, {"value": '), "props", F.lit(', "end_time": "'),
        F.date_add(day, 1).cast("string"), F.lit('T08:00:00+0000"}]}]}'),
    )
    table(spark, sf_dir, "events").select(page.alias("value")).write.text(path)
    return flatten_insights(read_payloads(spark, path, S.INSIGHTS_PAYLOAD), _at())


@query(
    "flatten_feed",
    f"""
    select 'page_' || cast(doc_id as varchar) as post_id,
           case when doc_id % 7 = 6 then '' else text end as message,
           cast(date '2024-01-01' + cast(doc_id % 300 as int) as varchar) as created_time,
           case doc_id % 3 when 0 then 'photo' end as content_type, {_STAMP}
    from documents""",
)
def q_flatten_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts go in and come out."""
    path = scratch_path(spark, "feed")
    doc, text = F.col("doc_id"), F.col("text")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (doc % 300).cast("int"))
    files = F.when(
        doc % 3 == 0,
        F.struct(
            F.array(
                F.struct(F.lit("photo").alias("type")), F.struct(F.lit("album").alias("type"))
            ).alias("data")
        ),
    ).when(
        doc % 3 == 1,
        F.struct(F.array_compact(F.array(F.lit(None).cast("struct<type: string>"))).alias("data")),
    )
    post = F.struct(
        F.concat(F.lit("page_"), doc.cast("string")).alias("id"),
        F.when(doc % 7 < 5, text).alias("message"),
        F.when(doc % 7 == 5, text).alias("story"),
        F.concat(day.cast("string"), F.lit("T10:11:12+0000")).alias("created_time"),
        files.alias("attachments"),
    )
    _write_json(table(spark, sf_dir, "documents"), _page("data", post), path)
    return flatten_feed(read_payloads(spark, path, S.FEED_PAYLOAD), _at())


@query(
    "flatten_channel",
    f"""
    select prefix || cast(c_custkey as varchar) as channel_id, c_name as channel_title,
           case when c_custkey % 9 <> 0 then cast(c_custkey * 3 as varchar) end
               as subscriber_count,
           cast(c_custkey * 1000 as varchar) as view_count,
           cast(c_nationkey as varchar) as video_count, {_STAMP}
    from customer, (values ('UC'), ('other')) p(prefix)""",
)
def q_flatten_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "channel")
    key = F.col("c_custkey")

    def item(prefix: str) -> Column:
        return F.struct(
            F.concat(F.lit(prefix), key.cast("string")).alias("id"),
            F.struct(F.col("c_name").alias("title")).alias("snippet"),
            F.struct(
                F.when(key % 9 != 0, (key * 3).cast("string")).alias("subscriberCount"),
                (key * 1000).cast("string").alias("viewCount"),
                F.col("c_nationkey").cast("string").alias("videoCount"),
            ).alias("statistics"),
        )

    customers = table(spark, sf_dir, "customer")
    _write_json(customers, _page("items", item("UC"), item("other")), path)
    return flatten_channel(read_payloads(spark, path, S.CHANNEL_PAYLOAD), _at())


@query(
    "flatten_playlist",
    """
    select 'v' || cast(p_partkey as varchar) as video_id from part
    union all select 'w' || cast(p_partkey as varchar) from part""",
)
def q_flatten_playlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "playlist")

    def item(prefix: str) -> Column:
        video = F.concat(F.lit(prefix), F.col("p_partkey").cast("string"))
        return F.struct(F.struct(video.alias("videoId")).alias("contentDetails"))

    _write_json(table(spark, sf_dir, "part"), _page("items", item("v"), item("w")), path)
    return flatten_playlist(read_payloads(spark, path, S.PLAYLIST_PAYLOAD))


@query(
    "flatten_videos",
    f"""
    select 'v' || cast(p_partkey as varchar) as video_id, p_name as title,
           cast(date '2020-01-01' + cast(p_partkey % 900 as int) as varchar) as published_at,
           cast(p_partkey * 7 as varchar) as view_count,
           case when p_size % 4 = 0 then '0' else cast(p_size as varchar) end as like_count,
           '0' as comment_count, '0' as favorite_count,
           'PT' || cast(p_size as varchar) || 'M' || cast(p_partkey % 60 as varchar) || 'S'
               as duration_raw,
           p_size * 60 + p_partkey % 60 as duration_seconds, 'true' as caption,
           null::varchar as definition, 'none' as live_broadcast_content,
           cast(p_size as varchar) as category_id, null::varchar as default_language,
           case p_size % 3 when 0 then null when 1 then p_brand || ',' || p_type
                else p_type end as tags_raw, {_STAMP}
    from part""",
)
def q_flatten_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "videos")
    key, size = F.col("p_partkey"), F.col("p_size")
    day = F.date_add(F.lit("2020-01-01").cast("date"), (key % 900).cast("int"))
    tags = (
        F.when(size % 3 == 0, F.array_remove(F.array(F.lit("x")), "x"))
        .when(size % 3 == 1, F.array("p_brand", "p_type"))
        .otherwise(F.array("p_type"))
    )
    item = F.struct(
        F.concat(F.lit("v"), key.cast("string")).alias("id"),
        F.struct(
            F.col("p_name").alias("title"),
            F.concat(day.cast("string"), F.lit("T00:00:00Z")).alias("publishedAt"),
            F.lit("none").alias("liveBroadcastContent"),
            size.cast("string").alias("categoryId"),
            tags.alias("tags"),
        ).alias("snippet"),
        F.struct(
            (key * 7).cast("string").alias("viewCount"),
            F.when(size % 4 != 0, size.cast("string")).alias("likeCount"),
        ).alias("statistics"),
        F.struct(
            F.concat(
                F.lit("PT"), size.cast("string"), F.lit("M"), (key % 60).cast("string"), F.lit("S")
            ).alias("duration"),
            F.lit("true").alias("caption"),
        ).alias("contentDetails"),
    )
    _write_json(table(spark, sf_dir, "part"), _page("items", item), path)
    return flatten_videos(read_payloads(spark, path, S.VIDEOS_PAYLOAD), _at())


@query(
    "flatten_comments",
    over_models(
        ["youtube_comments"],
        f"""
        select video_id, author, comment, ifnull(like_count, 0) as like_count, published_at, {_STAMP}
        from youtube_comments""",
    ),
)
def q_flatten_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "comments")
    inner = F.struct(
        F.col("author").alias("authorDisplayName"),
        F.col("comment").alias("textDisplay"),
        F.col("like_count").alias("likeCount"),
        F.concat("published_at", F.lit("T00:00:00Z")).alias("publishedAt"),
    )
    item = F.struct(
        F.struct(
            F.col("video_id").alias("videoId"), F.struct(inner.alias("snippet")).alias("topLevelComment")
        ).alias("snippet")
    )
    _write_json(raw_frame(spark, sf_dir, "youtube_comments"), _page("items", item), path)
    return flatten_comments(read_payloads(spark, path, S.COMMENTS_PAYLOAD), _at())


# --- tables and sinks -----------------------------------------------------------------


@query(
    "attach_ingested_at",
    f"select c_custkey, c_name, {_STAMP} from customer",
)
def q_attach_ingested_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attach_ingested_at(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), _at())


@query(
    "read_sources",
    over_models(
        list(RAW_SQL),
        "\nunion all\n".join(
            f"select '{n}' as mart, count(*) as rows from {n}"
            for n in RAW_SQL if n in S.RAW_TABLES
        )
        + "\nunion all select 'facebook_csv_insights', count(*) from events",
    ),
)
def q_read_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "sources")
    for name in S.RAW_TABLES:
        if name in RAW_SQL:
            append_raw(raw_frame(spark, sf_dir, name), f"{root}/{name}")
    insights = table(spark, sf_dir, "events").select(
        F.col("ts").cast("date").alias("date"),
        F.col("user_id").alias("value"),
        F.col("event_type").alias("metric_name"),
        F.col("ts").cast("timestamp").alias("ingested_at"),
    )
    append_raw(insights, f"{root}/facebook_csv_insights")
    return mart_row_summary(read_sources(spark, root))


@query("read_event_jsonl", over_models(["raw_tiktok_live_events"], "select * from raw_tiktok_live_events"))
def q_read_event_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "jsonl")
    write_event_jsonl(raw_frame(spark, sf_dir, "raw_tiktok_live_events"), path)
    return read_event_jsonl(spark, path, S.TIKTOK_LIVE_EVENTS)


@query(
    "append_raw",
    """
    select o_orderkey, o_custkey, 1 as batch from orders
    union all select o_orderkey, o_custkey + 1, 2 from orders""",
)
def q_append_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "append")
    orders = table(spark, sf_dir, "orders")
    first = orders.select("o_orderkey", "o_custkey", F.lit(1).alias("batch"))
    second = orders.select(
        "o_orderkey", (F.col("o_custkey") + 1).alias("o_custkey"), F.lit(2).alias("batch")
    )
    append_raw(first, path)
    append_raw(second, path)
    return spark.read.schema(first.schema).parquet(path)


@query("skip_empty", "select o_orderkey, o_custkey from orders")
def skip_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty batch leaves the table as it is."""
    path = scratch_path(spark, "skip-empty")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    written = append_raw(orders, path)
    skipped = append_raw(orders.where(F.col("o_orderkey") < 0), path)
    if skipped or not written:
        raise RuntimeError("an empty batch must not be written")
    return spark.read.schema(orders.schema).parquet(path)


@query(
    "materialize_view",
    "select s_nationkey, count(*) as suppliers from supplier group by s_nationkey",
)
def q_materialize_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    materialize_view(table(spark, sf_dir, "supplier"), "stg_supplier")
    return count_by(spark.table("stg_supplier"), ["s_nationkey"], "suppliers")


@query(
    "materialize_table",
    "select o_custkey, count(*) as orders from orders group by o_custkey",
)
def q_materialize_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second refresh replaces the first."""
    path = scratch_path(spark, "mart")
    orders = table(spark, sf_dir, "orders")
    materialize_table(count_by(orders, ["o_custkey", "o_orderstatus"], "orders"), path)
    return materialize_table(count_by(orders, ["o_custkey"], "orders"), path)


@query(
    "serialize_events",
    over_models(
        ["raw_tiktok_live_events"],
        """
        select session_id as key, event_type, session_id, event_id, event_ts, viewer_count, username
        from raw_tiktok_live_events""",
    ),
)
def q_serialize_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages read back: attributes and the parsed JSON value."""
    messages = serialize_events(raw_frame(spark, sf_dir, "raw_tiktok_live_events"))
    event = F.from_json("value", S.TIKTOK_LIVE_EVENTS).alias("e")
    return messages.select("key", "attributes", event).select(
        "key",
        F.col("attributes")["event_type"].alias("event_type"),
        F.col("attributes")["session_id"].alias("session_id"),
        "e.event_id",
        "e.event_ts",
        "e.viewer_count",
        "e.username",
    )


