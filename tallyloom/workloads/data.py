"""Raw tables projected from the test tables.

Each projection is one SQL text that Spark and the checking engine both run, over all
rows. They are plain scans: no joins and no shuffles. Repeated batches, sentinels,
NULLs and equal batch times are put in on purpose.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

from tallyloom.sources.schemas import KEYED_TABLES, RAW_TABLES

# Schemas of the test tables, declared so that reading one runs no job.
TABLE_SCHEMAS: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
TABLES = list(TABLE_SCHEMAS)

RAW_SQL: dict[str, str] = {
    "facebook": """
        select
            case event_type
                when 'signup' then 'page_follows'
                when 'view' then 'page_impressions_unique'
                when 'click' then 'page_views_total'
                when 'purchase' then 'page_actions_post_reactions_total'
                else case event_id % 4
                    when 0 then 'page_posts_impressions'
                    when 1 then 'page_video_views'
                    when 2 then 'page_total_actions' end
            end as METRIC,
            cast(date '2023-01-01' + cast(
                case when event_type = 'signup' then 10 + 3 * extract(day from ts)
                     else 2 * extract(day from ts) end as int) as string) as DATE,
            case
                when event_type = 'purchase' then case event_id % 5
                    when 0 then '{{}}'
                    when 1 then replace('{{^like^: ' || cast(user_id as string)
                                        || ', ^love^: None}}', '^', chr(39))
                    when 2 then '{{"like": ' || cast(user_id as string) || ', "love": '
                                || cast(event_id % 50 as string) || '}}'
                    when 3 then '7'
                    else replace('{{^love^: ' || cast(event_id % 90 as string) || '}}', '^', chr(39))
                    end
                when event_id % 17 = 0 then null
                else cast(cast(floor(value * 100) as bigint) as string)
            end as VALUE,
            cast(ts as timestamp) as ingested_at
        from {events}""",
    "facebook_posts": """
        with base as (
            select
                doc_id,
                'post_' || cast(doc_id as string) as post_id,
                case when doc_id % 11 = 0 then null else
                    case doc_id % 8
                        when 0 then 'Sunday Service Recap: '
                        when 1 then 'WE ARE LIVE now. '
                        when 2 then 'Join us for this. '
                        when 3 then 'Happy Birthday! '
                        when 4 then 'Join us live tonight. '
                        else '' end || text end as message,
                cast(date '2022-01-01' + cast(doc_id * 7 % 1000 as int) as string) as created_time,
                case doc_id % 7
                    when 0 then 'video_inline' when 1 then 'album' when 2 then 'photo'
                    when 3 then 'share' when 4 then 'native_templates' when 5 then 'note'
                    end as content_type
            from {documents})
        select post_id, message, created_time, content_type,
               timestamp '2024-01-01 00:00:00'
                   + cast(doc_id % 3 as int) * interval '1' day as ingested_at
        from base
        union all
        select post_id, message || ' (edited)', created_time, content_type,
               timestamp '2024-01-02 00:00:00'
        from base""",
    "youtube_channel": """
        select
            'ch_' || cast(c_nationkey as string) as channel_id,
            case when c_custkey % 7 = 0 then null else c_name end as channel_title,
            case when c_custkey % 29 = 0 then null
                 else cast(c_custkey * 3 + 100 as string) end as subscriber_count,
            cast(c_custkey * 1000 as string) as view_count,
            cast(c_custkey % 400 as string) as video_count,
            timestamp '2024-01-01 00:00:00'
                + cast(c_custkey % 500 as int) * interval '6' hour as ingested_at
        from {customer}""",
    "youtube_videos": """
        with base as (
            select *, case when p_partkey % 13 = 0 then 0 else p_partkey * 37 % 50000 end as views
            from {part})
        select
            'v' || cast(p_partkey as string) as video_id,
            case when p_partkey % 50 = 0 then null else p_name end as title,
            cast(date '2020-01-01' + cast(p_partkey % 1500 as int) as string) as published_at,
            cast(views as string) as view_count,
            cast(cast(floor(views / 9) as bigint) as string) as like_count,
            case when p_partkey % 31 = 0 then null
                 else cast(cast(floor(views / 70) as bigint) as string) end as comment_count,
            '0' as favorite_count,
            'PT' || cast(p_size as string) || 'M' || cast(p_partkey % 60 as string) || 'S'
                as duration_raw,
            case when p_partkey % 9 = 0 then null
                 else cast(p_size * 97 + p_partkey % 60 as bigint) end as duration_seconds,
            case when p_partkey % 3 = 0 then 'false' when p_partkey % 3 = 1 then 'TRUE' end
                as caption,
            case when p_partkey % 4 = 0 then 'HD' when p_partkey % 4 = 1 then 'sd' end
                as definition,
            case when p_partkey % 6 = 0 then 'LIVE' when p_partkey % 6 < 4 then 'none' end
                as live_broadcast_content,
            cast(p_size as string) as category_id,
            case when p_partkey % 5 = 0 then 'en' end as default_language,
            case when p_partkey % 2 = 0 then lower(p_type) || ',' || lower(p_brand) end
                as tags_raw,
            timestamp '2024-01-01 00:00:00'
                + cast(p_partkey % 3 as int) * interval '1' day as ingested_at
        from base
        union all
        select
            'v' || cast(p_partkey as string), p_name,
            cast(date '2020-01-01' + cast(p_partkey % 1500 as int) as string),
            cast(views + 500 as string),
            cast(cast(floor(views / 8) as bigint) as string),
            cast(cast(floor(views / 60) as bigint) as string),
            '1',
            'PT' || cast(p_size as string) || 'M' || cast(p_partkey % 60 as string) || 'S',
            cast(p_size * 97 + p_partkey % 60 as bigint),
            'false', 'hd', 'none', cast(p_size as string), null, lower(p_type),
            timestamp '2024-01-02 00:00:00'
        from base""",
    "youtube_comments": """
        select
            'v' || cast(l_partkey as string) as video_id,
            case when l_linenumber = 7 then null
                 else 'author ' || cast(l_suppkey as string) end as author,
            case when l_orderkey % 41 = 0 then null
                 else l_returnflag || l_linestatus || cast(l_orderkey as string) end as comment,
            case when l_orderkey % 19 = 0 then null
                 else cast(l_quantity as bigint) end as like_count,
            cast(cast(l_shipdate as date) as string) as published_at,
            timestamp '2024-01-01 00:00:00'
                + cast(l_orderkey % 100000 as int) * interval '1' second as ingested_at
        from {lineitem}""",
    "tiktok_followers": """
        select
            cast(cast(o_orderdate as timestamp)
                + cast(o_orderkey % 3 as int) * interval '1' hour as string) || ' UTC'
                as followed_at_raw,
            case when o_custkey % 97 = 0 then null
                 else 'user_' || cast(o_custkey as string) end as username,
            timestamp '2024-01-01 00:00:00'
                + cast(o_orderkey % 100000 as int) * interval '1' second as ingested_at
        from {orders}""",
    "tiktok_live_history": """
        with base as (
            select
                cast(o_orderkey as string) as room_id,
                case when o_orderkey % 10 = 0 then 'N/A' else o_orderpriority end as title,
                cast(o_orderdate as timestamp)
                    + cast(o_orderkey % 1440 as int) * interval '1' minute as started,
                cast(o_custkey % 150 as int) as mins,
                case when o_orderkey % 23 = 0 then 0 else o_orderkey * 17 % 20000 end as views,
                o_custkey % 900 as likes
            from {orders}),
        texts as (
            select room_id, title,
                   cast(started as string) || ' UTC - '
                       || cast(started + mins * interval '1' minute as string)
                       || ' UTC (' || cast(mins as string)
                       || case when mins = 1 then ' minute)' else ' minutes)' end as span,
                   case when views >= 1000
                        then cast(cast(floor(views / 1000) as bigint) as string) || ','
                             || lpad(cast(views % 1000 as string), 3, '0')
                        else cast(views as string) end as view_text,
                   views, likes, mins
            from base)
        select room_id, title as live_title_raw, span as duration_raw,
               view_text as total_view_raw,
               case when views % 7 = 0 then 'N/A' else cast(likes % 40 as string) end
                   as total_gifter_raw,
               cast(likes as string) as total_likes_raw,
               timestamp '2024-01-01 00:00:00' + mins * interval '1' minute as ingested_at
        from texts
        union all
        select room_id, title || ' (again)', span, view_text, null,
               case when likes % 11 = 0 then 'N/A' else cast(likes + 5 as string) end,
               timestamp '2024-01-01 01:00:00'
        from texts""",
    "tiktok_live_comments": """
        select
            cast(conv_id as string) as room_id,
            cast(timestamp '2024-01-01 00:00:00'
                + cast(conv_id * 10 + turn as int) * interval '1' minute as string) || ' UTC'
                as comment_time_raw,
            text as comment_text,
            timestamp '2024-02-01 00:00:00' as ingested_at
        from {conversations}""",
    "tiktok_posts": """
        select
            cast(cast(l_shipdate as timestamp)
                + cast(l_partkey % 24 as int) * interval '1' hour as string) || ' UTC' as date_raw,
            case when l_orderkey % 12 = 0 then 'N/A'
                 else cast(l_orderkey * l_linenumber % 6000 as string) end as likes_raw,
            case when l_linenumber = 1 then 'N/A' else 'Everyone' end as visibility_raw,
            case when l_suppkey % 15 = 0 then 'N/A'
                 else 'sound ' || cast(l_suppkey as string) end as sound_raw,
            case when l_tax > 0.04 then 'N/A' else l_returnflag end as location_raw,
            l_linestatus || ' ' || cast(l_partkey as string) as title_raw,
            timestamp '2024-01-01 00:00:00'
                + cast(l_orderkey % 50 as int) * interval '1' hour as ingested_at
        from {lineitem}""",
    "tiktok_watch_live_history": """
        with base as (
            select
                cast(date_trunc('second', cast(ts as timestamp)) as string) as watched,
                case when user_id % 9 = 0 then ''
                     else 'https://live.example.com/' || cast(user_id as string) end as link,
                event_id, props
            from {events})
        select watched as watched_at_raw, link as link_raw,
               case when event_id % 4 = 0 then null
                    else repeat('[' || watched || '] ' || props || chr(10),
                                cast(event_id % 4 as int)) end as raw_comments_blob,
               timestamp '2024-02-01 00:00:00' as ingested_at
        from base
        union all
        select watched, link, '[' || watched || '] late', timestamp '2024-02-02 00:00:00'
                   - cast(event_id % 3 as int) * interval '1' day
        from base""",
    "raw_tiktok_live_events": """
        with base as (
            select
                'e' || cast(event_id as string) as event_id,
                'live_' || cast(cast(ts as date) as string) as session_id,
                case event_type
                    when 'view' then 'viewer_count'
                    when 'click' then 'like'
                    when 'purchase' then 'gift'
                    when 'signup' then 'follow'
                    else case event_id % 6 when 0 then 'share' when 1 then 'connect'
                         when 2 then 'live_end' else 'comment' end
                end as event_type,
                cast(ts as timestamp) as event_ts,
                case when event_type = 'view' or user_id % 13 = 0 then null
                     when user_id % 17 = 0 then '  '
                     else ' u' || cast(user_id as string) end as username,
                case when event_type = 'view' then null
                     else cast(user_id as string) end as user_id,
                case when event_type <> 'error' or event_id % 6 < 3 then null
                     when event_id % 7 = 0 then '   '
                     else 'says ' || props || ' ' end as comment_text,
                case when event_type = 'click' then cast(user_id % 5 + 1 as bigint) end
                    as like_count,
                case when event_type = 'view' then cast(floor(value * 10) as bigint) end
                    as viewer_count,
                case when event_type = 'purchase'
                     then 'gift ' || cast(event_id % 9 as string) end as gift_name,
                case when event_type = 'purchase' and event_id % 8 <> 0
                     then cast(floor(value) as bigint) end as diamond_count,
                case when event_type = 'error' and event_id % 6 = 1
                     then 'room ' || cast(user_id as string) end as room_id
            from {events})
        select event_id, session_id, event_type, event_ts, event_ts as ingested_at, username,
               user_id, comment_text, like_count, viewer_count, gift_name, diamond_count, room_id
        from base
        union all
        select event_id, session_id, event_type, event_ts, event_ts + interval '3' second,
               username, user_id, comment_text, like_count, viewer_count, gift_name,
               diamond_count, room_id
        from base""",
    "raw_youtube_live_events": """
        select
            'y' || cast(event_id as string) as event_id,
            'stream_' || cast(cast(ts as date) as string) as session_id,
            case event_type when 'view' then 'viewer_count' when 'signup' then 'stream_start'
                 else 'chat_message' end as event_type,
            cast(ts as timestamp) as event_ts,
            cast(ts as timestamp) as ingested_at,
            case when event_type in ('view', 'signup') then null
                 when user_id % 13 = 0 then null
                 else 'viewer ' || cast(user_id as string) end as username,
            case when event_type in ('view', 'signup') then null
                 else cast(user_id as string) end as user_id,
            case when event_type in ('view', 'signup') then null else props end as comment_text,
            case when event_type = 'view' then cast(floor(value * 10) as bigint) end
                as viewer_count,
            cast(null as bigint) as like_count,
            'video_' || cast(cast(ts as date) as string) as video_id,
            'chat_' || cast(cast(ts as date) as string) as live_chat_id
        from {events}""",
}


# Columns of the row key, in the order in which the projection has them.
KEYED = {
    name: [c.split()[0] for c in RAW_TABLES[name].split(", ") if c.split()[0] not in ("ingested_at", "row_key")]
    for name in KEYED_TABLES
}


def raw_sql(name: str) -> str:
    """The projection, with a row key where the raw table has one."""
    if name not in KEYED:
        return RAW_SQL[name]
    values = ", ".join(f"coalesce(cast({c} as string), '~')" for c in KEYED[name])
    return f"select *, md5(concat_ws('|', {values})) as row_key from ({RAW_SQL[name]}) as landed"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def project(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run a projection whose braces name test tables."""
    names = {field for _, field, _, _ in string.Formatter().parse(sql) if field}
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in names})


def raw_frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return project(spark, sf_dir, raw_sql(name))


def raw_cte(name: str) -> str:
    """The projection as the checking engine reads it."""
    return raw_sql(name).format(**{t: t for t in TABLES})
