"""The 23 models and their data tests over the projected raw tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators import (
    check_accepted_values,
    check_expression,
    check_not_null,
    check_row_count,
    check_unique,
    mart_row_summary,
    union_all,
)
from tallyloom.plans.incremental import merge_newest, refresh_incremental
from tallyloom.plans.marts import MART_MODELS, mart_social_followers_snapshot
from tallyloom.plans.refresh import (
    SUMMARY_MARTS,
    THREADS,
    ModelFrames,
    check_mart_rows,
    check_marts,
    refresh_marts,
)
from tallyloom.plans.staging import STAGING_MODELS
from tallyloom.plans.suite import SUITE
from tallyloom.session import scratch_path
from tallyloom.sources import append_raw
from tallyloom.sources.schemas import EVENT_REQUIRED, RAW_TABLES
from tallyloom.sources.versions import read_version
from tallyloom.workloads.data import RAW_SQL, raw_cte, raw_frame

AS_OF = date(2024, 1, 1)


def rounded(x: str, digits: int) -> str:
    """Round half up on the decimal digits of a double."""
    return f"cast(round(cast(cast({x} as varchar) as decimal(38, 18)), {digits}) as double)"


def newest(keys: str, *ties: str) -> str:
    order = ", ".join(["ingested_at desc", *[f"{t} desc nulls last" for t in ties]])
    return f"row_number() over (partition by {keys} order by {order}) = 1"


def _pct(num: str, den: str, digits: int) -> str:
    return rounded(f"(cast({num} as double) / nullif({den}, 0) * 100)", digits)


def _mean(col: str) -> str:
    """Mean of a column of two decimals, rounded to two."""
    mean = f"(cast(sum(cast({col} as decimal(28, 2))) as double) / nullif(count({col}), 0))"
    return rounded(mean, 2)


def _metric(name: str) -> str:
    return f"max(metric_value) filter (where metric_name = '{name}')"


# name -> (names it reads, SQL body)
MODEL_SQL: dict[str, tuple[list[str], str]] = {
    "stg_facebook_insights": (
        ["facebook"],
        f"""
        with long as (
            select cast(DATE as date) as d, ifnull(METRIC, 'unknown') as m,
                   ifnull(VALUE, '0') as v, ingested_at
            from facebook),
        whole as (
            select d, m, cast(v as bigint) as n, ingested_at from long
            where m <> 'page_actions_post_reactions_total'
            union all
            select d, 'reaction_' || k,
                   cast(json_extract_string(
                       replace(replace(v, chr(39), '"'), 'None', 'null'), '$.' || k) as bigint),
                   ingested_at
            from long, (values ('like'), ('love')) as kinds(k)
            where m = 'page_actions_post_reactions_total')
        select d as date, m as metric_name, n as metric_value, ingested_at
        from whole qualify {newest('d, m', 'n')}""",
    ),
    "stg_facebook_posts": (
        ["facebook_posts"],
        f"""
        select post_id, ifnull(message, '') as post_message,
               cast(created_time as date) as post_date,
               ifnull(content_type, 'unknown') as content_type, ingested_at
        from facebook_posts
        qualify {newest('post_id', 'row_key')}""",
    ),
    "youtube_channel_rows": (
        ["youtube_channel"],
        """
        select channel_id, ifnull(channel_title, 'unknown') as channel_title,
               ifnull(cast(subscriber_count as bigint), 0) as subscriber_count,
               ifnull(cast(view_count as bigint), 0) as total_view_count,
               ifnull(cast(video_count as bigint), 0) as total_video_count, ingested_at
        from youtube_channel""",
    ),
    "stg_youtube_channel": (
        ["youtube_channel_rows"],
        f"""
        select * from youtube_channel_rows
        qualify {newest('channel_id', 'subscriber_count', 'total_view_count',
                        'total_video_count', 'channel_title')}""",
    ),
    "stg_youtube_videos": (
        ["youtube_videos"],
        f"""
        with typed as (
            select video_id, ifnull(title, 'unknown') as video_title,
                   cast(published_at as date) as published_at,
                   ifnull(cast(view_count as bigint), 0) as view_count,
                   ifnull(cast(like_count as bigint), 0) as like_count,
                   ifnull(cast(comment_count as bigint), 0) as comment_count,
                   ifnull(cast(favorite_count as bigint), 0) as favorite_count,
                   duration_raw, duration_seconds,
                   lower(ifnull(live_broadcast_content, 'none')) as live_broadcast_content,
                   lower(ifnull(definition, 'unknown')) as definition,
                   lower(ifnull(caption, 'false')) as caption,
                   category_id, default_language, tags_raw, ingested_at, row_key
            from youtube_videos)
        select * exclude (row_key) from typed qualify {newest('video_id', 'row_key')}""",
    ),
    "stg_youtube_comments": (
        ["youtube_comments"],
        f"""
        with typed as (
            select video_id, ifnull(author, 'anonymous') as comment_author,
                   ifnull(comment, '') as comment_text,
                   ifnull(like_count, 0) as like_count,
                   cast(published_at as date) as published_at, ingested_at, row_key
            from youtube_comments)
        select * exclude (row_key) from typed
        qualify {newest('video_id, comment_author, published_at', 'row_key')}""",
    ),
    "stg_tiktok_followers": (
        ["tiktok_followers"],
        """
        select md5(ifnull(username, '') || '|' || ifnull(followed_at_raw, '')) as follower_id,
               cast(replace(followed_at_raw, ' UTC', '') as timestamp) as followed_at,
               username, max(ingested_at) as ingested_at
        from tiktok_followers group by username, followed_at_raw""",
    ),
    "stg_tiktok_live": (
        ["tiktok_live_history"],
        f"""
        with picked as (
            select * from tiktok_live_history
            qualify {newest('room_id', 'duration_raw', 'live_title_raw', 'total_view_raw',
                            'total_gifter_raw', 'total_likes_raw')}),
        parts as (
            select *, string_split(duration_raw, ' UTC') as p from picked)
        select room_id, nullif(live_title_raw, 'N/A') as live_title,
               cast(p[1][1:10] as date) as live_date,
               cast(p[1] as timestamp) as start_time,
               cast(p[2][4:] as timestamp) as end_time,
               cast(string_split(p[3][3:], ' ')[1] as bigint) as duration_mins,
               cast(replace(nullif(total_view_raw, 'N/A'), ',', '') as bigint) as total_views,
               cast(replace(nullif(total_gifter_raw, 'N/A'), ',', '') as bigint) as total_gifters,
               cast(replace(nullif(total_likes_raw, 'N/A'), ',', '') as bigint) as total_likes,
               ingested_at
        from parts""",
    ),
    "stg_tiktok_live_comments": (
        ["tiktok_live_comments"],
        """
        select md5(ifnull(room_id, '') || '|' || ifnull(comment_time_raw, '') || '|'
                   || ifnull(comment_text, '')) as comment_id,
               room_id, cast(replace(comment_time_raw, ' UTC', '') as timestamp) as comment_time,
               comment_text, ingested_at
        from tiktok_live_comments""",
    ),
    "stg_tiktok_livestream": (
        ["raw_tiktok_live_events"],
        """
        with first_seen as (
            select event_id, event_type, nullif(trim(username), '') as username,
                   nullif(trim(comment_text), '') as content,
                   coalesce(like_count, viewer_count, diamond_count) as value,
                   session_id as stream_session_id, min(ingested_at) as ingested_at
            from raw_tiktok_live_events group by all)
        select *, cast(ingested_at as date) as event_date,
               cast(hour(ingested_at) as int) as event_hour,
               cast(dayofweek(ingested_at) + 1 as int) as day_of_week_num,
               dayname(ingested_at) as day_of_week,
               event_type = 'comment' as is_comment, event_type = 'like' as is_like,
               event_type = 'gift' as is_gift, event_type = 'viewer_count' as is_viewer_count
        from first_seen""",
    ),
    "stg_tiktok_posts": (
        ["tiktok_posts"],
        f"""
        with picked as (
            select * from tiktok_posts
            qualify {newest('date_raw, sound_raw', 'row_key')})
        select md5(ifnull(date_raw, '') || '|' || ifnull(sound_raw, '')) as post_id,
               cast(left(date_raw, 10) as date) as post_date,
               cast(left(date_raw, 19) as timestamp) as posted_at,
               case when likes_raw = 'N/A' or likes_raw is null then 0
                    else cast(likes_raw as bigint) end as likes,
               nullif(visibility_raw, 'N/A') as visibility, nullif(sound_raw, 'N/A') as sound,
               nullif(location_raw, 'N/A') as location, nullif(title_raw, 'N/A') as title,
               ingested_at
        from picked""",
    ),
    "stg_tiktok_watch_live_history": (
        ["tiktok_watch_live_history"],
        f"""
        select md5(ifnull(watched_at_raw, '') || '|' || ifnull(link_raw, '')) as watch_id,
               cast(watched_at_raw as timestamp) as watched_at, nullif(link_raw, '') as link,
               cast(len(regexp_extract_all(ifnull(raw_comments_blob, ''),
                   '\\[[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')) as bigint) as comments_sent,
               raw_comments_blob as comments_raw, ingested_at
        from tiktok_watch_live_history
        qualify {newest('watched_at_raw, link_raw', 'row_key')}""",
    ),
    "mart_facebook_insights": (
        ["stg_facebook_insights"],
        f"""
        with wide as (
            select date as d, {_metric('page_follows')} as follows,
                   {_metric('page_impressions_unique')} as seen,
                   {_metric('page_posts_impressions')} as posts,
                   {_metric('page_video_views')} as videos,
                   {_metric('page_views_total')} as pages,
                   {_metric('page_total_actions')} as actions,
                   {_metric('reaction_like')} as likes, {_metric('reaction_love')} as loves
            from stg_facebook_insights group by date),
        days as (
            select cast(unnest(generate_series(min(d), max(d), interval 1 day)) as date) as d
            from wide)
        select days.d as date, strftime(days.d, '%Y-%W') as year_week,
               strftime(days.d, '%Y-%m') as year_month, strftime(days.d, '%A') as day_of_week,
               last_value(follows ignore nulls) over (order by days.d) as total_followers,
               ifnull(seen, 0) as unique_impressions, ifnull(posts, 0) as post_impressions,
               ifnull(videos, 0) as video_views, ifnull(pages, 0) as page_views,
               ifnull(actions, 0) as total_actions, ifnull(likes, 0) as reaction_likes,
               ifnull(loves, 0) as reaction_loves,
               ifnull(likes, 0) + ifnull(loves, 0) as total_reactions
        from days left join wide using (d)""",
    ),
    "mart_facebook_metrics": (
        ["stg_facebook_insights"],
        """
        select date, strftime(date, '%Y-%W') as year_week, strftime(date, '%Y-%m') as year_month,
               dayname(date) as day_of_week, metric_name, metric_value,
               ifnull(category, 'other') as metric_category, ingested_at
        from stg_facebook_insights left join (values
            ('page_impressions_unique', 'reach'), ('page_posts_impressions', 'reach'),
            ('reaction_like', 'engagement'), ('reaction_love', 'engagement'),
            ('page_video_views', 'video'), ('page_follows', 'growth'),
            ('page_views_total', 'activity'), ('page_total_actions', 'activity'))
            as categories(name, category) on metric_name = name""",
    ),
    "mart_facebook_posts": (
        ["stg_facebook_posts"],
        """
        select post_id, post_date, strftime(post_date, '%Y-%m') as year_month,
               dayname(post_date) as day_of_week, strftime(post_date, '%Y') as year,
               post_message, content_type,
               ifnull(map_extract_value(map {'video_inline': 'video', 'album': 'album',
                   'photo': 'photo', 'share': 'share', 'native_templates': 'link'},
                   content_type), 'other') as content_category,
               case
                   when regexp_matches(post_message,
                       'recap|sunday service|ministered by|title:', 'i') then 'sermon_recap'
                   when regexp_matches(post_message,
                       'we are live|join us live|live tonight', 'i') then 'live_announcement'
                   when regexp_matches(post_message,
                       'join us|see you|you are invited', 'i') then 'announcement'
                   when regexp_matches(post_message,
                       'happy birthday|we celebrate', 'i') then 'celebration'
                   else 'general' end as post_category,
               ingested_at
        from stg_facebook_posts""",
    ),
    "mart_posts_perfomance": (
        ["stg_tiktok_posts"],
        """
        select post_id, post_date, posted_at, likes, sound, location, title, ingested_at,
               case when likes is null then 'unknown'
                    when likes < 0 or likes > 5000 then '5000+'
                    when likes > 1000 then '1001-5000' when likes > 500 then '501-1000'
                    when likes > 200 then '201-500' when likes > 100 then '101-200'
                    when likes > 50 then '51-100' else '0-50' end as like_bucket
        from stg_tiktok_posts""",
    ),
    "mart_tiktok_followers": (
        ["stg_tiktok_followers"],
        """
        with span as (
            select min(cast(followed_at as date)) as a, max(cast(followed_at as date)) as z
            from stg_tiktok_followers),
        days as (
            select cast(unnest(generate_series(a, z, interval 1 day)) as date) as d from span),
        daily as (
            select d, count(follower_id) as n
            from days left join stg_tiktok_followers on cast(followed_at as date) = d group by d)
        select d as follow_date, n as new_followers,
               cast(sum(n) over (order by d) as bigint) as cumulative_followers
        from daily""",
    ),
    "mart_tiktok_live_perfomance": (
        ["stg_tiktok_live"],
        f"""
        select room_id, live_title, live_date, start_time, end_time, duration_mins,
               {rounded('(duration_mins / 60)', 2)} as duration_hours,
               dayname(live_date) as live_day_name, total_views, total_gifters, total_likes,
               ingested_at,
               case when duration_mins >= 90 or duration_mins is null then 'Long'
                    when duration_mins >= 30 then 'Medium' else 'Short' end
                   as live_duration_bucket,
               {rounded('(cast(total_likes as double) / nullif(total_views, 0))', 2)} as like_rate
        from stg_tiktok_live""",
    ),
    "mart_tiktok_activity_overlap": (
        ["mart_posts_perfomance", "mart_tiktok_live_perfomance"],
        """
        with both_kinds as (
            select post_date as d, 'p' as kind, likes, null as views from mart_posts_perfomance
            union all
            select live_date, 'l', total_likes, total_views from mart_tiktok_live_perfomance),
        daily as (
            select d, count(*) filter (where kind = 'p') as p, count(*) filter (where kind = 'l') as l,
                   sum(likes) filter (where kind = 'p') as pl,
                   avg(likes) filter (where kind = 'p') as pa,
                   sum(views) as lv, sum(likes) filter (where kind = 'l') as ll
            from both_kinds group by d)
        select d as activity_date, dayname(d) as day_of_week,
               cast(isodow(d) as varchar) as day_number, p as posts_on_day,
               cast(ifnull(pl, 0) as bigint) as total_post_likes,
               ifnull(pa, 0) as avg_post_likes, l as live_sessions_on_day,
               cast(ifnull(lv, 0) as bigint) as live_views_on_day,
               cast(ifnull(ll, 0) as bigint) as live_likes_on_day,
               case when p > 0 and l > 0 then 'Post + Live' when l > 0 then 'Live Only'
                    else 'Post Only' end as activity_type
        from daily""",
    ),
    "mart_youtube_perfomance": (
        ["stg_youtube_videos", "stg_youtube_comments"],
        f"""
        select video_id, any_value(video_title) as video_title,
               any_value(v.published_at) as published_at,
               strftime(any_value(v.published_at), '%Y-%m') as year_month,
               dayname(any_value(v.published_at)) as day_of_week,
               any_value(view_count) as view_count, any_value(v.like_count) as like_count,
               any_value(comment_count) as comment_count,
               {_pct('(any_value(v.like_count) + any_value(comment_count))',
                     'any_value(view_count)', 2)} as engagement_rate_pct,
               count(comment_text) as total_comments_ingested,
               cast(ifnull(sum(c.like_count), 0) as bigint) as total_comment_likes,
               max(c.published_at) as latest_comment_date,
               date_diff('day', any_value(v.published_at), date '{AS_OF}')
                   as days_since_published,
               any_value(v.ingested_at) as ingested_at
        from stg_youtube_videos v left join stg_youtube_comments c using (video_id)
        group by video_id""",
    ),
    "mart_youtube_videos": (
        ["stg_youtube_videos", "stg_youtube_comments"],
        f"""
        select video_id, video_title, v.published_at,
               strftime(v.published_at, '%Y-%m') as year_month,
               dayname(v.published_at) as day_of_week, isodow(v.published_at) as day_of_week_num,
               view_count, v.like_count, comment_count, favorite_count,
               {_pct('(v.like_count + comment_count)', 'view_count', 2)} as engagement_rate_pct,
               if(live_broadcast_content = 'live', 'Live Stream', 'Uploaded') as content_type,
               {rounded('(duration_seconds / 60)', 1)} as duration_minutes,
               case when duration_seconds >= 3600 then 'Long form (60+ min)'
                    when duration_seconds >= 1800 then 'Medium (30–60 min)'
                    when duration_seconds >= 180 then 'Short clips (< 30 min)'
                    when duration_seconds is not null then 'YouTube Shorts (< 3 min)'
                    else 'Unknown' end as duration_bucket,
               (select count(*) from stg_youtube_comments c where c.video_id = v.video_id)
                   as total_comments_ingested,
               (select cast(ifnull(sum(c.like_count), 0) as bigint) from stg_youtube_comments c
                where c.video_id = v.video_id) as total_comment_likes,
               (select max(c.published_at) from stg_youtube_comments c
                where c.video_id = v.video_id) as latest_comment_date,
               live_broadcast_content, tags_raw, definition, caption, category_id,
               default_language, v.ingested_at
        from stg_youtube_videos v""",
    ),
    "mart_social_followers_snapshot": (
        ["stg_youtube_channel", "mart_tiktok_followers", "stg_facebook_insights"],
        "",
    ),
    "mart_social_overview": (
        [
            "facebook", "youtube_channel", "mart_tiktok_live_perfomance",
            "mart_tiktok_followers", "mart_youtube_videos",
        ],
        f"""
        select 'facebook' as platform, max(cast(VALUE as bigint)) as total_followers,
               0::bigint as total_posts, 0::bigint as total_likes, 0::bigint as total_views,
               0::bigint as total_comments, 0.0::double as avg_engagement_rate,
               0::bigint as total_live_sessions
        from facebook where METRIC = 'page_follows'
        union all
        select 'tiktok', (select max(cumulative_followers) from mart_tiktok_followers), 0,
               cast(sum(total_likes) as bigint), cast(sum(total_views) as bigint), 0,
               {_mean('like_rate')}, count(distinct room_id)
        from mart_tiktok_live_perfomance
        union all
        select 'youtube', (select max(cast(subscriber_count as bigint)) from youtube_channel),
               count(distinct video_id), cast(sum(like_count) as bigint),
               cast(sum(view_count) as bigint), cast(sum(comment_count) as bigint),
               {_mean('engagement_rate_pct')},
               count(*) filter (where live_broadcast_content = 'live')
        from mart_youtube_videos""",
    ),
    "mart_executive_summary": (
        [
            "stg_youtube_channel", "mart_youtube_perfomance", "mart_facebook_insights",
            "mart_facebook_posts", "mart_tiktok_followers", "mart_posts_perfomance",
            "mart_tiktok_live_perfomance",
        ],
        f"""
        with channel as (
            select max(subscriber_count) as f, max(total_video_count) as p,
                   max(total_view_count) as v
            from stg_youtube_channel)
        select 'youtube' as platform, any_value(f) as total_followers,
               any_value(p) as total_posts, any_value(v) as total_views,
               cast(sum(like_count) as bigint) as total_likes,
               null::bigint as total_live_sessions,
               {_mean('engagement_rate_pct')} as avg_engagement_rate
        from mart_youtube_perfomance, channel
        union all
        select 'facebook', max(total_followers), (select count(*) from mart_facebook_posts),
               max(unique_impressions), max(total_reactions), null,
               {_pct('max(total_reactions)', 'max(unique_impressions)', 2)}
        from mart_facebook_insights
        union all
        select 'tiktok', (select max(cumulative_followers) from mart_tiktok_followers),
               (select count(*) from mart_posts_perfomance),
               cast(sum(total_views) as bigint), cast(sum(total_likes) as bigint), count(*),
               {_mean('like_rate')}
        from mart_tiktok_live_perfomance""",
    ),
}


def _snapshot_sql(channel: str) -> str:
    return f"""
        with rows_by_day as (
            select 'YouTube' as platform, cast(ingested_at as date) as snapshot_date,
                   subscriber_count as follower_count, total_view_count as total_views,
                   null::bigint as total_reach
            from {channel}
            qualify {newest('cast(ingested_at as date)', 'subscriber_count', 'total_view_count',
                            'channel_id')}
            union all
            select 'TikTok', follow_date, cumulative_followers, null, null
            from mart_tiktok_followers
            union all
            select 'Facebook', date, {_metric('page_follows')}, {_metric('page_views_total')},
                   {_metric('page_impressions_unique')}
            from stg_facebook_insights
            where metric_name in ('page_follows', 'page_views_total', 'page_impressions_unique')
            group by date),
        paired as (
            select *, lag(follower_count) over w as pf, lag(total_views) over w as pv
            from rows_by_day window w as (partition by platform order by snapshot_date))
        select platform, snapshot_date, follower_count, total_views, total_reach,
               pf as prev_period_followers,
               {_pct('(follower_count - pf)', 'pf', 1)} as pct_growth_mom,
               pv as prev_period_views, {_pct('(total_views - pv)', 'pv', 1)} as pct_views_growth
        from paired"""


MODEL_SQL["mart_social_followers_snapshot"] = (
    MODEL_SQL["mart_social_followers_snapshot"][0],
    _snapshot_sql("stg_youtube_channel"),
)


def model_ctes(*names: str) -> str:
    """WITH clause that defines the named raw tables and models and all they read."""
    done: dict[str, str] = {}

    def add(name: str) -> None:
        if name in done:
            return
        if name in MODEL_SQL:
            reads, body = MODEL_SQL[name]
            for dep in reads:
                add(dep)
            done[name] = body
        else:
            done[name] = raw_cte(name)

    for name in names:
        add(name)
    return "with " + ",\n".join(f"{n} as ({body})" for n, body in done.items())


def over_models(names: list[str], body: str) -> str:
    return f"{model_ctes(*names)}\n{body}"


def models(spark: SparkSession, sf_dir: str) -> ModelFrames:
    return ModelFrames(lambda name: raw_frame(spark, sf_dir, name), as_of=AS_OF)


def _model_query(name: str):
    return lambda spark, sf_dir: models(spark, sf_dir)[name]


def _snapshot_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart_social_followers_snapshot(models(spark, sf_dir), youtube_history=True)


def _results_sql(table: str, column: str, check: str, failures: str, severity: str = "error"):
    return f"""
        select '{table}' as "table", '{column}' as "column", '{check}' as "check",
               n as failures, '{severity}' as severity,
               case when n = 0 then 'PASS' else upper('{severity}') end as status
        from ({failures}) as counted(n)"""


def _suite_sql(row_counts: bool = False) -> str:
    """One statement per declared test, and per mart one that wants a row."""
    parts = []
    for name in MART_MODELS if row_counts else ():
        short = f"select greatest(1 - count(*), 0) from {name}"
        parts.append(_results_sql(name, "*", "row_count >= 1", short, "warn"))
    for table, spec in SUITE.items():
        warned = set(spec.get("warn", ()))

        def add(col, check, count, table=table, warned=warned):
            severity = "warn" if (col, check) in warned else "error"
            parts.append(_results_sql(table, col, check, count, severity))

        for c in spec.get("not_null", ()):
            add(c, "not_null", f"select count(*) - count({c}) from {table}")
        for c, values in spec.get("accepted", {}).items():
            listed = ", ".join(f"'{v}'" for v in values)
            add(c, "accepted_values", f"select count(*) from {table} where {c} not in ({listed})")
        for c in spec.get("at_least_zero", ()):
            add(c, "expression: >= 0", f"select count(*) from {table} where {c} < 0")
        for c in spec.get("unique", ()):
            add(
                c,
                "unique",
                f"select count(*) from (select {c} from {table} where {c} is not null "
                f"group by {c} having count(*) > 1)",
            )
    names = list(MART_MODELS) if row_counts else list(SUITE)
    return over_models(names, "\nunion all\n".join(parts))


def _refreshed(
    spark: SparkSession, sf_dir: str, observed: dict[str, Observation] | None = None
) -> dict[str, DataFrame]:
    """Land the projected raw tables, then run the daily refresh on them."""
    root = scratch_path(spark, "raw")
    names = [n for n in RAW_TABLES if n in RAW_SQL]
    frames = [raw_frame(spark, sf_dir, n) for n in names]
    with ThreadPoolExecutor(THREADS) as pool:
        list(pool.map(append_raw, frames, [f"{root}/{n}" for n in names]))
    return refresh_marts(spark, root, scratch_path(spark, "marts"), as_of=AS_OF, observed=observed)


def _refresh_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart_row_summary(_refreshed(spark, sf_dir))


def _landed_twice(spark: SparkSession, sf_dir: str, names: list[str], marts: list[str] | None) -> dict[str, DataFrame]:
    """Two landings, rows of all ingest times in each, and an incremental refresh after either."""
    root, stored = scratch_path(spark, "raw"), scratch_path(spark, "marts")
    for second in (False, True):
        frames = [raw_frame(spark, sf_dir, n) for n in names]
        # A few of the first rows land again.
        chosen = [F.pmod(F.xxhash64(*f.columns), F.lit(5)) for f in frames]
        frames = [f.where(c.isin(0, 4) if second else c < 4) for f, c in zip(frames, chosen, strict=True)]
        with ThreadPoolExecutor(THREADS) as pool:
            list(pool.map(append_raw, frames, [f"{root}/{n}" for n in names]))
        found = refresh_incremental(spark, root, stored, as_of=AS_OF, marts=marts, missing="empty", buckets=8)
    return found


def _refresh_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["facebook_posts", "tiktok_posts"]
    marts = ["mart_facebook_posts", "mart_posts_perfomance"]
    return _landed_twice(spark, sf_dir, names, marts)["mart_posts_perfomance"]


def _refresh_incremental_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["youtube_videos", "youtube_comments"]
    return _landed_twice(spark, sf_dir, names, ["mart_youtube_perfomance"])["mart_youtube_perfomance"]


def _dedup_latest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest posts from ten batches in any order, some of them repeated."""
    raw, path = raw_frame(spark, sf_dir, "facebook_posts"), scratch_path(spark, "newest")
    batch = F.pmod(F.xxhash64("row_key"), F.lit(8))
    for step in (3, 0, 7, 1, 5, 3, 6, 2, 4, 0):
        merge_newest(raw.where(batch == step), path, ["post_id"], "ingested_at", ["row_key"], buckets=8)
    return read_version(spark, path, RAW_TABLES["facebook_posts"])


def _run_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_marts(_refreshed(spark, sf_dir))


def _run_checks_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row tests and row counts come from the writes of the marts, uniqueness from the stored rows."""
    observed = {}
    stored = _refreshed(spark, sf_dir, observed)
    return union_all(check_marts(stored, observed), check_mart_rows(stored, observed))


def _mart_row_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = models(spark, sf_dir)
    return mart_row_summary({n: built[n] for n in SUMMARY_MARTS})


def _summary_sql(names: list[str]) -> str:
    counts = "\nunion all\n".join(
        f"select '{n}' as mart, count(*) as rows from {n}" for n in names
    )
    return over_models(names, counts)


def _check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = raw_frame(spark, sf_dir, "raw_tiktok_live_events")
    return check_not_null(events, [*EVENT_REQUIRED, "username", "room_id"], "live")


def _check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_frame(spark, sf_dir, "youtube_comments")
    return check_unique(raw, ["video_id", "author"], "comments", "warn")


def _check_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_frame(spark, sf_dir, "facebook_posts")
    return check_accepted_values(raw, "content_type", ["album", "photo", "share"], "posts")


def _check_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_frame(spark, sf_dir, "youtube_videos")
    return check_expression(raw, "duration_seconds", ">= 600", "videos", "warn")


def _check_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landed tables pass; comments on a day without any fail."""
    checks = [
        check_row_count(raw_frame(spark, sf_dir, name), 1, name)
        for name in ("tiktok_live_history", "tiktok_posts")
    ]
    followers = raw_frame(spark, sf_dir, "tiktok_followers").where("username = 'nobody'")
    return union_all(*checks, check_row_count(followers, 1, "tiktok_followers"))


_LIVE = "raw_tiktok_live_events"

QUERIES = {
    name: (_model_query(name), over_models([name], f"select * from {name}"))
    for name in (*STAGING_MODELS, *MART_MODELS)
}
QUERIES |= {
    "mart_social_followers_snapshot_history": (
        _snapshot_history,
        over_models(
            ["youtube_channel_rows", "mart_tiktok_followers", "stg_facebook_insights"],
            f"select * from ({_snapshot_sql('youtube_channel_rows')})",
        ),
    ),
    "run_checks": (_run_checks, _suite_sql()),
    "run_checks_observed": (_run_checks_observed, _suite_sql(row_counts=True)),
    "refresh_marts": (_refresh_marts, _summary_sql(list(MART_MODELS))),
    "refresh_incremental": (
        _refresh_incremental,
        over_models(["mart_posts_perfomance"], "select * from mart_posts_perfomance"),
    ),
    "refresh_incremental_videos": (
        _refresh_incremental_videos,
        over_models(["mart_youtube_perfomance"], "select * from mart_youtube_perfomance"),
    ),
    "dedup_latest_incremental": (
        _dedup_latest_incremental,
        over_models(
            ["facebook_posts"],
            f"select * from facebook_posts qualify {newest('post_id', 'row_key')}",
        ),
    ),
    "mart_row_summary": (_mart_row_summary, _summary_sql(SUMMARY_MARTS)),
    "check_not_null": (
        _check_not_null,
        over_models(
            [_LIVE],
            "\nunion all\n".join(
                _results_sql("live", c, "not_null", f"select count(*) - count({c}) from {_LIVE}")
                for c in (*EVENT_REQUIRED, "username", "room_id")
            ),
        ),
    ),
    "check_unique": (
        _check_unique,
        over_models(
            ["youtube_comments"],
            _results_sql(
                "comments", "video_id, author", "unique",
                "select count(*) from (select 1 from youtube_comments where video_id is not null "
                "and author is not null group by video_id, author having count(*) > 1)",
                "warn",
            ),
        ),
    ),
    "check_accepted_values": (
        _check_accepted,
        over_models(
            ["facebook_posts"],
            _results_sql(
                "posts", "content_type", "accepted_values",
                "select count(*) from facebook_posts "
                "where content_type not in ('album', 'photo', 'share')",
            ),
        ),
    ),
    "check_expression": (
        _check_expression,
        over_models(
            ["youtube_videos"],
            _results_sql(
                "videos", "duration_seconds", "expression: >= 600",
                "select count(*) from youtube_videos where duration_seconds < 600", "warn",
            ),
        ),
    ),
    "check_row_count": (
        _check_row_count,
        over_models(
            ["tiktok_live_history", "tiktok_posts", "tiktok_followers"],
            "\nunion all\n".join(
                _results_sql(t, "*", "row_count >= 1", f"select greatest(1 - count(*), 0) from {s}")
                for t, s in (
                    ("tiktok_live_history", "tiktok_live_history"),
                    ("tiktok_posts", "tiktok_posts"),
                    ("tiktok_followers", "tiktok_followers where username = 'nobody'"),
                )
            ),
        ),
    ),
}
