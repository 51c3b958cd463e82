"""Single operators and column functions over whole test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import (
    bucket_likes,
    bucket_live_duration,
    bucket_video_duration,
    classify_keywords,
    clean_number,
    coerce_int,
    content_type_label,
    count_matches,
    day_name,
    days_between,
    default_nulls,
    event_flags,
    event_hour,
    exact_avg,
    extract_field,
    iso_day_num,
    json_texts,
    lower_norm,
    map_category,
    null_sentinels,
    parse_iso_duration,
    ratio_pct,
    regexp_or_null,
    safe_ratio,
    sunday_day_num,
    surrogate_key,
    to_bigint,
    trim_blank,
    utc_timestamp,
    year_label,
    year_month,
    year_week,
)
from tallyloom.operators import (
    agg_global,
    count_by,
    date_spine,
    dedup_earliest,
    dedup_latest,
    distinct_error,
    distinct_over,
    distinct_sketches,
    expand_days,
    forward_fill,
    gap_fill,
    join_cross_scalar,
    join_full_outer,
    join_left_enrich,
    join_left_spine,
    lag_change,
    last_n,
    numbered,
    pivot_metrics,
    qualify_row_number,
    running_sum,
    sample_every_nth,
    top_k_by_count,
    union_all,
    unpivot_reactions,
)
from tallyloom.plans.carried import advance_series, read_series
from tallyloom.plans.marts import ATTACHMENT_CATEGORIES, METRIC_CATEGORIES, POST_RULES
from tallyloom.plans.staging import FLAGGED_EVENTS
from tallyloom.session import scratch_path
from tallyloom.sources import materialize_table
from tallyloom.workloads.data import raw_frame, table
from tallyloom.workloads.models import over_models, rounded

QUERIES: dict[str, tuple] = {}


def query(name: str, sql: str | None):
    def register(run):
        QUERIES[name] = (run, sql)
        return run

    return register


# --- projections and predicates -------------------------------------------------


@query(
    "cast_types",
    over_models(
        ["youtube_videos"],
        """
        select video_id, cast(view_count as bigint) as view_count,
               cast(published_at as date) as published_at,
               cast(try_cast(title as integer) as bigint) as title_number, ingested_at
        from youtube_videos""",
    ),
)
def cast_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_frame(spark, sf_dir, "youtube_videos").select(
        "video_id",
        to_bigint("view_count").alias("view_count"),
        F.col("published_at").cast("date").alias("published_at"),
        to_bigint("title", on_error="null").alias("title_number"),
        "ingested_at",
    )


@query(
    "default_nulls",
    over_models(
        ["facebook_posts"],
        """
        select post_id, ifnull(message, '') as message,
               ifnull(content_type, 'unknown') as content_type, ingested_at
        from facebook_posts""",
    ),
)
def q_default_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_frame(spark, sf_dir, "facebook_posts").select(
        "post_id",
        default_nulls("message", "").alias("message"),
        default_nulls("content_type", "unknown").alias("content_type"),
        "ingested_at",
    )


@query(
    "null_sentinels",
    over_models(
        ["tiktok_posts"],
        """
        select case when visibility_raw = 'N/A' then null else visibility_raw end as visibility,
               case when sound_raw = 'N/A' then null else sound_raw end as sound,
               case when location_raw in ('N/A', 'R') then null else location_raw end as location,
               count(*) as posts
        from tiktok_posts group by 1, 2, 3""",
    ),
)
def q_null_sentinels(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = raw_frame(spark, sf_dir, "tiktok_posts")
    return count_by(
        posts.select(
            null_sentinels("visibility_raw").alias("visibility"),
            null_sentinels("sound_raw").alias("sound"),
            null_sentinels("location_raw", ["N/A", "R"]).alias("location"),
        ),
        ["visibility", "sound", "location"],
        "posts",
    )


@query(
    "clean_number",
    over_models(
        ["tiktok_live_history"],
        """
        select room_id, cast(replace(total_view_raw, ',', '') as bigint) as views,
               try_cast(total_gifter_raw as bigint) as gifters,
               try_cast(total_likes_raw as bigint) as likes, ingested_at
        from tiktok_live_history""",
    ),
)
def q_clean_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_frame(spark, sf_dir, "tiktok_live_history").select(
        "room_id",
        clean_number("total_view_raw").alias("views"),
        clean_number("total_gifter_raw").alias("gifters"),
        clean_number("total_likes_raw").alias("likes"),
        "ingested_at",
    )


@query(
    "coerce_int",
    """
    select o_orderkey, cast(case o_orderkey % 5
        when 0 then 0 when 1 then o_custkey when 2 then -trunc(o_totalprice)
        when 3 then 0 else 0 end as bigint) as number
    from orders""",
)
def q_coerce_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("o_orderkey") % 5
    text = (
        F.when(kind == 0, F.col("o_orderpriority"))
        .when(kind == 1, F.col("o_custkey").cast("string"))
        .when(kind == 2, F.concat(F.lit(" -"), F.col("o_totalprice").cast("string")))
        .when(kind == 3, F.concat(F.col("o_custkey").cast("string"), F.lit(",000")))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", coerce_int(text).alias("number"))


@query(
    "trim_blank",
    over_models(
        ["raw_tiktok_live_events"],
        """
        select event_id, ingested_at, nullif(trim(username), '') as username,
               nullif(trim(comment_text), '') as content
        from raw_tiktok_live_events""",
    ),
)
def q_trim_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_frame(spark, sf_dir, "raw_tiktok_live_events").select(
        "event_id",
        "ingested_at",
        trim_blank("username").alias("username"),
        trim_blank("comment_text").alias("content"),
    )


@query(
    "lower_norm",
    over_models(
        ["youtube_videos"],
        """
        select lower(ifnull(live_broadcast_content, 'none')) as live,
               lower(ifnull(definition, 'UNKNOWN')) as definition,
               lower(ifnull(caption, 'false')) as caption, count(*) as videos
        from youtube_videos group by all""",
    ),
)
def q_lower_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    normal = raw_frame(spark, sf_dir, "youtube_videos").select(
        lower_norm("live_broadcast_content", "none").alias("live"),
        lower_norm("definition", "UNKNOWN").alias("definition"),
        lower_norm("caption", "false").alias("caption"),
    )
    return count_by(normal, ["live", "definition", "caption"], "videos")


@query(
    "surrogate_key",
    """
    select c_custkey, md5(c_name || '|' || c_mktsegment) as pair_key,
           md5(ifnull(nullif(c_mktsegment, 'BUILDING'), '') || '|' || c_name || '|'
               || cast(c_nationkey as varchar)) as triple_key
    from customer""",
)
def q_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        surrogate_key("c_name", "c_mktsegment").alias("pair_key"),
        surrogate_key(
            F.nullif("c_mktsegment", F.lit("BUILDING")), "c_name", F.col("c_nationkey").cast("string")
        ).alias("triple_key"),
    )


@query(
    "event_flags",
    over_models(
        ["raw_tiktok_live_events"],
        """
        select event_type = 'comment' as is_comment, event_type = 'like' as is_like,
               event_type = 'gift' as is_gift, event_type = 'viewer_count' as is_viewer_count,
               count(*) as events
        from raw_tiktok_live_events group by all""",
    ),
)
def q_event_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = raw_frame(spark, sf_dir, "raw_tiktok_live_events").select(
        *event_flags("event_type", FLAGGED_EVENTS)
    )
    return count_by(flagged, flagged.columns, "events")


@query(
    "bucket_likes",
    """
    select l_orderkey, l_linenumber, l_partkey, case
        when l_partkey % 100 = 0 then 'unknown'
        when l_orderkey - 60 not between 0 and 5000 then '5000+'
        when l_orderkey - 60 > 1000 then '1001-5000' when l_orderkey - 60 > 500 then '501-1000'
        when l_orderkey - 60 > 200 then '201-500' when l_orderkey - 60 > 100 then '101-200'
        when l_orderkey - 60 > 50 then '51-100' else '0-50' end as like_bucket
    from lineitem""",
)
def q_bucket_likes(spark: SparkSession, sf_dir: str) -> DataFrame:
    likes = F.when(F.col("l_partkey") % 100 != 0, F.col("l_orderkey") - 60)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", bucket_likes(likes).alias("like_bucket")
    )


@query(
    "bucket_live_duration",
    """
    select case when m < 30 then 'Short' when m < 90 then 'Medium' else 'Long' end as length,
           count(*) as orders
    from (select case when o_custkey % 10 <> 0 then o_orderkey % 200 end as m from orders)
    group by all""",
)
def q_bucket_live_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    minutes = F.when(F.col("o_custkey") % 10 != 0, F.col("o_orderkey") % 200)
    orders = table(spark, sf_dir, "orders").select(bucket_live_duration(minutes).alias("length"))
    return count_by(orders, ["length"], "orders")


@query(
    "bucket_video_duration",
    """
    select case when s is null then 'Unknown' when s < 180 then 'YouTube Shorts (< 3 min)'
                when s < 1800 then 'Short clips (< 30 min)' when s < 3600 then 'Medium (30–60 min)'
                else 'Long form (60+ min)' end as length, count(*) as orders
    from (select case when o_custkey % 10 <> 0 then o_orderkey % 5000 end as s from orders)
    group by all""",
)
def q_bucket_video_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.when(F.col("o_custkey") % 10 != 0, F.col("o_orderkey") % 5000)
    orders = table(spark, sf_dir, "orders").select(bucket_video_duration(seconds).alias("length"))
    return count_by(orders, ["length"], "orders")


@query(
    "content_type_label",
    over_models(
        ["youtube_videos"],
        """
        select video_id, ingested_at,
               case lower(live_broadcast_content) when 'live' then 'Live Stream'
                    else 'Uploaded' end as content_type
        from youtube_videos""",
    ),
)
def q_content_type_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_frame(spark, sf_dir, "youtube_videos").select(
        "video_id",
        "ingested_at",
        content_type_label(F.lower("live_broadcast_content")).alias("content_type"),
    )


@query(
    "map_category",
    over_models(
        ["facebook", "facebook_posts"],
        """
        select 'metric' as kind, METRIC as name, case METRIC
                when 'page_impressions_unique' then 'reach'
                when 'page_posts_impressions' then 'reach'
                when 'page_video_views' then 'video' when 'page_follows' then 'growth'
                when 'page_views_total' then 'activity'
                when 'page_total_actions' then 'activity' else 'other' end as category,
               count(*) as rows
        from facebook group by all
        union all
        select 'attachment', content_type, case content_type
                when 'video_inline' then 'video' when 'native_templates' then 'link'
                when 'album' then 'album' when 'photo' then 'photo' when 'share' then 'share'
                else 'other' end, count(*)
        from facebook_posts group by all""",
    ),
)
def q_map_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = raw_frame(spark, sf_dir, "facebook").select(
        F.lit("metric").alias("kind"),
        F.col("METRIC").alias("name"),
        map_category("METRIC", METRIC_CATEGORIES, "other").alias("category"),
    )
    posts = raw_frame(spark, sf_dir, "facebook_posts").select(
        F.lit("attachment").alias("kind"),
        F.col("content_type").alias("name"),
        map_category("content_type", ATTACHMENT_CATEGORIES, "other").alias("category"),
    )
    return count_by(union_all(metrics, posts), ["kind", "name", "category"])


WORD_RULES = [
    ("license", ["license", "copyright"]),
    ("contact", ["@", "phone"]),
    ("german", [" der ", " und "]),
    ("french", [" que ", " les "]),
]


@query(
    "classify_keywords",
    over_models(
        ["facebook_posts"],
        """
        select 'post_' || cast(doc_id as varchar) as id, 'document' as kind, case
            when lower(text) like '%license%' or lower(text) like '%copyright%' then 'license'
            when contains(text, '@') or lower(text) like '%phone%' then 'contact'
            when lower(text) like '% der %' or lower(text) like '% und %' then 'german'
            when lower(text) like '% que %' or lower(text) like '% les %' then 'french'
            else 'none' end as category
        from documents
        union all
        select post_id || ' ' || cast(ingested_at as varchar) || ' '
                   || ifnull(right(message, 9), ''), 'post', case
            when regexp_matches(message, 'recap|sunday service|ministered by|title:', 'i')
                then 'sermon_recap'
            when regexp_matches(message, 'we are live|join us live|live tonight', 'i')
                then 'live_announcement'
            when regexp_matches(message, 'join us|see you|you are invited', 'i')
                then 'announcement'
            when regexp_matches(message, 'happy birthday|we celebrate', 'i') then 'celebration'
            else 'general' end
        from facebook_posts""",
    ),
)
def q_classify_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("post_"), F.col("doc_id").cast("string")).alias("id"),
        F.lit("document").alias("kind"),
        classify_keywords("text", WORD_RULES, "none").alias("category"),
    )
    posts = raw_frame(spark, sf_dir, "facebook_posts").select(
        F.concat_ws(
            " ", "post_id", F.col("ingested_at").cast("string"),
            F.coalesce(F.expr("right(message, 9)"), F.lit("")),
        ).alias("id"),
        F.lit("post").alias("kind"),
        classify_keywords("message", POST_RULES, "general").alias("category"),
    )
    return union_all(documents, posts)


@query(
    "ratio_pct",
    f"""
    select l_orderkey, l_linenumber, l_partkey,
           {rounded('(cast(l_orderkey as double) / nullif(l_suppkey % 10, 0) * 100)', 2)} as pct,
           {rounded('(cast(l_linenumber as double) / nullif(l_partkey % 7, 0))', 2)} as ratio
    from lineitem""",
)
def q_ratio_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        ratio_pct("l_orderkey", F.col("l_suppkey") % 10, 2).alias("pct"),
        ratio_pct("l_linenumber", F.col("l_partkey") % 7, 2, scale=1).alias("ratio"),
    )


@query(
    "drop_columns",
    """select * exclude (s_acctbal, s_name) from supplier""",
)
def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").drop("s_acctbal", "s_name")


@query(
    "const_column",
    """
    select 'star' as platform, cast(null as bigint) as total_reach, c_mktsegment,
           count(*) as customers
    from customer group by c_mktsegment""",
)
def const_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_by(table(spark, sf_dir, "customer"), ["c_mktsegment"], "customers")
    return counted.select(
        F.lit("star").alias("platform"),
        F.lit(None).cast("bigint").alias("total_reach"),
        "c_mktsegment",
        "customers",
    )


@query(
    "filter_eq",
    "select o_orderkey, o_orderstatus from orders where o_orderstatus = 'F'",
)
def filter_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_orderstatus")


@query(
    "filter_neq",
    "select o_orderkey, o_orderstatus from orders where not o_orderstatus = 'F'",
)
def filter_neq(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.where(F.col("o_orderstatus") != "F").select("o_orderkey", "o_orderstatus")


@query(
    "filter_in",
    """
    select o_orderkey, o_orderpriority from orders
    where o_orderpriority = '1-URGENT' or o_orderpriority = '2-HIGH'""",
)
def filter_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    kept = orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return kept.select("o_orderkey", "o_orderpriority")


@query(
    "filter_notnull",
    over_models(
        ["youtube_comments"],
        """
        select author, count(*) as comments from youtube_comments
        where author is not null group by author""",
    ),
)
def filter_notnull(spark: SparkSession, sf_dir: str) -> DataFrame:
    comments = raw_frame(spark, sf_dir, "youtube_comments")
    return count_by(comments.where(F.col("author").isNotNull()), ["author"], "comments")


# --- scalar functions -------------------------------------------------------------


@query(
    "calendar_labels",
    """
    select d as day, strftime(d, '%Y-%m') as year_month, strftime(d, '%Y') as year,
           strftime(d, '%A') as day_name, strftime(d, '%Y-%W') as year_week,
           cast(strftime(d, '%u') as int) as iso_day, cast(strftime(d, '%w') as int) + 1 as sunday_day,
           n as orders
    from (select cast(o_orderdate as date) as d, count(*) as n from orders group by all)""",
)
def calendar_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    days = count_by(orders, [F.col("o_orderdate").cast("date").alias("day")], "orders")
    return days.select(
        "day",
        year_month("day").alias("year_month"),
        year_label("day").alias("year"),
        day_name("day").alias("day_name"),
        year_week("day").alias("year_week"),
        iso_day_num("day").alias("iso_day"),
        sunday_day_num("day").alias("sunday_day"),
        "orders",
    )


@query(
    "date_parts",
    """
    select event_id, cast(ts as date) as event_date, cast(date_part('hour', ts) as int) as event_hour,
           cast(date '2024-03-01' - cast(ts as date) as bigint) as age_days
    from events""",
)
def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").cast("date").alias("event_date"),
        event_hour("ts").alias("event_hour"),
        days_between(F.lit("2024-03-01").cast("date"), F.col("ts").cast("date")).alias("age_days"),
    )


@query(
    "utc_timestamp",
    over_models(
        ["tiktok_followers", "tiktok_watch_live_history"],
        """
        select username as who, cast(left(followed_at_raw, 19) as timestamp) as at
        from tiktok_followers
        union all
        select link_raw, strptime(watched_at_raw, '%Y-%m-%d %H:%M:%S')
        from tiktok_watch_live_history""",
    ),
)
def q_utc_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    follows = raw_frame(spark, sf_dir, "tiktok_followers").select(
        F.col("username").alias("who"), utc_timestamp("followed_at_raw").alias("at")
    )
    watched = raw_frame(spark, sf_dir, "tiktok_watch_live_history").select(
        F.col("link_raw").alias("who"), utc_timestamp("watched_at_raw").alias("at")
    )
    return union_all(follows, watched)


@query(
    "regexp_or_null",
    """
    select page_id, nullif(regexp_extract(url, '//([^/:?#]+)', 1), '') as host,
           nullif(regexp_extract(url, '[?&]page=(\\d+)', 1), '') as page_number,
           nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') as title
    from pages""",
)
def q_regexp_or_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id",
        regexp_or_null("url", "//([^/:?#]+)").alias("host"),
        regexp_or_null("url", r"[?&]page=(\d+)").alias("page_number"),
        regexp_or_null("html", "<title>([^<]*)</title>").alias("title"),
    )


@query(
    "count_matches",
    """
    select page_id, len(regexp_extract_all(html, '<p[ >]')) as paragraphs,
           len(regexp_extract_all(html, 'href="[^"]*"')) as links
    from pages""",
)
def q_count_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id",
        count_matches("html", "<p[ >]").alias("paragraphs"),
        count_matches("html", 'href="[^"]*"').alias("links"),
    )


@query(
    "text_functions",
    """
    select doc_id, replace(lower(text), 'e', '') as without_e,
           regexp_replace(source, '^src', 'source ') as source_name,
           nullif(trim(lang), 'de') as lang, text like '%the%' as has_the,
           length(text) between 100 and 1000 as middling,
           lang || '/' || source as place
    from documents""",
)
def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.replace(F.lower(text), F.lit("e"), F.lit("")).alias("without_e"),
        F.regexp_replace("source", "^src", "source ").alias("source_name"),
        null_sentinels(F.trim("lang"), ["de"]).alias("lang"),
        text.contains("the").alias("has_the"),
        F.char_length(text).between(100, 1000).alias("middling"),
        F.concat("lang", F.lit("/"), "source").alias("place"),
    )


@query(
    "md5_hex",
    "select doc_id, md5(text) as text_key from documents",
)
def md5_hex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("text_key"))


@query(
    "json_texts",
    over_models(
        ["facebook"],
        """
        select METRIC as metric, ingested_at,
               json_extract_string(fixed, '$.like') as likes,
               json_extract_string(fixed, '$.love') as loves
        from (select *, replace(replace(VALUE, chr(39), '"'), 'None', 'null') as fixed
              from facebook)""",
    ),
)
def q_json_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = json_texts("VALUE", ["like", "love"])
    return raw_frame(spark, sf_dir, "facebook").select(
        F.col("METRIC").alias("metric"),
        "ingested_at",
        parsed["like"].alias("likes"),
        parsed["love"].alias("loves"),
    )


@query(
    "safe_divide",
    """
    select p_partkey, cast(p_partkey as double) / nullif(p_size % 5, 0) as ratio,
           0 / nullif(cast(p_size % 3 as double), 0) as zero_ratio
    from part""",
)
def safe_divide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        safe_ratio("p_partkey", F.col("p_size") % 5).alias("ratio"),
        safe_ratio(F.lit(0), F.col("p_size") % 3).alias("zero_ratio"),
    )


@query(
    "round_digits",
    f"""
    select p_partkey, {rounded('p_retailprice / 7', 2)} as price_2,
           {rounded('p_retailprice / 60', 1)} as price_1, {rounded('(p_size / 8)', 2)} as size_2
    from part""",
)
def round_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.round(F.col("p_retailprice") / 7, 2).alias("price_2"),
        F.round(F.col("p_retailprice") / 60, 1).alias("price_1"),
        F.round(F.col("p_size") / 8, 2).alias("size_2"),
    )


@query(
    "date_array",
    """
    select o_orderkey, cast(unnest(generate_series(cast(o_orderdate as date),
               cast(o_orderdate as date) + cast(o_orderkey % 4 as int), interval 1 day)) as date)
               as day
    from orders""",
)
def date_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.col("o_orderdate").cast("date")
    last = F.date_add(first, (F.col("o_orderkey") % 4).cast("int"))
    days = F.sequence(first, last, F.expr("interval 1 day"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.explode(days).alias("day"))


@query(
    "struct_array",
    """
    select c_name, 'nation' as kind, cast(c_nationkey as bigint) as number from customer
    union all select c_name, 'key', c_custkey from customer""",
)
def struct_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = F.array(
        F.struct(
            F.lit("nation").alias("kind"), F.col("c_nationkey").cast("bigint").alias("number")
        ),
        F.struct(F.lit("key").alias("kind"), F.col("c_custkey").alias("number")),
    )
    customers = table(spark, sf_dir, "customer")
    return customers.select("c_name", F.explode(pairs).alias("p")).select(
        "c_name", "p.kind", "p.number"
    )


@query(
    "parse_iso_duration",
    """
    select p_partkey, case when p_size % 5 = 4 then null else
        case when p_size % 5 in (0, 3) then p_size * 86400 else 0 end
        + case when p_size % 5 in (0, 1) then p_partkey % 24 * 3600 else 0 end
        + case when p_size % 5 in (0, 1, 2) then p_partkey % 60 * 60 else 0 end
        + case when p_size % 5 = 1 then p_size else 0 end end as seconds
    from part""",
)
def q_parse_iso_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, part = F.col("p_size").cast("string"), F.col("p_partkey")
    hours, minutes = (part % 24).cast("string"), (part % 60).cast("string")
    kind = F.col("p_size") % 5
    text = (
        F.when(kind == 0, F.concat(F.lit("P"), size, F.lit("DT"), hours, F.lit("H"), minutes, F.lit("M")))
        .when(kind == 1, F.concat(F.lit("PT"), hours, F.lit("H"), minutes, F.lit("M"), size, F.lit("S")))
        .when(kind == 2, F.concat(F.lit("PT"), minutes, F.lit("M")))
        .when(kind == 3, F.concat(F.lit("P"), size, F.lit("DT")))
        .otherwise(F.concat(F.lit("P"), size, F.lit("D")))
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey", parse_iso_duration(text).alias("seconds")
    )


@query(
    "extract_field",
    """
    select conv_id, turn, role as speaker, nullif(trim(split_part(text, chr(10), 1)), '') as line,
           null::varchar as mood
    from conversations""",
)
def q_extract_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    block = F.concat(F.lit("Role:  "), "role", F.lit(" \nText: "), "text", F.lit("\nEnd: x"))
    return table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        extract_field(block, "Role").alias("speaker"),
        extract_field(block, "Text").alias("line"),
        extract_field(block, "Mood").alias("mood"),
    )


# --- joins ------------------------------------------------------------------------

# Dates are moved to every third day, so that the series has gaps.
_DAY_TOTALS = """
    select date '1992-01-01' + cast(3 * (cast(o_orderdate as date) - date '1992-01-01') as int) as day,
           count(*) as orders,
           cast(sum(cast(round(o_totalprice * 100) as bigint)) as bigint) as cents
    from orders group by all"""


def _cents(col: str):
    return F.round(F.col(col) * 100).cast("bigint")


def _spread_day() -> Column:
    start = F.lit("1992-01-01").cast("date")
    return F.date_add(start, 3 * F.datediff(F.col("o_orderdate").cast("date"), start)).alias("day")


def _spread_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(_spread_day()).agg(
        F.count("*").alias("orders"), F.sum(_cents("o_totalprice")).alias("cents")
    )


@query(
    "join_left_spine",
    f"""
    with daily as ({_DAY_TOTALS}),
    days as (select cast(unnest(generate_series(
                 (select min(day) from daily), (select max(day) from daily), interval 1 day)) as date) as day)
    select days.day, orders, cents from days left join daily on daily.day = days.day""",
)
def q_join_left_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "orders").select(_spread_day())
    return join_left_spine(date_spine(days, "day"), _spread_days(spark, sf_dir), ["day"])


@query(
    "join_left_enrich",
    """
    select p_partkey, p_brand, count(l_orderkey) as lines,
           cast(ifnull(sum(cast(l_quantity as bigint)), 0) as bigint) as quantity,
           cast(max(l_shipdate) as date) as last_ship
    from part left join lineitem on l_partkey + l_partkey % 2 = p_partkey
    group by all""",
)
def q_join_left_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines are moved to even parts, so that odd ones have none."""
    part = F.col("l_partkey") + F.col("l_partkey") % 2
    lines = table(spark, sf_dir, "lineitem").withColumn("p_partkey", part)
    return join_left_enrich(
        table(spark, sf_dir, "part").select("p_partkey", "p_brand"),
        lines,
        "p_partkey",
        [
            F.count("*").alias("lines"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
            F.max("l_shipdate").cast("date").alias("last_ship"),
        ],
        zero_cols=["lines", "quantity"],
    )


@query(
    "join_full_outer",
    """
    with a as (select cast(o_orderdate as date) as day, count(*) as orders from orders group by all),
    b as (select cast(l_shipdate as date) as day, count(*) as lines from lineitem group by all)
    select ifnull(a.day, b.day) as day, orders, lines,
           case when b.day is null then 'ordered only' when a.day is null then 'shipped only'
                else 'both' end as kind
    from a full join b on a.day = b.day""",
)
def q_join_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    ordered = count_by(orders, [F.col("o_orderdate").cast("date").alias("day")], "orders")
    shipped = count_by(lines, [F.col("l_shipdate").cast("date").alias("day")], "lines")
    labels = ("both", "ordered only", "shipped only")
    return join_full_outer(ordered, shipped, "day", labels, "kind")


@query(
    "join_cross_scalar",
    """
    select o_orderkey, o_totalprice, max(o_totalprice) over () as top_price,
           count(*) over () as orders
    from orders""",
)
def q_join_cross_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    top = agg_global(orders, top_price=F.max("o_totalprice"), orders=F.count("*"))
    return join_cross_scalar(orders, top)


@query(
    "scalar_subquery",
    """
    select count(*) as customers, (select count(*) from orders) as orders,
           (select max(s_suppkey) from supplier) as last_supplier
    from customer""",
)
def scalar_subquery(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = agg_global(table(spark, sf_dir, "customer"), customers=F.count("*"))
    orders = agg_global(table(spark, sf_dir, "orders"), orders=F.count("*"))
    suppliers = agg_global(table(spark, sf_dir, "supplier"), last_supplier=F.max("s_suppkey"))
    return join_cross_scalar(join_cross_scalar(customers, orders), suppliers)


@query(
    "lateral_unnest",
    """
    select l_orderkey, l_linenumber, l_partkey, unnest(['quantity', 'line']) as kind,
           unnest([cast(l_quantity as bigint), cast(l_linenumber as bigint)]) as number
    from lineitem""",
)
def lateral_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.stack(
            F.lit(2),
            F.lit("quantity"), F.col("l_quantity").cast("bigint"),
            F.lit("line"), F.col("l_linenumber").cast("bigint"),
        ).alias("kind", "number"),
    )


# --- aggregates -------------------------------------------------------------------


@query("agg_count", "select event_type, count(*) as events from events group by all")
def agg_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(table(spark, sf_dir, "events"), ["event_type"], "events")


@query(
    "agg_sum_avg_min_max",
    """
    select l_returnflag, l_linestatus, cast(sum(cast(l_quantity as bigint)) as bigint) as total,
           avg(cast(l_quantity as bigint)) as mean, min(l_extendedprice) as low,
           max(l_extendedprice) as high,
           cast(sum(cast(l_discount as decimal(28, 2))) as double) / count(*) as mean_discount
    from lineitem group by all""",
)
def agg_sum_avg_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.col("l_quantity").cast("bigint")
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.sum(quantity).alias("total"),
        F.avg(quantity).alias("mean"),
        F.min("l_extendedprice").alias("low"),
        F.max("l_extendedprice").alias("high"),
        exact_avg("l_discount", 2).alias("mean_discount"),
    )


@query(
    "agg_count_distinct",
    """
    select cast(ts as date) as day, count(distinct user_id) as users from events group by all""",
)
def agg_count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.groupBy(F.col("ts").cast("date").alias("day")).agg(
        F.count_distinct("user_id").alias("users")
    )


@query(
    "agg_count_distinct_merged",
    """
    select date_trunc('month', ts)::date as month, count(distinct user_id) as users, true as within
    from events group by all""",
)
def agg_count_distinct_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months from stored sketches of days, beside the exact count: within the stated error or not."""
    events = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("date").alias("day"))
    days = materialize_table(distinct_sketches(events, ["day"], "user_id"), scratch_path(spark, "day-sketches"))
    month = F.trunc("day", "month").alias("month")
    near = distinct_over(days, [month], "estimate")
    exact = events.groupBy(month).agg(F.count_distinct("user_id").alias("users"))
    apart = F.abs(F.col("estimate") - F.col("users")) <= F.greatest(F.lit(1.0), distinct_error() * F.col("users"))
    return exact.join(near, "month").select("month", "users", apart.alias("within"))


@query(
    "running_sum_carried",
    """
    with days as (
        select event_type, cast(ts as date) as day,
               case when extract(day from cast(ts as date)) % 3 <> 0 then count(*) end as events
        from events group by event_type, cast(ts as date))
    select event_type, day, events,
           last_value(events ignore nulls) over (partition by event_type order by day) as filled,
           cast(sum(events) over (partition by event_type order by day) as bigint) as total
    from days""",
)
def running_sum_carried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last values and totals carried over four runs; the third lands wrong days, the last corrects them."""
    day = F.col("ts").cast("date")
    days = table(spark, sf_dir, "events").groupBy("event_type", day.alias("day")).agg(F.count("*").alias("n"))
    known = F.dayofmonth("day") % 3 != 0
    days = materialize_table(
        days.select("event_type", "day", F.when(known, F.col("n")).alias("events")), scratch_path(spark, "days")
    )
    path, third = scratch_path(spark, "series"), F.floor((F.dayofmonth("day") - 1) / 11)
    wrong = days.where(third == 2).withColumn("events", F.col("events") + 1)
    for batch in (days.where(third == 0), days.where(third == 1), wrong, days.where(third == 2)):
        advance_series(batch, path, ["event_type"], "day", "events", period="week")
    return read_series(spark, path, days, ["event_type"], "day", "events")


@query(
    "agg_count_if",
    """
    select cast(ts as date) as day, count(*) filter (where event_type = 'purchase') as purchases,
           count(*) filter (where value > 100) as large
    from events group by all""",
)
def agg_count_if(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.groupBy(F.col("ts").cast("date").alias("day")).agg(
        F.count_if(F.col("event_type") == "purchase").alias("purchases"),
        F.count_if(F.col("value") > 100).alias("large"),
    )


@query(
    "pivot_metrics",
    """
    select cast(ts as date) as day, max(value) filter (where event_type = 'view') as views,
           max(value) filter (where event_type = 'click') as clicks,
           max(value) filter (where event_type = 'purchase') as purchases
    from events group by all""",
)
def q_pivot_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_metrics(
        table(spark, sf_dir, "events"),
        [F.col("ts").cast("date").alias("day")],
        "event_type",
        "value",
        {"view": "views", "click": "clicks", "purchase": "purchases"},
    )


@query(
    "agg_global",
    """
    select count(*) as orders, cast(sum(o_custkey) as bigint) as keys, min(o_orderdate) as first,
           cast((select sum(o_custkey) from orders where o_totalprice < 0) as bigint) as none
    from orders""",
)
def q_agg_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    whole = agg_global(
        orders, orders=F.count("*"), keys=F.sum("o_custkey"), first=F.min("o_orderdate")
    )
    empty = agg_global(orders.where(F.col("o_totalprice") < 0), none=F.sum("o_custkey"))
    return join_cross_scalar(whole, empty)


@query(
    "group_by_ordinal",
    """
    select o_orderstatus, strftime(o_orderdate, '%Y-%m') as year_month, count(*) as orders
    from orders group by 1, 2""",
)
def group_by_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["o_orderstatus", year_month("o_orderdate").alias("year_month")]
    return count_by(table(spark, sf_dir, "orders"), keys, "orders")


# --- windows ----------------------------------------------------------------------


@query(
    "dedup_latest",
    """
    select arg_max(event_id, (ts, event_id)) as event_id, max(ts) as ts, user_id, event_type,
           arg_max(value, (ts, event_id)) as value
    from events group by user_id, event_type""",
)
def q_dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").drop("props")
    return dedup_latest(events, ["user_id", "event_type"], "ts", ["event_id"])


@query(
    "dedup_earliest",
    """
    select arg_min(event_id, (ts, event_id)) as event_id, min(ts) as ts, user_id, event_type,
           arg_min(value, (ts, event_id)) as value
    from events group by user_id, event_type""",
)
def q_dedup_earliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").drop("props")
    return dedup_earliest(events, ["user_id", "event_type"], "ts", ["event_id"])


@query(
    "qualify_row_number",
    """
    select * from events
    qualify row_number() over (partition by cast(ts as date) order by value desc, event_id) <= 3""",
)
def q_qualify_row_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qualify_row_number(
        table(spark, sf_dir, "events"),
        [F.col("ts").cast("date")],
        [F.desc("value"), F.asc("event_id")],
        n=3,
    )


@query(
    "lag_change",
    f"""
    with monthly as (
        select o_orderstatus, strftime(o_orderdate, '%Y-%m') as month, count(*) as orders
        from orders group by all),
    paired as (
        select *, lag(orders) over (partition by o_orderstatus order by month) as prev_orders
        from monthly)
    select *, {rounded('(cast(orders - prev_orders as double) / nullif(prev_orders, 0) * 100)', 1)}
               as pct_orders
    from paired""",
)
def q_lag_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["o_orderstatus", year_month("o_orderdate").alias("month")]
    monthly = count_by(table(spark, sf_dir, "orders"), keys, "orders")
    return lag_change(monthly, "orders", ["o_orderstatus"], "month")


@query(
    "lag_change_split",
    f"""
    with paired as (
        select event_id, event_type, event_id + user_id as score,
               lag(event_id + user_id) over (partition by event_type order by ts) as prev_score
        from events)
    select *, {rounded('(cast(score - prev_score as double) / nullif(prev_score, 0) * 100)', 1)}
               as pct_score
    from paired""",
)
def lag_change_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row by row, without reducing to days: five large groups, split by day."""
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", (F.col("event_id") + F.col("user_id")).alias("score"), "ts"
    )
    day = F.date_trunc("day", "ts")
    return lag_change(events, "score", ["event_type"], "ts", split=day).drop("ts")


_USER_DAYS = """
    with daily as (
        select user_id, cast(ts as date) as day,
               max(case when event_type = 'purchase'
                        then cast(round(value * 100) as bigint) end) as cents
        from events group by all),
    spans as (select user_id, min(day) as a, max(day) as z from daily group by all),
    days as (
        select user_id, cast(unnest(generate_series(a, z, interval 1 day)) as date) as day
        from spans)"""


def _user_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    bought = F.when(F.col("event_type") == "purchase", _cents("value"))
    events = table(spark, sf_dir, "events")
    return events.groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(
        F.max(bought).alias("cents")
    )


@query(
    "forward_fill",
    f"""{_USER_DAYS}
    select user_id, day,
           last_value(cents ignore nulls) over (partition by user_id order by day) as cents
    from days left join daily using (user_id, day)""",
)
def q_forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = expand_days(_user_days(spark, sf_dir), "day", ["user_id"])
    return forward_fill(days, ["cents"], "day", ["user_id"])


@query(
    "forward_fill_split",
    """
    select event_id, event_type, last_value(case when user_id % 5 = 0 then value end ignore nulls)
               over (partition by event_type order by ts) as reading
    from events""",
)
def forward_fill_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "ts",
        F.when(F.col("user_id") % 5 == 0, F.col("value")).alias("reading"),
    )
    filled = forward_fill(
        events, ["reading"], "ts", ["event_type"], split=F.date_trunc("day", "ts")
    )
    return filled.drop("ts")


@query(
    "running_sum",
    """
    with daily as (
        select first_day as day, count(*) as new_customers
        from (select o_custkey, min(cast(o_orderdate as date)) as first_day
              from orders group by all)
        group by all)
    select day, new_customers,
           cast(sum(new_customers) over (order by day) as bigint) as cumulative_new_customers
    from daily""",
)
def q_running_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    firsts = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.min("o_orderdate").cast("date").alias("day"))
    )
    return running_sum(count_by(firsts, ["day"], "new_customers"), "new_customers", "day")


@query(
    "running_sum_split",
    """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey,
           cast(sum(cast(l_quantity as bigint)) over (partition by l_suppkey order by l_shipdate)
                as bigint) as cumulative_quantity
    from lineitem""",
)
def running_sum_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line by line per supplier, split by month of shipping."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
        F.col("l_quantity").cast("bigint").alias("quantity"),
    )
    month = F.date_trunc("month", "l_shipdate")
    summed = running_sum(lines, "quantity", "l_shipdate", ["l_suppkey"], split=month)
    return summed.drop("l_shipdate", "quantity")


# --- union, top k, time series ------------------------------------------------------


@query(
    "union_all",
    """
    select 'customer' as kind, c_nationkey as nation, count(*) as rows from customer group by all
    union all
    select 'supplier', s_nationkey, count(*) from supplier group by all""",
)
def q_union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.lit("customer").alias("kind"), F.col("c_nationkey").alias("nation")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("kind")
    )
    return count_by(union_all(customers, suppliers), ["kind", "nation"])


@query(
    "top_k_by_count",
    """
    with counted as (
        select cast(ts as date) as day, user_id, count(*) as events, min(event_id) as first_id
        from events group by all)
    select day, user_id, events, cast(row_number() over w as int) as rank from counted
    window w as (partition by day order by events desc, first_id)
    qualify row_number() over w <= 5""",
)
def q_top_k_by_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))
    return top_k_by_count(events, ["day"], "user_id", ["event_id"])


@query(
    "last_n",
    """
    select event_id, ts, user_id, event_type from events
    qualify row_number() over (partition by user_id order by ts desc, event_id desc) <= 8""",
)
def q_last_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return last_n(events, ["user_id"], ["ts", "event_id"])


@query(
    "numbered",
    """
    select event_id, event_type, row_number() over (partition by event_type order by ts, event_id)
               as position,
           count(*) over (partition by event_type) as size
    from events""",
)
def q_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    day = F.date_trunc("day", "ts")
    out = numbered(events, ["event_type"], ["ts", "event_id"], day, size="size")
    return out.drop("ts")


@query(
    "sample_every_nth",
    """
    select event_id, user_id, event_type from (
        select *, row_number() over (partition by user_id, event_type order by ts, event_id) as r,
               count(*) over (partition by user_id, event_type) as n
        from events)
    where n <= 5 or (r - 1) % 5 = 0""",
)
def q_sample_every_nth(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    sampled = sample_every_nth(
        events, ["user_id", "event_type"], ["ts", "event_id"], split=F.date_trunc("day", "ts")
    )
    return sampled.drop("ts")


@query(
    "date_spine",
    """
    select o_orderstatus, o_orderpriority, cast(unnest(generate_series(min(o_orderdate),
               max(o_orderdate), interval 1 day)) as date) as day
    from orders group by o_orderstatus, o_orderpriority""",
)
def q_date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "orders").select(
        "o_orderstatus", "o_orderpriority", F.col("o_orderdate").cast("date").alias("day")
    )
    return date_spine(days, "day", ["o_orderstatus", "o_orderpriority"])


@query(
    "gap_fill",
    f"""{_USER_DAYS}
    select user_id, day, ifnull(cents, 0) as cents
    from days left join daily using (user_id, day)""",
)
def q_gap_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = _user_days(spark, sf_dir)
    spine = date_spine(daily, "day", ["user_id"])
    return gap_fill(daily, spine, ["user_id", "day"], {"cents": 0})


@query(
    "expand_days",
    f"""{_USER_DAYS}
    select user_id, day, ifnull(cents, 0) as cents
    from days left join daily using (user_id, day)""",
)
def q_expand_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expand_days(_user_days(spark, sf_dir), "day", ["user_id"], {"cents": 0})


@query(
    "unpivot_reactions",
    """
    select event_id, 'prop_' || key as metric_name,
           case key when 'k' then json_extract_string(props, '$.k') end as metric_value
    from events, (values ('k'), ('missing')) as keys(key)""",
)
def q_unpivot_reactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", F.replace("props", F.lit('"'), F.lit("'")).alias("props")
    )
    return unpivot_reactions(events, "props", ["k", "missing"], prefix="prop_").drop("props")
