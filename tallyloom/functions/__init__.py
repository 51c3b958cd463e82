"""Column expressions: text, numbers, calendar, labels. All run inside the JVM."""

from tallyloom.functions.calendar import (
    day_name,
    days_between,
    event_hour,
    iso_day_num,
    sunday_day_num,
    utc_timestamp,
    year_label,
    year_month,
    year_week,
)
from tallyloom.functions.labels import (
    bucket,
    bucket_likes,
    bucket_live_duration,
    bucket_video_duration,
    classify_keywords,
    content_type_label,
    event_flags,
    map_category,
    presence_label,
)
from tallyloom.functions.numbers import (
    clean_number,
    coerce_int,
    exact_avg,
    gift_value,
    parse_iso_duration,
    ratio_pct,
    safe_ratio,
    to_bigint,
)
from tallyloom.functions.text import (
    count_matches,
    default_nulls,
    extract_field,
    json_texts,
    lower_norm,
    null_sentinels,
    regexp_or_null,
    strip,
    surrogate_key,
    trim_blank,
)

__all__ = [
    "bucket",
    "bucket_likes",
    "bucket_live_duration",
    "bucket_video_duration",
    "classify_keywords",
    "clean_number",
    "coerce_int",
    "content_type_label",
    "count_matches",
    "day_name",
    "days_between",
    "default_nulls",
    "event_flags",
    "event_hour",
    "exact_avg",
    "extract_field",
    "gift_value",
    "iso_day_num",
    "json_texts",
    "lower_norm",
    "map_category",
    "null_sentinels",
    "parse_iso_duration",
    "presence_label",
    "ratio_pct",
    "regexp_or_null",
    "safe_ratio",
    "strip",
    "sunday_day_num",
    "surrogate_key",
    "to_bigint",
    "trim_blank",
    "utc_timestamp",
    "year_label",
    "year_month",
    "year_week",
]
