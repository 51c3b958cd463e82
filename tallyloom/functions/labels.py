"""Buckets, categories and flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.text import ColumnLike, as_column

# Labels and limits that results must show exactly.
LIKE_STEPS = [
    (50, "0-50"),
    (100, "51-100"),
    (200, "101-200"),
    (500, "201-500"),
    (1000, "501-1000"),
    (5000, "1001-5000"),
]
LIKE_REST = "5000+"
LIVE_MINUTE_STEPS = [(30, "Short"), (90, "Medium")]
LIVE_MINUTE_REST = "Long"
VIDEO_SECOND_STEPS = [
    (180, "YouTube Shorts (< 3 min)"),
    (1800, "Short clips (< 30 min)"),
    (3600, "Medium (30–60 min)"),
]
VIDEO_SECOND_REST = "Long form (60+ min)"


def bucket(
    c: ColumnLike,
    steps: Sequence[tuple[float, str]],
    rest: str,
    null_label: str | None = None,
    inclusive: bool = False,
    floor: float | None = None,
) -> Column:
    """Label of the first step whose limit is above (or, if inclusive, at or above) the value.

    Values under ``floor`` and values past the last step get ``rest``. NULL gets
    ``null_label``, or ``rest`` where that is not given.
    """
    c = as_column(c)
    out = F.when(c.isNull(), F.lit(rest if null_label is None else null_label))
    if floor is not None:
        out = out.when(c < floor, F.lit(rest))
    for limit, label in steps:
        out = out.when((c <= limit) if inclusive else (c < limit), F.lit(label))
    return out.otherwise(F.lit(rest))


def bucket_likes(c: ColumnLike) -> Column:
    """Negative counts fall to the open bucket."""
    return bucket(c, LIKE_STEPS, LIKE_REST, null_label="unknown", inclusive=True, floor=0)


def bucket_live_duration(minutes: ColumnLike) -> Column:
    return bucket(minutes, LIVE_MINUTE_STEPS, LIVE_MINUTE_REST)


def bucket_video_duration(seconds: ColumnLike) -> Column:
    return bucket(seconds, VIDEO_SECOND_STEPS, VIDEO_SECOND_REST, null_label="Unknown")


def content_type_label(c: ColumnLike) -> Column:
    return F.when(as_column(c) == "live", F.lit("Live Stream")).otherwise(F.lit("Uploaded"))


def map_category(c: ColumnLike, mapping: Mapping[str, Sequence[str]], default: str) -> Column:
    """Category whose list holds the value. The lists are literals in the plan."""
    c = as_column(c)
    out = None
    for category, members in mapping.items():
        hit = c.isin(list(members))
        out = F.when(hit, F.lit(category)) if out is None else out.when(hit, F.lit(category))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def classify_keywords(
    c: ColumnLike, rules: Sequence[tuple[str, Sequence[str]]], default: str
) -> Column:
    """Category of the first rule with a phrase inside the text, upper or lower case."""
    lowered = F.lower(as_column(c))
    out = None
    for category, phrases in rules:
        hit = F.lit(False)
        for i, phrase in enumerate(phrases):
            found = lowered.contains(phrase.lower())
            hit = found if i == 0 else hit | found
        out = F.when(hit, F.lit(category)) if out is None else out.when(hit, F.lit(category))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def event_flags(c: ColumnLike, names: Sequence[str], prefix: str = "is_") -> list[Column]:
    """One boolean column per event type, NULL for a NULL type."""
    return [(as_column(c) == name).alias(f"{prefix}{name}") for name in names]


def presence_label(
    left: ColumnLike, right: ColumnLike, labels: tuple[str, str, str]
) -> Column:
    """Which sides of a full outer join are present: (both, left only, right only)."""
    left, right = as_column(left), as_column(right)
    both, left_only, right_only = labels
    return (
        F.when(left.isNotNull() & right.isNotNull(), F.lit(both))
        .when(right.isNotNull(), F.lit(right_only))
        .when(left.isNotNull(), F.lit(left_only))
    )
