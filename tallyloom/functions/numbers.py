"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.text import ColumnLike, as_column

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_bigint(c: ColumnLike, on_error: str = "fail") -> Column:
    """Cast to a whole number; ``on_error='null'`` turns bad text into NULL."""
    c = as_column(c)
    return c.try_cast("bigint") if on_error == "null" else c.cast("bigint")


def clean_number(c: ColumnLike, sentinel: str = "N/A", on_error: str = "fail") -> Column:
    """'1,234' to 1234, the sentinel to NULL."""
    bare = F.replace(F.nullif(as_column(c), F.lit(sentinel)), F.lit(","), F.lit(""))
    return to_bigint(bare, on_error)


def coerce_int(c: ColumnLike) -> Column:
    """Number text truncated to a whole number, anything else 0."""
    c = as_column(c)
    return F.when(c.rlike(_NUMBER), F.trim(c).try_cast("double").cast("bigint")).otherwise(
        F.lit(0).cast("bigint")
    )


def safe_ratio(num: ColumnLike, den: ColumnLike) -> Column:
    """num / den as a double, NULL for a zero divisor."""
    return F.try_divide(as_column(num).cast("double"), as_column(den).cast("double"))


def ratio_pct(num: ColumnLike, den: ColumnLike, digits: int, scale: int = 100) -> Column:
    ratio = safe_ratio(num, den)
    return F.round(ratio if scale == 1 else ratio * F.lit(scale), digits)


def exact_avg(c: ColumnLike, digits: int) -> Column:
    """Mean of values that carry ``digits`` decimals.

    The sum is taken in decimals, so it does not depend on the order in which
    partitions are merged.
    """
    c = as_column(c)
    total = F.sum(c.cast(f"decimal(28,{digits})")).cast("double")
    return F.try_divide(total, F.count(c).cast("double"))


def gift_value(diamonds: ColumnLike, repeats: ColumnLike) -> Column:
    """Diamonds of one gift event: unit price times repeats, defaults 0 and 1."""
    price = F.coalesce(as_column(diamonds), F.lit(0)).cast("bigint")
    return price * F.coalesce(as_column(repeats), F.lit(1)).cast("bigint")


def parse_iso_duration(c: ColumnLike) -> Column:
    """Seconds of 'P1DT2H3M4S'; NULL without a time part or for other text."""
    c = as_column(c)
    seconds = F.lit(0).cast("bigint")
    # Seconds per unit of an ISO 8601 duration.
    for pattern, unit in (
        (r"^P(\d+)DT", 86400),
        (r"^P(?:\d+D)?T(\d+)H", 3600),
        (r"^P(?:\d+D)?T(?:\d+H)?(\d+)M", 60),
        (r"^P(?:\d+D)?T(?:\d+H)?(?:\d+M)?(\d+)S", 1),
    ):
        part = F.regexp_extract(c, pattern, 1).try_cast("bigint")
        seconds = seconds + F.coalesce(part, F.lit(0)) * F.lit(unit)
    return F.when(c.rlike(r"^P(\d+D)?T"), seconds)
