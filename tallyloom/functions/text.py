"""Text cleaning expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnLike = Column | str

# All Unicode white space, with the four ASCII separators.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def as_column(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: ColumnLike) -> Column:
    """Drop white space of any kind (tabs and line ends too) at both ends."""
    return F.trim(as_column(c), F.lit(WHITE_SPACE))


def regexp_or_null(c: ColumnLike, pattern: str, group: int = 1) -> Column:
    """First match of a group, NULL where nothing matches."""
    return F.nullif(F.regexp_extract(as_column(c), pattern, group), F.lit(""))


def count_matches(c: ColumnLike, pattern: str) -> Column:
    """Number of matches, 0 for NULL text."""
    return F.regexp_count(F.coalesce(as_column(c), F.lit("")), F.lit(pattern)).cast("bigint")


def extract_field(c: ColumnLike, label: str) -> Column:
    """The rest of the first line holding ``label: ``, stripped; NULL if absent.

    The dot ends at a newline only, and a value of blanks is '' and not NULL.
    """
    return strip(regexp_or_null(c, rf"(?d)\Q{label}\E: (.+)"))


def default_nulls(c: ColumnLike, default: object) -> Column:
    return F.coalesce(as_column(c), F.lit(default))


def null_sentinels(c: ColumnLike, values: Iterable[str] = ("N/A",)) -> Column:
    """NULL where the text is one of the given stand-ins."""
    out = as_column(c)
    for value in values:
        out = F.nullif(out, F.lit(value))
    return out


def trim_blank(c: ColumnLike) -> Column:
    return F.nullif(strip(c), F.lit(""))


def lower_norm(c: ColumnLike, default: str) -> Column:
    return F.lower(F.coalesce(as_column(c), F.lit(default)))


def surrogate_key(*cols: ColumnLike) -> Column:
    """Hex md5 of the columns joined by a pipe, NULLs as ''."""
    return F.md5(F.concat_ws("|", *[F.coalesce(as_column(c), F.lit("")) for c in cols]))


def parse_json_texts(c: ColumnLike, keys: Iterable[str]) -> Column:
    """Some keys of JSON text as a struct of strings, nested values as their JSON text.

    Accepts JSON and the printed form of a Python dict (single quotes, None).
    """
    fixed = F.replace(F.replace(as_column(c), F.lit("'"), F.lit('"')), F.lit("None"), F.lit("null"))
    return F.from_json(fixed, T.StructType([T.StructField(k, T.StringType()) for k in keys]))


def scalar_text(c: ColumnLike) -> Column:
    """NULL for the JSON text of an object or array."""
    c = as_column(c)
    return F.when(~c.startswith("{") & ~c.startswith("["), c)


def json_texts(c: ColumnLike, keys: Iterable[str]) -> Column:
    """The scalar values of some keys of JSON text as a struct of strings.

    A missing key, a null, a nested value or broken text gives NULL.
    """
    keys = list(keys)
    parsed = parse_json_texts(c, keys)
    return F.struct(*[scalar_text(parsed[k]).alias(k) for k in keys])
