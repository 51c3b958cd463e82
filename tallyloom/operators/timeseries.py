"""Gap-free series and ordered calculations.

Ordered calculations take an optional ``split``: a column that never falls when
``order`` rises, such as the month of a date. Without it one window task handles
each ``by`` group, which is right for rows already reduced to one per day (a
calendar bounds them). With it each (group, split) is a window of its own and only
one summary row per split is carried over from the splits before, so a group
holding a third of all rows is spread over as many tasks as it has splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.numbers import ratio_pct

_SPLIT = "__split"
_KEY = "__key"


def date_spine(df: DataFrame, date_col: str, by: Sequence[str] = ()) -> DataFrame:
    """Every day from the first to the last date, per ``by`` group if given.

    The bounds stay a one-row (or one row per group) frame; nothing is collected.
    An empty input, or only NULL dates, gives no rows.
    """
    bounds = df.groupBy(*by).agg(
        F.min(date_col).cast("date").alias("__first"), F.max(date_col).cast("date").alias("__last")
    )
    days = F.sequence("__first", "__last", F.expr("interval 1 day"))
    return bounds.where(F.col("__first").isNotNull()).select(*by, F.explode(days).alias(date_col))


def gap_fill(
    df: DataFrame, spine: DataFrame, on: Sequence[str], fill: dict[str, object]
) -> DataFrame:
    """Left join to the spine, with the given values in place of NULL measures."""
    joined = spine.join(df, list(on), "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fill.items()})


def expand_days(
    df: DataFrame, date_col: str, by: Sequence[str] = (), fill: dict[str, object] | None = None
) -> DataFrame:
    """Add the days missing between the rows of a frame that has one row per day.

    Same rows as ``gap_fill`` on ``date_spine``, but from one reading of ``df``: each
    row also stands for the empty days up to the row after it. Added days have NULL
    measures, or those of ``fill``. Rows without a date are left out.
    """
    fill = fill or {}
    following = F.lead(date_col).over(Window.partitionBy(*by).orderBy(date_col))
    until = F.greatest(F.date_sub(following, 1), F.col(date_col))
    days = F.sequence(date_col, F.coalesce(until, F.col(date_col)), F.expr("interval 1 day"))
    spread = (
        df.where(F.col(date_col).isNotNull())
        .withColumn("__days", days)
        .withColumn("__day", F.explode_outer("__days"))
    )

    def measure(c: str) -> Column:
        kept = F.when(F.col("__day") == F.col(date_col), F.col(c))
        return F.coalesce(kept, F.lit(fill[c])) if c in fill else kept

    return spread.select(
        *[
            F.col("__day").alias(c) if c == date_col
            else F.col(c) if c in by
            else measure(c).alias(c)
            for c in df.columns
        ]
    )


def split_rows(df: DataFrame, by: Sequence[str], split: Column) -> DataFrame:
    """Mark each row with the (group, split) it belongs to.

    The key is one struct: equal structs match even where a field is NULL, so a plain
    equality join works, and join and window share one partitioning.
    """
    return df.withColumn(_KEY, F.struct(*by, split.alias(_SPLIT)))


def across_splits(summary: DataFrame, by: Sequence[str], *values: Column) -> DataFrame:
    """Values computed over one row per (group, split), ready to be joined back."""
    named = [F.col(f"{_KEY}.`{c}`").alias(c) for c in by]
    split = F.col(f"{_KEY}.`{_SPLIT}`").alias(_SPLIT)
    return summary.select("*", *named, split).select(_KEY, *values)


def inside_split() -> Window:
    return Window.partitionBy(_KEY)


def earlier_splits(by: Sequence[str]) -> Window:
    """The splits of the group before the current one."""
    return (
        Window.partitionBy(*by)
        .orderBy(F.asc_nulls_first(_SPLIT))
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def forward_fill(
    df: DataFrame,
    cols: Sequence[str],
    order: str,
    by: Sequence[str] = (),
    split: Column | None = None,
) -> DataFrame:
    """NULLs replaced by the last value before them; leading NULLs stay.

    ``order`` should be unique within a group.
    """
    up_to_now = (Window.unboundedPreceding, Window.currentRow)
    if split is None:
        window = Window.partitionBy(*by).orderBy(order).rowsBetween(*up_to_now)
        return df.withColumns({c: F.last(c, ignorenulls=True).over(window) for c in cols})

    marked = split_rows(df, by, split)
    lasts = marked.groupBy(_KEY).agg(
        *[
            F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"__last_{c}")
            for c in cols
        ]
    )
    before = earlier_splits(by)
    carried = across_splits(
        lasts,
        by,
        *[F.last(f"__last_{c}", ignorenulls=True).over(before).alias(f"__carry_{c}") for c in cols],
    )
    inside = inside_split().orderBy(order).rowsBetween(*up_to_now)
    filled = marked.withColumns({c: F.last(c, ignorenulls=True).over(inside) for c in cols})
    return (
        filled.join(carried, _KEY, "left")
        .withColumns({c: F.coalesce(F.col(c), F.col(f"__carry_{c}")) for c in cols})
        .select(*df.columns)
    )


def running_sum(
    df: DataFrame,
    col: str,
    order: str,
    by: Sequence[str] = (),
    name: str | None = None,
    split: Column | None = None,
) -> DataFrame:
    """Sum up to and including the current ``order`` value; ties share their total."""
    name = name or f"cumulative_{col}"
    if split is None:
        window = Window.partitionBy(*by).orderBy(order)
        return df.withColumn(name, F.sum(col).over(window))

    marked = split_rows(df, by, split)
    totals = marked.groupBy(_KEY).agg(F.sum(col).alias("__total"))
    carried = across_splits(
        totals, by, F.sum("__total").over(earlier_splits(by)).alias("__carry")
    )
    summed = marked.withColumn("__sum", F.sum(col).over(inside_split().orderBy(order)))
    # Both parts NULL means no value so far, as in a plain running sum.
    total = F.when(
        F.col("__sum").isNotNull() | F.col("__carry").isNotNull(),
        F.coalesce("__sum", F.lit(0)) + F.coalesce("__carry", F.lit(0)),
    )
    return summed.join(carried, _KEY, "left").select(*df.columns, total.alias(name))


def lag_change(
    df: DataFrame,
    col: str,
    by: Sequence[str],
    order: str,
    digits: int = 1,
    prev_name: str | None = None,
    pct_name: str | None = None,
    split: Column | None = None,
) -> DataFrame:
    """The value one row before and the change from it in percent.

    ``order`` should be unique within a group.
    """
    prev_name = prev_name or f"prev_{col}"
    pct_name = pct_name or f"pct_{col}"
    if split is None:
        window = Window.partitionBy(*by).orderBy(order)
        out = df.withColumn(prev_name, F.lag(col).over(window))
    else:
        marked = split_rows(df, by, split)
        lasts = marked.groupBy(_KEY).agg(F.max_by(col, order).alias("__last"))
        following = Window.partitionBy(*by).orderBy(F.asc_nulls_first(_SPLIT))
        carried = across_splits(lasts, by, F.lag("__last").over(following).alias("__carry"))
        inside = inside_split().orderBy(order)
        previous = F.when(F.col("__row") == 1, F.col("__carry")).otherwise(F.col("__lag"))
        out = (
            marked.withColumns(
                {"__row": F.row_number().over(inside), "__lag": F.lag(col).over(inside)}
            )
            .join(carried, _KEY, "left")
            .select(*df.columns, previous.alias(prev_name))
        )
    change = F.col(col) - F.col(prev_name)
    return out.withColumn(pct_name, ratio_pct(change, prev_name, digits))
