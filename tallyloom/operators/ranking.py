"""Top k, last n and every n-th row per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.dedup import qualify_row_number
from tallyloom.operators.timeseries import (
    _KEY,
    across_splits,
    earlier_splits,
    inside_split,
    split_rows,
)


def top_k_by_count(
    df: DataFrame,
    group: Sequence[str],
    item: str,
    seq: Sequence[str],
    k: int = 5,
    count_name: str = "events",
    rank_name: str = "rank",
) -> DataFrame:
    """The k most frequent items per group; ties go to the item seen first.

    Rows are counted per (group, item) before ranking, with partial counts ahead of
    the shuffle, and ranking keeps k rows per group and partition before its own.
    A NULL item is an item.
    """
    counted = df.groupBy(*group, item).agg(
        F.count("*").alias(count_name), F.min(F.struct(*seq)).alias("__first")
    )
    window = Window.partitionBy(*group).orderBy(F.desc(count_name), F.asc("__first"))
    return (
        counted.withColumn(rank_name, F.row_number().over(window))
        .where(F.col(rank_name) <= k)
        .drop("__first")
    )


def last_n(df: DataFrame, group: Sequence[str], seq: Sequence[str], n: int = 8) -> DataFrame:
    """The n latest rows per group."""
    return qualify_row_number(df, group, [F.col(c).desc_nulls_last() for c in seq], n)


def numbered(
    df: DataFrame,
    group: Sequence[str],
    seq: Sequence[str],
    split: Column | None = None,
    position: str = "position",
    size: str | None = None,
) -> DataFrame:
    """Number the rows of each group from 1 in ``seq`` order; all rows are kept.

    ``split`` never falls when ``seq`` rises (a minute of a timestamp, say). Each
    (group, split) is then numbered on its own and shifted by the row count of the
    splits before it, so a group with a third of all rows uses many tasks.
    """
    order = [F.col(c).asc_nulls_first() for c in seq]
    if split is None:
        window = Window.partitionBy(*group).orderBy(*order)
        out = df.withColumn(position, F.row_number().over(window))
        if size:
            out = out.withColumn(size, F.count("*").over(Window.partitionBy(*group)))
        return out

    marked = split_rows(df, group, split)
    counts = marked.groupBy(_KEY).agg(F.count("*").alias("__rows"))
    whole = Window.partitionBy(*group)
    shift = F.coalesce(F.sum("__rows").over(earlier_splits(group)), F.lit(0)).alias("__shift")
    sizes = [F.sum("__rows").over(whole).alias(size)] if size else []
    shifts = across_splits(counts, group, shift, *sizes)
    placed = marked.withColumn("__row", F.row_number().over(inside_split().orderBy(*order)))
    return placed.join(shifts, _KEY).select(
        *df.columns,
        (F.col("__row") + F.col("__shift")).alias(position),
        *([size] if size else []),
    )


def sample_every_nth(
    df: DataFrame,
    group: Sequence[str],
    seq: Sequence[str],
    step: int = 5,
    min_rows: int = 5,
    split: Column | None = None,
) -> DataFrame:
    """Rows 1, 1+step, 1+2*step ... of each group; all rows of groups up to ``min_rows``."""
    marked = numbered(df, group, seq, split, position="__position", size="__size")
    keep = ((F.col("__position") - 1) % step == 0) | (F.col("__size") <= min_rows)
    return marked.where(keep).drop("__position", "__size")
