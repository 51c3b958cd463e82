"""Join shapes of the marts.

There are no broadcast hints: the optimizer broadcasts a side only after checking its
size, and one-row aggregates are scalar subqueries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.labels import presence_label


def join_left_spine(spine: DataFrame, df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Every spine row, with the measures of ``df`` where it has any."""
    return spine.join(df, list(on), "left")


def join_left_enrich(
    one: DataFrame,
    many: DataFrame,
    key: str,
    aggs: Sequence[Column],
    zero_cols: Sequence[str] = (),
) -> DataFrame:
    """Add aggregates of ``many`` to ``one`` without multiplying its rows.

    The many side is grouped first, with partial sums before the shuffle, so the
    join sees one row per key on that side even for a very hot key.
    """
    summed = many.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)
    joined = one.join(summed, key, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zero_cols})


def join_full_outer(
    left: DataFrame,
    right: DataFrame,
    on: str,
    labels: tuple[str, str, str],
    label_col: str,
) -> DataFrame:
    """Full outer join of two frames keyed by ``on``, with a presence label."""
    a = left.withColumnRenamed(on, "__left")
    b = right.withColumnRenamed(on, "__right")
    joined = a.join(b, F.col("__left") == F.col("__right"), "full_outer")
    measures = [c for c in (*a.columns, *b.columns) if c not in ("__left", "__right")]
    return joined.select(
        F.coalesce("__left", "__right").alias(on),
        *measures,
        presence_label("__left", "__right", labels).alias(label_col),
    )


def join_cross_scalar(df: DataFrame, agg_df: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row.

    This is a scalar subquery: Spark runs the aggregate once, fails if it has more
    than one row, and neither joins nor shuffles ``df``.
    """
    one = agg_df.select(F.struct(*agg_df.columns).alias("one")).scalar()
    return df.withColumn("__one", one).select(
        *df.columns, *[F.col(f"__one.`{c}`").alias(c) for c in agg_df.columns]
    )
