"""Grouped and global aggregates, pivot, unpivot, union."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import ColumnLike, as_column, parse_json_texts, scalar_text

#: Registers of a distinct-count sketch, as a power of two.
SKETCH_LG_K = 14

_AGGS = {"max": F.max, "min": F.min, "sum": F.sum, "count": F.count, "avg": F.avg}


def count_by(df: DataFrame, keys: Sequence[str | Column], name: str = "rows") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def agg_global(df: DataFrame, **aggs: Column) -> DataFrame:
    """One row of aggregates, also for empty input."""
    return df.agg(*[expr.alias(name) for name, expr in aggs.items()])


def distinct_sketches(
    df: DataFrame, keys: Sequence[str | Column], value: str | Column, lg_k: int = SKETCH_LG_K
) -> DataFrame:
    """One HyperLogLog sketch of ``value`` per group, in column ``sketch``: 2 ** lg_k bytes at most.

    Stored per day, sketches answer for any period without the days' rows. NULLs are not counted; a
    group without values has an empty sketch.
    """
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, lg_k).alias("sketch"))


def distinct_over(
    sketches: DataFrame, keys: Sequence[str | Column], name: str = "distinct_values"
) -> DataFrame:
    """Distinct values per group of stored sketches, within ``distinct_error`` in 99 of 100 groups."""
    merged = sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))
    rest = [c for c in merged.columns if c != "sketch"]
    return merged.select(*rest, F.hll_sketch_estimate("sketch").cast("long").alias(name))


def distinct_error(lg_k: int = SKETCH_LG_K) -> float:
    """Three standard errors of an estimate, as a share of it."""
    return 3 * 1.04 / 2 ** (lg_k / 2)


def pivot_metrics(
    df: DataFrame,
    group_cols: Sequence[str | Column],
    name_col: str,
    value_col: str,
    names: Mapping[str, str] | Sequence[str],
    agg: str = "max",
) -> DataFrame:
    """Long to wide for a fixed list of metric names, in one aggregation.

    ``names`` maps metric name to output column. Each metric is a conditional
    aggregate, so partial results merge before the single shuffle.
    """
    if not isinstance(names, Mapping):
        names = {n: n for n in names}
    pick = _AGGS[agg]
    return df.groupBy(*group_cols).agg(
        *[
            pick(F.when(F.col(name_col) == metric, F.col(value_col))).alias(out)
            for metric, out in names.items()
        ]
    )


def unpivot_reactions(
    df: DataFrame,
    json_col: ColumnLike,
    keys: Sequence[str],
    prefix: str = "reaction_",
    only_when: Column | None = None,
    name_col: str = "metric_name",
    value_col: str = "metric_value",
) -> DataFrame:
    """One row per key of the JSON text in ``json_col``.

    With ``only_when``, other rows pass through unchanged; both kinds come out of
    one scan, instead of a filter per kind and a union.
    """
    parsed = parse_json_texts(json_col, keys)
    if only_when is not None:
        parsed = F.when(only_when, parsed)
    unpivoted = F.array(
        *[
            F.struct(
                F.lit(f"{prefix}{k}").alias("name"), scalar_text(f"__json.{k}").alias("value")
            )
            for k in keys
        ]
    )
    if only_when is not None:
        kept = F.array(
            F.struct(F.col(name_col).alias("name"), as_column(json_col).alias("value"))
        )
        unpivoted = F.when(only_when, unpivoted).otherwise(kept)
    rest = [c for c in df.columns if c not in (name_col, value_col)]
    # Parsing has a step of its own, so that it happens once per row. The arrays are never
    # empty; the outer form keeps Spark from adding a filter that would parse again.
    staged = df.withColumn("__json", parsed).withColumn("__pairs", unpivoted)
    exploded = staged.select(*rest, F.explode_outer("__pairs").alias("__pair"))
    return exploded.select(
        *rest, F.col("__pair.name").alias(name_col), F.col("__pair.value").alias(value_col)
    )


def union_all(*frames: DataFrame) -> DataFrame:
    """Rows of all frames, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)
