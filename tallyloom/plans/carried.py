"""Daily series whose running values are carried from run to run.

A series has a row per group and day. Its rows are kept by period (a month, say), and with each
period what the groups carry out of it: the last known value and the running total. A run takes in
new days, or corrected old ones, and calculates their periods and those after them again, each from
what the period before has carried out. New days thus cost their own period, a corrected day the
periods since; no other rows are read. A group has at most a row per day of a period in a window,
so none is large.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.operators import qualify_row_number
from tallyloom.sources.versions import (
    Version,
    _hadoop,
    commit,
    current_version,
    drop_unused,
    read_version,
    write_folder,
)

_PERIOD, _CARRIED, _FRESH = "__period", "__carried", "__fresh"
_OUT = "/out"


def advance_series(
    days: DataFrame,
    path: str,
    groups: Sequence[str],
    day: str,
    value: str,
    period: str = "month",
) -> Version | None:
    """Take days into the series at ``path``: columns groups, day, value, ``filled`` and ``total``.

    ``filled`` is the last value that is not NULL, ``total`` the sum of values up to the day. A day
    that is there already is replaced; of several rows of a group and day in one batch the largest
    value stays. NULL is a group like any other; rows without a day are left out. ``period`` is a
    unit of ``date_trunc`` and stays that of the first run. An empty batch changes nothing.
    """
    spark = days.sparkSession
    base = current_version(spark, path)
    unit = base.notes["period"] if base else period
    columns = [*groups, day, value]
    given = days.select(*columns).where(F.col(day).isNotNull())
    label = F.date_format(F.date_trunc(unit, F.col(day)), "yyyy-MM-dd")
    staged_path = f"{path}/_staged-{uuid.uuid4().hex}"
    staged = write_folder(given.withColumn(_PERIOD, label), staged_path, _PERIOD)
    parts = dict(base.parts) if base else {}
    if not staged:
        return base
    known = {p for p in parts if not p.endswith(_OUT)}
    schema, computed = given.schema, _schema(given, groups, day, value)
    before = max((p for p in known if p < min(staged)), default=None)
    carried = _read(spark, path, parts, f"{before}{_OUT}", computed) if before else None
    for part in sorted({p for p in known if p >= min(staged)} | set(staged)):
        fresh = [spark.read.schema(schema).parquet(f"{staged_path}/{staged[part]}")] if part in staged else []
        old = _read(spark, path, parts, part, computed).where(~F.col(_CARRIED)).select(*columns) if part in known else None
        rows = [x.withColumn(_FRESH, F.lit(True)) for x in fresh]
        rows += [old.withColumn(_FRESH, F.lit(False))] if old is not None else []
        merged = rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1])
        order = [F.col(_FRESH).desc(), F.col(value).desc_nulls_last()]
        merged = qualify_row_number(merged, [*groups, day], order).select(*columns)
        parts[part] = write_folder(_run(merged, carried, groups, day, value), path)[""]
        done = _read(spark, path, parts, part, computed)
        last = Window.partitionBy(*groups).orderBy(F.col(day).desc_nulls_last())
        out = done.withColumn("__n", F.row_number().over(last)).where("__n = 1").drop("__n")
        # What goes into the next period stands before all of its days.
        out = out.withColumns({day: F.lit(None).cast(schema[day].dataType), _CARRIED: F.lit(True)})
        parts[f"{part}{_OUT}"] = write_folder(out.select(*computed.fieldNames()), path)[""]
        carried = _read(spark, path, parts, f"{part}{_OUT}", computed)
    version = commit(spark, path, base, parts, {"period": unit})
    fs, place = _hadoop(spark, staged_path)
    fs.delete(place, True)
    drop_unused(spark, path)
    return version


def read_series(spark: SparkSession, path: str, days: DataFrame, groups: Sequence[str], day: str, value: str) -> DataFrame:
    """The whole series; ``days`` is a frame with the columns and types of those taken in."""
    version = current_version(spark, path)
    schema = _schema(days.select(*groups, day, value), groups, day, value)
    periods = [p for p in version.parts if not p.endswith(_OUT)] if version else []
    rows = read_version(spark, path, schema, version, periods)
    return rows.where(~F.col(_CARRIED)).drop(_CARRIED)


def _run(rows: DataFrame, carried: DataFrame | None, groups: Sequence[str], day: str, value: str) -> DataFrame:
    """Rows of one period with filled and total, and the rows that the period before carries in."""
    none = F.lit(None)
    start = rows.withColumns(
        {"filled": none.cast(rows.schema[value].dataType), "total": none.cast("long"), _CARRIED: F.lit(False)}
    )
    every = start if carried is None else start.unionByName(carried)
    up_to = Window.partitionBy(*groups).orderBy(F.col(day).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    own = F.when(F.col(_CARRIED), F.col("filled")).otherwise(F.col(value))
    added = F.when(F.col(_CARRIED), F.col("total")).otherwise(F.col(value).cast("long"))
    return every.withColumns({"__own": own, "__added": added}).select(
        *groups, day, value,
        F.last("__own", ignorenulls=True).over(up_to).alias("filled"),
        F.sum("__added").over(up_to).alias("total"),
        _CARRIED,
    )


def _schema(rows: DataFrame, groups: Sequence[str], day: str, value: str):
    return _run(rows.limit(0), None, groups, day, value).schema


def _read(spark: SparkSession, path: str, parts: dict[str, str], part: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{path}/{parts[part]}")
