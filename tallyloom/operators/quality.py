"""Declarative data tests.

All row-level tests of a table share one aggregation pass; each uniqueness test is
one grouped count. Results are frames: nothing is collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.aggregates import union_all

RESULT_COLUMNS = ["table", "column", "check", "failures", "severity", "status"]

# (column, check, severity, condition that marks a failing row)
RowCheck = tuple[str, str, str, Column]


def _not_null(col: str, severity: str = "error") -> RowCheck:
    return (col, "not_null", severity, F.col(col).isNull())


def _accepted(col: str, values: Sequence[str], severity: str = "error") -> RowCheck:
    bad = F.col(col).isNotNull() & ~F.col(col).isin(list(values))
    return (col, "accepted_values", severity, bad)


def _expression(col: str, expr: str, severity: str = "error") -> RowCheck:
    # NULL passes: only a row where the condition is false fails.
    return (col, f"expression: {expr}", severity, ~F.expr(f"`{col}` {expr}"))


def _run_row_checks(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    counted = df.agg(*[F.count_if(bad).alias(f"c{i}") for i, (*_, bad) in enumerate(checks)])
    rows = [
        F.struct(
            F.lit(col).alias("column"),
            F.lit(check).alias("check"),
            F.col(f"c{i}").alias("failures"),
            F.lit(severity).alias("severity"),
        )
        for i, (col, check, severity, _) in enumerate(checks)
    ]
    return counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _finish(df: DataFrame, table: str) -> DataFrame:
    status = F.when(F.col("failures") == 0, F.lit("PASS")).otherwise(F.upper("severity"))
    return df.select(
        F.lit(table).alias("table"), "column", "check", "failures", "severity",
        status.alias("status"),
    )


def check_not_null(
    df: DataFrame, cols: Sequence[str], table: str = "", severity: str = "error"
) -> DataFrame:
    return _finish(_run_row_checks(df, [_not_null(c, severity) for c in cols]), table)


def check_accepted_values(
    df: DataFrame, col: str, values: Sequence[str], table: str = "", severity: str = "error"
) -> DataFrame:
    """NULLs pass."""
    return _finish(_run_row_checks(df, [_accepted(col, values, severity)]), table)


def check_expression(
    df: DataFrame, col: str, expr: str, table: str = "", severity: str = "error"
) -> DataFrame:
    """``col expr`` must not be false, for example ``check_expression(df, 'likes', '>= 0')``."""
    return _finish(_run_row_checks(df, [_expression(col, expr, severity)]), table)


def _unique(df: DataFrame, cols: Sequence[str], severity: str = "error") -> DataFrame:
    present = F.lit(True)
    for c in cols:
        present = present & F.col(c).isNotNull()
    repeated = df.where(present).groupBy(*cols).agg(F.count("*").alias("n")).where("n > 1")
    return repeated.agg(F.count("*").alias("failures")).select(
        F.lit(", ".join(cols)).alias("column"),
        F.lit("unique").alias("check"),
        "failures",
        F.lit(severity).alias("severity"),
    )


def check_unique(
    df: DataFrame, cols: Sequence[str], table: str = "", severity: str = "error"
) -> DataFrame:
    """Number of values held by more than one row; NULLs are left out."""
    return _finish(_unique(df, cols, severity), table)


def check_row_count(
    df: DataFrame, minimum: int = 1, table: str = "", severity: str = "error"
) -> DataFrame:
    """Fails when the table has fewer rows than ``minimum``."""
    missing = F.greatest(F.lit(minimum) - F.count("*"), F.lit(0)).cast("bigint")
    counted = df.agg(missing.alias("failures")).select(
        F.lit("*").alias("column"),
        F.lit(f"row_count >= {minimum}").alias("check"),
        "failures",
        F.lit(severity).alias("severity"),
    )
    return _finish(counted, table)


def _severity(spec: Mapping[str, object], col: str, check: str) -> str:
    return "warn" if (col, check) in set(spec.get("warn", ())) else "error"


def _row_checks(spec: Mapping[str, object]) -> list[RowCheck]:
    """The row-level tests that a suite declares for one table."""
    checks = [_not_null(c, _severity(spec, c, "not_null")) for c in spec.get("not_null", ())]
    checks += [
        _accepted(c, values, _severity(spec, c, "accepted_values"))
        for c, values in spec.get("accepted", {}).items()
    ]
    checks += [
        _expression(c, ">= 0", _severity(spec, c, "expression: >= 0"))
        for c in spec.get("at_least_zero", ())
    ]
    return checks


def observe_checks(df: DataFrame, spec: Mapping[str, object]) -> tuple[DataFrame, Observation]:
    """``df`` and what its next write will have seen: the row count and failing rows per row test.

    The counts are taken in the tasks that write, so they cost no scan, and a task that is run
    again counts once. ``spec`` is a table's entry of a suite; without one only rows are counted.
    """
    seen = Observation()
    counts = [F.count_if(bad).alias(f"c{i}") for i, (*_, bad) in enumerate(_row_checks(spec))]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen


_FOUND = "column string, check string, failures bigint, severity string"


def _observed(spark: SparkSession, spec: Mapping[str, object], seen: Observation) -> DataFrame:
    """Results of row tests as they were counted by a write."""
    checks = enumerate(_row_checks(spec))
    found = [(col, check, seen.get[f"c{i}"], severity) for i, (col, check, severity, _) in checks]
    return spark.createDataFrame(found, _FOUND)


def run_checks(
    tables: Mapping[str, DataFrame],
    suite: Mapping[str, Mapping[str, object]],
    observed: Mapping[str, Observation] | None = None,
) -> DataFrame:
    """Run a suite over tables; see ``plans.suite`` for the form.

    A ``warn`` entry of a table lists (column, check) pairs that only warn. The row tests of
    tables in ``observed`` are not run again (``observe_checks``), their uniqueness tests are.
    """
    results = []
    for name, spec in suite.items():
        df = tables[name]
        checks = _row_checks(spec)
        if checks and name in (observed or {}):
            results.append(_finish(_observed(df.sparkSession, spec, observed[name]), name))
        elif checks:
            results.append(_finish(_run_row_checks(df, checks), name))
        for col in spec.get("unique", ()):
            results.append(_finish(_unique(df, [col], _severity(spec, col, "unique")), name))
    return union_all(*results)


def check_row_counts(
    tables: Mapping[str, DataFrame],
    minimum: int = 1,
    severity: str = "warn",
    observed: Mapping[str, Observation] | None = None,
) -> DataFrame:
    """``check_row_count`` of several tables; those in ``observed`` are not scanned.

    Row tests and uniqueness pass on a table without rows, so this is what tells of one.
    """
    results = []
    for name, df in tables.items():
        if name not in (observed or {}):
            results.append(check_row_count(df, minimum, name, severity))
            continue
        short = max(minimum - observed[name].get["rows"], 0)
        found = [("*", f"row_count >= {minimum}", short, severity)]
        results.append(_finish(df.sparkSession.createDataFrame(found, _FOUND), name))
    return union_all(*results)


def mart_row_summary(marts: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per mart."""
    return union_all(
        *[
            df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("mart"), "rows")
            for name, df in marts.items()
        ]
    )


def check_inputs_present(spark: SparkSession, directory: str, required: Sequence[str]) -> DataFrame:
    """Required file names and whether the folder holds them; a missing one only warns.

    A folder of that name with files in it counts too. File contents are not read.
    """
    parts = F.split("path", "/")
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(directory)
        .select(F.explode(F.array(F.element_at(parts, -1), F.element_at(parts, -2))).alias("file"))
        .where(F.col("file").isin(list(required)))
        .groupBy("file")
        .agg(F.lit(True).alias("__found"))
    )
    wanted = spark.createDataFrame(
        [(name,) for name in required], T.StructType([T.StructField("file", T.StringType())])
    )
    found = F.col("__found").isNotNull()
    return wanted.join(listed, "file", "left").select(
        "file",
        found.alias("present"),
        F.when(found, F.lit("PASS")).otherwise(F.lit("WARN")).alias("status"),
    )
