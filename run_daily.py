"""The daily run: land a batch, bring the marts up to date, test them.

    spark-submit run_daily.py LANDING RAW MARTS [incremental]

With ``incremental`` only what is new is read, and marts are kept in versions
(``tallyloom.sources.versions.read_version``); else they are rebuilt as plain tables.
Exits with 1 if a test fails with severity error. Results of the tests, with those of
the landed row counts, are written to MARTS/_checks, a warning per mart without rows to
MARTS/_mart_rows, the row counts of marts to MARTS/_summary, the exports found to
MARTS/_inputs and playlist ids without a video to MARTS/_missing_videos. Sources that have
not landed yet count as empty.
"""

from __future__ import annotations

import sys

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from tallyloom.operators import check_inputs_present, check_row_count, union_all
from tallyloom.plans.incremental import refresh_incremental
from tallyloom.plans.landing import land_batch, videos_not_landed
from tallyloom.plans.refresh import check_mart_rows, check_marts, refresh_marts, summarize_marts
from tallyloom.session import configure
from tallyloom.sources import materialize_table, read_sources
from tallyloom.sources.exports import REQUIRED_EXPORTS
from tallyloom.sources.schemas import INVENTORY_TABLES, RAW_TABLES


def main(landing: str, raw_root: str, mart_root: str, mode: str = "full") -> int:
    spark = configure(SparkSession.builder.appName("daily").getOrCreate())
    try:
        inputs = check_inputs_present(spark, f"{landing}/tiktok", REQUIRED_EXPORTS)
        materialize_table(inputs, f"{mart_root}/_inputs")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        print("no exports have landed")
    outcomes = land_batch(spark, landing, raw_root)
    for table, outcome in outcomes.items():
        print(f"{table}: {outcome}")
    raw = read_sources(spark, raw_root, [*RAW_TABLES, *INVENTORY_TABLES], missing="empty")
    refresh = refresh_incremental if mode == "incremental" else refresh_marts
    observed = {}
    stored = refresh(spark, raw_root, mart_root, missing="empty", observed=observed)
    counts = [check_row_count(raw[name], table=name, severity="warn") for name in raw]
    checks = materialize_table(union_all(check_marts(stored, observed), *counts), f"{mart_root}/_checks")
    mart_rows = materialize_table(check_mart_rows(stored, observed), f"{mart_root}/_mart_rows")
    materialize_table(videos_not_landed(raw), f"{mart_root}/_missing_videos")
    materialize_table(summarize_marts(stored), f"{mart_root}/_summary")
    failed = checks.where("status = 'ERROR'").count()
    print(f"tests with errors: {failed}")
    # Tests of rows pass where there are none.
    print(f"marts without rows: {mart_rows.where('failures > 0').count()}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:5]))
