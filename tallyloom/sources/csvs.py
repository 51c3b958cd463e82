"""Metric CSV exports."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.numbers import coerce_int
from tallyloom.functions.text import strip
from tallyloom.sources.heads import file_heads, utf16_order
from tallyloom.sources.tables import attach_ingested_at

# File name to metric name.
METRIC_FILES = {
    "Views.csv": "page_views",
    "Visits.csv": "page_visits",
    "Follows.csv": "page_follows_daily",
    "Viewers.csv": "page_viewers",
    "Interactions.csv": "page_interactions",
    "Link clicks.csv": "page_link_clicks",
}


def read_metric_csvs(
    spark: SparkSession,
    directory: str,
    name_map: Mapping[str, str] = METRIC_FILES,
    ingested_at: Column | None = None,
    byte_order: str | None = None,
    header: str = "Date",
) -> DataFrame:
    """UTF-16 files of (date, value) below two preamble lines and a header.

    All files of the folder (and below) are one scan. ``name_map`` gives the metric
    for a file name, or for the name of the folder that holds the file. Other files
    are left out, missing ones are no error. A row of a single cell is preamble and the
    row that starts with ``header`` is the header; any other first cell that is no date
    fails the job.

    The mark at the start of a file tells its byte order; for files longer than a split it
    is looked up when the scan is planned, so that lines are found by their bytes and the file
    is read as many splits. A large file without a mark is one task, unless all files are
    known to be 'LE' or 'BE' and ``byte_order`` says so.
    """
    names = F.create_map(*[F.lit(x) for pair in name_map.items() for x in pair])
    parts = F.split(F.url_decode(F.col("_metadata.file_path")), "/")
    metric = F.coalesce(
        F.try_element_at(names, F.element_at(parts, -1)),
        F.try_element_at(names, F.element_at(parts, -2)),
    )
    by_order: dict[str | None, list[str]] = {}
    if byte_order is None:
        for name, head in file_heads(spark, directory):
            by_order.setdefault(head and utf16_order(head), []).append(name)
    if len(by_order) < 2:
        by_order = {byte_order or next(iter(by_order), None): [directory]}

    def scan(order: str | None, files: list[str]) -> DataFrame:
        reader = spark.read.schema("day string, amount string").option("recursiveFileLookup", True)
        if order is None:
            reader = reader.option("encoding", "UTF-16").option("multiLine", True)
        else:
            reader = reader.option("encoding", f"UTF-16{order}").option("lineSep", "\n")
        # Where lines are found by their bytes, the mark is the first sign of the file.
        day = F.ltrim(F.col("day"), F.lit("\ufeff"))
        return reader.csv(files).select(day.alias("day"), "amount", metric.alias("metric_name"))

    rows = reduce(DataFrame.unionByName, [scan(*x) for x in by_order.items()])
    read = strip("day").try_cast("timestamp").cast("date")
    day = F.coalesce(
        read, F.raise_error(F.concat(F.lit("no date in a metric file: "), F.col("day"))).cast("date")
    )
    preamble = strip(F.coalesce("amount", F.lit(""))) == ""
    title = F.lower(strip("day")) == header.lower()
    # A day without a reading is data; without a date as well it is preamble.
    kept = rows.where(
        F.col("metric_name").isNotNull() & F.col("day").isNotNull() & ~title
        & ~(preamble & read.isNull())
    )
    return attach_ingested_at(
        kept.select(day.alias("date"), coerce_int(strip("amount")).alias("value"), "metric_name"),
        ingested_at,
    )
