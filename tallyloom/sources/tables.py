"""Raw tables and landed event files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.sources.schemas import EVENT_TABLES, INVENTORY_TABLES, RAW_TABLES


def attach_ingested_at(df: DataFrame, at: Column | None = None) -> DataFrame:
    """Stamp the batch; the clock is read once per query."""
    return df.withColumn("ingested_at", F.current_timestamp() if at is None else at)


def attach_row_key(df: DataFrame) -> DataFrame:
    """A hash of all values but the ingest time."""
    values = [c for c in df.columns if c not in ("ingested_at", "row_key")]
    filled = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in values]
    return df.withColumn("row_key", F.md5(F.concat_ws("|", *filled).cast("binary")))


def read_sources(
    spark: SparkSession,
    root: str,
    names: Iterable[str] = tuple(RAW_TABLES),
    missing: str = "fail",
) -> dict[str, DataFrame]:
    """The raw tables below ``root`` as lazy frames under their declared schemas.

    ``missing='empty'`` reads a table that was never landed as one without rows. Live
    event tables and the video inventory are read when they are named.
    """
    schemas = {**RAW_TABLES, **EVENT_TABLES, **INVENTORY_TABLES}

    def read(name: str) -> DataFrame:
        try:
            return spark.read.schema(schemas[name]).parquet(f"{root.rstrip('/')}/{name}")
        except AnalysisException as e:
            if missing != "empty" or e.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schemas[name])

    return {name: read(name) for name in names}


def read_event_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Landed live events, one JSON object per line. A line that is no JSON fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
