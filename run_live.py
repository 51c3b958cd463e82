"""The live run: land events, then write the model and the report frames of all sessions.

    spark-submit run_live.py EVENTS RAW REPORTS [youtube]

EVENTS is a folder of JSON-lines files. Every delivery is landed, late ones too; what has
arrived since the last run is taken. Copies are dropped in batch, when the model is built
from the landed table. Report frames are tables below REPORTS.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession

from tallyloom.operators import dedup_earliest
from tallyloom.plans.refresh import ModelFrames
from tallyloom.session import configure
from tallyloom.sources import materialize_table, read_sources, sink_events
from tallyloom.sources.schemas import EVENT_TABLES
from tallyloom.streaming import session_report, stream_events


def land_events(spark: SparkSession, events: str, raw_root: str, table: str) -> None:
    """Append what has arrived to the event table, each file once."""
    stream = stream_events(spark, events, EVENT_TABLES[table])
    target = f"{raw_root.rstrip('/')}/{table}"
    sink_events(stream, target, f"{target}_progress", interval=None, fmt="parquet").awaitTermination()


def main(events: str, raw_root: str, reports: str, platform: str = "tiktok") -> dict[str, DataFrame]:
    spark = configure(SparkSession.builder.appName("live").getOrCreate())
    table = f"raw_{platform}_live_events"
    land_events(spark, events, raw_root, table)
    landed = read_sources(spark, raw_root, [table])[table]
    once = materialize_table(dedup_earliest(landed, ["event_id"], "ingested_at"), f"{reports}/_events")
    frames = session_report(once, chat=platform == "youtube")
    if platform == "tiktok":
        frames["stg_tiktok_livestream"] = ModelFrames({table: landed}.__getitem__)["stg_tiktok_livestream"]
    return {name: materialize_table(df, f"{reports}/{name}") for name, df in frames.items()}


if __name__ == "__main__":
    main(*sys.argv[1:5])
