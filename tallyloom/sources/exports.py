"""Text exports: blocks of ``Label: value`` lines.

Blocks are the records of Spark's own text reader (``lineSep``), so one big export
is still read as many splits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.text import extract_field, strip
from tallyloom.sources.heads import file_heads, line_end
from tallyloom.sources.tables import attach_ingested_at

# Block separators and headers of the exports.
LIVE_HISTORY_DELIMITER = "-" * 12
LIVE_COMMENTS_DELIMITER = "-" * 23
POSTS_HEADER = "Date:"
FOLLOWERS_HEADER = "Date:"
WATCH_HISTORY_HEADER = "Date and time:"

REQUIRED_EXPORTS = [
    "Go_LIVE_History.txt",
    "LiveStream_Comment.txt",
    "Posts.txt",
    "Watch_LIVE_History.txt",
    "Follower.txt",
]

_COMMENT_LINE = r"(?d)(\[\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\] .+)"


def _clean(block: Column) -> Column:
    """Line ends of any kind become a newline, outer white space goes."""
    return strip(_one_way(block))


def _one_way(block: Column) -> Column:
    return F.replace(F.replace(block, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def read_blocks_delim(spark: SparkSession, path: str, delim: str) -> DataFrame:
    """One row per non-empty block between delimiters, in column ``block``."""
    return (
        spark.read.text(path, lineSep=delim)
        .select(_clean(F.col("value")).alias("block"))
        .where("block != ''")
    )


def read_blocks_lookahead(
    spark: SparkSession, path: str, header: str, blank_lines: int = 1, newline: str | None = None
) -> DataFrame:
    """One row per block that starts with ``header``, which stays part of the block.

    ``blank_lines`` is the number of empty lines before a header. The line end by which the
    reader splits a large file is looked up in the file's first bytes, or given as ``newline``
    for all of them. Files with other or mixed line ends are cut here as well, so they
    give the same blocks. The reader takes the header away together with the separator;
    it is put back except for the first block of a file, which still has it.
    """
    by_end: dict[str, list[str]] = {}
    if newline is None:
        for name, head in file_heads(spark, path):
            by_end.setdefault("\n" if head is None else line_end(head), []).append(name)
    if len(by_end) < 2:
        by_end = {newline or next(iter(by_end), "\n"): [path]}
    value = F.col("value")
    block = F.when(strip(value).startswith(header), value).otherwise(
        F.concat(F.lit(header), value)
    )
    parts = F.split(_one_way(block), "\n" * (blank_lines + 1) + f"(?=\\Q{header}\\E)")
    scans = [
        spark.read.text(files, lineSep=end * (blank_lines + 1) + header) for end, files in by_end.items()
    ]
    return (
        reduce(DataFrame.unionByName, scans)
        .where(strip(value) != "")
        .select(F.explode(parts).alias("part"))
        .where(strip("part") != "")
        .select(strip("part").alias("block"))
    )


def _fields(blocks: DataFrame, labels: dict[str, str]) -> DataFrame:
    return blocks.select(
        "block", *[extract_field("block", label).alias(out) for out, label in labels.items()]
    )


def _filled(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit("")) != ""


def parse_live_history(blocks: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    fields = _fields(
        blocks,
        {
            "room_id": "Room Id",
            "live_title_raw": "LIVE title",
            "duration_raw": "LIVE duration",
            "total_view_raw": "Total view",
            "total_gifter_raw": "Total gifter",
            "total_likes_raw": "Total likes received",
        },
    )
    return attach_ingested_at(fields.where(_filled("duration_raw")).drop("block"), ingested_at)


def parse_live_comments(blocks: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Comments of one block each; of a comment over several lines the first line is kept."""
    fields = _fields(
        blocks,
        {"room_id": "Room ID", "comment_time_raw": "Comment Time", "comment_text": "Comment"},
    )
    return attach_ingested_at(fields.where(_filled("comment_text")).drop("block"), ingested_at)


def parse_posts(blocks: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    fields = _fields(
        blocks,
        {
            "date_raw": "Date",
            "likes_raw": "Like(s)",
            "visibility_raw": "Who can view",
            "sound_raw": "Sound",
            "location_raw": "Location",
            "title_raw": "Title",
        },
    )
    return attach_ingested_at(fields.where(_filled("date_raw")).drop("block"), ingested_at)


def parse_watch_history(blocks: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """The timed comment lines of a block stay together, one per line; NULL if none."""
    fields = _fields(blocks, {"watched_at_raw": "Date and time", "link_raw": "Link"})
    comments = F.regexp_extract_all("block", F.lit(_COMMENT_LINE), F.lit(1))
    out = fields.where(_filled("watched_at_raw")).select(
        "watched_at_raw",
        "link_raw",
        F.nullif(F.array_join(comments, "\n"), F.lit("")).alias("raw_comments_blob"),
    )
    return attach_ingested_at(out, ingested_at)


def parse_followers(blocks: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    fields = _fields(blocks, {"followed_at_raw": "Date", "username": "Username"})
    kept = fields.where(_filled("followed_at_raw") & _filled("username")).drop("block")
    return attach_ingested_at(kept, ingested_at)
