"""One row per key.

``row_number() <= n`` lets Spark keep at most n rows per key in each input
partition before the shuffle (WindowGroupLimit), so a key that holds a third of
all rows sends n rows per partition, not all of them, to its task.

Rows that know where they are stored (``with_address``) need not go through a shuffle to be chosen
(``dedup_latest_stored``): keys and addresses do, then every file is read again for the rows that won.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"
#: File and place in it of a stored row.
ADDRESS = ["__file", "__row"]
_BLOCK, _BITS, _TIED = "__block", "__bits", "__tied"
_BLOCK_BITS = 15  # of Spark's bitmaps, which hold 32,768 places in 4 KB
#: Bitmaps that may be broadcast: 64 MB, for half a billion rows. Beyond that whole rows are shuffled.
MAX_BLOCKS = 1 << 14
#: Rows of one key and one newest time that are told apart by their addresses; keys with more are hot.
MAX_TIED = 64


def qualify_row_number(
    df: DataFrame,
    partition: Sequence[str | Column],
    order: Sequence[Column],
    n: int = 1,
    rank: Callable[[], Column] = F.row_number,
) -> DataFrame:
    """The first n rows of each partition; ``order`` should end in a unique key, or ``rank`` be one that keeps ties."""
    window = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(_RANK, rank().over(window)).where(F.col(_RANK) <= n).drop(_RANK)


def dedup_latest(
    df: DataFrame, keys: Sequence[str], order_col: str, tie_cols: Sequence[str] = ()
) -> DataFrame:
    """The newest row per key; ties go to the largest ``tie_cols``, NULLs last."""
    order = [F.col(c).desc_nulls_last() for c in (order_col, *tie_cols)]
    return qualify_row_number(df, keys, order)


def with_address(*frames: DataFrame) -> DataFrame:
    """All rows of ``frames``, scans of Parquet files, with their ``ADDRESS``.

    Without it where ``dedup_latest`` is the better way: a frame is of no file, there are more than
    ``MAX_BLOCKS`` blocks of rows, or two files have the same number. It takes one job over file footers.
    """
    path, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    plain = reduce(DataFrame.unionByName, frames)
    if not all(df.inputFiles() for df in frames):
        return plain
    files = [df.select(path.alias("path"), F.xxhash64(path).alias("file"), row.alias("row")) for df in frames]
    blocks = F.shiftright(F.max("row"), _BLOCK_BITS) + 1
    counted = reduce(DataFrame.unionByName, files).groupBy("path", "file").agg(blocks.alias("blocks"))
    found = counted.agg(
        F.sum("blocks").alias("blocks"), F.count("*").alias("paths"), F.count_distinct("file").alias("files")
    ).first()
    if (found["blocks"] or 0) > MAX_BLOCKS or found["paths"] != found["files"]:
        return plain
    numbered = [F.xxhash64(path).alias(ADDRESS[0]), row.alias(ADDRESS[1])]
    return reduce(DataFrame.unionByName, [df.select("*", *numbered) for df in frames])


def address_columns(df: DataFrame) -> list[str]:
    """``ADDRESS`` if the rows have one, for a projection to carry."""
    return [c for c in ADDRESS if c in df.columns]


def _marked(df: DataFrame, marks: DataFrame) -> DataFrame:
    """Rows whose places are in the bitmaps ``marks``, without moving any."""
    row = F.col(ADDRESS[1])
    byte = F.shiftright(row.bitwiseAND(F.lit((1 << _BLOCK_BITS) - 1)), 3).cast("int") + 1
    held = F.conv(F.hex(F.substring(_BITS, byte, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", held, row.bitwiseAND(F.lit(7)).cast("int")).bitwiseAND(F.lit(1)) == 1
    placed = df.withColumn(_BLOCK, F.shiftright(row, _BLOCK_BITS))
    return placed.join(F.broadcast(marks), [ADDRESS[0], _BLOCK]).where(bit).select(*[F.col(f"`{c}`") for c in df.columns])


def _marks(rows: DataFrame, *by: str) -> DataFrame:
    """Bitmaps of the places of rows, per file, block and columns ``by``."""
    place = F.col(ADDRESS[1]).bitwiseAND(F.lit((1 << _BLOCK_BITS) - 1))
    block = F.shiftright(ADDRESS[1], _BLOCK_BITS).alias(_BLOCK)
    return rows.groupBy(ADDRESS[0], block, *by).agg(F.bitmap_construct_agg(place).alias(_BITS))


def dedup_latest_stored(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    tie_cols: Sequence[str] = (),
    hint: Column | None = None,
) -> DataFrame:
    """``dedup_latest`` of rows with an address: only keys, time, ``hint`` and address are shuffled.

    The winners' addresses come back to the files as bitmaps, a bit per row. ``hint`` is something
    short that sorts as ``tie_cols`` do, as far as it tells rows apart: those are read and shuffled, with keys
    and address, for rows that share key, newest time and hint alone. At most ``MAX_TIED`` rows of a key
    leave a partition. A frame without addresses goes the way of ``dedup_latest``.
    """
    if not address_columns(df):
        return dedup_latest(df, keys, order_col, tie_cols)
    hints = [] if hint is None else [hint.alias("__hint")]
    narrow = df.select(*keys, order_col, *hints, *ADDRESS)
    order = [F.col(c).desc_nulls_last() for c in (order_col, *["__hint"] * len(hints))]
    # A key with very many rows sends so many of each partition, whether they tie or not.
    few = qualify_row_number(narrow, keys, order, MAX_TIED)
    first = qualify_row_number(few, keys, order, rank=F.rank)
    first = first.withColumn(_TIED, F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    marks = _marks(first.select(*ADDRESS, (F.col(_TIED) > 1).alias(_TIED)), _TIED)
    alone, tied = marks.where(~F.col(_TIED)).drop(_TIED), marks.where(_TIED).drop(_TIED)
    # Rows of hot keys may be missing above. All of them, and those of keys of the same hash, are compared.
    number = F.xxhash64(*keys).alias("__number")
    # Addresses are asked for here too, so that all branches read the same shuffle.
    hot = first.where(F.col(_TIED) >= MAX_TIED).groupBy(number).agg(F.max(F.struct(*ADDRESS)).alias("last"))
    hot = hot.where(F.col(f"last.{ADDRESS[1]}") >= 0)
    whole = [*keys, order_col, *tie_cols, *ADDRESS]
    of_hot = df.select(*whole, number).join(F.broadcast(hot), "__number", "left_semi").select(*whole)
    compared = _marked(df, tied).select(*whole).unionByName(of_hot)
    won = alone.unionByName(_marks(dedup_latest(compared, keys, order_col, tie_cols)))
    won = won.groupBy(ADDRESS[0], _BLOCK).agg(F.bitmap_or_agg(_BITS).alias(_BITS))
    return _marked(df, won).drop(*ADDRESS)


def dedup_earliest(
    df: DataFrame, keys: Sequence[str], order_col: str, tie_cols: Sequence[str] = ()
) -> DataFrame:
    """The oldest row per key; ties go to the smallest ``tie_cols``.

    A NULL time sorts first, as in the source dialect's ascending order.
    """
    order = [F.col(c).asc_nulls_first() for c in (order_col, *tie_cols)]
    return qualify_row_number(df, keys, order)
