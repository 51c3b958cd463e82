"""Tables in versions: data folders, and per version a manifest that is put in place in one step.

A manifest names the folders that make up a version, one per part of the table. A writer adds
folders, then a manifest: until that is there, readers see the version before, and a writer that
dies leaves folders which no manifest names. Parts that a version does not touch are carried over
by reference. Two writers of one table do not mix: the second to finish fails.

A part may also be a list of folders: runs of rows of which readers keep the newest per key, as the
notes of the version say (``newest``: keys, order and ties). Runs may also lie in files of another table,
which are not copied: the notes name its folder and the span of modification times (``landed``).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyloom.operators.dedup import dedup_latest, with_address
from tallyloom.sources.sinks import COMPRESSION

_MANIFESTS = "_versions"
#: Versions whose folders stay, so that readers of an older one can finish.
KEPT_VERSIONS = 3


@dataclass(frozen=True)
class Version:
    """Part -> folder (or runs) below the table, and what the writer noted."""

    number: int
    parts: dict[str, str | list[str]]
    notes: dict = field(default_factory=dict)


def folders(part: str | list[str]) -> list[str]:
    """The folders of a part."""
    return [part] if isinstance(part, str) else list(part)


def _hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, place = _hadoop(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def _manifests(spark: SparkSession, path: str) -> list[int]:
    names = _children(spark, f"{path}/{_MANIFESTS}")
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _load(spark: SparkSession, path: str, number: int) -> Version:
    fs, place = _hadoop(spark, f"{path}/{_MANIFESTS}/{number:010d}.json")
    stream = fs.open(place)
    try:
        found = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Version(number, found["parts"], found["notes"])


def current_version(spark: SparkSession, path: str) -> Version | None:
    """The newest version of a table, or None before the first."""
    numbers = _manifests(spark, path)
    return _load(spark, path, numbers[-1]) if numbers else None


def commit(
    spark: SparkSession, path: str, base: Version | None, parts: dict[str, str | list[str]], notes: dict | None = None
) -> Version:
    """Make ``parts`` the version after ``base``; fails if another writer has made it."""
    version = Version(base.number + 1 if base else 1, parts, notes or {})
    folder = f"{path}/{_MANIFESTS}"
    fs, made = _hadoop(spark, f"{folder}/.{uuid.uuid4().hex}.tmp")
    stream = fs.create(made, False)
    try:
        stream.write(bytearray(json.dumps({"parts": parts, "notes": version.notes}).encode()))
    finally:
        stream.close()
    final = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{version.number:010d}.json")
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.makeQualified(made).toUri(), spark._jsc.hadoopConfiguration()
    )
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    # A rename in one step that never replaces: the second of two writers fails here.
    context.rename(fs.makeQualified(made), fs.makeQualified(final), options)
    return version


def changed_at() -> Column:
    """When a row's file was written, in milliseconds."""
    return F.unix_millis(F.col("_metadata.file_modification_time"))


def read_landed(spark: SparkSession, version: Version, schema: StructType | str | None = None) -> list[DataFrame]:
    """The runs of a version that lie in files of other tables; files of other times are not opened."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return [
        reader.parquet(span["path"]).where(changed_at().between(span["since"], span["until"]))
        for span in version.notes.get("landed", [])
    ]


def write_folder(df: DataFrame, path: str, part: str | None = None) -> dict[str, str]:
    """Write a new data folder; the parts in it, by value of column ``part`` or one named ''."""
    folder = f"data-{uuid.uuid4().hex}"
    if part is None:
        df.write.option("compression", COMPRESSION).parquet(f"{path}/{folder}")
        return {"": folder}
    df.write.option("compression", COMPRESSION).partitionBy(part).parquet(f"{path}/{folder}")
    found = [n for n in _children(df.sparkSession, f"{path}/{folder}") if n.startswith(f"{part}=")]
    return {n.removeprefix(f"{part}="): f"{folder}/{n}" for n in found}


def read_version(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    version: Version | None = None,
    parts: Iterable[str] | None = None,
    merged: bool = True,
    addressed: bool = False,
) -> DataFrame:
    """The rows of a version (the newest if none is given), or of some of its parts.

    Parts in runs are merged to the newest row per key, unless the reader does so itself
    (``merged=False``); the other parts are read as they are stored. ``addressed`` rows, which are not
    merged, say where they are stored (``with_address``).
    """
    version = version or current_version(spark, path)
    named = version.parts if version else {}
    chosen = [named[p] for p in (named if parts is None else parts) if p in named]
    landed = read_landed(spark, version, schema) if version and parts is None else []
    if not chosen and not landed:
        if schema is None:
            raise ValueError(f"{path} has no version to read a schema from")
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)

    def read(some: list[str | list[str]]) -> list[DataFrame]:
        return [reader.parquet(*[f"{path}/{f}" for part in some for f in folders(part)])] if some else []

    if addressed:
        return with_address(*read(chosen), *landed)
    if not merged:
        return reduce(DataFrame.unionByName, [*read(chosen), *landed])
    # Rows that lie elsewhere may have the keys of any part.
    in_runs = chosen if landed else [part for part in chosen if not isinstance(part, str)]
    whole = [] if landed else [part for part in chosen if isinstance(part, str)]
    frames = read(whole)
    if in_runs or landed:
        by = version.notes["newest"]
        runs = reduce(DataFrame.unionByName, [*read(in_runs), *landed])
        frames.append(dedup_latest(runs, by["keys"], by["order"], by["ties"]))
    return reduce(DataFrame.unionByName, frames)


def materialize_version(df: DataFrame, path: str, notes: dict | None = None) -> DataFrame:
    """Write ``df`` as the next version of a table and return the stored rows."""
    spark = df.sparkSession
    base = current_version(spark, path)
    version = commit(spark, path, base, write_folder(df, path), notes)
    drop_unused(spark, path)
    return read_version(spark, path, df.schema, version)


def drop_unused(spark: SparkSession, path: str, keep: int = KEPT_VERSIONS) -> None:
    """Delete manifests before the last ``keep``, and folders that none of those name.

    Folders of a write that is under way would go too, so the table's one writer calls this.
    """
    numbers = _manifests(spark, path)
    used = {f for n in numbers[-keep:] for part in _load(spark, path, n).parts.values() for f in folders(part)}
    fs, _ = _hadoop(spark, path)
    for number in numbers[:-keep]:
        fs.delete(_hadoop(spark, f"{path}/{_MANIFESTS}/{number:010d}.json")[1], False)
    for name in _children(spark, path):
        if not name.startswith("data-") or name in used:
            continue
        inside = [f for f in used if f.startswith(f"{name}/")]
        gone = [f"{name}/{x}" for x in _children(spark, f"{path}/{name}") if f"{name}/{x}" not in inside] if inside else [name]
        for folder in gone:
            fs.delete(_hadoop(spark, f"{path}/{folder}")[1], True)
