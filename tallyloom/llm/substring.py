"""Substring dedup: runs of words that an earlier document also has are cut out.

The index is an FM-index per shard. Shards are made so that a document streams only past the shard
that can answer: in every window of ``WINDOW`` words the run of ``ANCHOR`` words with the smallest
hash is the window's anchor, which depends on the window's words alone. Neighbouring windows with
one anchor form a unit, and a unit goes to the shard of its anchor. Two equal windows thus meet in
one shard, each window is looked up once, and the work grows with the input.

0. Of equal texts only the one with the smallest doc_id goes on. The others lose all their words if
   they have a window at all, and as they come later they answer for nobody.
1. Anchors that occur in one text only are dropped by an aggregate of two numbers.
2. Units of the rest become text; equal units are one row with the smallest doc_id.
3. An anchor with very many units (a passage that sits in many contexts) is cut into single
   windows, which go to shards of their own hash; equal windows are one row, so no key is hot.
4. A task sorts its units by key and builds an index over a bounded number of words at a time.
   Backward search over the wavelet matrix gives the matching statistics, capped at the window; a
   full match is a block of the suffix order, and the smallest doc_id of the block is the answer.
5. Stretches answered by a smaller doc_id are joined to the documents and cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyloom.llm.common import (
    BATCH_BYTES,
    Words,
    arrow_binary,
    grams,
    map_batches,
    read,
    small_batches,
    stored,
)
from tallyloom.llm.wavelet import FMIndex

WINDOW = 50
ANCHOR = 12
#: End of a range that stands for a whole text.
COPY = -1
#: Texts that share an anchor beyond which it is cut into single windows.
HOT_UNITS = 2_000
#: Words that one index takes; with one key's units on top at most.
INDEX_WORDS = 400_000


def _doc_units(codes: np.ndarray, window: int, anchor: int):
    """First window, number of windows and anchor hash of each unit of one document."""
    hashes = grams(codes, anchor)
    view = np.lib.stride_tricks.sliding_window_view(hashes, window - anchor + 1)
    place = view.argmin(axis=1) + np.arange(len(view))
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    count = np.diff(np.concatenate((first, [len(place)])))
    return first, count, hashes[place[first]].view(np.int64)


def _units(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """Units of every document: row key, first window, windows, anchor."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        words = Words(batch.column(2).to_pylist())
        parts = []
        for i in range(batch.num_rows):
            codes = words.codes[words.first[i] : words.first[i + 1]]
            if len(codes) >= window:
                parts.append((i, *_doc_units(codes, window, anchor)))
        row = np.concatenate([np.full(len(p[1]), p[0]) for p in parts] or [np.empty(0, np.int64)])
        joined = [np.concatenate([p[k] for p in parts] or [np.empty(0, np.int64)]) for k in (1, 2, 3)]
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array(ids[row], pa.int64()),
                "row_key": pa.array(keys[row], pa.int64()),
                "start": pa.array(joined[0].astype(np.int32), pa.int32()),
                "windows": pa.array(joined[1].astype(np.int32), pa.int32()),
                "anchor": pa.array(joined[2], pa.int64()),
            }
        )

    return map_batches(docs, run, "doc_id long, row_key long, start int, windows int, anchor long")


def _pack(docs: DataFrame) -> DataFrame:
    """Texts as compressed bytes, for the shuffles."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        packed = [None if t is None else squeeze(t.encode("utf-8", "replace")) for t in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:2], arrow_binary(packed), *batch.columns[3:]],
            ["doc_id", "row_key", "packed", *batch.schema.names[3:]],
        )

    rest = [f for f in docs.schema.fields if f.name not in ("doc_id", "row_key", "text")]
    schema = StructType.fromDDL("doc_id long, row_key long, packed binary")
    return map_batches(docs, run, StructType([*schema.fields, *rest]))


def _unpack(values: list[bytes | None]) -> list[str | None]:
    open_ = zstandard.ZstdDecompressor().decompress
    return [None if v is None else open_(v).decode() for v in values]


def _unit_texts(packed: DataFrame, window: int) -> DataFrame:
    """The words of the wanted units; windows one by one where the anchor is hot."""

    names = ("doc_id", "row_key", "start", "windows", "hot", "key", "digest", "words")
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.binary(), pa.binary())

    def units_of(batch: pa.RecordBatch) -> Iterator[tuple]:
        ids, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        words, wanted = Words(_unpack(batch.column(2).to_pylist())), batch.column(3).to_pylist()
        for i in range(batch.num_rows):
            base = int(words.first[i])
            singles = None
            for u in wanted[i]:
                cuts = [(u["start"], u["windows"], u["anchor"])]
                if u["hot"]:
                    if singles is None:
                        singles = grams(words.codes[base : words.first[i + 1]], window).view(np.int64)
                    cuts = [(j, 1, int(singles[j])) for j in range(u["start"], u["start"] + u["windows"])]
                for start, count, key in cuts:
                    text = words.text(base + start, base + start + count + window - 1)
                    digest = hashlib.blake2b(text, digest_size=16).digest()
                    yield ids[i], keys[i], start, count, u["hot"], key, digest, text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            columns = zip(*held, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, kinds, strict=True)], list(names))

        for batch in batches:
            for low in range(0, batch.num_rows, 32):
                for unit in units_of(batch.slice(low, 32)):
                    held.append(unit)
                    size += len(unit[-1]) + 64
                    if size >= BATCH_BYTES:
                        yield flush()
                        held, size = [], 0
        if held:
            yield flush()

    return packed.mapInArrow(
        run,
        "doc_id long, row_key long, start int, windows int, hot boolean, key long, digest binary, words binary",
    )


def _copies(docs: DataFrame) -> DataFrame:
    """doc_id and row_key of the rows whose text a smaller doc_id has as well."""
    named = docs.select("doc_id", "row_key", F.xxhash64(F.lit(1), "text").alias("more"))
    first = (
        named.groupBy("row_key", "more").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
        .where("lo < hi").drop("hi")
    )
    return named.join(first, ["row_key", "more"]).where("doc_id > lo").select("doc_id", "row_key").distinct()


def _search(held: list[tuple], window: int) -> Iterator[tuple]:
    """Index the units of some keys, stream them past it, yield stretches with a smaller doc_id."""
    words = Words([t.decode() for _, t, _, _ in held])
    _, symbols = np.unique(words.codes, return_inverse=True)
    symbols = symbols.astype(np.int64) + 1
    begins, ends = words.first[:-1], words.first[1:]
    index = FMIndex(symbols, ends, window)
    lowest = np.array([x[2] for x in held], np.int64)
    highest = np.array([x[3] for x in held], np.int64)
    # Smallest doc_id of each block of suffixes that share a window.
    row_doc = np.full(index.n, np.iinfo(np.int64).max)
    owner = np.repeat(np.arange(len(held)), ends - begins)
    row_doc[index.place] = lowest[owner]
    block_doc = np.minimum.reduceat(row_doc[index.order], index.block_start)
    block = index.full_matches(symbols, begins, ends)
    at = np.flatnonzero(block >= 0)
    doc, unit = block_doc[block[at]], owner[at]
    kept = doc < highest[unit]
    at, doc, unit = at[kept], doc[kept], unit[kept]
    if not len(at):
        return
    fresh = np.ones(len(at), bool)
    fresh[1:] = (unit[1:] != unit[:-1]) | (doc[1:] != doc[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(fresh)
    last = np.concatenate((first[1:], [len(at)])) - 1
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        start = int(begins[unit[a]])
        yield held[unit[a]][0], int(at[a]) - start, int(at[b]) - start + window, int(doc[a])


def _stretches(units: DataFrame, window: int, index_words: int) -> DataFrame:
    """Per distinct unit the stretches that start in a document with a smaller doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, key = 0, None

        def flush() -> pa.RecordBatch:
            rows = list(_search(held, window))
            columns = list(zip(*rows, strict=True)) or [[], [], [], []]
            kinds = (pa.binary(), pa.int32(), pa.int32(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                ["digest", "low", "high", "other"],
            )

        for batch in batches:
            for k, digest, text, windows, low, high in zip(
                *(batch.column(j).to_pylist() for j in range(6)), strict=True
            ):
                if k != key and size >= index_words:
                    yield flush()
                    held, size = [], 0
                held.append((digest, text, low, high))
                key, size = k, size + windows + window - 1
        if held:
            yield flush()

    return units.mapInArrow(run, "digest binary, low int, high int, other long")


def _cut(packed: DataFrame, window: int, whole: bool = False) -> DataFrame:
    """Kept words and counts per row; ``cuts`` are word ranges to remove, or null.

    A range that ends at COPY stands for all words of a text that has a window.

    ``whole`` adds the text as it was.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, cuts = _unpack(batch.column(2).to_pylist()), batch.column(3).to_pylist()
        kept, total, removed = [], [], []
        for text, ranges in zip(texts, cuts, strict=True):
            words = [] if text is None else text.encode("utf-8", "replace").split()
            total.append(len(words))
            if ranges and ranges[0]["high"] == COPY:
                words = words if len(words) < window else []
            elif ranges:
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, [r["low"] for r in ranges], 1)
                np.add.at(edge, [r["high"] for r in ranges], -1)
                stay = np.cumsum(edge[:-1]) == 0
                words = [words[i] for i in np.flatnonzero(stay)]
            kept.append(b" ".join(words).decode())
            removed.append(total[-1] - len(words))
        return pa.RecordBatch.from_arrays(
            [
                *batch.columns[:2], pa.array(kept, pa.string()),
                pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                *([pa.array(texts, pa.string())] if whole else []), *batch.columns[4:],
            ],
            [*schema.names, *batch.schema.names[4:]],
        )

    schema = StructType.fromDDL("doc_id long, row_key long, kept_text string, n_words long, n_removed long")
    if whole:
        schema = schema.add("text", "string")
    return map_batches(packed, run, StructType([*schema.fields, *packed.schema.fields[4:]]))


def cut_repeats(
    docs: DataFrame,
    keep: list[str] | None = None,
    window: int = WINDOW,
    anchor: int = ANCHOR,
    hot_units: int = HOT_UNITS,
    index_words: int = INDEX_WORDS,
) -> DataFrame:
    """One row per document: doc_id, row_key, kept_text, n_words, n_removed.

    With ``keep`` also the text as it was, and the columns named there as a struct, kept.

    Words are runs of anything but ASCII white space. A word goes if a window of ``window`` words
    over it also starts in a document with a smaller doc_id, judged on the input. Rows that share a
    doc_id are not earlier than each other and all stay; a null doc_id is neither earlier nor later
    than any. A null text has no words and an empty ``kept_text``; texts shorter than the window
    keep all words. Repeated rows are repeated in the result, an empty table gives an empty
    result, and columns besides doc_id, text and ``keep`` are not read, whatever their names. ``row_key`` is a hash of the text.
    """
    small_batches(docs.sparkSession)
    held = [F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept")] if keep else []
    docs = docs.select("doc_id", F.xxhash64("text").alias("row_key"), "text", *held)
    named = docs.where("doc_id is not null").select("doc_id", "row_key", "text")
    found = stored(_units(named, window, anchor), "units")
    copies = stored(_copies(named), "copies")
    # Written out, so that both sides of the join are plain and Spark can split a hot anchor. Equal
    # texts count once, by their row key.
    shared = stored(
        found.groupBy("anchor", "row_key").agg(F.min("doc_id").alias("doc_id"))
        .groupBy("anchor")
        .agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("n"))
        .where("lo < hi")
        .select("anchor", (F.col("n") > hot_units).alias("hot")),
        "anchors",
    )
    wanted = (
        found.join(shared, "anchor")
        .groupBy("doc_id", "row_key")
        .agg(F.collect_set(F.struct("start", "windows", "anchor", "hot")).alias("wanted"))
        .join(copies, ["doc_id", "row_key"], "left_anti")
    )
    occurrences = stored(
        _unit_texts(
            _pack(named).join(wanted.hint("merge"), ["doc_id", "row_key"]).select(
                "doc_id", "row_key", "packed", "wanted"
            ),
            window,
        ),
        "unit-texts",
    )
    units = (
        occurrences.groupBy("key", "digest", "words", "windows", "hot")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        # A hot anchor's units are all single windows, so one that a single document has is like no
        # other. Elsewhere a unit of one window may lie inside a longer unit.
        .where("not hot or low < high")
        .select("key", "digest", "words", "windows", "low", "high")
    )
    stretches = _stretches(
        units.repartition("key").sortWithinPartitions("key", "digest")
        .select("key", "digest", "words", "windows", "low", "high"),
        window, index_words,
    )
    cuts = (
        occurrences.select("doc_id", "row_key", "start", "digest")
        .join(stretches, "digest")
        .where("other < doc_id")
        .groupBy("doc_id", "row_key")
        .agg(
            F.collect_set(
                F.struct((F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high")).alias("high"))
            ).alias("cuts")
        )
    )
    everything = F.array(F.struct(F.lit(0).alias("low"), F.lit(COPY).alias("high")))
    cuts = cuts.unionByName(copies.withColumn("cuts", everything))
    # Joins of texts are by sorted runs, which spill.
    return _cut(
        _pack(docs).join(cuts.hint("merge"), ["doc_id", "row_key"], "left").select(
            "doc_id", "row_key", "packed", "cuts", *(["kept"] if keep else [])
        ),
        window,
        whole=bool(keep),
    )


def op2_fm_substring(spark, sf_dir):
    return cut_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


QUERIES = {"op2_fm_substring": (op2_fm_substring, None)}
