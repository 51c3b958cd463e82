"""Token ids as a binary store: one wavelet matrix per shard.

A shard is a row of a Parquet table: the ids of consecutive documents as bit-planes (one bit of
every id per plane), the documents' ids and where each ends. Rank and select on the planes give
access, counts and places of a token without unpacking the rest. The table is written by Spark's
own writer, so a lost executor leaves no half shard and any file system Spark knows will do.
"""

from __future__ import annotations

import hashlib
import json
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.bpe import text_starts
from tallyloom.llm.common import (
    arrow_binary,
    map_batches,
    mix,
    read,
    run_codes,
    scratch_path,
    small_batches,
)
from tallyloom.llm.wavelet import WaveletMatrix

#: Ids after which a shard is closed: bounds a row, and the memory of a task.
SHARD_TOKENS = 1 << 18
#: Tokenizer files above this size are refused, as they are broadcast.
MAX_TOKENIZER_BYTES = 64 << 20
#: Pieces remembered per Python worker; two generations of this size.
CACHE = 240_000

SHARD_SCHEMA = (
    "part int, shard int, bits int, n_docs long, n_tokens long, "
    "doc_ids binary, no_id binary, ends binary, planes array<binary>"
)


class PieceEncoder:
    """A byte-level tokenizer of the tokenizers library with a memory of pieces.

    Such a tokenizer splits a text by the pattern of ``bpe.piece_starts`` and encodes each piece on
    its own, so ids of a piece hold wherever the piece turns up. Each new piece goes through the
    library; a text that holds the string of an added token goes through it whole.
    """

    def __init__(self, content: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(content)
        spec = json.loads(content)
        split = spec.get("pre_tokenizer") or {}
        self.by_piece = (
            split.get("type") == "ByteLevel"
            and split.get("use_regex")
            and not split.get("add_prefix_space")
            and spec.get("normalizer") is None
            and spec.get("post_processor") is None
        )
        self.added = [x["content"] for x in spec.get("added_tokens", [])]
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        whole = [not self.by_piece or any(a in t for a in self.added) for t in texts]
        out = self._by_pieces(["" if w else t for t, w in zip(texts, whole, strict=True)])
        for i, t in enumerate(texts):
            if whole[i]:
                out[i] = array("I", self.library.encode(t, add_special_tokens=False).ids).tobytes()
        return out

    def _by_pieces(self, texts: list[str]) -> list[bytes]:
        """All pieces at once: equal pieces are found by hash, checked, and looked up once."""
        starts = [text_starts(t) for t in texts]
        counts = np.array([len(s) for s in starts])
        if not counts.sum():
            return [b""] * len(texts)
        joined = "".join(texts)
        offsets = np.cumsum([0, *map(len, texts)])
        begin = np.concatenate(starts) + np.repeat(offsets[:-1], counts)
        end = np.concatenate((begin[1:], offsets[-1:]))
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = run_codes(_point_codes(), points, begin, end)
        _, first, kind = np.unique(codes, return_index=True, return_inverse=True)
        like = np.repeat(begin[first][kind] - begin, end - begin) + np.arange(len(points))
        if (points[like] != points).any():  # two different pieces of one hash
            first, kind = np.arange(len(begin)), np.arange(len(begin))
        bounds = zip(begin[first].tolist(), end[first].tolist(), strict=True)
        pieces = [joined[a:b] for a, b in bounds]
        found = list(map(self.young.get, pieces))
        if None in found:
            found = [self._new(p) if ids is None else ids for p, ids in zip(pieces, found, strict=True)]
        flat = np.frombuffer(b"".join(found), "<u4")
        size = np.array([len(x) >> 2 for x in found])
        place = np.cumsum(size) - size
        sizes = size[kind]
        before = np.cumsum(sizes) - sizes
        ids = flat[np.repeat(place[kind] - before, sizes) + np.arange(int(sizes.sum()))].tobytes()
        edge = np.concatenate((before, [len(ids) >> 2]))[np.concatenate(([0], np.cumsum(counts)))].tolist()
        return [ids[4 * a : 4 * b] for a, b in zip(edge, edge[1:], strict=False)]

    def _new(self, piece: str) -> bytes:
        """Ids of a piece that the younger memory does not hold."""
        ids = self.old.get(piece)
        if ids is None:
            if piece.isascii() and piece.isprintable():
                signs = piece.replace(" ", _BLANK)
            else:
                signs = piece.encode("utf-8", "replace").decode("latin-1").translate(_SIGNS)
            ids = array("I", [t.id for t in self.library.model.tokenize(signs)]).tobytes()
        if len(self.young) >= CACHE:
            self.old, self.young = self.young, {}
        self.young[piece] = ids
        return ids


def _signs() -> dict[int, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + i for i, b in enumerate(rest)}


_SIGNS = _signs()
_BLANK = chr(_SIGNS[32])
_tables: list[np.ndarray] = []


def _point_codes() -> np.ndarray:
    if not _tables:
        _tables.append(mix(np.arange(1, 0x110001, dtype=np.uint64)) | np.uint64(1))
    return _tables[0]


_loaded: dict[str, PieceEncoder] = {}


def _cached(key: str, shared) -> PieceEncoder:
    """One encoder per Python worker, with its memory, for all tasks that the worker runs."""
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = PieceEncoder(shared.value)
    return _loaded[key]


def _encoder(spark: SparkSession, path: str):
    with open(path, encoding="utf-8") as f:
        content = f.read(MAX_TOKENIZER_BYTES + 1)
    if len(content) > MAX_TOKENIZER_BYTES:
        raise ValueError(f"{path} holds more than {MAX_TOKENIZER_BYTES} characters")
    shared = spark.sparkContext.broadcast(content)
    key = hashlib.sha256(content.encode()).hexdigest()
    return lambda: _cached(key, shared)


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int = 2,
    shard_tokens: int = SHARD_TOKENS,
    text: str = "text",
) -> None:
    """Encode every text and write shards in ascending order of doc_id.

    A null text counts as empty: a document of the end id alone. Rows that share a doc_id are all
    kept, ordered by text; rows without doc_id come first. An empty table gives an empty store.
    Columns besides doc_id and the text are not read. The work per task is bounded by the range
    partitions of doc_id and the shard size.
    """
    spark = docs.sparkSession
    small_batches(spark)
    load = _encoder(spark, tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard = TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        held: list[bytes] = []
        size, end = 0, np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                texts = [t or "" for t in piece.column(1).to_pylist()]
                for doc, tokens in zip(piece.column(0).to_pylist(), load().encode(texts), strict=True):
                    ids.append(doc)
                    held.append(tokens + end)
                    size += len(held[-1]) // 4
                    if size >= shard_tokens:
                        yield _shard(part, shard, ids, held)
                        ids, held, size, shard = [], [], 0, shard + 1
        if ids:
            yield _shard(part, shard, ids, held)

    placed = docs.select("doc_id", F.col(text).alias("text")).repartitionByRange("doc_id")
    shards = placed.sortWithinPartitions("doc_id", "text").mapInArrow(run, SHARD_SCHEMA)
    # Planes are as good as random; small row groups bound what a reader holds.
    shards.write.option("compression", "none").option("parquet.block.size", 8 << 20).parquet(path)


def _shard(part: int, shard: int, ids: list, held: list[bytes]) -> pa.RecordBatch:
    tokens = np.frombuffer(b"".join(held), "<u4")
    bits = max(1, int(tokens.max()).bit_length())
    narrow = tokens.astype(np.uint16) if bits <= 16 else tokens
    missing = np.array([i is None for i in ids])
    row = {
        "part": pa.array([part], pa.int32()),
        "shard": pa.array([shard], pa.int32()),
        "bits": pa.array([bits], pa.int32()),
        "n_docs": pa.array([len(ids)], pa.int64()),
        "n_tokens": pa.array([len(tokens)], pa.int64()),
        "doc_ids": arrow_binary([np.array([i or 0 for i in ids], "<i8").tobytes()]),
        "no_id": arrow_binary([np.packbits(missing).tobytes()]),
        "ends": arrow_binary([np.cumsum([len(x) // 4 for x in held]).astype("<i8").tobytes()]),
        "planes": pa.array([WaveletMatrix.of(narrow, bits).to_bytes()], pa.list_(pa.binary())),
    }
    return pa.RecordBatch.from_pydict(row)


class TokenShard:
    """One shard of the store: tokens by document, and access, count and places of a token."""

    def __init__(self, row: dict) -> None:
        self.matrix = WaveletMatrix.from_bytes(row["planes"], row["n_tokens"])
        missing = np.unpackbits(np.frombuffer(row["no_id"], np.uint8), count=row["n_docs"])
        self.doc_ids = [
            None if gone else int(i)
            for i, gone in zip(np.frombuffer(row["doc_ids"], "<i8"), missing, strict=True)
        ]
        self.ends = np.frombuffer(row["ends"], "<i8")
        self.starts = np.concatenate(([0], self.ends[:-1]))

    def tokens(self) -> np.ndarray:
        return self.matrix.decode()

    def access(self, at: np.ndarray) -> np.ndarray:
        return self.matrix.access(at)

    def count(self, token: int) -> int:
        return self.matrix.count(token)

    def places(self, token: int) -> np.ndarray:
        """Ascending positions of a token in the shard."""
        return self.matrix.select(token, np.arange(self.count(token)))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Every document of a store: part, shard, doc_id, start in the shard, n_tokens, ids (binary)."""
    small_batches(spark)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: dict[str, list] = {k: [] for k in ("part", "shard", "doc_id", "shard_start", "n_tokens", "ids")}
        for row in batch.to_pylist():
            shard = TokenShard(row)
            raw = shard.tokens().astype("<u4").tobytes()
            for doc, a, b in zip(shard.doc_ids, shard.starts.tolist(), shard.ends.tolist(), strict=True):
                for k, v in zip(out, (row["part"], row["shard"], doc, a, b - a, raw[4 * a : 4 * b]), strict=True):
                    out[k].append(v)
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], list(out)
        )

    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    return map_batches(
        shards, run, "part int, shard int, doc_id long, shard_start long, n_tokens long, ids binary"
    )


def token_counts(spark: SparkSession, path: str, token: int) -> DataFrame:
    """Occurrences of one token per shard, by rank alone."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = batch.to_pylist()
        return pa.RecordBatch.from_pydict(
            {
                "part": pa.array([r["part"] for r in rows], pa.int32()),
                "shard": pa.array([r["shard"] for r in rows], pa.int32()),
                "n": pa.array([TokenShard(r).count(token) for r in rows], pa.int64()),
            }
        )

    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    return map_batches(shards, run, "part int, shard int, n long")


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """Ids before each shard. The one ordered task sees a row per part, not per shard."""
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path).select("part", "shard", "n_tokens")
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    ordered = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "part", F.coalesce(F.sum("part_tokens").over(ordered), F.lit(0)).alias("part_start")
    )
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.withColumn("before", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return shards.join(parts, "part").select(
        "part", "shard", (F.col("part_start") + F.col("before")).alias("base")
    )


def op4_token_store(spark, sf_dir):
    import public_tokenizers

    path = scratch_path(spark, "tokens")
    write_tokens(
        read(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json")
    )
    docs = read_tokens(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return docs.join(shard_starts(spark, path), ["part", "shard"]).select(
        "doc_id", (F.col("base") + F.col("shard_start")).alias("start"), "n_tokens", "ids_crc32"
    )


QUERIES = {"op4_token_store": (op4_token_store, None)}
