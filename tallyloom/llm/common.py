"""Helpers shared by the training-data operators: Arrow batches, words and shingles as 64-bit codes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import scratch_path

#: Rows of one Arrow batch. Texts are long, so a batch of ten thousand would not stay small.
BATCH_ROWS = 512

#: Bytes of one batch, on the way to Python and as it is handled there.
BATCH_BYTES = 8 << 20

#: ASCII white space: what separates words in every word-based operator here.
SPACES = b" \t\n\x0b\x0c\r"

_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_CODES = np.random.Generator(np.random.PCG64(2024)).integers(1, 2**63, 256, np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the rows and the bytes of the batches that go to Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: a cut of the lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_batches(
    df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str
) -> DataFrame:
    """``mapInArrow`` with a function of one batch; empty batches are skipped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from _pieces(batch, fn)

    return df.mapInArrow(run, schema)


def _pieces(batch, fn):
    """Halves batches whose rows are very long until they are small or one row."""
    if batch.nbytes > BATCH_BYTES and batch.num_rows > 1:
        half = batch.num_rows // 2
        yield from _pieces(batch.slice(0, half), fn)
        yield from _pieces(batch.slice(half), fn)
    else:
        yield fn(batch)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        up, down = np.full(size, _BASE), np.full(size, _INVERSE)
        up[0] = down[0] = 1
        _powers = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return _powers


def run_codes(table: np.ndarray, symbols: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the runs ``symbols[begin:end]``; ``table`` has a random odd number per symbol."""
    codes = np.empty(len(begin), np.uint64)
    step, at = 1 << 16, 0
    # A stretch of the symbols at a time, so that the tables of powers stay in the cache.
    while at < len(codes):
        low = begin[at]
        stop = max(at + 1, int(np.searchsorted(end, low + step, "right")))
        b, e = begin[at:stop] - low, end[at:stop] - low
        up, down = _power_tables(int(e[-1]) + 1)
        total = np.zeros(int(e[-1]) + 1, np.uint64)
        np.cumsum(table[symbols[low : low + e[-1]]] * up[: e[-1]], out=total[1:])
        codes[at:stop] = mix((total[e] - total[b]) * down[b] + (e - b).astype(np.uint64))
        at = stop
    return codes


class Words:
    """The words of several texts, back to back.

    ``codes`` are 64-bit hashes of the words' bytes; ``first[i]:first[i + 1]`` are the words of
    text i; ``data[begin[w]:end[w]]`` are the bytes of word w. Two different words of one
    document get the same code with probability 2**-64.
    """

    def __init__(self, texts: list[str | None], lower: bool = False) -> None:
        joined = [b"" if t is None else t.encode("utf-8", "replace") for t in texts]
        self.raw = b"\n".join([*joined, b""])
        data = np.frombuffer(self.raw, np.uint8)
        if lower:
            data = _LOWER[data]
        space = _SPACE[data]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if len(data) and not space[0]:
            edge = np.concatenate(([0], edge))
        self.begin, self.end = edge[0::2], edge[1::2]
        ends = np.cumsum([len(x) + 1 for x in joined])
        self.first = np.concatenate(([0], np.searchsorted(self.begin, ends))).astype(np.int64)
        self.codes = run_codes(_BYTE_CODES, data, self.begin, self.end)

    def text(self, start: int, stop: int) -> bytes:
        """Words start to stop, joined by one space."""
        return b" ".join(self.raw[self.begin[start] : self.end[stop - 1]].split()) if stop > start else b""


def grams(codes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k codes."""
    n = len(codes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = codes[:n].copy()
    for j in range(1, k):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += codes[j : n + j]
    return mix(out)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str | None]:
    return batch.column(batch.schema.get_field_index(column)).to_pylist()


def arrow_binary(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def long_code(*columns) -> F.Column:
    return F.xxhash64(*columns)
