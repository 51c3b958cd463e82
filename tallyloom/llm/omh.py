"""Document fingerprints by Order MinHash.

A text's words give k-mers of ``K`` words, each numbered by its occurrence, so that repeats count.
A word of more than ``LONG_WORD`` bytes (text without blanks, an address, a long number) counts as several:
it is cut behind every character at which a hash of the last three bytes says so, one in four, so a
changed character moves only the cuts beside it.
For each of ``TUPLES`` hash functions the ``PICKED`` k-mers of smallest hash are taken, put back
into text order and hashed as a tuple. Two texts share a tuple only if they share those k-mers in
the same order, so the share of equal tuples falls with the edit distance, not just with the
overlap of the k-mers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import _BYTE_CODES, Words, grams, map_batches, mix, read, run_codes, small_batches

K = 3
TUPLES = 64
PICKED = 2
LONG_WORD = 24

_FACTORS = np.random.Generator(np.random.PCG64(77)).integers(1, 2**63, 4096, np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Hash functions times k-mers handled at a time.
_CELLS = 1 << 21


def _numbered(codes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of occurrence-numbered k-mers in text order; a shorter text is one k-mer."""
    if not len(codes):
        return np.empty(0, np.uint64)
    kmers = grams(codes, min(k, len(codes)))
    order = np.argsort(kmers, kind="stable")
    ranked = kmers[order]
    fresh = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    start = np.maximum.accumulate(np.where(fresh, np.arange(len(ranked)), 0))
    number = np.empty(len(kmers), np.uint64)
    number[order] = (np.arange(len(ranked)) - start).astype(np.uint64)
    return mix(kmers + number * _STEP)


def signature(codes: np.ndarray, k: int = K, tuples: int = TUPLES, picked: int = PICKED) -> np.ndarray:
    """``tuples`` unsigned 32-bit values; all zero for a text without words."""
    base = _numbered(codes, k)
    if not len(base):
        return np.zeros(tuples, np.uint32)
    picked = min(picked, len(base))
    out = np.empty(tuples, np.uint32)
    step = max(1, _CELLS // len(base))
    for low in range(0, tuples, step):
        factors = _FACTORS[low : min(low + step, tuples)]
        hashed = base[None, :] * factors[:, None]
        rows = np.arange(len(factors))
        places = np.empty((len(factors), picked), np.int64)
        for j in range(picked):
            places[:, j] = hashed.argmin(axis=1)
            hashed[rows, places[:, j]] = np.iinfo(np.uint64).max
        places.sort(axis=1)
        value = factors.copy()
        for j in range(picked):
            value = mix(value * _STEP + base[places[:, j]])
        out[low : low + len(factors)] = (value >> np.uint64(32)).astype(np.uint32)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.count_nonzero(a == b)) / len(a)


def _tokens(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the words, long ones in pieces, and the place of each text's first."""
    long = np.flatnonzero(words.end - words.begin > LONG_WORD)
    if not len(long):
        return words.codes, words.first
    data = np.frombuffer(words.raw, np.uint8)
    # Three bytes of the word stand before each place looked at, so cuts depend on the word alone.
    inside = np.zeros(len(data) + 1, np.int8)
    inside[words.begin[long] + 3] = 1
    inside[words.end[long]] = -1
    at = np.flatnonzero(np.cumsum(inside, dtype=np.int8))
    at = at[(data[at] & 0xC0) != 0x80]  # not within a character
    last = [data[at - j].astype(np.uint64) << np.uint64(8 * (j - 1)) for j in (1, 2, 3)]
    cuts = at[mix((last[0] | last[1] | last[2]) + _STEP) & np.uint64(3) == 0]
    begin = np.sort(np.concatenate((words.begin, cuts)))
    end = np.sort(np.concatenate((words.end, cuts)))
    first = np.searchsorted(begin, np.append(words.begin, len(data))[words.first])
    return run_codes(_BYTE_CODES, data, begin, end), first


def _signatures(texts: list[str]) -> list[np.ndarray]:
    codes, first = _tokens(Words(texts))
    return [signature(codes[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add a column fingerprint: the signature's values as hex, eight digits each.

    A null text counts as empty and gets zeros, as any text without words. Other columns stay; one
    that has the name already is replaced. Repeated rows stay, an empty table stays empty.
    """
    small_batches(docs.sparkSession)
    rest = docs.drop("fingerprint")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
        out = pa.array([s.astype(">u4").tobytes().hex() for s in _signatures(texts)], pa.string())
        return pa.RecordBatch.from_arrays([*batch.columns, out], [*batch.schema.names, "fingerprint"])

    return map_batches(rest, run, rest.withColumn("fingerprint", F.lit("")).schema)


def _with_successor(docs: DataFrame) -> DataFrame:
    """Rows in runs of ascending doc_id: bucket, is_next, doc_id, text.

    Each bucket holds a range of doc_ids and, marked, the first row of the range behind it (the
    first of all behind the last), so a task has every row's successor. Texts are shuffled once;
    the driver sees the bounds of the buckets only.
    """
    spark = docs.sparkSession
    lowest = F.lit(-(2**63)).cast("long")
    docs = docs.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("place", F.coalesce("id", lowest))
    count = max(2, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = docs.where("id is not null").agg(
        F.percentile_approx("id", [i / count for i in range(1, count)], 20 * count)
    ).first()[0]
    bounds = sorted(set(cuts or []))
    numbers = lambda values: F.expr(f"array({', '.join(f'{v}L' for v in values)})") if values else F.array().cast("array<bigint>")
    whole, coarse = numbers(bounds), numbers(bounds[31::32])
    above = lambda values: F.size(F.filter(values, lambda b: F.col("place") >= b))
    if bounds:
        bucket = above(coarse) * 32
        bucket = bucket + F.size(
            F.filter(F.slice(whole, bucket + 1, F.lit(32)), lambda b: F.col("place") >= b)
        )
    else:
        bucket = F.lit(0)
    docs = docs.withColumn("bucket", bucket.cast("int"))
    heads = docs.groupBy("bucket").agg(F.min("place").alias("place"))
    firsts = sorted((r["bucket"], r["place"]) for r in heads.collect())  # at most ``count`` rows
    goes = [(b, p, firsts[i - 1][0]) for i, (b, p) in enumerate(firsts)]
    table = spark.createDataFrame(goes, "head int, head_place long, goes_to int")
    marked = (
        docs.join(F.broadcast(table), F.col("place") == F.col("head_place"))
        .groupBy("goes_to", "id").agg(F.min("text").alias("text"))
    )
    rows = docs.select("bucket", F.lit(False).alias("is_next"), "id", "text").unionByName(
        marked.select(F.col("goes_to").alias("bucket"), F.lit(True).alias("is_next"), "id", "text")
    )
    return rows.repartition("bucket").sortWithinPartitions("bucket", "is_next", "id", "text")


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text, of the text with its last half replaced, and of the next text.

    Columns: doc_id, n_chars, edited_text, fingerprint, edited_fingerprint, near_edited, near_next.
    The last floor(n_chars / 2) code points give way to the first as many, or all, of the next
    document by doc_id; the last document is followed by the first. A null text counts as empty. A
    null doc_id comes before all others; rows that share a doc_id are ordered by text. A single row
    is its own successor; an empty table gives an empty result. Other columns are not read.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row so far, waiting for its successor

        def rows_of(pairs: list[tuple]) -> pa.RecordBatch:
            edited = [
                t[: len(t) - len(t) // 2] + after[: len(t) // 2] for (_, t, _), (_, after, _) in pairs
            ]
            own = [x[0][2] for x in pairs]
            changed, following = _signatures(edited), [x[1][2] for x in pairs]
            text = lambda sigs: pa.array([s.astype(">u4").tobytes().hex() for s in sigs], pa.string())
            return pa.RecordBatch.from_pydict({
                "doc_id": pa.array([x[0][0] for x in pairs], pa.int64()),
                "n_chars": pa.array([len(x[0][1]) for x in pairs], pa.int64()),
                "edited_text": pa.array(edited, pa.string()),
                "fingerprint": text(own),
                "edited_fingerprint": text(changed),
                "near_edited": pa.array([likeness(a, b) for a, b in zip(own, changed, strict=True)], pa.float64()),
                "near_next": pa.array([likeness(a, b) for a, b in zip(own, following, strict=True)], pa.float64()),
            })

        for batch in batches:
            pairs: list[tuple] = []
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                _, following, ids, texts = (part.column(j).to_pylist() for j in range(4))
                for is_next, doc, text, sig in zip(following, ids, texts, _signatures(texts), strict=True):
                    row = (doc, text, sig)
                    if held is not None:
                        pairs.append((held, row))
                    held = None if is_next else row
            if pairs:
                yield rows_of(pairs)

    return _with_successor(docs).mapInArrow(
        run,
        "doc_id long, n_chars long, edited_text string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )


def op9_order_minhash(spark, sf_dir):
    return edited_pairs(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    )


QUERIES = {"op9_order_minhash": (op9_order_minhash, None)}
