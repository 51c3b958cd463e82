"""Periodic runs of words, found as maximal pairs, and texts with the repeats taken out.

A maximal pair is two places i < j of a text from which the same l words follow, with different
words (or an end of the text) before them and behind them. The stretch from i to j + l then has the
period j - i, and neither neighbour continues it: if j - i is small beside l, the pair *is* a run,
and nothing has to be extended.

1. Suffixes of a batch of texts are sorted by doubling; places that are already alone drop out of
   every further step, so ordinary prose costs a few sorts. Texts never mix: a word counts as
   another word in another text.
2. Neighbours in that order that share enough words for a run form blocks. A block is read as the
   bottom-up traversal of its LCP-interval tree. Each interval holds its places in ascending order,
   each in the class of the word on its left.
3. Where two children of an interval are joined, the smaller goes into the larger, and each of its
   places is paired with the nearest places of the larger on both sides, if those are of another
   class. Nearest ones are enough: were there a third place of the same l words between i and
   i + p, with l >= 2 p, the stretch would have a smaller period (Fine and Wilf), so p would not be
   its period. A place moves O(log n) times.
4. Of pairs with the same stretch the one with the smallest distance stays: by the same theorem the
   smallest period of a stretch divides the others, and its own pair is among those found.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import Words, map_batches, mix, read, small_batches, texts_of

#: A run has at least so many words, and so many periods.
MIN_WORDS = 24
MIN_PERIODS = 3
#: Places of one block of an interval's ordered list.
BLOCK = 1024

_STEP = np.uint64(0x9E3779B97F4A7C15)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS_TYPE = "array<struct<start:long,length:long,period:long>>"


class Places:
    """Ascending numbers in blocks of bounded size, so that an insertion moves few of them."""

    __slots__ = ("blocks", "lows", "size")

    def __init__(self, place: int) -> None:
        self.blocks = [[place]]
        self.lows = [place]
        self.size = 1

    def around(self, x: int) -> tuple[int | None, int | None]:
        """The nearest numbers below and above x, which is not in the list."""
        b = max(0, bisect_left(self.lows, x) - 1)
        block = self.blocks[b]
        i = bisect_left(block, x)
        below = block[i - 1] if i else None
        if i < len(block):
            return below, block[i]
        return below, self.lows[b + 1] if b + 1 < len(self.lows) else None

    def add(self, x: int) -> None:
        b = max(0, bisect_left(self.lows, x) - 1)
        block = self.blocks[b]
        insort(block, x)
        self.lows[b] = block[0]
        self.size += 1
        if len(block) > BLOCK:
            half = len(block) // 2
            self.blocks.insert(b + 1, block[half:])
            self.lows.insert(b + 1, block[half])
            del block[half:]


def _sorted_suffixes(kinds: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes in order, and per level j the group of each place by its first 2**j words.

    ``kinds`` are codes of words that no two texts share, ``ends[i]`` is the end of the text of
    place i. A suffix shorter than 2**j words is alone in its group.
    """
    n = len(kinds)
    order = np.argsort(kinds, kind="stable").astype(np.int32)
    ranked = kinds[order]
    fresh = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    places = np.arange(n, dtype=np.int32)
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(fresh, places, 0))
    shared = np.flatnonzero(~(fresh & np.append(fresh[1:], True)))
    levels, k = [rank], 1
    while len(shared):
        at = order[shared]
        behind = at + np.int32(k)
        inside = behind < ends[at]
        second = np.where(inside, rank[np.minimum(behind, n - 1)] + np.int64(1), 0)
        pair = rank[at].astype(np.int64) * (n + 1) + second
        by_pair = np.argsort(pair, kind="stable")
        at, pair = at[by_pair], pair[by_pair]
        order[shared] = at
        fresh = np.concatenate(([True], pair[1:] != pair[:-1]))
        start = shared[np.maximum.accumulate(np.where(fresh, np.arange(len(shared)), 0))]
        rank = rank.copy()
        rank[at] = start
        levels.append(rank)
        shared = shared[~(fresh & np.append(fresh[1:], True))]
        k *= 2
    return order, levels


def _shared_prefix(a: np.ndarray, b: np.ndarray, ends: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """How many words the suffixes at a and b, of the same text, have in common."""
    last = len(ends) - 1
    stop, out = ends[a], np.zeros(len(a), np.int64)
    for j in range(len(levels) - 1, -1, -1):
        x, y = a + out, b + out
        same = (x < stop) & (y < stop)
        same &= levels[j][np.minimum(x, last)] == levels[j][np.minimum(y, last)]
        out += same.astype(np.int64) << j
    return out


def _maximal_pairs(places: list[int], shared: list[int], left: np.ndarray, min_words: int, min_periods: int) -> list:
    """Pairs (start, length, period) of one block: ``shared[i]`` words are common to places i and i + 1."""
    found = []

    def joined(a: Places, b: Places, words: int) -> Places:
        """Both children of an interval whose places share that many words."""
        small, large = (a, b) if a.size <= b.size else (b, a)
        own = [x for block in small.blocks for x in block]
        for x in own:
            below, above = large.around(x)
            for i, j in ((below, x), (x, above)):
                if i is None or j is None:
                    continue
                p = j - i
                if words >= (min_periods - 1) * p and words + p >= min_words and left[i] != left[j]:
                    found.append((i, words + p, p))
        for x in own:
            large.add(x)
        return large

    open_: list[tuple[int, Places]] = []
    child = Places(places[0])
    for x, words in zip(places[1:], shared, strict=True):
        while open_ and open_[-1][0] > words:
            depth, held = open_.pop()
            child = joined(held, child, depth)
        if open_ and open_[-1][0] == words:
            held = open_.pop()[1]
            child = joined(held, child, words)
        open_.append((words, child))
        child = Places(x)
    while open_:
        depth, held = open_.pop()
        child = joined(held, child, depth)
    return found


def find_runs(
    codes: np.ndarray, first: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and periods of all runs, ascending; text t has the words first[t]:first[t + 1]."""
    if min_periods < 3:
        raise ValueError("runs of fewer than three periods are not found as neighbouring places")
    none = np.empty(0, np.int64)
    n = len(codes)
    # The fewest words that the two places of a run have in common.
    least = -(-min_words * (min_periods - 1) // min_periods)
    if n < min_words:
        return none, none, none
    sizes = np.diff(first)
    text = np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes)
    ends = np.repeat(first[1:], sizes)
    kinds = mix(codes + text * _STEP)
    order, levels = _sorted_suffixes(kinds, ends)
    level = least.bit_length() - 1
    if level >= len(levels):
        return none, none, none
    a, b = order[:-1].astype(np.int64), order[1:].astype(np.int64)
    near = np.flatnonzero(levels[level][a] == levels[level][b])
    words = _shared_prefix(a[near], b[near], ends, levels)
    near, words = near[words >= least], words[words >= least]
    if not len(near):
        return none, none, none
    left = np.concatenate(([-1], levels[0][:-1]))
    left[first[:-1][sizes > 0]] = -1  # nothing stands on the left of a text's first word
    cut = np.flatnonzero(np.diff(near) > 1) + 1
    found: list[tuple[int, int, int]] = []
    for low, high in zip([0, *cut.tolist()], [*cut.tolist(), len(near)], strict=True):
        places = order[near[low] : near[high - 1] + 2].tolist()
        found += _maximal_pairs(places, words[low:high].tolist(), left, min_words, min_periods)
    if not found:
        return none, none, none
    start, length, period = np.array(found, np.int64).T
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    fresh = np.concatenate(([True], (start[1:] != start[:-1]) | (length[1:] != length[:-1])))
    start, length, period = start[fresh], length[fresh], period[fresh]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def periodic_runs(
    docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS
) -> DataFrame:
    """Add ``n_words``, ``runs`` (start, length, period in words, ascending) and ``collapsed``.

    A run is a stretch of consecutive words (anything but ASCII white space) with smallest period
    ``period``, at least ``min_words`` and ``min_periods`` periods long, that no neighbouring word
    extends. ``collapsed`` has the words, joined by one blank, that no run holds beyond its first
    period. A null or blank text has no words, no runs and an empty ``collapsed``. Other columns
    stay; those of the three names are replaced. Repeated rows stay, an empty table stays empty. A
    text is handled whole by one task; the memory of a batch follows its words.
    """
    small_batches(docs.sparkSession)
    names = ("n_words", "runs", "collapsed")
    rest = docs.drop(*names)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(texts_of(batch, text))
        first = words.first
        start, length, period = find_runs(words.codes, first, min_words, min_periods)
        covered = np.zeros(len(words.codes) + 1, np.int64)
        np.add.at(covered, start + period, 1)
        np.add.at(covered, start + length, -1)
        gone = np.cumsum(covered)[:-1] > 0
        bounds = np.searchsorted(start, first)
        collapsed = []
        for low, high, has in zip(first[:-1].tolist(), first[1:].tolist(), np.diff(bounds).tolist(), strict=True):
            if not has:
                collapsed.append(words.text(low, high))
                continue
            kept = low + np.flatnonzero(~gone[low:high])
            spans = zip(words.begin[kept].tolist(), words.end[kept].tolist(), strict=True)
            collapsed.append(b" ".join([words.raw[a:b] for a, b in spans]))
        base = first[np.searchsorted(first, start, "right") - 1]
        run_rows = pa.StructArray.from_arrays(
            [pa.array(start - base), pa.array(length), pa.array(period)], fields=list(_RUN)
        )
        return pa.RecordBatch.from_arrays(
            [
                *batch.columns,
                pa.array(np.diff(first)),
                pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), run_rows),
                pa.array(collapsed, pa.binary()).cast(pa.string()),
            ],
            [*batch.schema.names, *names],
        )

    more = rest.select(
        "*", F.lit(0).cast("long").alias("n_words"), F.lit(None).cast(RUNS_TYPE).alias("runs"), F.lit("").alias("collapsed")
    )
    return map_batches(rest, run, more.schema)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text; every tenth text, by the checksum of doc_id, ends in a repeated passage.

    With h the checksum and g = floor(h / 10), the word i >= a = g % n of n becomes word
    a + (i - a) % p, p = 1 + floor((n - a) / (3 + g % 8)); such words are joined by one blank. Without
    doc_id, or without words, a text stays as it is; a null text stays null.
    """
    gap = "[\\x20\\x09-\\x0D]+"
    trimmed = F.btrim("text", F.lit(" \t\n\x0b\x0c\r"))
    check = F.crc32(F.col("doc_id").cast("string"))
    chosen = (check % 10 == 0) & (trimmed != "")
    docs = docs.select("doc_id", "text", F.when(chosen, F.split(trimmed, gap)).alias("__words"))
    docs = docs.withColumns({"__n": F.size("__words"), "__g": F.floor(check / 10)})
    docs = docs.withColumn("__a", (F.col("__g") % F.col("__n")).cast("int"))
    docs = docs.withColumn("__p", F.expr("cast(1 + (__n - __a) div (3 + __g % 8) as int)"))
    moved = F.transform(
        "__words",
        lambda w, i: F.when(i < F.col("__a"), w).otherwise(
            F.get("__words", F.col("__a") + (i - F.col("__a")) % F.col("__p"))
        ),
    )
    changed = F.col("__words").isNotNull()
    return docs.select("doc_id", F.when(changed, F.array_join(moved, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark, sf_dir):
    found = periodic_runs(with_planted_runs(read(spark, sf_dir, "documents")))
    # Runs ascend by start and period, so the first of several of one exponent stays.
    best = F.reduce(
        "runs",
        F.get("runs", F.lit(0)),
        lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best),
    )
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    found = found.withColumn("best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {"op13_periodic_runs": (op13_periodic_runs, None)}
