"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text is cut into bins at quantiles. Boosting goes round the features and fits,
per step, a tree of one or two cuts to the gradients summed by bin; its leaves are added to the
feature's lookup table. The pairs of features with the most left to explain then get tables of two
dimensions in the same way. A score is a sum of looked-up values. The fit sees a bounded sample of
labelled rows on the driver; scoring is one pass over all texts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import Words, arrow_binary, grams, map_batches, read, small_batches

#: Labelled rows that the fit sees at most, chosen by a hash of doc_id.
FIT_ROWS = 20_000
BINS = 32
PAIR_BINS = 8
PAIRS = 8
ROUNDS = 120
PAIR_ROUNDS = 40
RATE = 0.1
#: Added to the summed curvature of a leaf: small leaves stay near zero.
RIDGE = 2.0

FEATURES = (
    "log_words", "log_chars", "word_length", "long_words", "symbol_share", "digit_share",
    "upper_share", "punctuation_share", "wide_share", "distinct_words", "top_word",
    "repeated_triples", "dup_lines", "words_per_line", "words_per_sentence", "longest_word",
)

_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_DIGIT = np.isin(np.arange(256), list(b"0123456789"))
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_POINT = np.isin(np.arange(256), list(b".,;:!?'\"()-"))
_WIDE = np.arange(256) >= 128
_STOP = np.isin(np.arange(256), list(b".!?"))
_KINDS = np.stack([_SYMBOL, _DIGIT, _UPPER, _POINT, _WIDE, _STOP]).astype(np.float64)


def features(texts: list[str | None]) -> np.ndarray:
    """One row of numbers per text; a null or blank text gives zeros and finite values only."""
    words = Words(texts)
    out = np.zeros((len(texts), len(FEATURES)))
    for i, text in enumerate(texts):
        a, b = int(words.first[i]), int(words.first[i + 1])
        n = b - a
        if not n:
            continue
        raw = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
        counts = np.bincount(raw, minlength=256)
        symbol, digit, upper, point, wide, stop = _KINDS @ counts
        length = words.end[a:b] - words.begin[a:b]
        chars = int(length.sum())
        _, often = np.unique(words.codes[a:b], return_counts=True)
        triples = grams(words.codes[a:b], 3)
        _, kind, again = np.unique(triples, return_inverse=True, return_counts=True)
        lines = [x for x in re.split("\n", text or "") if x.strip(" \t\n\x0b\x0c\r")]
        out[i] = (
            np.log1p(n), np.log1p(chars), chars / n, (length > 12).mean(), symbol / chars,
            digit / chars, upper / chars, point / chars, wide / chars, len(often) / n,
            often.max() / n, (again[kind] > 1).mean() if len(triples) else 0.0,
            1 - len(set(lines)) / len(lines), n / len(lines), n / (stop + 1), np.log1p(length.max()),
        )
    return out


@dataclass
class Model:
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_edges: list[np.ndarray]
    pair_tables: list[np.ndarray]
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 per row."""
        total = np.full(len(x), self.start)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, x[:, j], "right")]
        for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
            at = np.searchsorted(self.pair_edges[a], x[:, a], "right")
            total += table[at, np.searchsorted(self.pair_edges[b], x[:, b], "right")]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.arange(1, bins) / bins))


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Best gain and place to cut a row of bins in two."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(left_g):
        return 0.0, 0
    g_all, h_all = g.sum(), h.sum()
    gain = (
        left_g**2 / (left_h + RIDGE) + (g_all - left_g) ** 2 / (h_all - left_h + RIDGE)
        - g_all**2 / (h_all + RIDGE)
    )
    at = int(gain.argmax())
    return float(gain[at]), at + 1


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf value of each bin: one cut, and one more on each side of it."""
    out = np.zeros(len(g))
    _, at = _cut(g, h)
    for low, high in ((0, at), (at, len(g))):
        if high > low:
            _, inner = _cut(g[low:high], h[low:high])
            for a, b in ((low, low + inner), (low + inner, high)):
                if b > a:
                    out[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return out


def _tree2(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and leaf value of each cell: a cut across, and one along on each side."""
    best, out = 0.0, np.zeros_like(g)
    for flip in (False, True):
        gg, hh = (g.T, h.T) if flip else (g, h)
        _, at = _cut(gg.sum(axis=1), hh.sum(axis=1))
        total, cells = -gg.sum() ** 2 / (hh.sum() + RIDGE), np.zeros_like(gg)
        for low, high in ((0, at), (at, len(gg))):
            if high > low:
                _, inner = _cut(gg[low:high].sum(axis=0), hh[low:high].sum(axis=0))
                for a, b in ((0, inner), (inner, gg.shape[1])):
                    if b > a:
                        part_g, part_h = gg[low:high, a:b].sum(), hh[low:high, a:b].sum()
                        total += part_g**2 / (part_h + RIDGE)
                        cells[low:high, a:b] = part_g / (part_h + RIDGE)
        if total > best:
            best, out = float(total), cells.T.copy() if flip else cells
    return best, out


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting of one-dimensional tables, then of the most useful two-dimensional ones.

    Without rows, or with one label only, the model is a constant.
    """
    count = x.shape[1]
    edges = [_edges(x[:, j], BINS) if len(x) else np.empty(0) for j in range(count)]
    pair_edges = [_edges(x[:, j], PAIR_BINS) if len(x) else np.empty(0) for j in range(count)]
    rate = (y.sum() + 1) / (len(y) + 2)
    model = Model(edges, [np.zeros(len(e) + 1) for e in edges], [], pair_edges, [], float(np.log(rate / (1 - rate))))
    if not len(y) or y.min() == y.max():
        return model
    bins = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)]
    total = np.full(len(y), model.start)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(count):
            g, h = slopes()
            size = len(model.tables[j])
            step = RATE * _tree(np.bincount(bins[j], g, size), np.bincount(bins[j], h, size))
            model.tables[j] += step
            total += step[bins[j]]
    coarse = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(pair_edges)]

    def sums(a: int, b: int, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shape = (len(pair_edges[a]) + 1, len(pair_edges[b]) + 1)
        cell = coarse[a] * shape[1] + coarse[b]
        size = shape[0] * shape[1]
        return np.bincount(cell, g, size).reshape(shape), np.bincount(cell, h, size).reshape(shape)

    g, h = slopes()
    ranked = sorted(
        ((_tree2(*sums(a, b, g, h))[0], a, b) for a in range(count) for b in range(a)), reverse=True
    )
    model.pairs = [(a, b) for _, a, b in ranked[:PAIRS]]
    model.pair_tables = [np.zeros((len(pair_edges[a]) + 1, len(pair_edges[b]) + 1)) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (a, b) in enumerate(model.pairs):
            g, h = slopes()
            step = RATE * _tree2(*sums(a, b, g, h))[1]
            model.pair_tables[k] += step
            total += step[coarse[a], coarse[b]]
    return model


def _featured(df: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the features of the text as packed doubles."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = features(batch.column(len(keep)).to_pylist())
        packed = arrow_binary([row.astype("<f8").tobytes() for row in x])
        return pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], packed], [*keep, "packed"])

    schema = df.select(*keep).withColumn("packed", F.lit(b"").cast("binary")).schema
    return map_batches(df.select(*keep, "text"), run, schema)


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Fit on at most ``fit_rows`` labelled documents (doc_id, quality), the same on every run.

    Rows without a doc_id or a label are left out. A doc_id labelled twice, or with several texts,
    counts as often, but the rows that reach the driver are ``fit_rows`` at most. Rows are in hash
    order of doc_id, so the sample does not depend on the layout of the tables.
    """
    chosen = (
        labels.where("quality is not null and doc_id is not null")
        .select(F.col("doc_id").alias("label_id"), F.col("quality").cast("double").alias("quality"))
        .orderBy(F.xxhash64("label_id"), "label_id", "quality").limit(fit_rows)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
    # The bound holds for rows of one size each, also where a doc_id stands many times in docs.
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("quality"), F.col("packed")]
    got = _featured(rows, ["doc_id", "quality"]).orderBy(*order).limit(fit_rows).collect()
    got.sort(key=lambda r: (r["doc_id"], r["quality"], r["packed"]))
    x = np.array([np.frombuffer(r["packed"], "<f8") for r in got]).reshape(len(got), len(FEATURES))
    return fit(x, np.array([r["quality"] for r in got]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1, higher: label 1 likelier) and predicted (1 from a score of 0.5).

    Null and empty texts are scored as texts without words. Repeated rows get equal scores; an
    empty table gives an empty result; other columns are not read.
    """
    small_batches(docs.sparkSession)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = model.score(features(batch.column(1).to_pylist()))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(values), pa.array((values >= 0.5).astype(np.int32))],
            ["doc_id", "score", "predicted"],
        )

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, score double, predicted int")


def held_out(doc_id: str = "doc_id"):
    """Whether a document's label is kept from the fit."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op5_quality_gam(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    labels = read(spark, sf_dir, "labels").where(~held_out())
    model = train(docs, labels)
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


QUERIES = {"op5_quality_gam": (op5_quality_gam, None)}
