"""Audit of how far the sources of a language differ in their use of terms.

``bytes.translate`` lowers A-Z and blanks every other ASCII sign in one pass, ``bytes.split`` gives
the terms, and a Counter per document their frequencies. A task adds the Counters up per language
and source, and sends (language, source, term, frequency, documents) to Spark's aggregation: one row
per term and task, however many documents a source has.

The smoothed share p of a term in a group is an integer of billionths. Terms that a group lacks all
have the same share ``p0``, so the distance of two groups needs no dense vectors. With V terms,

    sum |p_a - p_b| = V |p0_a - p0_b| + A(a, b) + A(b, a) + B(a, b)

    A(a, b) = sum over terms of a of |p_a - p0_b| - |p0_a - p0_b|
    B(a, b) = sum over terms of both of |p_a - p_b| - |p_a - p0_b| - |p0_a - p_b| + |p0_a - p0_b|

A depends on a term's count only, so it is summed over the distinct counts of a. B is summed over
blocks of terms as small matrices of terms by sources; a block gives one row per pair of sources.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import read, small_batches, stored

#: Documents of a language that a term needs, smoothing per term, and ranks of part ``term``.
MIN_DOCS = 30
SMOOTHING = 5
TOP = 50
UNIT = 1_000_000_000
#: Terms a task adds up before it sends them on: a hundred bytes and more each.
HELD_TERMS = 1_000_000
#: Rows of an outgoing batch, cells of a matrix of terms by sources, sources handled side by side.
ROWS = 1 << 16
CELLS = 1 << 20
SIDE = 256

#: A-Z become a-z; letters and bytes of longer code points stay; all else is a blank.
TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
#: Frequency and documents of a term in one number, so that a task keeps one table.
_TF = 1 << 32


def terms(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


def term_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Per lang, source and term: tf (occurrences) and df (documents), both long.

    A null text, lang or source counts as empty. A document without terms gives no row; every row of
    ``docs`` is a document, also one that is there twice.
    """
    small_batches(docs.sparkSession)

    def flushed(held: dict[tuple, dict[bytes, int]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), found in held.items():
            for low in range(0, len(found), ROWS):
                names = list(found)[low : low + ROWS] if len(found) > ROWS else list(found)
                values = np.array([found[t] for t in names], np.int64)
                fill = lambda x, n=len(names): pa.repeat(pa.scalar(x, pa.string()), n)
                yield pa.RecordBatch.from_arrays(
                    [
                        fill(lang), fill(source), pa.array(names, pa.binary()).cast(pa.string()),
                        pa.array(values // _TF), pa.array(values % _TF),
                    ],
                    ["lang", "source", "term", "tf", "df"],
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, dict[bytes, int]] = {}
        size = 0
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            for lang, source, whole in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, strict=True
            ):
                found = held.setdefault((lang, source), {})
                before, known = len(found), found.get
                for term, n in Counter(terms(whole.as_py())).items():
                    found[term] = known(term, 0) + (n * _TF + 1)
                size += len(found) - before
                if size >= HELD_TERMS:
                    yield from flushed(held)
                    held, size = {}, 0
        yield from flushed(held)

    empty = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    rows = docs.select(empty("lang"), empty("source"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.mapInArrow(run, "lang string, source string, term string, tf long, df long")
    # Hashed by language and term once: for these sums and for the windows over a term's sources.
    return (
        rows.repartition("lang", "term").groupBy("lang", "source", "term")
        .agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
    )


def _share(count: str, total: str, terms_: str = "n_terms") -> F.Column:
    """1 + floor(UNIT * (count + SMOOTHING) / (total + SMOOTHING * terms)), exactly."""
    up = f"cast({UNIT} as decimal(18, 0)) * cast({count} + {SMOOTHING} as decimal(20, 0))"
    return F.expr(f"1 + ({up}) div cast({total} + {SMOOTHING} * {terms_} as decimal(20, 0))")


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS, text: str = "text") -> DataFrame:
    """Counts of the terms that at least ``min_docs`` documents of their language hold.

    Columns: lang, source, term, count (here), lang_count (in the language), first (one row a term).
    """
    by_term = Window.partitionBy("lang", "term")
    counts = term_counts(docs, text).withColumns(
        {
            "lang_df": F.sum("df").over(by_term),
            "lang_count": F.sum("tf").over(by_term),
            "first": F.row_number().over(by_term.orderBy("source")) == 1,
        }
    )
    return counts.where(F.col("lang_df") >= min_docs).select(
        "lang", "source", "term", F.col("tf").alias("count"), "lang_count", "first"
    )


def groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Every (lang, source): total, lang_total, n_terms of the language, and p0 of a term it lacks."""
    empty = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    all_groups = docs.select(empty("lang"), empty("source")).distinct()
    own = kept.groupBy("lang", "source").agg(
        F.sum("count").alias("total"), F.count_if("first").alias("firsts")
    )
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    by_lang = Window.partitionBy("lang")
    rows = all_groups.join(own, ["lang", "source"], "left").select(
        "lang", "source", zero(F.col("total")).alias("total"),
        zero(F.sum("total").over(by_lang)).alias("lang_total"),
        zero(F.sum("firsts").over(by_lang)).alias("n_terms"),
    )
    return rows.withColumn("p0", F.when(F.col("n_terms") > 0, _share("0", "total")))


def _both(shares: DataFrame) -> DataFrame:
    """B of the formula above: lang, a, b, part; the rows of a term stand together."""

    def sums(lang: str, codes: list[int], sources: list[str], p: list[int], p0: list[int]) -> Iterator[pa.RecordBatch]:
        names, column = np.unique(np.array(sources, object), return_inverse=True)
        row = np.unique(np.array(codes), return_inverse=True)[1]
        base = np.zeros(len(names), np.int64)
        base[column] = p0
        here = np.zeros((row.max() + 1, len(names)), bool)
        share = np.zeros(here.shape, np.int64)
        here[row, column] = True
        share[row, column] = p
        labels = pa.array(names.tolist(), pa.string())
        for low in range(0, len(names), SIDE):
            side = range(low, min(low + SIDE, len(names)))
            out = np.empty((len(side), len(names)), np.int64)
            for i, a in enumerate(side):
                has = here[:, a]
                mine, others = share[has, a][:, None], share[has]
                both = (
                    np.abs(mine - others) - np.abs(mine - base) - np.abs(base[a] - others) + np.abs(base[a] - base)
                )
                out[i] = (both * here[has]).sum(axis=0)
            i, b = np.nonzero(out)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.repeat(pa.scalar(lang, pa.string()), len(i)),
                    labels.take(pa.array(i + low)), labels.take(pa.array(b)), pa.array(out[i, b]),
                ],
                ["lang", "a", "b", "part"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, last, code, seen = None, None, 0, set()
        held: tuple[list, list, list, list] = ([], [], [], [])
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                term = row[:2]
                if term != last:
                    if row[0] != lang or (code + 1) * max(1, len(seen)) > CELLS:
                        if held[0]:
                            yield from sums(lang, *held)
                        lang, code, seen, held = row[0], 0, set(), ([], [], [], [])
                    last, code = term, code + 1
                seen.add(row[2])
                for store, value in zip(held, (code, *row[2:]), strict=True):
                    store.append(value)
        if held[0]:
            yield from sums(lang, *held)

    return shares.mapInArrow(run, "lang string, a string, b string, part long")


def pair_distances(kept: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, source, item, value for each two sources of a language, both ways round.

    The result has a row for each two sources of a language, and so has the join that it starts from.
    """
    rows = kept.join(totals.select("lang", "source", "total", "n_terms", "p0"), ["lang", "source"])
    rows = rows.withColumn("p", _share("count", "total"))
    placed = rows.select("lang", "term", "source", "p", "p0").repartition("lang", "term")
    both = _both(placed.sortWithinPartitions("lang", "term")).groupBy("lang", "a", "b").agg(F.sum("part").alias("both"))
    side = lambda name: totals.select("lang", F.col("source").alias(name), F.col("p0").alias(f"{name}0"), "n_terms")
    one, other = side("a"), side("b").drop("n_terms")
    base = F.abs(F.col("a0") - F.col("b0"))
    shares = rows.groupBy("lang", F.col("source").alias("a"), F.col("p0").alias("a0"), "p").agg(F.count("*").alias("n"))
    own = (
        shares.join(other, "lang").groupBy("lang", "a", "b")
        .agg(F.sum(F.col("n") * (F.abs(F.col("p") - F.col("b0")) - base)).alias("own"))
    )
    pairs = one.join(other, "lang").where("a <> b")
    back = own.select("lang", F.col("a").alias("b"), F.col("b").alias("a"), F.col("own").alias("back"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    value = zero(F.col("n_terms") * base) + zero(F.col("own")) + zero(F.col("back")) + zero(F.col("both"))
    keys = ["lang", "a", "b"]
    return pairs.join(own, keys, "left").join(back, keys, "left").join(both, keys, "left").select(
        "lang", F.col("a").alias("source"), F.col("b").alias("item"), value.alias("value")
    )


def term_excess(kept: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, source, item, value: terms of a source whose share is above the language's."""
    rows = kept.join(totals, ["lang", "source"])
    rows = rows.withColumns({"p": _share("count", "total"), "q": _share("lang_count", "lang_total")})
    return rows.where("p > q").select(
        "lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value")
    )


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, text: str = "text") -> DataFrame:
    """lang, source, part, item, value, rank: other sources by distance, and a source's own terms.

    Nulls in lang, source or text count as ''. A language without kept terms gives distances of 0,
    one with a single source gives no pairs. Ties of value go by item (UTF-8, ascending). Equal rows
    are documents of their own. An empty table gives an empty result; other columns are not read.
    """
    kept = stored(kept_terms(docs, min_docs, text), "terms")
    totals = stored(groups(docs, kept), "groups")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda rows, part: rows.withColumns(
        {"part": F.lit(part), "rank": F.row_number().over(by_value)}
    )
    near = ranked(pair_distances(kept, totals), "pair")
    own = ranked(term_excess(kept, totals), "term").where(F.col("rank") <= top)
    return near.unionByName(own).select("lang", "source", "part", "item", "value", "rank")


def op11_source_divergence(spark, sf_dir):
    return audit(read(spark, sf_dir, "documents"))


ORACLE = f"""
WITH docs AS (
    SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           row_number() OVER () AS doc,
           regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+'
           ) AS terms
    FROM documents
),
words AS (SELECT lang, source, doc, unnest(terms) AS term FROM docs),
dfs AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= {MIN_DOCS}),
counts AS (
    SELECT lang, source, term, count(*) AS n
    FROM words JOIN dfs USING (lang, term) GROUP BY lang, source, term
),
grid AS (
    SELECT g.lang, g.source, d.term, coalesce(c.n, 0) AS n
    FROM (SELECT DISTINCT lang, source FROM docs) g JOIN dfs d ON g.lang = d.lang
    LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = d.term
),
shares AS (
    SELECT lang, source, term, n,
           1 + (1000000000::HUGEINT * (n + {SMOOTHING}))
             // (sum(n) OVER (PARTITION BY lang, source) + {SMOOTHING} * count(*) OVER (PARTITION BY lang, source)) AS p
    FROM grid
),
lang_shares AS (
    SELECT lang, term,
           1 + (1000000000::HUGEINT * (n + {SMOOTHING}))
             // (sum(n) OVER (PARTITION BY lang) + {SMOOTHING} * count(*) OVER (PARTITION BY lang)) AS q
    FROM (SELECT lang, term, sum(n) AS n FROM grid GROUP BY lang, term)
),
near AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY a.lang, a.source, b.source
),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(n.value, 0) AS value
    FROM (SELECT DISTINCT lang, source FROM docs) a
    JOIN (SELECT DISTINCT lang, source FROM docs) b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN near n ON n.lang = a.lang AND n.source = a.source AND n.item = b.source
),
own AS (
    SELECT s.lang, s.source, s.term AS item, s.p - l.q AS value
    FROM shares s JOIN lang_shares l ON s.lang = l.lang AND s.term = l.term
    WHERE s.n > 0 AND s.p > l.q
),
ranked AS (
    SELECT lang, source, 'pair' AS part, item, value,
           row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank
    FROM pairs
    UNION ALL
    SELECT lang, source, 'term' AS part, item, value,
           row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank
    FROM own
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""

QUERIES = {"op11_source_divergence": (op11_source_divergence, ORACLE)}
