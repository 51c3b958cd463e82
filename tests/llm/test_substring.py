"""Substring dedup against a table of all windows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import substring
from tallyloom.llm.substring import cut_repeats

from .conftest import DOCS, passage


def brute(rows, window=50):
    """Multiset of (doc_id, words, removed, kept text)."""
    first = {}
    split = [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in split:
        for i in range(len(w) - window + 1 if d is not None else 0):
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1 if d is not None else 0):
            if first[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()
        out.append((d, len(w), sum(gone), kept))
    return sorted(out, key=str)


def result(df):
    return sorted(map(tuple, df.select("doc_id", "n_words", "n_removed", "kept_text").collect()), key=str)


def test_odd_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert result(cut_repeats(odd)) == brute(rows)
    kept = cut_repeats(odd, keep=["doc_id", "packed", "row_key"])
    assert kept.select("kept.packed").distinct().collect()[0][0] == "p"
    assert cut_repeats(none).count() == 0


@pytest.mark.parametrize("hot_units", [2_000, 3])
def test_shared_passages(spark, hot_units):
    """Passages in many contexts, near copies, and a document that repeats itself."""
    shared, base = passage(9, 60), passage(8, 300).split()
    rows = [(i, f"{passage(100 + i, 30)} {shared} {passage(200 + i, 30)}") for i in range(12)]
    for i in range(12, 24):
        words = list(base)
        words[13 * (i - 11)] = f"edit{i}"
        rows.append((i, " ".join(words)))
    rows.append((24, f"{shared} {shared}"))
    rows.append((25, passage(300, 55) + " " + passage(300, 55)))
    rows.append((26, passage(9, 49)))
    df = spark.createDataFrame([(*r, *[None] * 8) for r in rows], DOCS).repartition(4)
    assert result(cut_repeats(df, hot_units=hot_units, index_words=2_000)) == brute(rows)


@pytest.mark.parametrize("hot_units", [2_000, 1])
def test_exact_windows_inside_longer_texts(spark, hot_units):
    """Texts of exactly one window, and passages at the first and last word, in both id orders."""
    rng = random.Random(5)
    rows = []
    for i in range(60):
        words = rng.choice([50, 50, 50, 51, 57])
        shared, at = passage(i, words), i % 3
        before = "" if at == 0 else passage(1_000 + i, rng.randrange(1, 60))
        after = "" if at == 2 else passage(2_000 + i, rng.randrange(1, 60))
        texts = [shared, f"{before} {shared} {after}"]
        if i % 5 == 0:  # both in a context of their own
            texts[0] = f"{passage(3_000 + i, 40)} {shared}"
        first = 2 * i
        rows += zip((first, first + 1) if i % 2 else (first + 1, first), texts, strict=True)
    df = spark.createDataFrame([(*r, *[None] * 8) for r in rows], DOCS).repartition(4)
    want = brute(rows)
    assert sum(r[2] > 0 for r in want) == 60
    assert result(cut_repeats(df, hot_units=hot_units)) == want


@pytest.mark.parametrize("hot_units", [2_000, 5])
def test_copies_collapse_first(spark, monkeypatch, hot_units):
    """Many copies of one text write about that text, in any order of ids, beside near copies of it."""
    base, written = passage(1, 300), {}
    rows = [(1_000 + i, base) for i in range(400)] + [(1_000, base)]
    rows += [(i, f"{passage(50 + i, 20)} {passage(7, 60)} {passage(90 + i, 20)}") for i in range(20)]
    rows += [(5_000 + i, base.replace(f"w1x{i} ", "edit ")) for i in range(1, 6)]
    rows += [(6_000, base.replace(" ", "  ")), (900, passage(3, 49)), (901, passage(3, 49)), (902, None), (903, None), (None, base)]
    rows += [(2_000, "x " * 30), (2_001, "x " * 30)]

    def counted(df, label):
        out = stored(df, label)
        if label == "unit-texts":
            written["bytes"] = sum(len(r.words) for r in out.select("words").collect())
        return out

    stored = substring.stored
    monkeypatch.setattr(substring, "stored", counted)
    df = spark.createDataFrame([(*r, *[None] * 8) for r in rows], DOCS).repartition(4)
    assert result(cut_repeats(df, hot_units=hot_units)) == brute(rows)
    many = written["bytes"]
    few = df.where("doc_id is null or not doc_id between 1002 and 1399")
    assert result(cut_repeats(few, hot_units=hot_units)) == brute([r for r in rows if not 1_002 <= (r[0] or 0) < 1_400])
    assert many == written["bytes"] > 0  # what is written does not depend on the number of copies
    plain = df.where("doc_id between 1000 and 1399")
    assert result(cut_repeats(plain, hot_units=hot_units)) == brute([r for r in rows if r[0] and 1_000 <= r[0] < 1_400])
    assert written["bytes"] == 0


def test_batches_of_units_are_bounded(spark, monkeypatch):
    """A long text under a hot anchor comes out in many small batches."""
    monkeypatch.setattr(substring, "BATCH_BYTES", 2_000)
    rows = [(i, f"{passage(5, 120)} {passage(100 + i, 30)}") for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(cut_repeats(df, hot_units=2)) == brute(rows)


def test_query(spark, sf_dir, texts):
    from __spark_entry__ import queries

    got = sorted(map(tuple, queries()["op2_fm_substring"](spark, sf_dir).collect()))
    want = [(d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in brute(texts.items())]
    assert got == sorted(want)
    assert any(r[2] for r in got)


def test_columns_of_the_result(odd):
    assert cut_repeats(odd).columns == ["doc_id", "row_key", "kept_text", "n_words", "n_removed"]
    assert cut_repeats(odd).where(F.col("n_removed") > F.col("n_words")).count() == 0
