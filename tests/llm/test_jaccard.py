"""Jaccard join against sets of word tuples."""

import random
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import jaccard

from .conftest import DOCS, passage


def word_set(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0d]+", text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute(rows):
    """Documents with size and component; rows that share a doc_id are one document."""
    sets = [(d, word_set(t)) for d, t in rows]
    parent = {d: d for d, _ in sets if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        for x in s:
            holders[x].append(i)
    common = defaultdict(int)
    for held in holders.values():
        for a, b in combinations(held, 2):
            common[a, b] += 1
    for (a, b), c in common.items():
        (da, sa), (db, sb) = sets[a], sets[b]
        if None not in (da, db) and 100 * c >= 75 * (len(sa) + len(sb) - c):
            x, y = sorted((root(da), root(db)))
            parent[y] = x
    return sorted(((d, len(s), None if d is None else root(d)) for d, s in sets), key=str)


def result(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_odd_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert result(jaccard.near_duplicates(odd)) == brute(rows)
    assert jaccard.near_duplicates(none).count() == 0


@pytest.mark.parametrize("tile_rows, bits", [(20_000, 20), (3, 20), (5, 0), (20_000, 6)])
def test_families_and_boilerplate(spark, tile_rows, bits):
    """Families at many distances, one large group of near copies, a passage that all share."""
    rng = random.Random(7)
    rows = []
    for family in range(12):
        base = passage(family, rng.choice([6, 20, 80, 300])).split()
        for _ in range(6):
            words = [w if rng.random() > 0.03 * (family % 4) else f"e{rng.random()}" for w in base]
            rows.append((len(rows), " ".join(words)))
    base = passage(50, 60).split()
    for i in range(60):
        rows.append((len(rows), " ".join([*base[:-2], f"tail{i}", "x"])))
    rows += [(1_000 + i, passage(99, 40) + " " + passage(500 + i, 60)) for i in range(40)]
    rows.append((2_000, rows[5][1].upper()))
    df = spark.createDataFrame([(*r, *[None] * 8) for r in rows], DOCS).repartition(5)
    got = jaccard.near_duplicates(df, sketch_bits=bits, shard_docs=40, tile_rows=tile_rows)
    assert result(got) == brute(rows)


def test_a_common_passage_makes_few_pairs(spark):
    """A tenth of the documents share a passage: pairs of node and hub stay near those of true links."""
    rows = [(i, passage(i, 90)) for i in range(600)]
    rows += [(1_000 + i, passage(5_000, 45) + " " + passage(2_000 + i, 90)) for i in range(60)]
    rows += [(2_000 + i, passage(i, 90) + " tail") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    docs = df.select("doc_id", F.xxhash64("text").alias("row_key"), "text")
    profile = jaccard._profile(docs, 20).cache()
    frequencies = jaccard._frequencies(profile, 20)
    assert frequencies.max() == int(np.floor(16 * np.log2(61)))
    met = jaccard._meet(jaccard._prefixes(docs, spark.sparkContext.broadcast(frequencies), 8).repartition(2, "shard"))
    assert {r.node for r in met.collect()} == {r[0] for r in rows if r[0] < 30 or r[0] >= 2_000}
    assert result(jaccard.near_duplicates(df)) == brute(rows)


def test_exact_threshold(spark):
    """Three quarters link, anything below does not."""
    words = passage(1, 34).split()  # 30 shingles
    rows = [(1, " ".join(words))]
    for i, cut in enumerate((7, 8), 2):  # 23 and 22 of 30 shingles, then padded to 30
        rows.append((i, " ".join(words[: len(words) - cut])))
    df = spark.createDataFrame([(*r, *[None] * 8) for r in rows], DOCS)
    assert result(jaccard.near_duplicates(df)) == brute(rows) == [(1, 30, 1), (2, 23, 1), (3, 22, 1)]


def test_bitmaps_never_hide_a_link():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(1, 700))
        a = np.unique(rng.integers(0, 2**63, n, np.uint64))
        b = np.unique(np.concatenate((a[: int(len(a) * rng.uniform(0.8, 1))], rng.integers(0, 2**63, n // 10, np.uint64))))
        a, b = sorted((a, b), key=len)
        common = len(np.intersect1d(a, b))
        bands = jaccard._Bands()
        bands.place(len(a), jaccard.bitmap(a, jaccard._level(len(a))))
        _, near = bands.place(len(b), jaccard.bitmap(b, jaccard._level(len(b))))
        if 100 * common >= 75 * (len(a) + len(b) - common):
            assert near == [0]


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(60)] + [(100 + rng.randrange(40), 100 + rng.randrange(40)) for _ in range(30)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = dict(map(tuple, jaccard.components(spark.createDataFrame([*edges, (None, 3)], "a long, b long")).collect()))
    assert got == {x: root(x) for x in parent if root(x) != x}


def test_query(spark, sf_dir, texts):
    from __spark_entry__ import queries

    assert result(queries()["op3_jaccard_tiles"](spark, sf_dir)) == brute(texts.items())
