"""Periodic runs against a search over all periods and stretches."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tallyloom.llm import runs

from .conftest import DOCS, passage


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0d]+", text or "")


def brute(w, min_words=24, min_periods=3):
    """Every stretch that cannot be extended with its period; the smallest period of each stretch."""
    found = {}
    for p in range(1, len(w) // min_periods + 1):
        i = 0
        while i + p < len(w):
            if w[i] != w[i + p]:
                i += 1
                continue
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            length = j + p - i
            if length >= max(min_words, min_periods * p):
                found.setdefault((i, length), p)
            i = j
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def collapse(w, found):
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def own(texts, **kw):
    """Runs per text by the operator's search."""
    first = np.cumsum([0, *map(len, texts)])
    kinds = {}
    codes = np.array([kinds.setdefault(x, len(kinds)) for t in texts for x in t], np.uint64)
    s, n, p = runs.find_runs(codes, first, **kw)
    out = [[] for _ in texts]
    for a, b, c in zip(s.tolist(), n.tolist(), p.tolist(), strict=True):
        t = int(np.searchsorted(first, a, "right")) - 1
        out[t].append((a - int(first[t]), b, c))
    return out


def test_random_texts():
    """Few different words, powers of powers, overlapping runs, texts side by side."""
    rng = random.Random(4)
    for trial in range(300):
        texts = []
        for _ in range(rng.randrange(1, 5)):
            t = [rng.choice("ab" if trial % 2 else "abcdef") for _ in range(rng.randrange(0, 30))]
            for _ in range(rng.randrange(0, 3)):
                unit = [rng.choice("abc") for _ in range(rng.randrange(1, 9))]
                if rng.random() < 0.3:
                    unit = unit * 3 + [rng.choice("abc")]
                t += (unit * 12)[: rng.randrange(len(unit) * 3, len(unit) * 12)]
            texts.append(t)
        assert own(texts) == [brute(t) for t in texts]
        assert own(texts, min_words=6) == [brute(t, 6) for t in texts]
        assert own(texts, min_words=9, min_periods=4) == [brute(t, 9, 4) for t in texts]


def test_fibonacci_words():
    a, b = "a", "ab"
    while len(b) < 800:
        a, b = b, b + a
    assert own([list(b)], min_words=3) == [brute(b, 3)]


def test_long_runs_stay_fast(monkeypatch):
    monkeypatch.setattr(runs, "BLOCK", 64)
    n = 20_000
    assert own([["x"] * n]) == [[(0, n, 1)]]
    period = [f"w{i}" for i in range(700)]
    assert own([["q", *(period * 20), "r"]]) == [[(1, 14_000, 700)]]


def test_too_few_periods_are_refused():
    with pytest.raises(ValueError):
        runs.find_runs(np.zeros(50, np.uint64), np.array([0, 50]), min_periods=2)


def test_odd_rows(spark, odd, none):
    more = [
        "a b c " * 12, "x " * 24, "x " * 23, "one " + "two three " * 30 + "four", passage(1, 30) + " " + "y z " * 40,
        "u v w\n" * 9 + "\t" + "s " * 50,
    ]
    extra = spark.createDataFrame([(200 + i, t, *[None] * 8) for i, t in enumerate(more)], DOCS)
    both = odd.unionByName(extra).withColumnRenamed("ids", "collapsed").withColumnRenamed("n", "runs")
    got = runs.periodic_runs(both)
    assert got.columns == [c for c in both.columns if c not in ("runs", "collapsed")] + ["n_words", "runs", "collapsed"]
    rows = got.collect()
    assert len(rows) == both.count()
    for r in rows:
        w = words_of(r.text)
        found = brute(w)
        assert r.n_words == len(w)
        assert [tuple(x) for x in r.runs] == found
        assert r.collapsed == collapse(w, found)
    assert sum(len(r.runs) for r in rows) >= 6
    assert runs.periodic_runs(none).count() == 0
    assert runs.with_planted_runs(none).count() == 0


def planted(doc_id, text):
    w = words_of(text)
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [*w[:a], *[w[a + (i - a) % p] for i in range(a, n)]]
    return w


def test_planting_of_odd_rows(odd):
    before = sorted((str(r.doc_id), str(words_of(r.text) if r.doc_id is None else planted(r.doc_id, r.text))) for r in odd.collect())
    after = sorted((str(r.doc_id), str(words_of(r.text))) for r in runs.with_planted_runs(odd).collect())
    assert after == before


def test_query(spark, sf_dir, texts):
    from __spark_entry__ import queries

    got = {r.doc_id: tuple(r) for r in queries()["op13_periodic_runs"](spark, sf_dir).collect()}
    assert len(got) == len(texts)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    n_runs = 0
    for d, t in texts.items():
        w = planted(d, t)
        found = brute(w)
        n_runs += len(found)
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in found)
        assert got[d] == (d, len(found), *four, sha(lines), sha(collapse(w, found)))
    assert n_runs > 10
