"""License scan: SQL, recall on edited and scattered copies, bands switched off, many templates, odd rows."""

import random

from pyspark.sql import functions as F

from tallyloom.llm import licenses
from tools.check_queries import compare, duck

from .conftest import DOCS, passage


def test_query_matches_sql(spark, sf_dir):
    from __spark_entry__ import oracle_sql, queries

    name = "op10_license_scan"
    assert compare(spark, duck(sf_dir), sf_dir, name, queries()[name], oracle_sql()[name]).startswith("ok")


def test_whole_and_edited_notices(spark):
    rng = random.Random(2)
    rows, want = [], set()
    for i, (name, text) in enumerate(licenses.TEMPLATES):
        for pad in range(9):  # every alignment of the windows
            rows.append((100 * i + pad, f"{passage(i, pad + 3)} {text.upper()}\n {passage(i + 50, 20)}"))
            want.add((100 * i + pad, name))
        words = text.split()
        words[rng.randrange(len(words))] = "changed"
        rows.append((100 * i + 50, " ".join(words)))
        if len(words) > 25:
            want.add((100 * i + 50, name))
    df = spark.createDataFrame([(*r, *[None] * 8) for r in rows], DOCS)
    got = {(r.doc_id, r.template) for r in licenses.scan(df).collect()}
    assert want <= got
    assert {g for g in got if g[0] % 100 == 50 and g[1].endswith("mit-line")} <= want


def test_given_templates_of_middling_length(spark):
    """One word put into the middle: found wherever enough shingles are left."""
    given, rows, want = [], [], set()
    for i in range(28):
        n = 11 + i % 14
        words = [f"t{i}w{j}" for j in range(n + licenses.SHINGLE - 1)]
        given.append((f"t{i}", " ".join(words)))
        for pad in range(8):
            at = len(words) // 2 + pad % 3
            text = " ".join([*words[:at], "changed", *words[at:]])
            rows.append((100 * i + pad, f"{passage(i, pad + 3)} {text} {passage(i + 500, 20)}"))
            if (n - licenses.SHINGLE + 1) / n >= licenses.CONTAINED:
                want.add((100 * i + pad, f"t{i}"))
    df = spark.createDataFrame([(*r, *[None] * 8) for r in rows], DOCS).repartition(4)
    got = {(r.doc_id, r.template) for r in licenses.scan(df, licenses.given_templates(spark, given)).collect()}
    assert len(want) > 100
    assert got == want


def _grams(words):
    """Shingles by brute force; these texts have five words and more."""
    return {tuple(words[i : i + licenses.SHINGLE]) for i in range(len(words) - licenses.SHINGLE + 1)}


def _table(spark, rows):
    return spark.createDataFrame([(*r, *[None] * 8) for r in rows], DOCS).repartition(4)


def _edited(rng, words):
    """Words changed, dropped and put in, until about a fifth of the shingles is lost."""
    out, own = list(words), _grams(words)
    while True:
        at, kind = rng.randrange(len(out)), rng.randrange(3)
        new = list(out)
        new[at : at + (kind < 2)] = [] if kind == 1 else [f"e{rng.randrange(10**6)}"]
        if len(own & _grams(new)) < licenses.CONTAINED * len(own):
            return out
        out = new


SIZES = (1, 2, 3, 5, 7, 8, 9, 12, 15, 16, 17, 24, 31, 32, 48, 64, 100, 176, 400, 1000, 1996)


def _copies(spread):
    rng = random.Random(4)
    given, rows, want = [], [], {}
    for i, n in enumerate(SIZES):
        words = [f"s{i}w{j}" for j in range(n + licenses.SHINGLE - 1)]
        given.append((f"s{i}", " ".join(words)))
        for copy in range(6 if n < 400 else 2):
            if spread:
                # Every shingle in a place of its own: the hardest text for windows.
                places = [f"{' '.join(words[j : j + licenses.SHINGLE])} p{i}c{copy}x{j}" for j in range(n)]
                rng.shuffle(places)
                text = " ".join(places)
            else:
                text = " ".join(_edited(rng, words))
            doc = 10 * i + copy
            rows.append((doc, f"{passage(doc, copy)} {text} {passage(doc + 900, 9)}"))
            held = len(_grams(words) & _grams(rows[-1][1].split()))
            if held >= licenses.CONTAINED * n:
                want[doc, f"s{i}"] = (n, held)
    return given, rows, want


def _found(spark, rows, given):
    got = licenses.scan(_table(spark, rows), licenses.given_templates(spark, given)).collect()
    return {(r.doc_id, r.template): (r.n_template, r.n_shared) for r in got}


def test_edited_copies_of_all_lengths(spark):
    given, rows, want = _copies(spread=False)
    assert len(want) == len(rows)
    assert _found(spark, rows, given) == want


def test_recall_of_scattered_shingles(spark):
    given, rows, want = _copies(spread=True)
    got = _found(spark, rows, given)
    assert len(want) == len(rows)
    assert got.items() <= want.items()
    assert len(got) >= 0.99 * len(want)


def test_nothing_without_bands(spark, monkeypatch):
    """The keys of the windows are the only way to a match of a long template."""
    given, rows, want = _copies(spread=False)
    monkeypatch.setattr(licenses, "_band_keys", lambda *_: F.array().cast("array<bigint>"))
    assert set(_found(spark, rows, given)) == {w for w in want if want[w][0] < licenses.LONG}


def test_thousand_templates_without_broadcast(spark, monkeypatch):
    """Many templates, common shingles among them, and a third of the rows with one notice."""
    monkeypatch.setattr(licenses, "BROADCAST_ROWS", 0)
    shared = "this work may be used by anyone for any purpose"
    given = [(f"t{i}", f"{shared} " + " ".join(f"t{i}w{j}" for j in range(40))) for i in range(1000)]
    rows = [(i, f"{passage(i, 9)} {given[7][1]}") for i in range(60)]
    rows += [(100 + i, f"{given[i][1]} {passage(i, 9)}") for i in range(100)]
    rows += [(300 + i, f"{shared} {passage(i, 30)}") for i in range(20)]
    want = {(i, "t7") for i in range(60)} | {(100 + i, f"t{i}") for i in range(100)}
    assert set(_found(spark, rows, given)) == want


def test_odd_rows(spark, odd, none):
    assert licenses.scan(odd).count() == 0
    assert licenses.scan(none).count() == 0
    two = licenses.given_templates(spark, [("two", "one two"), ("blank", " "), ("null", None), ("two", "x y z")])
    assert {r.template for r in licenses.scan(odd, two).collect()} == {"two"}
    assert {r.doc_id for r in licenses.scan(odd, two).collect()} <= {8, 9}
    assert licenses.scan(odd, two.limit(0)).count() == 0


def test_notices_in_odd_rows(spark):
    name, text = licenses.TEMPLATES[5]
    cut = " ".join(text.split()[:-6])
    very_long = " ".join([passage(1, 200_000), text, passage(2, 200_000)])
    rows = [(None, text), (None, None), (1, ""), (2, text), (2, text), (3, very_long), (4, cut), (4, text), (4, cut)]
    got = licenses.scan(_table(spark, rows).withColumn("template", F.lit("x")).withColumn("__key", F.lit(1))).collect()
    n = len(_grams(text.lower().replace('"', "").split()))
    assert {(r.doc_id, r.template) for r in got} == {(i, name) for i in (None, 2, 3, 4)}
    assert len(got) == 4
    assert all(r.n_shared == r.n_template and r.containment == 1.0 for r in got)
    assert abs(got[0].n_template - n) <= 8


def test_edits_leave_a_run_that_is_certain():
    """The bound of the module's docstring: the longest run left holds a text window whole."""
    for n in range(licenses.LONG, 5000):
        lost = n // 4
        assert -(-(n - lost) // (lost // 4 + 1)) >= licenses.WINDOW + licenses.STEP - 1
