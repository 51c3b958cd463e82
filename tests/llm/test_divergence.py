"""Source audit against dense vectors in plain Python."""

import re
from collections import Counter, defaultdict

import pytest

from tallyloom.llm import divergence

from .conftest import DOCS


def terms(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute(rows, min_docs=30, top=50):
    """rows: (text, lang, source)."""
    df, tf, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source, found = lang or "", source or "", terms(text)
        sources[lang].add(source)
        df[lang].update(set(found))
        tf[lang, source].update(found)
    out = []
    for lang, names in sources.items():
        kept = sorted(t for t, n in df[lang].items() if n >= min_docs)
        v = len(kept)
        counts = {s: [tf[lang, s][t] for t in kept] for s in names}
        share = lambda c: [1 + 1_000_000_000 * (n + 5) // (sum(c) + 5 * v) for n in c]
        p = {s: share(c) for s, c in counts.items()}
        q = share([sum(c) for c in zip(*counts.values(), strict=True)])
        order = lambda found: sorted(found, key=lambda x: (-x[1], x[0].encode()))
        for s in names:
            near = [(o, sum(abs(a - b) for a, b in zip(p[s], p[o], strict=True))) for o in names if o != s]
            own = [(t, a - b) for t, n, a, b in zip(kept, counts[s], p[s], q, strict=True) if n and a > b]
            for part, found in (("pair", order(near)), ("term", order(own)[:top])):
                out += [(lang, s, part, item, value, i) for i, (item, value) in enumerate(found, 1)]
    return sorted(out)


def result(df):
    return sorted(map(tuple, df.collect()))


def rows_of(df):
    return [(r.text, r.lang, r.source) for r in df.collect()]


def test_terms():
    for text in ("", "It's A-Z [a_z] {q}|~ é　É\x7fx 中 \t\n", "a" * 5, "Ü b", "x y"):
        assert [t.decode() for t in divergence.terms(text.encode())] == terms(text)


@pytest.mark.parametrize("min_docs", [1, 2, 30])
def test_odd_rows(odd, none, min_docs):
    got = divergence.audit(odd, min_docs)
    assert dict(got.dtypes)["value"] == "bigint" and dict(got.dtypes)["rank"] == "int"
    assert result(got) == brute(rows_of(odd), min_docs)
    assert divergence.audit(none).count() == 0


@pytest.mark.parametrize("held, cells, side", [(1_000_000, 1 << 20, 256), (5, 8, 2), (40, 1, 1)])
def test_small_blocks(spark, monkeypatch, held, cells, side):
    """Blocks of any size give the same sums: terms in few and in all sources, ties, one lone source."""
    for name, value in (("HELD_TERMS", held), ("CELLS", cells), ("SIDE", side)):
        monkeypatch.setattr(divergence, name, value)
    rows = []
    for i in range(120):
        text = " ".join(f"t{'abcdefgh'[(i * j) % 8]}{'xyz'[j % (1 + i % 3)]}" for j in range(1 + i % 11))
        rows.append((i, text, ["en", "de", None][i % 3], f"s{i % 7}" if i % 5 else None))
    rows += [(900, "one two", "fr", "alone"), (901, "ta ta tb", "en", "s9"), (902, None, "en", "none")]
    df = spark.createDataFrame([(*r, *[None] * 6) for r in rows], DOCS).repartition(3)
    assert result(divergence.audit(df, 4, 3)) == brute([r[1:] for r in rows], 4, 3)


def test_large_counts_stay_exact(spark):
    """Counts whose product with a billion is beyond 64 bits."""
    df = spark.createDataFrame([(3 * 10**12, 7 * 10**12, 10**6)], "count long, total long, n_terms long")
    got = df.select(divergence._share("count", "total").alias("p")).first().p
    assert got == 1 + 10**9 * (3 * 10**12 + 5) // (7 * 10**12 + 5 * 10**6)


def test_query(spark, sf_dir, documents):
    import duckdb
    from __spark_entry__ import oracle_sql, queries

    got = result(queries()["op11_source_divergence"](spark, sf_dir))
    assert got == brute(rows_of(documents))
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    assert got == sorted(duckdb.sql(oracle_sql()["op11_source_divergence"]).fetchall())
