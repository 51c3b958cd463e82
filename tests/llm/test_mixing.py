"""Poisson replication: SQL, rates, determinism."""

import pytest

from tallyloom.llm import mixing
from tools.check_queries import compare, duck

from .conftest import DOCS


def test_query_matches_sql(spark, sf_dir):
    from __spark_entry__ import oracle_sql, queries

    name = "op7_poisson_mix"
    assert compare(spark, duck(sf_dir), sf_dir, name, queries()[name], oracle_sql()[name]).startswith("ok")


def test_rates_and_counts(spark):
    rows = [(i, "t", "en", "big" if i % 10 else "small") for i in range(6_000)]
    df = spark.createDataFrame([(*r, *[None] * 6) for r in rows], DOCS)
    targets = spark.createDataFrame([("big", 1.0), ("small", 3.0)], "source string, weight double")
    rate = {r.mix_source: r.rate for r in mixing.rates(df, targets).collect()}
    assert rate == pytest.approx({"big": 0.25 * 6_000 / 5_400, "small": 0.75 * 6_000 / 600})
    copies = mixing.replicate(df, targets)
    got = {r.source: r["count"] for r in copies.groupBy("source").count().collect()}
    assert got["big"] == pytest.approx(1_500, rel=0.1)
    assert got["small"] == pytest.approx(4_500, rel=0.05)
    again = mixing.replicate(df.repartition(7), targets)
    key = ["doc_id", "copy", "order_key"]
    assert sorted(map(tuple, copies.select(key).collect())) == sorted(map(tuple, again.select(key).collect()))


def test_large_rates_and_missing_sources(spark):
    df = spark.createDataFrame([(1, "t", "en", "a", *[None] * 6), (2, "u", "en", "b", *[None] * 6)], DOCS)
    targets = spark.createDataFrame([("a", 1.0)], "source string, weight double")
    wide = df.unionByName(spark.createDataFrame([(i, "v", "en", "c", *[None] * 6) for i in range(10, 1_010)], DOCS))
    got = {r.source: r["count"] for r in mixing.replicate(wide, targets).groupBy("source").count().collect()}
    assert set(got) == {"a"} and 850 < got["a"] < 1_160


def test_odd_rows(odd, none):
    got = mixing.replicate(odd)
    assert set(got.columns) == {*odd.columns, "order_key"}
    assert got.where("copy < 1").count() == 0
    assert mixing.replicate(none).count() == 0


def test_sql_with_nulls_repeats_and_several_draws(spark, monkeypatch):
    """The SQL over a fixture: null ids and sources, repeated rows, a source of one document at a rate above MOST."""
    import duckdb
    import pandas as pd

    rows = [(i, f"t{i}", "en", "big", 2) for i in range(900)]
    rows += [(900, "rare", "en", "rare", 4), (None, "n", None, None, 1), (None, "n", None, None, 1), (901, "m", "de", None, 1)]
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    power = -1.0  # rare sources weigh most, so that their rates pass MOST
    assert mixing.rates(docs, power=power).agg({"rate": "max"}).first()[0] > mixing.MOST
    frame = pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})
    con = duckdb.connect()
    con.register("documents", frame)
    sql = mixing.SQL.replace(f", {mixing.POWER}) weight", f", {power}) weight")
    want = con.execute(f"select doc_id, source, copy, order_key from ({sql})").fetchall()
    got = mixing.replicate(docs, power=power).select("doc_id", "source", "copy", "order_key").collect()
    assert len(want) > 300
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
