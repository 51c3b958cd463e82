"""Quality rules: counts against plain Python, verdicts against the rule on exact quantiles."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import rules

from .conftest import DOCS, passage


def counts(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0d]+", t)
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(triples)
    covered = {j for i, x in enumerate(triples) if often[x] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)),
        len(lines) - len(set(lines)), len(covered),
    )


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@pytest.mark.parametrize("few", [0, 16, 1_000])
def test_counts(spark, odd, monkeypatch, few):
    monkeypatch.setattr(rules, "FEW", few)
    more = [
        "a b c a b c a b c", "a a a a a", "x y z q x y z", "a b", "a b c",
        " ".join(passage(1, 20) for _ in range(30)), "p q r s p q r t p q",
    ]
    extra = spark.createDataFrame([(100 + i, t, *[None] * 8) for i, t in enumerate(more)], DOCS)
    for r in rules.base_counts(odd.unionByName(extra)).collect():
        assert tuple(r[c] for c in NAMES) == counts(r.text), r.text


def test_no_python_in_the_plan(spark, documents):
    judged = rules.judge(documents)
    plans = [rules.base_counts(documents), judged, rules.keep_good(documents)]
    plan = "".join(spark._jvm.PythonSQLUtils.explainString(x._jdf.queryExecution(), "formatted") for x in plans)
    assert not re.search("Python|Arrow|Pandas", plan)


def test_odd_rows(odd, none):
    rows = rules.judge(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.kept in (True, False) and not (r.kept and r.base_failed) for r in rows)
    assert rules.keep_good(odd).columns == odd.columns
    assert rules.judge(none).count() == 0


def test_adaptive_thresholds(spark):
    """One source is full of markup by nature; elsewhere the same share stands out."""
    rows = []
    for i in range(300):
        plain = passage(i, 80)
        rows.append((i, plain, "en", "prose"))
        rows.append((1_000 + i, plain.replace("x", "<>&x"), "en", "markup"))
    rows.append((5_000, passage(900, 80).replace("x", "<>&x"), "en", "prose"))
    rows.append((5_001, passage(901, 80).replace("x", "<>&x"), "en", "small"))
    df = spark.createDataFrame([(*r, *[None] * 6) for r in rows], DOCS)
    kept = {r.doc_id: r.kept for r in rules.judge(df).collect()}
    assert not kept[5_000]
    assert all(kept[i] for i in range(300)) and all(kept[1_000 + i] for i in range(300))


@pytest.mark.parametrize("same", [True, False])
def test_bad_copies_do_not_widen_limits(spark, same):
    """A third of a source are bad copies, and far more than that if they are exact copies."""
    rows = [(i, passage(i, 80), "en", "a") for i in range(600)]
    for i in range(2_000 if same else 300):
        text = passage(700 if same else 1_000 + i, 80 if same else 80 + i % 7)
        rows.append((10_000 + i, text.replace("x", "<>&x"), "en", "a"))
    rows.append((20_000, passage(900, 80).replace("x", "<>x"), "en", "a"))
    df = spark.createDataFrame([(*r, *[None] * 6) for r in rows], DOCS)
    kept = {r.doc_id: r.kept for r in rules.judge(df).collect()}
    assert len(kept) == len(rows)
    assert all(kept[r[0]] == (r[0] < 10_000) for r in rows)


def test_base_failures_do_not_widen_limits(spark):
    """Short and empty texts are left out of the sketches, also where a group has nothing else."""
    rows = [(i, passage(i, 80), "en", "a") for i in range(250)]
    rows += [(10_000 + i, f"word{i} <>&<>&<>&<>&<>&", "en", "a") for i in range(1_000)]
    rows += [(20_000 + i, None if i % 2 else f"s{i}", "de", "b") for i in range(250)]
    rows.append((30_000, passage(900, 80).replace("x", "<>&x"), "en", "a"))
    df = spark.createDataFrame([(*r, *[None] * 6) for r in rows], DOCS)
    kept = {r.doc_id: r.kept for r in rules.judge(df).collect()}
    assert len(kept) == len(rows)
    assert all(kept[r[0]] == (r[0] < 10_000) for r in rows)
    alone = rules.judge(df.where("doc_id between 20000 and 29999")).collect()
    assert len(alone) == 250 and not any(r.kept for r in alone)


def test_query(spark, sf_dir, texts):
    from __spark_entry__ import queries

    rows = queries()["op6_quality_rules"](spark, sf_dir).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        got = counts(texts[r.doc_id])
        assert tuple(r[c] for c in NAMES) == got
        assert r.base_failed == (got[0] < 50 or 100 * got[4] > 50 * got[0])
        assert not (r.base_failed and r.kept)
        if r.doc_id in labels and not r.base_failed:
            assert r.kept == bool(labels[r.doc_id])


def exact_limits(rows, weight=rules.GROUP_DOCS):
    """rows: (lang, source, text). Limits from sorted values in place of sketches."""
    shares = {}
    for lang, source, text in {(g, s, t) for g, s, t in rows}:
        n, chars, symbols, dups, repeats = counts(text)
        if n < 50 or 100 * repeats > 50 * n:
            shares.setdefault((lang, source), [])
            continue
        lines = sum(1 for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0d]", x))
        values = (symbols / chars, dups / (lines + 4), repeats / (n + 50), chars / n)
        shares.setdefault((lang, source), []).append(values)

    def limit(found, i, slack):
        values = sorted(v[i] for v in found)
        low, mid, high = (values[max(0, -(-len(values) * k // 4) - 1)] for k in (1, 2, 3))
        lower = max(mid + 13 * (mid - low), mid + slack)
        return lower if high > lower else max(high + 6 * (high - low), mid + slack)

    out = {}
    for lang, source in shares:
        levels = (
            [v for x in shares.values() for v in x],
            [v for (g, _), x in shares.items() if g == lang for v in x],
            shares[lang, source],
        )
        for i, (name, slack) in enumerate(rules.SLACK.items()):
            value = None
            for found in levels:
                if found:
                    w, own = len(found) / (len(found) + weight), limit(found, i, slack)
                    value = own if value is None else w * own + (1 - w) * value
            out[lang, source, name] = value
    return out


@pytest.mark.parametrize("weight", [20, 1, 500])
def test_limits_equal_those_of_exact_quantiles(documents, odd, weight):
    both = documents.select("doc_id", "text", "lang", "source").unionByName(odd.select("doc_id", "text", "lang", "source"))
    narrow = both.select("doc_id", F.xxhash64("text").alias("row_key"), "text", "lang", "source")
    want = exact_limits([(r.lang, r.source, r.text) for r in both.collect()], weight)
    got = rules.thresholds(rules.base_counts(narrow), group_docs=weight).collect()
    assert {(r.group_lang, r.group_source) for r in got} == {k[:2] for k in want}
    for r in got:
        for name in rules.SLACK:
            assert r["max_" + name] == pytest.approx(want[r.group_lang, r.group_source, name])


def test_verdicts_equal_those_of_exact_quantiles(documents):
    rows = documents.collect()
    limits = exact_limits([(r.lang, r.source, r.text) for r in rows])
    kept = {r.doc_id: r.kept for r in rules.judge(documents).collect()}
    for r in rows:
        n, chars, symbols, dups, repeats = counts(r.text)
        if n < 50 or 100 * repeats > 50 * n:
            assert not kept[r.doc_id]
            continue
        lines = sum(1 for x in r.text.split("\n") if re.search(r"[^\x20\x09-\x0d]", x))
        values = (symbols / chars, dups / (lines + 4), repeats / (n + 50), chars / n)
        within = all(v <= limits[r.lang, r.source, name] for v, name in zip(values, rules.SLACK, strict=True))
        assert kept[r.doc_id] == within


def test_no_jump_with_the_size_of_a_group(spark):
    """Limits of a group move evenly from those of its language to its own."""
    def made(n):
        plain = [(f"p{i} " + passage(i, 80), "en", "prose") for i in range(400)]
        marked = [(passage(1_000 + i, 80).replace("x", "<>&x"), "en", "markup") for i in range(n)]
        df = spark.createDataFrame([(i, t, g, s) for i, (t, g, s) in enumerate(plain + marked)], "doc_id long, text string, lang string, source string")
        narrow = df.select("doc_id", F.xxhash64("text").alias("row_key"), "text", "lang", "source")
        limits = rules.thresholds(rules.base_counts(narrow)).where("group_source = 'markup'").first()
        return limits.max_symbol_share

    sizes = [1, 2, 39, 40, 41, 199, 200, 201]
    limits = dict(zip(sizes, map(made, sizes), strict=True))
    assert limits[1] < 0.1 < limits[40] < limits[200]
    for n in (1, 39, 40, 199, 200):
        assert 0 <= limits[n + 1] - limits[n] < 0.02


def test_sketch_merging_equals_one_sketch(odd):
    counted = rules.base_counts(odd)
    limits = rules.thresholds(counted, group_docs=float("inf"))
    assert limits.select(*[c for c in limits.columns if c.startswith("max_")]).distinct().count() == 1
    assert limits.where(F.col("max_word_length").isNull()).count() == 0
