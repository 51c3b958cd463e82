"""Each stage of the corpus pipeline against brute force on its own input."""

import base64

import numpy as np
import pytest

import corpus_pipeline
from tallyloom.llm.common import stored

from . import test_bpe, test_jaccard, test_rules, test_substring


@pytest.fixture(scope="module")
def steps(spark, sf_dir, documents):
    """Input and output of each stage by name."""
    out, docs = {}, documents
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, sf_dir), name)
        out[name] = (docs, after)
        docs = after
    return out


def pairs(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_columns(steps, documents):
    for name, (_, after) in steps.items():
        assert after.columns == documents.columns + (["ids"] if name == "byte_bpe" else [])


def test_quality_rules(spark, sf_dir, steps):
    before, after = steps["quality_rules"]
    kept = {r.doc_id for r in after.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    for r in before.collect():
        n, _, _, _, repeated = test_rules.counts(r.text)
        base = n < 50 or 100 * repeated > 50 * n
        if base or r.doc_id in labels:
            assert (r.doc_id in kept) == (not base and bool(labels.get(r.doc_id, 0)))


def test_near_duplicates(steps):
    before, after = steps["near_duplicates"]
    want = [d for d, _, c in test_jaccard.brute(pairs(before)) if d == c]
    assert sorted(r.doc_id for r in after.collect()) == sorted(want)


def test_substring_dedup(steps):
    before, after = steps["substring_dedup"]
    texts = dict(pairs(before))
    want = {d: (kept if gone else texts[d]) for d, _, gone, kept in test_substring.brute(texts.items())}
    assert dict(pairs(after)) == want
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_mix_sources(steps):
    before, after = steps["mix_sources"]
    texts = dict(pairs(before))
    assert set(pairs(after)) <= set(texts.items())
    assert 0.6 * len(texts) < after.count() < 1.4 * len(texts)


def test_byte_bpe(steps):
    before, after = steps["byte_bpe"]
    assert pairs(before) == pairs(after)
    for r in after.collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == test_bpe.LIBRARY.encode_ordinary(r.text)


def test_byte_bpe_decodes(spark, sf_dir, odd, tmp_path, monkeypatch):
    """A vocabulary in which two bytes share an id loses texts; the stage has to notice."""
    lossy = tmp_path / "lossy.tiktoken"
    lossy.write_bytes(
        b"".join(base64.b64encode(bytes([b])) + b" %d\n" % (b + (b == ord("n"))) for b in range(256))
    )
    monkeypatch.setattr(corpus_pipeline.bpe, "default_ranks", lambda: str(lossy))
    with pytest.raises(Exception, match="ids do not decode to the text of doc_id 12"):
        corpus_pipeline.byte_bpe(spark, odd.where("doc_id = 12"), sf_dir).collect()
    assert corpus_pipeline.byte_bpe(spark, odd.where("doc_id = 1"), sf_dir).count() == 1


def test_odd_rows(spark, sf_dir, odd, none):
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, odd, sf_dir)
        assert set(got.columns) == {*odd.columns, *(["ids"] if name == "byte_bpe" else [])}
        got.collect()
        assert stage(spark, none, sf_dir).count() == 0


def test_run(spark, sf_dir, steps):
    got = corpus_pipeline.run(spark, sf_dir)
    want = steps["byte_bpe"][1]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
