"""Quality classifier: held-out accuracy, determinism, odd rows."""

import os
import zlib

import numpy as np
import pytest

from tallyloom.llm import gam


def test_fit_finds_effects_and_interactions():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4_000, 4))
    y = ((x[:, 0] * x[:, 1] > 0) | (x[:, 2] > 1)).astype(float)
    model = gam.fit(x[:3_000], y[:3_000])
    right = (model.score(x[3_000:]) >= 0.5) == y[3_000:]
    assert right.mean() > 0.9
    assert (1, 0) in model.pairs


@pytest.mark.parametrize("labels", [[], [1.0], [1.0, 1.0, 1.0], [0.0, 0.0]])
def test_one_label_gives_a_constant(labels):
    model = gam.fit(np.zeros((len(labels), len(gam.FEATURES))), np.array(labels))
    scores = model.score(np.random.default_rng(0).normal(size=(5, len(gam.FEATURES))))
    assert len(set(scores)) == 1 and 0 < scores[0] < 1


def test_odd_rows(spark, odd, none):
    assert np.isfinite(gam.features([r.text for r in odd.collect()])).all()
    labels = spark.createDataFrame(
        [(1, 1), (8, 0), (12, 0), (6, 1), (None, 1), (3, None), (77, 1), (1, 1)], "doc_id long, quality int"
    )
    model = gam.train(odd, labels)
    rows = gam.score(odd, model).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert len({r.score for r in rows if r.doc_id == 2}) == 1
    assert gam.score(none, gam.train(none, labels)).count() == 0


def test_query_on_held_out_labels(spark):
    from __spark_entry__ import queries

    sf_dir = os.environ.get("TEST_GAM_DIR", "/root/testdata/sf0.01")
    rows = queries()["op5_quality_gam"](spark, sf_dir).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert len(held) > 50
    for quality in (0, 1):
        of = [r for r in held if labels[r.doc_id] == quality]
        assert sum(r.predicted == quality for r in of) >= 0.9 * len(of)


def test_the_bound_holds_for_rows(spark, monkeypatch):
    """A labelled doc_id that stands very often brings no more rows than the bound."""
    seen = []
    fit = gam.fit
    monkeypatch.setattr(gam, "fit", lambda x, y: seen.append(len(x)) or fit(x, y))
    rows = [(1, f"text {i % 3} " * 20) for i in range(300)] + [(i, f"word{i} " * 30) for i in range(2, 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 12)], "doc_id long, quality int")
    gam.train(docs, labels, fit_rows=10)
    gam.train(docs, labels)
    assert seen == [10, 310]
