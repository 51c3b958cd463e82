"""Packing: ids against the library, cuts against a search over all choices, pieces put together again."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyloom.llm import packing

from .conftest import DOCS, passage

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def own_encoder():
    with open(PATH, encoding="utf-8") as f:
        return packing.WordEncoder(f.read())


def library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


ODD = [
    "", " \t\n", "It's they'RE we'll 'sword ''s \"'s ...'t", "a<|endoftext|>b <|startoftext|>", "x\x1cy\x85z\xa0q",
    "<|EndOfText|> <|ENDOFTEXT|>x",
    "Don't. don't, o'clock; a1. 7. x.. y?! (z). é, ß!", "ΟΔΟΣ Σ ΑΣ. İstanbul ŒUVRE ẞ", "é ä ́ x", "中文 没有。空格？x", "12 3.5 ½² ª\xad​", "😀😀! a‍b c",
    "﻿bom 　 ideographic", "ǅ ɏ Ɏ ɐ", "naïve cooperation's", "a\x00b",
]


def test_ids_equal_the_library(texts, monkeypatch):
    encoder = own_encoder()
    assert encoder.by_word
    some = [*texts.values(), *ODD]
    for _ in range(2):
        got, ends = encoder.encode(some)
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == [library(t) for t in some]
        monkeypatch.setattr(packing, "CACHE", 10)
    assert all((e <= len(x) // 4).all() for e, x in zip(ends, got, strict=True))


def test_sentence_ends(monkeypatch):
    monkeypatch.setattr(packing, "SHORT_SENTENCE", 0)
    ids, ends = own_encoder().encode(["One two. Three (four!) five"])
    parts = ("One two.", "One two. Three (four!)", "One two. Three (four!) five")
    assert ends[0].tolist() == [len(library(x)) for x in parts]


def least_cost(at, penalty, window):
    best = {0: 0.0}
    for i in range(1, len(at)):
        sizes = ((j, at[i] - at[j]) for j in best if at[i] - at[j] <= window)
        best[i] = penalty[i] + min(best[j] + packing.padding(n, window) for j, n in sizes)
    return best[len(at) - 1]


def test_cuts_cost_the_least():
    rng = random.Random(8)
    for _ in range(300):
        window = rng.choice([8, 16, 64])
        at = np.cumsum([0, *(rng.randrange(1, window + 1) for _ in range(rng.randrange(1, 60)))])
        penalty = np.array([0.0, *(rng.choice([0.0, 2.0, 7.0]) for _ in at[1:])])
        cuts = packing.choose_cuts(at, penalty, window)
        assert cuts[0] == 0 and cuts[-1] == len(at) - 1
        sizes = np.diff(at[cuts])
        assert (sizes > 0).all() and (sizes <= window).all()
        cost = sum(packing.padding(int(n), window) for n in sizes) + penalty[cuts[1:]].sum()
        assert cost == least_cost(at.tolist(), penalty.tolist(), window)


def test_cut_places():
    at, penalty = packing.cut_places(np.array([10, 30, 59]), 60)
    assert at.tolist() == [10, 30, 60] and penalty.tolist() == [16, 16, 0]
    at, penalty = packing.cut_places(np.array([], np.int64), 1_000)
    assert at.tolist() == [*range(64, 1_000, 64), 1_000] and penalty[-1] == 0
    assert packing.cut_places(np.array([], np.int64), 1)[0].tolist() == [1]


def check(pieces, want, window, end_id=2):
    """Every document's pieces make up its ids; sequences have no gap and no more than a window."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 4 * p.length > 0
        sequences[p.sequence_id].append((p.offset, p.length))
        docs[p.doc_id].append(p)
    used = []
    for held in sequences.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert at <= window
        used.append(at)
    got = defaultdict(list)
    for doc, held in docs.items():
        held.sort(key=lambda p: (p.sequence_id, p.offset))
        ids, total = b"", None
        for p in held:
            if p.start == 0:
                assert total is None or len(ids) == 4 * total
                if total is not None:
                    got[doc].append(ids)
                ids, total = b"", p.doc_tokens
            assert len(ids) == 4 * p.start and p.doc_tokens == total
            ids += p.ids
        assert len(ids) == 4 * total
        got[doc].append(ids)
    assert sorted((str(d), x) for d, xs in got.items() for x in xs) == sorted(
        (str(d), np.array([*library(t), end_id], "<u4").tobytes()) for d, t in want
    )
    return sum(packing.padding(n, window) for n in used), sum(used)


@pytest.mark.parametrize("window, block", [(4096, 1 << 20), (32, 200), (1, 5)])
def test_odd_rows(spark, odd, none, window, block):
    extra = spark.createDataFrame([(300 + i, t.replace("\x00", "0"), *[None] * 8) for i, t in enumerate(ODD)], DOCS)
    both = odd.where("doc_id is null or doc_id not in (6, 7)" if window == 1 else "true").unionByName(extra)
    want = [(r.doc_id, r.text) for r in both.collect()]
    check(packing.pack(both, PATH, window=window, block_tokens=block).collect(), want, window)
    assert packing.pack(none, PATH).count() == 0


def test_order_by(spark):
    rows = [(i, passage(i, 20 + i), *[None] * 8) for i in range(60)]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    pieces = packing.pack(df, PATH, window=64, order_by=["doc_id"]).collect()
    check(pieces, [(r[0], r[1]) for r in rows], 64)
    order = [p.doc_id for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset))]
    assert order == sorted(order)


def test_other_windows_are_refused(spark, none):
    with pytest.raises(ValueError):
        packing.pack(none, PATH, window=1000)


def test_query(spark, sf_dir, texts, documents):
    from __spark_entry__ import queries

    pieces = packing.pack(documents, PATH).collect()
    padded, filled = check(pieces, texts.items(), 4096)
    assert padded < 0.01 * filled
    rows = queries()["op12_packing"](spark, sf_dir).collect()
    by_place = lambda r: (r.doc_id, r.start)
    assert [tuple(r) for r in sorted(rows, key=by_place)] == [
        (p.doc_id, p.start, p.length, zlib.crc32(p.ids), p.doc_tokens, p.sequence_id, p.offset)
        for p in sorted(pieces, key=by_place)
    ]
