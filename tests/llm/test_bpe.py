"""Byte-level BPE against the tiktoken library."""

import random

import numpy as np
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

import public_tokenizers
from tallyloom.llm import bpe


def _load():
    with open(bpe.default_ranks(), "rb") as f:
        return bpe.Bpe.from_file(f.read())


OWN = _load()
LIBRARY = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=OWN.ranks, special_tokens={}
)
PATTERN = regex.compile(public_tokenizers.PATTERN)


def ids(text):
    return np.frombuffer(OWN.encode(text), "<u4")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab'sltremdv  \n\t é1２!?-«中' ", max_size=40))
def test_pieces_and_ids(text):
    starts = [m.start() for m in PATTERN.finditer(text)]
    assert bpe.piece_starts(text).tolist() == starts
    assert bpe.text_starts(text, leaf=4).tolist() == starts
    assert ids(text).tolist() == LIBRARY.encode_ordinary(text)
    assert OWN.decode(ids(text)) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    text = text.encode("utf-8", "replace").decode()
    assert ids(text).tolist() == LIBRARY.encode_ordinary(text)


@pytest.mark.parametrize("unit", ["a", "ab", "é中", "the", "=-"])
def test_long_pieces(unit):
    rng = random.Random(unit)
    text = unit * 3_000 + "".join(rng.choice("abcdefgh") for _ in range(5_000))
    got = ids(text)
    assert got.tolist() == LIBRARY.encode_ordinary(text)
    assert OWN.decode(got) == text.encode()


def test_every_token_encodes_to_itself():
    plain = bpe.Bpe(dict(OWN.ranks))
    for token, rank in list(OWN.ranks.items())[::7]:
        del plain.ranks[token]  # so that the merges, not the look-up, find it
        parts = plain._merge(token)
        plain.ranks[token] = rank
        assert len(parts) <= 2 or len(token) == 1


def test_frames(odd, none):
    path = bpe.default_ranks()
    got = bpe.decode(bpe.encode(odd, path), path)
    assert set(odd.columns) | {"decoded"} == set(got.columns)
    rows = got.collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert bytes(r.decoded).decode() == (r.text or "")
        assert np.frombuffer(r.ids, "<u4").tolist() == LIBRARY.encode_ordinary(r.text or "")
    assert bpe.decode(bpe.encode(none, path), path).count() == 0


def test_query(spark, sf_dir, texts):
    import hashlib

    from __spark_entry__ import queries

    rows = queries()["op1_byte_bpe"](spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        want = np.array(LIBRARY.encode_ordinary(texts[r.doc_id] or ""), "<u4")
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(want.tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
