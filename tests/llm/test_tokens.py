"""Token store against the tokenizers library."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tallyloom.llm import tokens
from tallyloom.llm.common import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def encoded(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2]


def test_pieces_equal_the_library(texts):
    with open(PATH, encoding="utf-8") as f:
        own = tokens.PieceEncoder(f.read())
    some = [*texts.values(), "a<|endoftext|>b", "", " \t\t it's x\n\n", "é中文''s"]
    got = [np.frombuffer(x, "<u4").tolist() for x in own.encode([t or "" for t in some])]
    assert got == [encoded(t)[:-1] for t in some]


def test_store(spark, odd, none):
    path = scratch_path(spark, "test-tokens")
    tokens.write_tokens(odd, path, PATH, shard_tokens=500)
    rows = tokens.read_tokens(spark, path).join(tokens.shard_starts(spark, path), ["part", "shard"])
    got = sorted(rows.collect(), key=lambda r: r.base + r.shard_start)
    want = sorted(
        ((r.doc_id, r.text) for r in odd.collect()),
        key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""),
    )
    assert [r.doc_id for r in got] == [d for d, _ in want]
    start = 0
    for r, (_, text) in zip(got, want, strict=True):
        assert np.frombuffer(r.ids, "<u4").tolist() == encoded(text)
        assert r.base + r.shard_start == start
        start += r.n_tokens
    for token in (2, 220, 50255):
        total = sum(r.n for r in tokens.token_counts(spark, path, token).collect())
        assert total == sum(encoded(t).count(token) for _, t in want)
    row = spark.read.parquet(path).orderBy("part", "shard").first().asDict()
    shard = tokens.TokenShard(row)
    assert (shard.access(shard.places(2)) == 2).all()
    empty = scratch_path(spark, "test-tokens")
    tokens.write_tokens(none, empty, PATH)
    assert tokens.read_tokens(spark, empty).count() == 0


def test_query(spark, sf_dir, texts):
    from __spark_entry__ import queries

    got = sorted(map(tuple, queries()["op4_token_store"](spark, sf_dir).collect()))
    want, start = [], 0
    for d, t in sorted(texts.items()):
        ids = encoded(t)
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
