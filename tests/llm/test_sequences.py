"""Wavelet matrix and FM-index against plain searches."""

import numpy as np
import pytest

from tallyloom.llm.wavelet import FMIndex, WaveletMatrix


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 1000])
def test_access_rank_select(n):
    rng = np.random.default_rng(n)
    values = rng.integers(0, 37, n).astype(np.uint32)
    matrix = WaveletMatrix.from_bytes(WaveletMatrix.of(values, 6).to_bytes(), n)
    assert (matrix.access(np.arange(n)) == values).all()
    assert (matrix.decode() == values).all()
    for symbol in range(38):
        places = np.flatnonzero(values == symbol)
        assert matrix.count(symbol) == len(places)
        assert (matrix.select(symbol, np.arange(len(places))) == places).all()
    at, symbols = rng.integers(0, n + 1, 200), rng.integers(0, 37, 200)
    want = [(values[:a] == s).sum() for a, s in zip(at, symbols, strict=True)]
    assert (matrix.rank(symbols, at) == want).all()


@pytest.mark.parametrize("depth", [2, 3, 5, 8])
def test_full_matches(depth):
    rng = np.random.default_rng(depth)
    for _ in range(20):
        parts = [rng.integers(1, 4, rng.integers(1, 20)) for _ in range(rng.integers(1, 12))]
        symbols, ends = np.concatenate(parts), np.cumsum([len(p) for p in parts])
        begins = np.concatenate(([0], ends[:-1]))
        index = FMIndex(symbols, ends, depth)
        got = index.full_matches(symbols, begins, ends)
        block_of: dict[tuple, int] = {}
        for b, e in zip(begins, ends, strict=True):
            for i in range(b, e):
                if i + depth > e:
                    assert got[i] == -1
                else:
                    assert block_of.setdefault(tuple(symbols[i : i + depth]), got[i]) == got[i] >= 0
        assert len(set(block_of.values())) == len(block_of)
