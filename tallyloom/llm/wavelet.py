"""Wavelet matrix and FM-index over integer sequences, as numpy arrays.

A wavelet matrix keeps a sequence of b-bit symbols as b bit-planes. Plane 0 holds the top bit
of every symbol in order; each later plane holds the next bit after a stable partition of the
symbols by the bit before. With counts of ones per 64 bits, access, rank and select take one
step per plane, and all of them work on whole arrays of positions at once.
"""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)


class BitPlane:
    """A bit vector with constant-time rank; select searches the counts."""

    def __init__(self, words: np.ndarray, n: int) -> None:
        self.words, self.n = words, n
        self.before = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.bitwise_count(words), out=self.before[1:])
        self.ones = int(self.before[-1])

    @classmethod
    def of(cls, bits: np.ndarray) -> BitPlane:
        packed = np.packbits(bits, bitorder="little")
        size = len(bits) // 64 + 1
        padded = np.zeros(size * 8, np.uint8)
        padded[: len(packed)] = packed
        return cls(padded.view("<u8"), len(bits))

    def bits(self) -> np.ndarray:
        return np.unpackbits(self.words.view(np.uint8), count=self.n, bitorder="little").view(bool)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & _ONE

    def rank1(self, at: np.ndarray) -> np.ndarray:
        """Ones in [0, at)."""
        block = at >> 6
        mask = (_ONE << (at & 63).astype(np.uint64)) - _ONE
        return self.before[block] + np.bitwise_count(self.words[block] & mask)

    def select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Position of the k-th (from 0) one or zero."""
        counts = self.before if one else np.arange(len(self.before)) * 64 - self.before
        block = np.searchsorted(counts, k, "right") - 1
        left = k - counts[block]
        words = self.words[block] if one else ~self.words[block]
        # Halve the word until the bit is found.
        at = np.zeros_like(block)
        for width in (32, 16, 8, 4, 2, 1):
            low = words & np.uint64((1 << width) - 1)
            count = np.bitwise_count(low).astype(np.int64)
            up = left >= count
            left = np.where(up, left - count, left)
            at += np.where(up, width, 0)
            words = np.where(up, words >> np.uint64(width), low)
        return block * 64 + at


class WaveletMatrix:
    def __init__(self, planes: list[BitPlane], n: int) -> None:
        self.planes, self.n = planes, n
        self.zeros = [n - p.ones for p in planes]

    @classmethod
    def of(cls, values: np.ndarray, bits: int) -> WaveletMatrix:
        planes, now = [], np.asarray(values)
        for level in range(bits - 1, -1, -1):
            bit = (now & now.dtype.type(1 << level)) != 0
            planes.append(BitPlane.of(bit))
            now = np.concatenate((now.take(np.flatnonzero(~bit)), now.take(np.flatnonzero(bit))))
        return cls(planes, len(values))

    def access(self, at: np.ndarray) -> np.ndarray:
        """Symbols at the positions."""
        at = np.asarray(at, np.int64).copy()
        out = np.zeros(len(at), np.int64)
        for plane, zeros in zip(self.planes, self.zeros, strict=True):
            bit = plane.get(at).astype(bool)
            ones = plane.rank1(at)
            out = out * 2 + bit
            at = np.where(bit, zeros + ones, at - ones)
        return out

    def decode(self) -> np.ndarray:
        """The whole sequence, plane by plane from the last: no random access."""
        out = np.zeros(self.n, np.uint32)
        for level, plane in enumerate(reversed(self.planes)):
            bit, back = plane.bits(), np.empty(self.n, np.uint32)
            zeros = self.n - plane.ones
            back[np.flatnonzero(~bit)] = out[:zeros]
            back[np.flatnonzero(bit)] = out[zeros:] | np.uint32(1 << level)
            out = back
        return out

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol in [0, at); equals the position below minus the symbol's start."""
        low, at = np.zeros(len(symbol), np.int64), np.asarray(at, np.int64).copy()
        for level, (plane, zeros) in enumerate(zip(self.planes, self.zeros, strict=True)):
            bit = ((symbol >> (len(self.planes) - 1 - level)) & 1).astype(bool)
            low1, at1 = plane.rank1(low), plane.rank1(at)
            low = np.where(bit, zeros + low1, low - low1)
            at = np.where(bit, zeros + at1, at - at1)
        return at - low

    def narrow(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Where the occurrences of each symbol in [low, high) lie in the fully sorted order."""
        low, high = low.copy(), high.copy()
        for level, (plane, zeros) in enumerate(zip(self.planes, self.zeros, strict=True)):
            bit = ((symbol >> (len(self.planes) - 1 - level)) & 1).astype(bool)
            low1, high1 = plane.rank1(low), plane.rank1(high)
            low = np.where(bit, zeros + low1, low - low1)
            high = np.where(bit, zeros + high1, high - high1)
        return low, high

    def select(self, symbol: int, k: np.ndarray) -> np.ndarray:
        """Positions of the k-th (from 0) occurrences of one symbol."""
        low = np.zeros(1, np.int64)
        path = []
        for level, (plane, zeros) in enumerate(zip(self.planes, self.zeros, strict=True)):
            bit = bool((symbol >> (len(self.planes) - 1 - level)) & 1)
            ones = plane.rank1(low)
            low = zeros + ones if bit else low - ones
            path.append(bit)
        at = low[0] + np.asarray(k, np.int64)
        for plane, zeros, bit in zip(self.planes[::-1], self.zeros[::-1], path[::-1], strict=True):
            at = plane.select(at - zeros if bit else at, bit)
        return at

    def count(self, symbol: int) -> int:
        return int(self.rank(np.array([symbol]), np.array([self.n]))[0])

    def to_bytes(self) -> list[bytes]:
        return [p.words.astype("<u8").tobytes() for p in self.planes]

    @classmethod
    def from_bytes(cls, planes: list[bytes], n: int) -> WaveletMatrix:
        return cls([BitPlane(np.frombuffer(p, "<u8"), n) for p in planes], n)


class FMIndex:
    """Backward search over a collection of integer sequences.

    Suffixes are sorted by their first ``depth`` symbols, which is enough for patterns up to
    that length. Every sequence ends with a symbol of its own class, 0, that no pattern holds.
    """

    def __init__(self, sequences: np.ndarray, ends: np.ndarray, depth: int) -> None:
        """sequences: symbols from 1 up, back to back; ends: where each sequence stops."""
        n = len(sequences) + len(ends)
        text = np.zeros(n, np.int64)
        gap = np.searchsorted(ends, np.arange(len(sequences)), "right")
        self.place = np.arange(len(sequences)) + gap  # of each symbol in the text
        text[self.place] = sequences
        self.n, self.depth = n, depth
        rank, span = text.copy(), 1
        tail = np.zeros(1, np.int64)
        while True:  # prefix doubling, as far as the depth
            reach = min(span, depth - span)
            if reach <= 0:
                break
            nxt = np.concatenate((rank[reach:], np.repeat(tail, reach)))[:n]
            key = rank * (int(rank.max()) + 1) + nxt
            order = np.argsort(key, kind="stable")
            sorted_key = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.concatenate(([0], sorted_key[1:] != sorted_key[:-1])))
            span += reach
        self.order = np.argsort(rank, kind="stable")
        ranked = rank[self.order]
        fresh = np.concatenate(([True], ranked[1:] != ranked[:-1]))
        starts = np.flatnonzero(fresh)
        #: For each row, the block of suffixes that share its first ``depth`` symbols.
        self.block = np.cumsum(fresh) - 1
        self.block_start = starts
        bits = max(1, int(text.max()).bit_length())
        self.bwt = WaveletMatrix.of(text[self.order - 1].astype(np.uint32), bits)
        symbols, counts = np.unique(text, return_counts=True)
        self.less = np.zeros(int(text.max()) + 2, np.int64)
        self.less[symbols + 1] = counts
        self.less = np.cumsum(self.less)
        # Start of each symbol in the fully sorted order of the wavelet matrix (bit-reversed).
        self.base, _ = self.bwt.narrow(
            np.arange(int(text.max()) + 1), np.zeros(int(text.max()) + 1, np.int64),
            np.zeros(int(text.max()) + 1, np.int64),
        )
        # Blocks of suffixes that share depth - 1 symbols, to widen a full match before a step.
        shorter = self._shared(text, depth - 1)
        self.short_start = np.maximum.accumulate(np.where(shorter, np.arange(n), 0))
        bounds = np.concatenate((np.flatnonzero(shorter), [n]))
        self.short_end = bounds[np.searchsorted(bounds, np.arange(n), "right")]

    def _shared(self, text: np.ndarray, length: int) -> np.ndarray:
        """Rows whose first ``length`` symbols differ from the row above."""
        fresh = np.concatenate(([True], self.block[1:] != self.block[:-1]))
        rows = np.flatnonzero(fresh)[1:]
        a, b = self.order[rows - 1], self.order[rows]
        same = np.ones(len(rows), bool)
        padded = np.concatenate((text, np.zeros(length + 1, np.int64)))
        for j in range(length):
            live = np.flatnonzero(same)
            if not len(live):
                break
            same[live] = padded[a[live] + j] == padded[b[live] + j]
        out = np.zeros(self.n, bool)
        out[0] = True
        out[rows[~same]] = True
        return out

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray):
        """One step of backward search: rows whose suffix is the symbol and then the match."""
        low, high = self.bwt.narrow(symbol, low, high)
        shift = self.less[symbol] - self.base[symbol]
        return low + shift, high + shift

    def full_matches(self, sequences: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """For each position of streamed sequences, the block of the depth-long match that starts there.

        Matching statistics, capped at the depth: each step goes one symbol to the left; a match of
        full length first gives up its last symbol. The sequences must be ones that the index holds,
        so a step never fails. -1: fewer than ``depth`` symbols are left.
        """
        out = np.full(len(sequences), -1, np.int64)
        order = np.argsort(begins - ends, kind="stable")  # longest first
        begins, ends = begins[order], ends[order]
        size = ends - begins
        low, high = np.zeros(len(begins), np.int64), np.full(len(begins), self.n, np.int64)
        longest = int(size[0]) if len(size) else 0
        for step in range(1, longest + 1):
            live = int(np.searchsorted(-size, -step, "right"))
            lo, hi = low[:live], high[:live]
            if step > self.depth:
                hi = self.short_end[lo]
                lo = self.short_start[lo]
            at = ends[:live] - step
            lo, hi = self.extend(sequences[at], lo, hi)
            low[:live], high[:live] = lo, hi
            if step >= self.depth:
                out[at] = self.block[lo]
        return out
