"""Byte-level BPE encoding and decoding by tree reduction.

Encoding is a reduction over a tree: both halves of a piece of text are encoded on their own, and
two neighbours are joined by encoding a window around their boundary again. The window grows on a
side until the outermost token of that side comes out unchanged. Then every pair of neighbouring
tokens in the joined sequence is a pair that encoding leaves as it is, and a sequence with that
property is the encoding of its bytes; tokens outside the window cannot change. The same holds one
level up, where a long text is split by the pattern in halves: only pieces that end within
``LOOKAHEAD`` characters of the boundary can change, and matching from there on falls in step with
the right half at the first common boundary. Decoding concatenates up the same kind of tree.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import arrow_binary, map_batches, read, small_batches

#: The pattern looks at most this far past the end of a match.
LOOKAHEAD = 3
#: Characters of a text, and ids, that one leaf of the tree takes.
LEAF_CHARS = 1 << 18
LEAF_IDS = 1 << 12
#: Bytes of a piece that are merged directly, and merges of windows up to a size that are remembered.
LEAF_BYTES = 6
WINDOW_BYTES = 16
WINDOWS = 100_000
#: Pieces remembered per Python worker; two generations of this size.
CACHE = 300_000
#: Vocabulary files above this size are refused, as they are broadcast.
MAX_VOCABULARY_BYTES = 64 << 20

_LETTER, _NUMBER, _SPACE, _OTHER = 0, 1, 2, 3
_classes: list[np.ndarray] = []


def _class_table() -> np.ndarray:
    """Class of every code point, as the regex library has the pattern's classes."""
    if not _classes:
        import regex

        table = np.full(0x110000, _OTHER, np.uint8)
        points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
            for m in regex.finditer(pattern, points):
                for a, b in ((m.start(), m.end()),):
                    shift = lambda i: i if i < 0xD800 else i + 0x800
                    table[shift(a) : shift(b - 1) + 1] = kind
        # Surrogates are no characters; a run across their gap must not colour it.
        table[0xD800:0xE000] = _OTHER
        _classes.append(table)
    return _classes[0]


def piece_starts(text: str, final: bool = True) -> np.ndarray:
    """Where the pattern's matches start, ascending; every character is in a match.

    The pattern, in words: a contraction after an apostrophe, else a run of letters, of digits or
    of other signs with one blank before it, else white space, of which the last character stays
    with what follows.
    """
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(points)
    if not n:
        return np.empty(0, np.int64)
    kind = _class_table()[points]
    start = np.empty(n, bool)
    start[0] = True
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    blank = points == 32
    runs = np.flatnonzero(start)
    # White-space runs that something follows: the last character is a match of its own ...
    last = runs[1:] - 1
    last = last[kind[last] == _SPACE]
    start[last] = True
    # ... unless it is a blank, which the run behind takes in.
    glued = last[blank[last]]
    start[glued + 1] = False
    # Contractions: a lone apostrophe that starts a match, with the right letters behind it.
    quote = np.flatnonzero((points == 39) & start)
    quote = quote[quote + 1 < n]
    if len(quote):
        padded = np.concatenate((points, [0, 0, 0])).astype(np.uint32)
        one, two = padded[quote + 1], padded[quote + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))
        long |= (one == ord("l")) & (two == ord("l"))
        for found, size in ((quote[short], 2), (quote[long], 3)):
            start[found + 1] = False
            rest = found + size
            rest = rest[rest < n]
            start[rest[kind[rest] == _LETTER]] = True
    # A glued blank whose run is an apostrophe: no contraction, as the match began at the blank.
    return np.flatnonzero(start)


def text_starts(text: str, leaf: int = LEAF_CHARS) -> np.ndarray:
    """``piece_starts`` by halves for long texts."""
    if len(text) <= leaf:
        return piece_starts(text)
    mid = len(text) // 2
    left, right = text_starts(text[:mid], leaf), text_starts(text[mid:], leaf) + mid
    # The first left piece that ends within the lookahead of the boundary starts the window.
    keep = max(0, int(np.searchsorted(left, mid - LOOKAHEAD, "right")) - 1)
    begin, reach = int(left[keep]), 64
    while True:
        stop = min(len(text), mid + reach)
        window = piece_starts(text[begin:stop]) + begin
        stable = window[window <= stop - LOOKAHEAD - 1] if stop < len(text) else window
        stable = stable[:-1] if stop < len(text) else stable  # the last one may still grow
        common = stable[(stable >= mid) & np.isin(stable, right)]
        if len(common):
            at = int(common[0])
            return np.concatenate((left[:keep], window[window < at], right[right >= at]))
        if stop == len(text):
            return np.concatenate((left[:keep], window))
        reach *= 2


class Bpe:
    """Encoder and decoder of one vocabulary of byte strings and ranks."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.tokens: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.windows: dict[bytes, list[bytes]] = {}

    @classmethod
    def from_file(cls, content: bytes) -> Bpe:
        """Lines of a base64 token and its rank."""
        pairs = (line.split() for line in content.splitlines() if line.strip())
        return cls({base64.b64decode(token): int(rank) for token, rank in pairs})

    def _window(self, data: bytes) -> list[bytes]:
        """``_merge``, remembered for short windows. The result is not to be changed."""
        found = self.windows.get(data)
        if found is None:
            found = self._merge(data)
            if len(data) <= WINDOW_BYTES:
                if len(self.windows) >= WINDOWS:
                    self.windows.clear()
                self.windows[data] = found
        return found

    def _merge(self, data: bytes) -> list[bytes]:
        """Lowest rank first, leftmost first."""
        if data in self.ranks:  # every token of the vocabulary encodes to itself
            return [data]
        parts = [data[i : i + 1] for i in range(len(data))]
        if len(parts) > 64:
            return self._merge_queue(parts)
        rank_of = self.ranks.get
        ranks = [rank_of(a + b) for a, b in zip(parts, parts[1:], strict=False)]
        while True:
            best, at = None, -1
            for i, r in enumerate(ranks):
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank_of(parts[at - 1] + parts[at])
            if at < len(ranks):
                ranks[at] = rank_of(parts[at] + parts[at + 1])

    def _merge_queue(self, parts: list[bytes]) -> list[bytes]:
        """The same for many parts: a queue of pairs over a linked list."""
        n = len(parts)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        live: list[bytes | None] = list(parts)
        queue: list[tuple[int, int, bytes]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] >= 0:
                pair = live[i] + live[after[i]]
                if (rank := self.ranks.get(pair)) is not None:
                    heapq.heappush(queue, (rank, i, pair))

        for i in range(n - 1):
            offer(i)
        while queue:
            _, i, pair = heapq.heappop(queue)
            j = after[i] if live[i] is not None else -1
            if j < 0 or live[i] + live[j] != pair:
                continue
            live[i], live[j] = pair, None
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [x for x in live if x is not None]

    def join(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        """The tokens of the concatenated bytes."""
        if not left or not right:
            return left or right
        window = self._window(left[-1] + right[0])
        if len(window) == 2 and window[0] == left[-1]:
            return left + right
        a, b = min(2, len(left)), min(2, len(right))
        while True:
            window = self._window(b"".join(left[-a:] + right[:b]))
            kept_left = a == len(left) or window[0] == left[-a]
            kept_right = b == len(right) or window[-1] == right[b - 1]
            # One token cannot stand for both ends unless it is both sides as they were.
            if kept_left and kept_right:
                return left[: len(left) - a] + window + right[b:]
            if not kept_left:
                a = min(len(left), 2 * a)
            if not kept_right:
                b = min(len(right), 2 * b)

    def _tree(self, data: bytes) -> list[bytes]:
        if len(data) <= LEAF_BYTES:
            return self._window(data)
        half = len(data) // 2
        return self.join(self._tree(data[:half]), self._tree(data[half:]))

    def piece(self, data: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        if (rank := self.ranks.get(data)) is not None:
            return [rank]
        return [self.ranks[t] for t in self._tree(data)]

    def _remember(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = np.array(self.piece(piece.encode("utf-8", "replace")), "<u4").tobytes()
        if len(piece) <= 64:
            if len(self.young) >= CACHE:
                self.old, self.young = self.young, {}
            self.young[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a text, as little-endian unsigned 32-bit integers."""
        starts = text_starts(text).tolist()
        known, remember = self.young.get, self._remember
        return b"".join(
            [
                known(p) or remember(p)
                for p in map(text.__getitem__, map(slice, starts, [*starts[1:], len(text)]))
            ]
        )

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) <= LEAF_IDS:
            return b"".join(map(self.tokens.__getitem__, ids.tolist()))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


_loaded: dict[str, Bpe] = {}


def _cached(key: str, shared) -> Bpe:
    """One vocabulary per Python worker, with its memory, for all tasks that the worker runs.

    A function of the module, so that tasks share the module's state; what a nested function
    refers to is copied into each task.
    """
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Bpe.from_file(shared.value)
    return _loaded[key]


def _vocabulary(df: DataFrame, path: str):
    with open(path, "rb") as f:
        content = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(content) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} holds more than {MAX_VOCABULARY_BYTES} bytes")
    shared = df.sparkSession.sparkContext.broadcast(content)
    key = hashlib.sha256(content).hexdigest()
    return lambda: _cached(key, shared)


def encode(df: DataFrame, ranks_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add a binary column: the ids of each text as little-endian unsigned 32-bit integers.

    A null text counts as empty and gets an empty value. Other columns stay as they are; a column
    that already has the name of ``ids`` is replaced. Repeated rows stay repeated, an empty table
    stays empty, and texts of any length are encoded whole.
    """
    load = _vocabulary(df, ranks_path)
    rest = df.drop(ids)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe, column = load(), batch.column(batch.schema.get_field_index(text))
        out = [bpe.encode(t or "") for t in column.to_pylist()]
        return pa.RecordBatch.from_arrays(
            [*batch.columns, arrow_binary(out)], [*batch.schema.names, ids]
        )

    small_batches(df.sparkSession)
    return map_batches(rest, run, rest.withColumn(ids, F.lit(b"").cast("binary")).schema)


def decode(df: DataFrame, ranks_path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add a binary column: the bytes that the ids stand for. Null ids give empty bytes."""
    load = _vocabulary(df, ranks_path)
    rest = df.drop(decoded)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe, column = load(), batch.column(batch.schema.get_field_index(ids))
        out = [bpe.decode(np.frombuffer(x or b"", "<u4")) for x in column.to_pylist()]
        return pa.RecordBatch.from_arrays(
            [*batch.columns, arrow_binary(out)], [*batch.schema.names, decoded]
        )

    small_batches(df.sparkSession)
    return map_batches(rest, run, rest.withColumn(decoded, F.lit(b"").cast("binary")).schema)


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def round_trip(docs: DataFrame, ranks_path: str) -> DataFrame:
    """Digests of the ids and of what they decode to, per document."""
    both = decode(encode(docs.select("doc_id", "text"), ranks_path).drop("text"), ranks_path)
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op1_byte_bpe(spark, sf_dir):
    return round_trip(read(spark, sf_dir, "documents"), default_ranks())


QUERIES = {"op1_byte_bpe": (op1_byte_bpe, None)}
