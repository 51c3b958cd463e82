"""Packing of documents into sequences by order-preserving dynamic programming.

The ids of a task's documents stand back to back, in the table's order. A sequence is a window of
that row of ids, so packing is the choice of cuts. Cuts may fall behind a document, behind a
sentence, or inside a very long sentence, and

    cost(i) = penalty(i) + min over cuts j before i of cost(j) + padding(at(i) - at(j))

A window of n ids is padded to the full size unless n is a power of two. The padding to the full
size is ``size - at(i) + at(j)``, so the best j is the one with the least ``cost(j) + at(j)`` among
those at most a window back: the front of a monotone queue. Windows of a power of two have at most
one j per power, found by search. Each cut enters and leaves the queue once.

Nothing is shuffled: a task packs what it reads, in blocks of ``BLOCK_TOKENS`` of which the last
windows go on into the next block, so memory does not follow the size of a task. Cuts inside texts
let a task's last window be filled or be a power of two, so many small tasks pad little more.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import BATCH_BYTES, arrow_binary, read, small_batches

WINDOW = 4096
#: What a cut costs beside padding, in ids: none behind a document.
SENTENCE_CUT = 16.0
INNER_CUT = 64.0
#: Where this many ids go by without a sentence's end, every INNER_STEP of them may be cut.
LONG_SENTENCE = 256
INNER_STEP = 64
#: A sentence of fewer characters counts as one with the next.
SHORT_SENTENCE = 80
#: Ids that are cut at a time, and windows of them that the next block decides anew.
BLOCK_TOKENS = 1 << 20
OPEN_WINDOWS = 8
#: Texts encoded at a time.
SLICE = 64
#: Tokenizer files above this size are refused, as they are broadcast.
MAX_TOKENIZER_BYTES = 64 << 20
#: Words remembered per Python worker, until they are forgotten together.
CACHE = 800_000

PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)

_SPACE = re.compile("[\t-\r ]+")
_SENTENCE = re.compile("[.!?…。！？][\"')\\]}»”’]*(?=[\t-\r ])")
# Characters of which composition changes none, and which hold no white space but the ASCII one.
_PLAIN = re.compile("[\t-\r -~¡-ɏ]*")
_SIGNS_IN_A_ROW = re.compile(r"[.,] (?<=[^\w\s][.,] |_[.,] )")
_MARKS = frozenset(".,;:!?")
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]


class WordEncoder:
    """A word-level tokenizer of the tokenizers library with a memory of words.

    Such a tokenizer composes and lower-cases, drops white space and encodes every match of a
    pattern that crosses no white space; so the ids of what stands between two blanks hold wherever
    it turns up. A new word goes through the library: by its pieces if it has only characters below
    U+0250, else whole. Any other tokenizer encodes whole texts.
    """

    def __init__(self, content: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(content)
        spec = json.loads(content)
        before = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}, {}]
        self.added = [x["content"] for x in spec.get("added_tokens", [])]
        self.by_word = (
            (spec.get("normalizer") or {}).get("normalizers") == _NORMALIZERS
            and before[0].get("pattern") == {"Regex": _PATTERN}
            and before[0].get("behavior") == "Removed"
            and before[0].get("invert") is True
            and before[1:] == [{"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]
            and spec.get("post_processor") is None
            and not any(_SPACE.search(x) for x in self.added)
        )
        self.split = regex.compile(_PATTERN).findall
        self.forget()

    def forget(self) -> None:
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[np.ndarray]]:
        """Per text its ids as little-endian unsigned 32-bit integers, and where its sentences end."""
        out, ends = [], []
        for text in texts:
            if len(self.pieces) + len(self.words) > CACHE:
                self.forget()
            parts = self._sentences(text) if self.by_word else [self._whole(text)]
            out.append(b"".join(parts))
            ends.append(np.cumsum([len(p) for p in parts], dtype=np.int64) >> 2)
        return out, ends

    def _sentences(self, text: str) -> list[bytes]:
        lowered = text.lower()
        if _PLAIN.fullmatch(text) and not any(x in lowered for x in self.added):
            # A point or comma behind no other sign is a piece of its own.
            if not _SIGNS_IN_A_ROW.search(lowered):
                lowered = lowered.replace(". ", " . ").replace(", ", " , ")
            text, split, other = lowered, str.split, self._plain_word
        else:
            split, other = _SPACE.split, self._word
        known, find, out, at = self.pieces.get, _SENTENCE.search, [], 0
        while at < len(text):
            found = find(text, at + SHORT_SENTENCE)
            stop = found.end() if found else len(text)
            out.append(b"".join([known(w) or other(w) for w in split(text[at:stop])]))
            at = stop
        return out

    def _word(self, word: str) -> bytes:
        """Ids of what stands between two blanks, or of nothing."""
        ids = self.words.get(word)
        if ids is None:
            plain = _PLAIN.fullmatch(word) and not any(x in word.lower() for x in self.added)
            ids = self.words[word] = self._plain_word(word.lower()) if plain and word else self._whole(word)
        return ids

    def _plain_word(self, word: str) -> bytes:
        """Ids of a lower-case word of plain characters."""
        if word.isalpha():
            return self._piece(word)
        if word[-1] in _MARKS and word[:-1].isalpha():
            return self._piece(word[:-1]) + self._piece(word[-1])
        ids = self.words.get(word)
        if ids is None:
            ids = self.words[word] = b"".join([self._piece(p) for p in self.split(word)])
        return ids

    def _whole(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            signs = piece if piece.isascii() else piece.encode("utf-8").decode("latin-1").translate(_SIGNS)
            ids = array("I", [t.id for t in self.library.model.tokenize(signs)]).tobytes()
            self.pieces[piece] = ids
        return ids


def _signs() -> dict[int, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + i for i, b in enumerate(rest)}


_SIGNS = _signs()
_loaded: dict[str, WordEncoder] = {}


def _encoder(spark: SparkSession, path: str):
    with open(path, encoding="utf-8") as f:
        content = f.read(MAX_TOKENIZER_BYTES + 1)
    if len(content) > MAX_TOKENIZER_BYTES:
        raise ValueError(f"{path} holds more than {MAX_TOKENIZER_BYTES} characters")
    shared = spark.sparkContext.broadcast(content)
    key = hashlib.sha256(content.encode()).hexdigest()

    def load() -> WordEncoder:
        """One encoder per Python worker, with its memory, for all tasks that the worker runs."""
        if key not in _loaded:
            _loaded.clear()
            _loaded[key] = WordEncoder(shared.value)
        return _loaded[key]

    return load


def padding(n: int, window: int = WINDOW) -> int:
    return 0 if n & (n - 1) == 0 else window - n


def choose_cuts(at: np.ndarray, penalty: np.ndarray, window: int = WINDOW) -> list[int]:
    """Indices of the cuts of least cost, from the first to the last of ``at``.

    ``at`` ascends in steps of at most ``window``; its first and last entry are cuts. The cost is
    the padding of all windows and the penalties of the cuts.
    """
    m = len(at)
    exact, power = [], 1
    while power <= window:
        back = np.searchsorted(at, at - power)
        hit = np.flatnonzero(at[back] == at - power)
        exact.append(np.stack((hit, back[hit]), axis=1))
        power *= 2
    pairs = np.concatenate([*exact, np.empty((0, 2), np.int64)])
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    ends, starts = [*pairs[:, 0].tolist(), m], pairs[:, 1].tolist()
    places, extra = at.tolist(), penalty.tolist()
    cost, came = [0.0] * m, [0] * m
    queue, keys, head, pair = [0], [float(places[0])], 0, 0
    for i in range(1, m):
        here = places[i]
        low = here - window
        while places[queue[head]] < low:
            head += 1
        j, least = queue[head], keys[head] - low
        while ends[pair] == i:
            k = starts[pair]
            if cost[k] < least:
                j, least = k, cost[k]
            pair += 1
        least += extra[i]
        cost[i], came[i] = least, j
        key = least + here
        while len(keys) > head and keys[-1] >= key:
            keys.pop()
            queue.pop()
        queue.append(i)
        keys.append(key)
    chosen = [m - 1]
    while chosen[-1]:
        chosen.append(came[chosen[-1]])
    return chosen[::-1]


def cut_places(ends: np.ndarray, n: int, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Where a document of n ids may be cut, ascending up to n, and the penalties."""
    natural = np.append(ends[ends < n - 1], n)
    gaps = np.diff(natural, prepend=0)
    if not gaps.all():  # a sentence without ids
        natural, gaps = natural[gaps > 0], gaps[gaps > 0]
    penalty = np.full(len(natural), SENTENCE_CUT)
    penalty[-1] = 0.0
    if gaps.max() <= min(LONG_SENTENCE, window):
        return natural, penalty
    wide = np.flatnonzero(gaps > min(LONG_SENTENCE, window))
    step = min(INNER_STEP, window)
    inner = np.concatenate([np.arange(natural[i] - gaps[i] + step, natural[i], step) for i in wide.tolist()])
    at = np.concatenate((natural, inner))
    penalty = np.concatenate((penalty, np.full(len(inner), INNER_CUT)))
    order = np.argsort(at)
    return at[order], penalty[order]


class Packer:
    """Documents of one task, cut block by block."""

    def __init__(self, part: int, window: int = WINDOW, block: int = BLOCK_TOKENS) -> None:
        self.window, self.block = window, block
        self.next_id = part << 40
        self.docs: list[list] = []  # doc_id, ids in all, ids that went before, ids here
        self.tokens: list[np.ndarray] = []
        self.at: list[np.ndarray] = [np.zeros(1, np.int64)]
        self.penalty: list[np.ndarray] = [np.zeros(1)]
        self.size = 0

    def add(self, doc: int | None, tokens: np.ndarray, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        n = len(tokens)
        at, penalty = cut_places(ends, n, self.window)
        self.docs.append([doc, n, 0, n])
        self.tokens.append(tokens)
        self.at.append(at + self.size)
        self.penalty.append(penalty)
        self.size += n
        if self.size >= self.block:
            yield from self._cut(OPEN_WINDOWS)

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            yield from self._cut(0)

    def _cut(self, open_windows: int) -> Iterator[pa.RecordBatch]:
        tokens = np.concatenate(self.tokens)
        at, penalty = np.concatenate(self.at), np.concatenate(self.penalty)
        chosen = at[choose_cuts(at, penalty, self.window)]
        if open_windows:
            chosen = chosen[: max(2, len(chosen) - open_windows)]
        done = int(chosen[-1])
        begin = np.cumsum([0, *(d[3] for d in self.docs)])
        bounds = np.union1d(chosen, begin[begin <= done])
        a, b = bounds[:-1], bounds[1:]
        doc = np.searchsorted(begin, a, "right") - 1
        window = np.searchsorted(chosen, a, "right") - 1
        before = np.array([d[2] for d in self.docs], np.int64)
        total = np.array([d[1] for d in self.docs], np.int64)
        raw = tokens[:done].astype("<u4").tobytes()
        ids = [raw[4 * x : 4 * y] for x, y in zip(a.tolist(), b.tolist(), strict=True)]
        names = [self.docs[i][0] for i in doc.tolist()]
        batch = pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.int64()),
                pa.array(before[doc] + a - begin[doc]),
                pa.array(b - a),
                arrow_binary(ids),
                pa.array(total[doc]),
                pa.array(self.next_id + window),
                pa.array(a - chosen[window]),
            ],
            [field.split()[0] for field in PIECES.split(", ")],
        )
        self.next_id += len(chosen) - 1
        last = int(np.searchsorted(begin, done, "right")) - 1
        rest = self.docs[last:] if done < self.size else []
        if rest:
            gone = done - int(begin[last])
            rest[0] = [rest[0][0], rest[0][1], rest[0][2] + gone, rest[0][3] - gone]
        self.docs, self.tokens = rest, [tokens[done:].copy()]
        keep = at >= done
        self.at, self.penalty = [at[keep] - done], [penalty[keep]]
        self.size -= done
        step = max(1, BATCH_BYTES // (4 * self.window))
        for low in range(0, batch.num_rows, step):
            yield batch.slice(low, step)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 2,
    window: int = WINDOW,
    text: str = "text",
    order_by: list[str] | None = None,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per piece of a document: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    A document is the ids of its text, without special tokens, and ``end_id``; a null or empty text
    is the end id alone. Every id lies in one piece. ``start`` counts the document's ids before the
    piece and ``offset`` the sequence's; ``ids`` are little-endian unsigned 32-bit integers. Sequence
    ids ascend in the order of the documents and are not consecutive between tasks. Documents keep
    the order in which tasks read them; with ``order_by`` they are range-partitioned and sorted
    first. Rows that share a doc_id, and rows without one, are documents of their own. An empty
    table gives no pieces; other columns are not read.
    """
    if window & (window - 1) or window < 1:
        raise ValueError("the window has to be a power of two")
    small_batches(docs.sparkSession)
    load = _encoder(docs.sparkSession, tokenizer_path)
    if order_by:
        docs = docs.repartitionByRange(*order_by).sortWithinPartitions(*order_by, text)
    end = np.array([end_id], np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(TaskContext.get().partitionId(), window, block_tokens)
        for batch in batches:
            for low in range(0, batch.num_rows, SLICE):
                part = batch.slice(low, SLICE)
                found, ends = load().encode([t or "" for t in part.column(1).to_pylist()])
                for doc, ids, stops in zip(part.column(0).to_pylist(), found, ends, strict=True):
                    yield from packer.add(doc, np.concatenate((np.frombuffer(ids, "<u4"), end)), stops)
        yield from packer.close()

    return docs.select("doc_id", F.col(text).alias("text")).mapInArrow(run, PIECES)


def op12_packing(spark, sf_dir):
    import public_tokenizers

    pieces = pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


QUERIES = {"op12_packing": (op12_packing, None)}
