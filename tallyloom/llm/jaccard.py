"""N-gram Jaccard join in size-banded tiles, and the classes its links make.

1. Every document becomes a set of 64-bit shingle hashes. Equal sets are one node, the smallest
   doc_id that has the set.
2. Two sets that link share at least one of their first ``n - ceil(0.75 n) + 1`` members in any
   order that all sets are sorted by. The order is by document frequency, then by hash: rare
   shingles come first, so a passage that many documents share stands in few prefixes. Frequencies
   come from a sketch of fixed size, one counter per hash slot, summed over all tasks and broadcast;
   its errors change the work, not the result. As counters are shared evenly, a shingle stands out
   from some 0.04 % of the documents on, however many there are. Prefixes go to shards of their
   hash as packed runs, so a member costs some ten bytes of shuffle.
3. In a shard, the nodes that share a member are cut into chains of sizes that may link, and each
   chain of two and more is sent to the tile of its smallest node. So any two sets that can link
   meet in a tile. Tiles beyond ``tile_rows`` are split into blocks, and
   every two blocks meet.
4. A tile streams its sets' bitmaps by ascending size. A set is compared with the ones not smaller
   than three quarters of it, kept per size band: the bits in which two bitmaps differ bound the
   overlap from above. Sets that chains of such possible links join form a group; most sets that
   share no more than a passage are in no group, and their texts go nowhere.
5. Texts go to the tile of their group. There the same bounds hold, and what passes them is
   intersected exactly, unless a link to the same class in the tile is already known.
6. Links are joined to classes by alternating star contractions, written out at each step.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import Words, arrow_binary, grams, map_batches, mix, read, small_batches, stored
from tallyloom.llm.substring import _pack, _unpack

SHINGLE = 5
#: Sets link when DENOMINATOR * intersection >= NUMERATOR * union.
NUMERATOR, DENOMINATOR = 75, 100
#: Counters of the frequency sketch (2 ** SKETCH_BITS, two bytes each in the broadcast), in blocks.
SKETCH_BITS = 20
SKETCH_BLOCK = 1 << 14
#: Sizes are told apart by factors of this; sizes that may link differ by SIZE_STEPS at most.
SIZE_FACTOR = 1.05
SIZE_STEPS = 7
#: Documents whose prefixes one task of the candidate search takes, about, in so many shards, of which
#: it holds one at a time. A set comes out of every task in which it meets another, so a task with much
#: to read puts out fewer rows.
SHARD_DOCS = 40_000
SHARDS_PER_TASK = 8
#: Pairs of node and hub that a task holds before it puts them out.
HELD_PAIRS = 4_000_000
#: Large hubs up to which their list is broadcast (twelve bytes each); beyond, it is joined by hash.
BROADCAST_HUBS = 1_000_000
#: Sets of a tile beyond which it is split.
TILE_ROWS = 20_000


def shingle_set(codes: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of one document's shingles; all its words as one if they are few."""
    if len(codes) >= k:
        return np.unique(grams(codes, k))
    if not len(codes):
        return np.empty(0, np.uint64)
    return mix(grams(codes, len(codes)) + np.uint64(len(codes)))


def _sets(texts: list[str | None]) -> list[np.ndarray]:
    words = Words(texts, lower=True)
    return [shingle_set(words.codes[a:b]) for a, b in zip(words.first[:-1], words.first[1:], strict=True)]


def least_overlap(n: int | np.ndarray):
    """The least intersection with any set that a set of n members can link to."""
    return -(-n * NUMERATOR // DENOMINATOR)


def _profile(docs: DataFrame, bits: int) -> DataFrame:
    """Per document its set's size, digest and bitmap; per task the counters of its shingles, in blocks."""
    slots = 1 << bits
    size = min(slots, SKETCH_BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(slots, np.int64)
        for batch in batches:
            for low in range(0, batch.num_rows, 128):
                part = batch.slice(low, 128)
                sets = _sets(part.column(2).to_pylist())
                flat = np.concatenate([*sets, np.empty(0, np.uint64)])
                counts += np.bincount((flat & np.uint64(slots - 1)).astype(np.int64), minlength=slots)
                maps = [bitmap(x, _level(len(x))).tobytes() for x in sets]
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()),
                        arrow_binary(digests), arrow_binary(maps), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()),
                    ],
                    names,
                )
        if counts.any():
            blocks = range(slots // size)
            packed = [zlib.compress(counts[i * size : (i + 1) * size].astype("<i8").tobytes(), 1) for i in blocks]
            empty = [pa.nulls(len(packed), kind) for kind in (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*empty, pa.array(blocks, pa.int32()), arrow_binary(packed)], names)

    names = ["doc_id", "row_key", "n", "digest", "bitmap", "block", "counts"]
    schema = "doc_id long, row_key long, n long, digest binary, bitmap binary, block int, counts binary"
    return docs.mapInArrow(run, schema)


def _frequencies(profile: DataFrame, bits: int) -> np.ndarray:
    """Per hash slot how many sets have a member there, in sixteenths of a doubling."""
    slots = 1 << bits
    size = min(slots, SKETCH_BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counts = np.frombuffer(zlib.decompress(packed.as_py()), "<i8")
                sums[block] = sums[block] + counts if block in sums else counts
        if sums:
            steps = [np.floor(16 * np.log2(1.0 + c)).astype("<u2").tobytes() for c in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), arrow_binary(steps)], ["block", "steps"])

    rows = profile.where("block is not null").select("block", "counts").repartition("block")
    out = np.zeros(slots, np.uint16)
    for r in rows.mapInArrow(run, "block int, steps binary").collect():  # one row per block
        out[r.block * size : (r.block + 1) * size] = np.frombuffer(r.steps, "<u2")
    return out


def _prefix(members: np.ndarray, frequencies: np.ndarray) -> np.ndarray:
    """The members that any set of enough overlap shares one of, rarest first."""
    size = len(members) - least_overlap(len(members)) + 1
    slots = (members & np.uint64(len(frequencies) - 1)).astype(np.int64)
    return members[np.argsort(frequencies[slots], kind="stable")[:size]]


def _prefixes(docs: DataFrame, shared_frequencies, shards: int) -> DataFrame:
    """Packed runs of (member, doc_id, size step) per batch and shard."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, frequencies = batch.column(0).to_pylist(), shared_frequencies.value
        seen: set[bytes] = set()
        members, owners, sizes = [], [], []
        sets = _sets(batch.column(2).to_pylist())
        for i in sorted(range(len(ids)), key=ids.__getitem__):  # of equal sets the smallest doc_id
            key = sets[i].tobytes()
            if key and key not in seen:
                seen.add(key)
                members.append(_prefix(sets[i], frequencies))
                owners.append(ids[i])
                sizes.append(int(np.log(len(sets[i])) / np.log(SIZE_FACTOR)))
        lengths = [len(m) for m in members]
        flat = np.concatenate([*members, np.empty(0, np.uint64)])
        owner = np.repeat(np.array(owners, np.int64), lengths)
        size = np.repeat(np.array(sizes, "<u2"), lengths)
        shard = (mix(flat) % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        shard, flat, owner, size = shard[order], flat[order], owner[order], size[order]
        first = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1])))[: len(shard)]
        spans = list(zip(first.tolist(), [*first[1:].tolist(), len(shard)], strict=True)) if len(shard) else []
        base = min(owners, default=0)
        narrow = max(owners, default=0) - base < 1 << 32
        offset = (owner - base).astype("<u4" if narrow else "<u8")
        return pa.RecordBatch.from_arrays(
            [
                pa.array([int(shard[a]) for a, _ in spans], pa.int64()),
                pa.array([base] * len(spans), pa.int64()),
                arrow_binary([flat[a:b].astype("<u8").tobytes() for a, b in spans]),
                arrow_binary([offset[a:b].tobytes() for a, b in spans]),
                arrow_binary([size[a:b].tobytes() for a, b in spans]),
            ],
            ["shard", "base", "members", "offsets", "sizes"],
        )

    return map_batches(docs, run, "shard long, base long, members binary, offsets binary, sizes binary")


def _chains(members: list[np.ndarray], owners: list[np.ndarray], sizes: list[np.ndarray]) -> np.ndarray:
    """Pairs (node, hub) of one shard: holders of a member, cut into chains of sizes that may link."""
    m, o, s = np.concatenate(members), np.concatenate(owners), np.concatenate(sizes).astype(np.int32)
    if not len(m):
        return np.empty((0, 2), np.int64)
    order = np.lexsort((s, m))
    m, o, s = m[order], o[order], s[order]
    fresh = (m[1:] != m[:-1]) | (s[1:] - s[:-1] > SIZE_STEPS)
    start = np.flatnonzero(np.concatenate(([True], fresh)))
    size = np.diff(np.concatenate((start, [len(m)])))
    hub = np.repeat(np.minimum.reduceat(o, start), size)
    kept = np.repeat(size > 1, size)
    return np.unique(np.stack((o[kept], hub[kept]), axis=1), axis=0)


def _meet(runs: DataFrame) -> DataFrame:
    """Every node that shares a member with others of like size, and the smallest of them.

    A task takes one shard after the other, so it holds one of them at a time, and puts a pair out once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, ([], [], [])
        found: list[np.ndarray] = []

        def emit() -> Iterator[pa.RecordBatch]:
            pairs = np.unique(np.concatenate([*found, np.empty((0, 2), np.int64)]), axis=0)
            found.clear()
            for at in range(0, len(pairs), 1 << 16):
                part = pairs[at : at + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[:, 0].copy()), pa.array(part[:, 1].copy())], ["node", "hub"]
                )

        for batch in batches:
            for shard, base, packed, offsets, steps in zip(
                *(batch.column(j).to_pylist() for j in range(5)), strict=True
            ):
                if shard != last and held[0]:
                    found.append(_chains(*held))
                    held = ([], [], [])
                    if sum(map(len, found)) > HELD_PAIRS:
                        yield from emit()
                last = shard
                kind = "<u4" if len(offsets) < len(packed) else "<u8"
                held[0].append(np.frombuffer(packed, "<u8"))
                held[1].append(np.frombuffer(offsets, kind).astype(np.int64) + base)
                held[2].append(np.frombuffer(steps, "<u2"))
        if held[0]:
            found.append(_chains(*held))
        yield from emit()

    return runs.sortWithinPartitions("shard").mapInArrow(run, "node long, hub long")


def _level(n: int) -> int:
    """The size band of a set: sizes from 2**level to below twice that."""
    return max(7, n.bit_length() - 1)


def bitmap(members: np.ndarray, level: int) -> np.ndarray:
    """One bit per hash value of the members, 2 << level bits in all."""
    bits = 2 << level
    flags = np.zeros(bits, np.uint8)
    flags[(members & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little").view("<u8")


def _fold(bits: np.ndarray) -> np.ndarray:
    """The bitmap of the same members in half the bits."""
    half = len(bits) // 2
    return bits[:half] | bits[half:]


class _Band:
    """Sets of one size band, ascending, with their bitmaps."""

    def __init__(self, level: int) -> None:
        self.n = 0
        self.maps = np.zeros((16, (2 << level) // 64), np.uint64)
        self.sizes = np.zeros(16, np.int64)
        self.items: list[int] = []

    def add(self, item: int, n: int, bits: np.ndarray) -> None:
        if self.n == len(self.sizes):
            self.maps = np.concatenate((self.maps, np.zeros_like(self.maps)))
            self.sizes = np.concatenate((self.sizes, np.zeros_like(self.sizes)))
        self.maps[self.n], self.sizes[self.n] = bits, n
        self.items.append(item)
        self.n += 1

    def near(self, n: int, bits: np.ndarray) -> list[int]:
        """Items whose bitmaps leave room for a link with a set of n members, closest first."""
        low = int(np.searchsorted(self.sizes[: self.n], least_overlap(n)))
        sizes = self.sizes[low : self.n]
        apart = np.bitwise_count(self.maps[low : self.n] ^ bits).sum(axis=1, dtype=np.int64)
        most = (sizes + n - apart) // 2
        good = np.flatnonzero(DENOMINATOR * most >= NUMERATOR * (sizes + n - most))
        return [self.items[low + i] for i in good[np.argsort(apart[good], kind="stable")]]


class _Bands:
    """Sets by ascending size: finds the earlier ones that a set may link to."""

    def __init__(self) -> None:
        self.bands: dict[int, _Band] = {}
        self.parent: list[int] = []

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def place(self, n: int, bits: np.ndarray) -> tuple[int, list[int]]:
        """The number of the new set, and earlier sets that may link to it."""
        level, me = _level(n), len(self.parent)
        for old in [x for x in self.bands if x < level - 1]:
            del self.bands[old]
        near = []
        if level in self.bands:
            near += self.bands[level].near(n, bits)
        if level - 1 in self.bands and least_overlap(n) < 1 << level:
            near += self.bands[level - 1].near(n, _fold(bits))
        self.parent.append(me)
        self.bands.setdefault(level, _Band(level)).add(me, n, bits)
        return me, near


class Tile:
    """Sets by ascending size; yields links that join what was apart."""

    def __init__(self) -> None:
        self.bands = _Bands()
        self.nodes: list[int] = []
        self.sets: list[np.ndarray] = []
        self.low = 0

    def add(self, node: int, members: np.ndarray) -> Iterator[tuple[int, int]]:
        n = len(members)
        me, near = self.bands.place(n, bitmap(members, _level(n)))
        while self.low < me and len(self.sets[self.low]) < least_overlap(n):
            self.sets[self.low] = members[:0]  # too small for all that follow
            self.low += 1
        self.nodes.append(node)
        self.sets.append(members)
        for other in near:
            a, b = self.bands.root(other), self.bands.root(me)
            if a == b:
                continue
            common = len(np.intersect1d(self.sets[other], members, assume_unique=True))
            if DENOMINATOR * common >= NUMERATOR * (len(self.sets[other]) + n - common):
                self.bands.parent[b] = a
                yield self.nodes[other], node


def _groups(rows: DataFrame) -> DataFrame:
    """Per tile, the sets that chains of possible links join, and the smallest node of each chain.

    The rows of a tile stand together, by ascending size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, bands, nodes = None, _Bands(), []

        def close() -> list[tuple]:
            chains: dict[int, list[tuple]] = {}
            for i, node in enumerate(nodes):
                chains.setdefault(bands.root(i), []).append(node)
            return [
                (*node, low) for chain in chains.values() if len(chain) > 1
                for low in [min(x[0] for x in chain)] for node in chain
            ]

        def emit(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) or [[], [], [], []]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["node", "row_key", "n", "hub"]
            )

        for batch in batches:
            found = []
            for hub, i, j, node, row_key, n, bits in zip(
                *(batch.column(k).to_pylist() for k in range(7)), strict=True
            ):
                if (hub, i, j) != key:
                    found += close()
                    key, bands, nodes = (hub, i, j), _Bands(), []
                me, near = bands.place(n, np.frombuffer(bits, "<u8"))
                nodes.append((node, row_key, n))
                for other in near:
                    bands.parent[bands.root(other)] = bands.root(me)
            yield emit(found)
        yield emit(close())

    return rows.mapInArrow(run, "node long, row_key long, n long, hub long")


def _blocks(pairs: DataFrame, tile_rows: int) -> DataFrame:
    """Add i and j: a hub with too many nodes becomes a tile per two blocks of its nodes."""
    large = stored(
        pairs.groupBy("hub").agg(F.count("*").alias("rows")).where(F.col("rows") > tile_rows)
        .select("hub", F.ceil(F.col("rows") / tile_rows).cast("int").alias("blocks")),
        "hubs",
    )
    count = large.count()  # at most a row per tile_rows pairs
    if not count:
        return pairs.withColumns({"i": F.lit(0), "j": F.lit(0)})
    # A small list goes to the pairs, so that those of a large hub stay where they are.
    blocks = F.broadcast(large) if count <= BROADCAST_HUBS else large
    blocks_of = F.coalesce("blocks", F.lit(1))
    split = pairs.join(blocks, "hub", "left").select(
        *[F.col(c) for c in pairs.columns],
        F.pmod(F.xxhash64("node"), blocks_of).cast("int").alias("own"),
        F.explode(F.sequence(F.lit(0), blocks_of - 1)).alias("other"),
    )
    return split.select(
        *pairs.columns, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    )


def _tile_links(rows: DataFrame) -> DataFrame:
    """Links of each tile; the rows of a tile stand together, by ascending size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, tile = None, Tile()
        for batch in batches:
            links = []
            keys = list(zip(*(batch.column(j).to_pylist() for j in range(3)), strict=True))
            nodes = batch.column(3).to_pylist()
            for at in range(0, len(keys), 128):
                sets = _sets(_unpack(batch.column(5).slice(at, 128).to_pylist()))
                for i, members in enumerate(sets, at):
                    if keys[i] != key:
                        key, tile = keys[i], Tile()
                    links += tile.add(nodes[i], members)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())],
                ["a", "b"],
            )

    return rows.mapInArrow(run, "a long, b long")


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """Nodes of links (a, b) with the smallest node that links reach: columns node, component.

    Large-star and small-star steps alternate until nothing changes. Each step is written out, so
    the plan stays short and a lost executor costs one step at most. Nulls link nothing.
    """
    edges = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        label,
    )
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct()
        )
        large = stored(large, label)
        lows = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(lows, "a")
            .select(F.inline(F.array(
                F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))
            )))
            .where("a <> b").distinct()
        )
        small = stored(small, label)
        # Done when every node has one edge, and the nodes that edges lead to have none.
        again = small.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").limit(1)
        chained = small.join(small.select(F.col("b").alias("a")).distinct(), "a", "left_semi").limit(1)
        edges = small
        if not again.unionByName(chained.select("a", F.lit(1).cast("long").alias("n"))).take(1):
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def near_duplicates(
    docs: DataFrame,
    sketch_bits: int = SKETCH_BITS,
    shard_docs: int = SHARD_DOCS,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Words are lower-cased (A-Z) runs of anything but ASCII white space; a null or blank text has an
    empty set and links with nothing, so it is its own component. Equal sets link. Rows that share
    a doc_id are one document in the components, whichever their texts. A null doc_id takes part in
    no link and has a null component. An empty table gives an empty result; other columns are not
    read. All links at or above the threshold count; none is capped.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", F.xxhash64("text").alias("row_key"), "text")
    profile = stored(_profile(docs, sketch_bits), "profile")
    sets = profile.where("digest is not null").drop("block", "counts")
    total = sets.count()
    frequencies = spark.sparkContext.broadcast(_frequencies(profile, sketch_bits))
    named = docs.where("doc_id is not null")
    parts = max(4, -(-total // shard_docs))
    runs = _prefixes(named, frequencies, SHARDS_PER_TASK * parts)
    met = _meet(runs.repartition(parts, "shard")).distinct()
    # A set's copies hold the same members, so its first document stands for them everywhere.
    classes = (
        sets.where("doc_id is not null and n > 0").groupBy("digest", "n", "bitmap")
        .agg(F.min("doc_id").alias("node"), F.min_by("row_key", "doc_id").alias("row_key"))
    )
    nodes = classes.select("node", "row_key", "n", "bitmap").distinct()
    pairs = stored(met.join(nodes.select("node").distinct(), "node", "left_semi"), "pairs")
    sketched = (
        _blocks(pairs, tile_rows).join(nodes, "node")
        .select("hub", "i", "j", "node", "row_key", "n", "bitmap")
        .repartition("hub", "i", "j").sortWithinPartitions("hub", "i", "j", "n", "node")
    )
    groups = stored(_groups(sketched).distinct(), "groups")
    placed = (
        _blocks(groups, tile_rows).groupBy(F.col("node").alias("doc_id"), "row_key", "n")
        .agg(F.collect_set(F.struct("hub", "i", "j")).alias("tiles"))
    )
    # By sorted runs, which spill; both sides grow with the data.
    rows = (
        _pack(named).join(placed.hint("merge"), ["doc_id", "row_key"])
        .select("doc_id", "n", "packed", F.explode("tiles").alias("tile"))
        .select("tile.hub", "tile.i", "tile.j", F.col("doc_id").alias("node"), "n", "packed")
    )
    links = _tile_links(
        rows.repartition("hub", "i", "j").sortWithinPartitions("hub", "i", "j", "n", "node")
    )
    reach = components(links)
    return (
        sets.join(classes.select("digest", "node"), "digest", "left")
        .join(reach, "node", "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id")).alias("component_id"),
        )
    )


def op3_jaccard_tiles(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents"))


QUERIES = {"op3_jaccard_tiles": (op3_jaccard_tiles, None)}
