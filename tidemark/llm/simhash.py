"""Near duplicates by SimHash, linked through a Gray-ordered hierarchical index.

Fingerprints are sorted by the rank they have in the Gray code, where neighbours
differ in few bits. Runs of eight neighbours become leaves, runs of four nodes the
nodes above. A node keeps the bits all its fingerprints share, as a mask and a
pattern, so the differences of two nodes on bits both fix are a lower bound for
every pair below them: if there are too many, both groups are left out at once.

The index is built once for each rotation that brings one of ``distance + 1`` parts
of the bits to the top: prints that close have one part in common, and in that
rotation lie under one node. So sorted prints are cut into blocks between nodes, and
a block is compared with itself; blocks meet only where they hold parts of one node,
and only if their roots allow it. What is returned is a spanning forest of the links
found, never the links themselves, and components of the forests are found in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.scratch import materialise

SEED = 42
LEAF = 8
FANOUT = 4
# fingerprints in a block
BLOCK = 8192
# node pairs looked at in one numpy step
STEP = 1 << 16
GRAMS_AT_ONCE = 1 << 15


# --- fingerprints ------------------------------------------------------------


def fingerprint(text: bytes | None, words: int = 3) -> int:
    """64 bits: those set in over half of the hashes of all word shingles."""
    found = text.lower().split() if text else []
    if not found:
        return 0
    if len(found) < words:
        grams, count = iter([b" ".join(found)]), 1
    else:
        shifted = zip(*(found[i:] for i in range(words)))
        grams, count = map(b" ".join, shifted), len(found) - words + 1
    hashed = map(partial(xxhash.xxh64_intdigest, seed=SEED), grams)
    ones = np.zeros(64, np.int64)
    for start in range(0, count, GRAMS_AT_ONCE):
        size = min(GRAMS_AT_ONCE, count - start)
        part = np.fromiter(hashed, "<u8", size)
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3
) -> DataFrame:
    """``id, print`` for every row; the 64 bits are stored as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t, words) for t in batch.column(1).to_pylist()]
            signed = pa.array(np.array(prints, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), signed], ["id", "print"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, print bigint")


# --- index -------------------------------------------------------------------


def gray_rank(bits: Column) -> Column:
    """Place of a bit string in the Gray code: each bit xor all bits above it."""
    rank = bits
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank


class Index:
    """Shared bit patterns over Gray-ordered fingerprints, leaves first."""

    def __init__(self, prints: np.ndarray, height: int):
        self.prints = prints
        starts = np.arange(0, len(prints), LEAF)
        ones = np.bitwise_and.reduceat(prints, starts)
        anys = np.bitwise_or.reduceat(prints, starts)
        self.levels = []
        for _ in range(height):
            self.levels.append((ones, ~(ones ^ anys)))  # pattern, mask of shared bits
            starts = np.arange(0, len(ones), FANOUT)
            ones = np.bitwise_and.reduceat(ones, starts)
            anys = np.bitwise_or.reduceat(anys, starts)

    @staticmethod
    def height(size: int) -> int:
        """Levels until one node is left."""
        nodes, levels = -(-size // LEAF), 1
        while nodes > 1:
            nodes, levels = -(-nodes // FANOUT), levels + 1
        return levels


def _children(a: np.ndarray, b: np.ndarray, fan: int, ends: tuple, same: bool):
    """All pairs of children of node pairs, without places that do not exist."""
    step = np.arange(fan)
    left = np.repeat(a[:, None] * fan + step, fan, axis=1).ravel()
    right = np.tile(b[:, None] * fan + step, (1, fan)).ravel()
    good = (left < ends[0]) & (right < ends[1])
    if same:
        good &= left <= right
    return left[good], right[good]


def close_pairs(
    left: Index, right: Index, distance: int, same: bool
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of fingerprints at most ``distance`` bits apart, in bounded batches."""
    top = len(left.levels) - 1
    zero = np.zeros(1, np.int64)
    todo = [(top, zero, zero)]
    while todo:
        level, a, b = todo.pop()
        if len(a) > STEP:
            half = len(a) // 2
            todo += [(level, a[:half], b[:half]), (level, a[half:], b[half:])]
            continue
        (pattern_a, mask_a), (pattern_b, mask_b) = left.levels[level], right.levels[level]
        apart = (pattern_a[a] ^ pattern_b[b]) & mask_a[a] & mask_b[b]
        near = np.bitwise_count(apart) <= distance
        a, b = a[near], b[near]
        if not len(a):
            continue
        if level:
            below = left.levels[level - 1][0], right.levels[level - 1][0]
            ends = len(below[0]), len(below[1])
            todo.append((level - 1, *_children(a, b, FANOUT, ends, same)))
            continue
        for start in range(0, len(a), STEP // 8):
            part = slice(start, start + STEP // 8)
            ends = len(left.prints), len(right.prints)
            i, j = _children(a[part], b[part], LEAF, ends, same)
            apart = np.bitwise_count(left.prints[i] ^ right.prints[j])
            hit = (apart <= distance) & ((i != j) if same else True)
            if hit.any():
                yield i[hit], j[hit]


def merge(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Give linked places the least label of their component, in place."""
    while True:
        x, y = labels[i], labels[j]
        open_ = x != y
        if not open_.any():
            return
        i, j, x, y = i[open_], j[open_], x[open_], y[open_]
        low = np.minimum(x, y)
        np.minimum.at(labels, np.maximum(x, y), low)
        while True:
            jumped = labels[labels]
            if np.array_equal(jumped, labels):
                break
            labels[:] = jumped


def forest(left: np.ndarray, right: np.ndarray | None, distance: int):
    """Links, as few as keep the components, between the fingerprints of two blocks."""
    same = right is None
    other = left if same else right
    height = Index.height(max(len(left), len(other)))
    first = Index(left, height)
    second = first if same else Index(other, height)
    everything = left if same else np.concatenate([left, other])
    labels = np.arange(len(everything))
    shift = 0 if same else len(left)
    for i, j in close_pairs(first, second, distance, same):
        merge(labels, i, j + shift)
    linked = np.flatnonzero(labels != np.arange(len(labels)))
    return everything[linked], everything[labels[linked]]


def turned(bits: Column, by: int) -> Column:
    """A bit string rotated to the left."""
    return F.shiftleft(bits, by).bitwiseOR(F.shiftrightunsigned(bits, 64 - by))


class _Packer:
    """Cuts a sorted run of ranks into blocks that end where nodes do.

    A node that may go on in another task, the first or last of this one, or that is
    larger than a block, lies in blocks of its own, which carry its number.
    """

    def __init__(self, width: int):
        self.shift = np.uint64(64 - width)
        self.turn = np.empty(0, np.int32)
        self.rank = np.empty(0, np.uint64)
        self.first = True

    def _block(self, first: int, last: int, own: bool) -> dict:
        rank = self.rank[first:last]
        prints = rank ^ (rank >> np.uint64(1))
        ones, anys = np.bitwise_and.reduce(prints), np.bitwise_or.reduce(prints)
        return {
            "turn": int(self.turn[first]),
            "node": int((rank[0] >> self.shift).astype(np.int64)) if own else None,
            "prints": prints.tobytes(),
            "pattern": int(ones.view(np.int64)),
            "mask": int((~(ones ^ anys)).view(np.int64)),
        }

    def add(self, turn: np.ndarray, rank: np.ndarray, last: bool) -> Iterator[dict]:
        """Blocks of what is complete; the node that the input ends in is kept back."""
        self.turn = np.concatenate([self.turn, turn])
        self.rank = np.concatenate([self.rank, rank])
        if not len(self.rank):
            return
        node = self.rank >> self.shift
        opens = (np.diff(node, prepend=~node[:1]) != 0) | (np.diff(self.turn, prepend=-1) != 0)
        edges = np.append(np.flatnonzero(opens), len(node))
        whole = len(edges) - 2  # the last node is not known to be complete
        at = 0
        while at < whole:
            start = edges[at]
            # nodes that fit a block and are of one rotation
            end = int(np.searchsorted(edges, start + BLOCK, "right")) - 1
            end = min(max(end, at + 1), whole)
            same = self.turn[edges[at:end]] == self.turn[start]
            end = at + (len(same) if same.all() else int(same.argmin()))
            if self.first or edges[at + 1] - start > BLOCK:
                end = at + 1
            own = self.first or edges[end] - start > BLOCK
            yield from self._cut(start, edges[end], own)
            self.first, at = False, end
        start = edges[at]
        if last:
            yield from self._cut(start, len(node), True)
            start = len(node)
        elif len(node) - start > 2 * BLOCK:
            # the beginning of a large node
            yield self._block(start, start + BLOCK, True)
            start += BLOCK
        self.turn, self.rank = self.turn[start:], self.rank[start:]

    def _cut(self, start: int, end: int, own: bool) -> Iterator[dict]:
        for first in range(start, end, BLOCK):
            yield self._block(first, min(first + BLOCK, end), own)


def _blocks(prints: DataFrame, distance: int) -> DataFrame:
    """The index: distinct fingerprints in every rotation, Gray-ordered, in blocks.

    A rotation brings one of ``distance + 1`` parts of the bits to the top. Prints
    ``distance`` bits apart have an equal part, so in that rotation they lie under
    one node of the highest level, and only blocks of one node can be partners.
    """
    parts, width = distance + 1, 64 // (distance + 1)
    tasks = max(1, -(-prints.count() * parts // (8 * BLOCK)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(width)
        for batch in batches:
            turn, rank = (batch.column(k).to_numpy() for k in range(2))
            for block in packer.add(turn, rank.view(np.uint64), False):
                yield pa.RecordBatch.from_pylist([block], _BLOCK)
        for block in packer.add(np.empty(0, np.int32), np.empty(0, np.uint64), True):
            yield pa.RecordBatch.from_pylist([block], _BLOCK)

    every = [
        F.struct(F.lit(k).alias("turn"), gray_rank(turned(F.col("print"), k * width)).alias("rank"))
        for k in range(parts)
    ]
    ordered = (
        prints.select(F.inline(F.array(*every)))
        .repartitionByRange(tasks, "turn", "rank")
        .sortWithinPartitions("turn", "rank")
    )
    rows = ordered.mapInArrow(
        pack, "turn int, node bigint, prints binary, pattern bigint, mask bigint"
    )
    return materialise(
        rows.withColumn("block", F.monotonically_increasing_id()), "gray-index"
    )


_BLOCK = pa.schema(
    [
        ("turn", pa.int32()),
        ("node", pa.int64()),
        ("prints", pa.binary()),
        ("pattern", pa.int64()),
        ("mask", pa.int64()),
    ]
)


def _links(blocks: DataFrame, distance: int) -> DataFrame:
    """Forests of the links within blocks, and between blocks of one node, as ``a, b``."""
    width = 64 // (distance + 1)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for turn, *sides in zip(*(column.to_pylist() for column in batch.columns)):
                arrays = [np.frombuffer(side, np.uint64) for side in sides]
                found = forest(arrays[0], arrays[1] if len(arrays) > 1 else None, distance)
                back, ahead = np.uint64(turn * width), np.uint64(64 - turn * width)
                a, b = (x >> back | x << ahead if turn else x for x in found)
                yield pa.RecordBatch.from_pydict({"a": a.view(np.int64), "b": b.view(np.int64)})

    within = blocks.select("turn", "prints").mapInArrow(join, "a bigint, b bigint")
    shared = blocks.where("node IS NOT NULL")
    roots = shared.select("turn", "node", "block", "pattern", "mask")
    low, high = (
        roots.select("turn", "node", *[F.col(c).alias(f"{c}_{k}") for c in ("block", "pattern", "mask")])
        for k in "ab"
    )
    apart = F.col("pattern_a").bitwiseXOR(F.col("pattern_b"))
    apart = F.bit_count(apart.bitwiseAND(F.col("mask_a")).bitwiseAND(F.col("mask_b")))
    pairs = low.join(high, ["turn", "node"]).where(
        (F.col("block_a") < F.col("block_b")) & (apart <= distance)
    )
    pairs = materialise(pairs.select("turn", "block_a", "block_b"), "block-pairs")
    sides = [
        shared.select(F.col("block").alias(f"block_{k}"), F.col("prints").alias(f"prints_{k}"))
        for k in "ab"
    ]
    both = pairs.join(sides[0], "block_a").join(sides[1], "block_b")
    between = both.select("turn", "prints_a", "prints_b").mapInArrow(join, "a bigint, b bigint")
    return within.unionByName(between)


# --- operator ----------------------------------------------------------------


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 3,
    distance: int = 3,
) -> DataFrame:
    """Groups of documents whose fingerprints are linked by ``distance`` bits.

    Returns ``id_col, fingerprint, component_id``: 16 hexadecimal digits and the
    smallest id that can be reached over links, the row's own included. Words are
    runs without ASCII white space, A-Z in lower case; a text with fewer words
    than a shingle is one shingle. Null, empty and blank texts have fingerprint
    zero and are linked like any other. Repeated rows get the same answer; a null
    id is answered but never is a component's id unless all its ids are null. An
    empty table gives an empty result; other columns are not read.
    """
    prints = materialise(fingerprints(docs, id_col, text_col, words), "fingerprints")
    classes = prints.groupBy("print").agg(F.min("id").alias("first"))
    classes = materialise(classes, "fingerprint-classes")
    index = _blocks(classes.select("print"), distance)
    roots = components(_links(index, distance))
    rooted = classes.join(
        roots.withColumnRenamed("node", "print"), "print", "left"
    ).select("print", "first", F.coalesce("root", "print").alias("root"))
    rooted = materialise(rooted, "fingerprint-roots")
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    found = rooted.join(smallest, "root").select("print", "component_id")
    return prints.join(found, "print").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
