"""Shards of equal bytes from a k-d tree over document metadata.

A node that has to give several shards is split at the weighted median of its widest
dimension; the weight is the size. Medians are found for all nodes of a level at
once by histograms: rows fall into bins of the interval that still holds a node's
median, Spark sums the bins, and the bin that crosses the wanted weight is the next
interval. Rows equal in the dimension are told apart by checksum and then by a hash
of the row, so the split of a group of equal texts is possible where one shard could
not hold it, and happens nowhere else than at a split.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.scratch import materialise

BINS = 1024
# a median may be off by this part of a shard
TOLERANCE = 1 / 2000
OVERHEAD = 16  # bytes a document takes besides its text
_ROW_BITS = 33


@dataclass
class Node:
    """A cell of the tree that becomes ``shards`` shards from ``first`` on."""

    first: int
    shards: int
    split: tuple[str, tuple[int, ...]] | None = None  # dimension, key of the split
    children: list[Node] = field(default_factory=list)

    def leaves(self) -> list[Node]:
        return [x for c in self.children for x in c.leaves()] or [self]


Columns = dict[str, np.ndarray]


def _columns(batch: pa.RecordBatch) -> Columns:
    return {n: c.to_numpy() for n, c in zip(batch.schema.names, batch.columns) if n != "id"}


def _key(dimension: str) -> list[str]:
    """What orders rows along a dimension: its value, then what breaks ties."""
    return [dimension, "checksum", "tie"]


def _below(rows: Columns, dimension: str, key: tuple[int, ...]) -> np.ndarray:
    """Whether rows lie before a key; later parts decide where earlier ones tie."""
    test = np.zeros(len(rows["size"]), bool)
    for column, value in reversed(list(zip(_key(dimension), key))):
        here = rows[column]
        test = (here < value) | ((here == value) & test)
    return test


def _cells(node: Node, rows: Columns) -> np.ndarray:
    """First shard of the leaf that each row falls into."""
    if not node.children:
        return np.full(len(rows["size"]), node.first)
    low, high = (_cells(child, rows) for child in node.children)
    return np.where(_below(rows, *node.split), low, high)


@dataclass
class _Search:
    """Interval of one part of the key that still holds a node's median."""

    node: Node
    dimension: str
    ranges: dict[str, tuple[int, int]]
    wanted: float  # weight that lies before the split
    close: float
    fixed: list[int] = field(default_factory=list)
    before: float = 0.0

    def __post_init__(self):
        self.low, self.high = self.ranges[self.dimension]

    @property
    def column(self) -> str:
        return _key(self.dimension)[len(self.fixed)]

    @property
    def width(self) -> int:
        return -(-(self.high - self.low + 1) // BINS)

    def add(self, cells: np.ndarray, rows: Columns, sums: np.ndarray) -> None:
        """Add the sizes of the rows in the interval to their bins."""
        test = cells == self.node.first
        for column, value in zip(_key(self.dimension), self.fixed):
            test &= rows[column] == value
        here = rows[self.column]
        test &= (here >= self.low) & (here <= self.high)
        bins = (here[test] - self.low) // self.width
        np.add.at(sums, bins, rows["size"][test])

    def narrow(self, sums: dict[int, int]) -> bool:
        """Step into the bin that crosses the wanted weight; true when that is enough."""
        width, found, held = self.width, None, 0
        for number in sorted(sums):
            found, held = number, sums[number]
            if self.before + held >= self.wanted:
                break
            self.before += held
        if found is None:  # a node without rows
            self.node.split = self.dimension, (self.low,)
            return True
        low = self.low + found * width
        crossed = self.before + held < self.wanted  # by rounding: all rows lie before
        if held <= self.close or crossed:
            after = self.before + held - self.wanted < self.wanted - self.before
            edge = low + width if after or crossed else low
            self.node.split = self.dimension, (*self.fixed, edge)
            return True
        if width > 1:
            self.low, self.high = low, low + width - 1
        elif len(self.fixed) < 2:
            self.fixed.append(low)
            self.low, self.high = self.ranges[self.column]
        else:  # one row, or repeats of it
            self.node.split = self.dimension, (*self.fixed, low + 1)
            return True
        return False


def _ranges(rows: DataFrame, root: Node, keys: list[str]) -> dict[int, Row]:
    """Weight and ends of every column of the rows in each cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = _columns(batch)
            cells = _cells(root, held)
            order = np.argsort(cells, kind="stable")
            numbers, starts = np.unique(cells[order], return_index=True)
            if len(numbers):
                out = [numbers, np.add.reduceat(held["size"][order], starts)]
                for key in keys:
                    values = held[key][order]
                    out += [np.minimum.reduceat(values, starts), np.maximum.reduceat(values, starts)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names)

    ends = [f"{end}_{key}" for key in keys for end in ("low", "high")]
    names = ["cell", "size", *ends]
    found = rows.mapInArrow(run, ", ".join(f"{n} bigint" for n in names))
    merged = [(F.min if n.startswith("low_") else F.max)(n).alias(n) for n in ends]
    total = found.groupBy("cell").agg(F.sum("size").alias("size"), *merged)
    return {r["cell"]: r for r in total.collect()}  # a row for each cell


def _histograms(rows: DataFrame, root: Node, searches: list[_Search]) -> list[dict[int, int]]:
    """Weight of every bin that has rows, for each search."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(searches), BINS), np.int64)
        for batch in batches:
            held = _columns(batch)
            cells = _cells(root, held)
            for search, own in zip(searches, sums):
                search.add(cells, held, own)
        search, number = np.nonzero(sums)
        columns = [pa.array(search), pa.array(number), pa.array(sums[search, number])]
        yield pa.RecordBatch.from_arrays(columns, ["search", "bin", "size"])

    found = rows.mapInArrow(run, "search bigint, bin bigint, size bigint")
    total = found.groupBy("search", "bin").agg(F.sum("size").alias("size"))
    sums: list[dict[int, int]] = [{} for _ in searches]
    for r in total.collect():  # at most BINS numbers for each open node
        sums[r["search"]][r["bin"]] = r["size"]
    return sums


def _split_level(rows: DataFrame, root: Node, dims: list[str], scale: dict) -> bool:
    """Split every leaf that has to give several shards; false if there is none."""
    open_ = [n for n in root.leaves() if n.shards > 1]
    if not open_:
        return False
    found = _ranges(rows, root, _keys(dims))
    searches = []
    for node in open_:
        row = found.get(node.first)
        if row is None:
            ranges, weight, widest = dict.fromkeys(_keys(dims), (0, 0)), 0, dims[0]
        else:
            ranges = {c: (row[f"low_{c}"], row[f"high_{c}"]) for c in _keys(dims)}
            weight = row["size"]
            widest = max(dims, key=lambda d: (ranges[d][1] - ranges[d][0]) / scale[d])
        left = node.shards // 2
        close = weight / node.shards * TOLERANCE
        searches.append(_Search(node, widest, ranges, weight * left / node.shards, close))
    while searches:
        sums = _histograms(rows, root, searches)
        searches = [s for s, held in zip(searches, sums) if not s.narrow(held)]
    for node in open_:
        left = node.shards // 2
        node.children = [Node(node.first, left), Node(node.first + left, node.shards - left)]
    return True


def _keys(dims: list[str]) -> list[str]:
    return [*dims, "checksum", "tie"]


def numbered(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """``slot``: place of a row in its group from 0, without a task per group.

    Rows are range-partitioned by group and order; a place is the row's in its
    partition and group plus the group's rows in partitions before it.
    """
    columns = rows.columns
    stamped = (
        rows.repartitionByRange(group, *order)
        .sortWithinPartitions(group, *order)
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_row", _ROW_BITS))
    )
    stored = materialise(stamped, "numbered")
    counts = stored.groupBy(group, "_part").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_row").alias("_first")
    )
    earlier = W.partitionBy(group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(
        F.col(group).alias("_group"),
        F.col("_part").alias("_in"),
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    # bounded: one row per group and partition it reaches into
    return stored.join(
        F.broadcast(starts),
        (F.col(group) == F.col("_group")) & (F.col("_part") == F.col("_in")),
    ).select(*columns, (F.col("_row") + F.col("_shift")).alias("slot"))


def shard(
    docs: DataFrame,
    shards: int = 40,
    dimensions: dict[str, Column] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Shards 0 to ``shards - 1`` of nearly equal bytes.

    Returns one row per row of ``docs``: ``id_col, size`` (UTF-8 bytes and
    ``OVERHEAD``), ``text_crc32, shard, slot`` (gapless from 0 in its shard).
    ``dimensions`` are whole numbers computed from the columns of ``docs``; by
    default the size, the bytes beyond ASCII and the checksum, which are all
    properties of the text, so equal texts share a shard unless a split has to go
    through them. A null text has no bytes, a null dimension is 0, a null id a row
    like others; rows that repeat id and text stay together. Fewer documents than
    shards leave shards empty; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = F.octet_length(text).cast("bigint") + OVERHEAD
    checksum = F.crc32(text)
    if dimensions is None:
        beyond = (F.octet_length(text) - F.char_length(text)).cast("bigint")
        dimensions = {"bytes": size, "beyond_ascii": beyond, "sum": checksum}
    dims = [f"dim_{name}" for name in dimensions]
    rows = docs.select(
        F.col(id_col).alias("id"),
        size.alias("size"),
        checksum.alias("checksum"),
        F.shiftrightunsigned(F.xxhash64(F.col(id_col), text), 1).alias("tie"),
        *[
            F.coalesce(column.cast("bigint"), F.lit(0)).alias(name)
            for name, column in zip(dims, dimensions.values())
        ],
    )
    rows = materialise(rows, "shard-metadata")
    widths = rows.agg(*[(F.max(d) - F.min(d)).alias(d) for d in dims]).first()
    scale = {d: max(1, widths[d] or 0) for d in dims}
    root = Node(0, shards)
    while _split_level(rows, root, dims, scale):
        pass

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = _cells(root, _columns(batch)).astype(np.int32)
            yield batch.append_column("shard", pa.array(cells))

    kept = rows.select("id", "size", "checksum", "tie", *dims)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema)
    placed = kept.mapInArrow(place, f"{schema}, shard int").drop(*dims)
    found = numbered(placed, "shard", "checksum", "tie")
    return found.select(
        F.col("id").alias(id_col),
        "size",
        F.col("checksum").alias("text_crc32"),
        "shard",
        "slot",
    )
