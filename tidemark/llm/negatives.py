"""Hard negatives: rows of another label that score a little below a true match.

Scores are integer inner products. Every row stores its norm and its angles to a few
reference directions. For a reference r, the angle between an anchor and a row lies
between the difference and the sum of their angles to r; its cosine, times the
norms, bounds their score. Rows are stored by label, nearest reference and angle and
read in windows of neighbours; a window is scored for those anchors alone whose
bounds against it reach the scores that are wanted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.scratch import materialise

SCALE = 256
# reference directions, spread over a sample of this many rows
REFERENCES, SAMPLE = 16, 1024
# neighbouring rows whose scores are bounded together
WINDOW = 256
# bytes of anchors' components that one pass over the rows takes, and of scores that
# are held at once
ANCHOR_BYTES = 4 << 20
SCORES = 1 << 22
# components must be smaller, so that products of 128 of them fit a long
LARGEST = 1 << 20
# what the rounding of an angle, and of a bound, may come to
ANGLE_SLACK, SCORE_SLACK = 1e-7, 1.0


# --- stored rows -------------------------------------------------------------


def _rows(vectors: DataFrame, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """``id, label, q``: the rows that take part, one an id, in whole numbers."""
    good = F.forall(vector_col, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < LARGEST))
    whole = F.transform(vector_col, lambda x: F.floor(x.cast("double") * SCALE).cast("int"))
    return (
        vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & good)
        .select(
            F.col(id_col).alias("id"),
            F.struct(F.col(label_col).alias("label"), whole.alias("q")).alias("row"),
        )
        .groupBy("id")
        .agg(F.min("row").alias("row"))
        .select("id", "row.label", "row.q")
    )


def matrix(lists: pa.Array) -> np.ndarray:
    """Lists of numbers as rows of doubles, shorter ones filled up with zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    values = lists.flatten().to_numpy(zero_copy_only=False)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    if not len(sizes):
        return np.zeros((0, 0))
    out = np.zeros((len(sizes), sizes.max()))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, whether or not doubles can hold them."""
    width = min(left.shape[1], right.shape[1])
    left, right = left[:, :width], right[:, :width]
    most = np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * width
    if most < 2**53:
        return (left @ right.T).astype(np.int64)
    return left.astype(np.int64) @ right.astype(np.int64).T


def directions(sample: np.ndarray, wanted: int) -> np.ndarray:
    """Unit vectors far from each other: each next one is the least alike so far."""
    norms = np.linalg.norm(sample, axis=1)
    units = sample[norms > 0] / norms[norms > 0, None]
    if not len(units):
        return np.zeros((0, sample.shape[1]))
    chosen = [0]
    nearest = units @ units[0]
    while len(chosen) < min(wanted, len(units)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, units @ units[chosen[-1]])
    return units[chosen]


def angles(rows: np.ndarray, norms: np.ndarray, references: np.ndarray) -> np.ndarray:
    width = min(rows.shape[1], references.shape[1])
    length = np.where(norms > 0, norms, 1.0)[:, None]
    return np.arccos(np.clip(rows[:, :width] @ references[:, :width].T / length, -1.0, 1.0))


def _stored(rows: DataFrame) -> DataFrame:
    """``id, label, q, norm, angles`` with neighbours side by side in each file.

    The range's last key is the id, so that no label and no direction that a third
    of the rows have keeps them in one task.
    """
    rows = materialise(rows, "vectors")
    drawn = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("q").toArrow()
    references = directions(matrix(drawn.column("q")), REFERENCES)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = matrix(batch.column(2))
            norms = np.linalg.norm(values, axis=1)
            turned = angles(values, norms, references)
            near = turned.argmin(axis=1) if turned.size else np.zeros(len(values), int)
            least = turned.min(axis=1, initial=np.pi)
            width = len(references)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(norms, pa.float64()),
                    pa.ListArray.from_arrays(
                        np.arange(0, width * len(values) + 1, max(width, 1), np.int32)
                        if width
                        else np.zeros(len(values) + 1, np.int32),
                        pa.array(turned.ravel(), pa.float64()),
                    ),
                    pa.array(near, pa.int32()),
                    pa.array(least, pa.float64()),
                ],
                ["id", "label", "q", "norm", "angles", "near", "least"],
            )

    with_angles = rows.mapInArrow(
        run,
        f"id {kinds['id']}, label {kinds['label']}, q array<int>, norm double, "
        "angles array<double>, near int, least double",
    )
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["label", "near", "least", "id"]
    return materialise(
        with_angles.repartitionByRange(tasks, *order).sortWithinPartitions(*order), "angles"
    )


# --- one pass ----------------------------------------------------------------


@dataclass
class Anchors:
    """The anchors of one pass, a row each."""

    ids: np.ndarray
    labels: np.ndarray
    values: np.ndarray
    norms: np.ndarray
    angles: np.ndarray

    @classmethod
    def of(cls, table: pa.Table | pa.RecordBatch) -> Anchors:
        plain = {name: table.column(name) for name in ("id", "label", "norm")}
        ids, labels, norms = (x.to_numpy(zero_copy_only=False) for x in plain.values())
        values, turned = matrix(table.column("q")), matrix(table.column("angles"))
        return cls(ids, labels, values, norms, turned)

    def part(self, first: int, last: int) -> Anchors:
        return Anchors(*(getattr(self, name)[first:last] for name in self.__dataclass_fields__))


def bounds(anchors: Anchors, window: Anchors) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score each anchor can have in a window, rounded outwards."""
    low, high = window.angles.min(axis=0), window.angles.max(axis=0)
    a = anchors.angles
    apart = np.maximum(0.0, np.maximum(a - high, low - a)).max(axis=1, initial=0.0)
    # a sum beyond half a turn leads back towards the anchor from the other side
    first, last = a + low, a + high
    reach = np.where(last <= np.pi, last, np.where(first >= np.pi, 2 * np.pi - first, np.pi))
    reach = reach.min(axis=1, initial=np.pi)
    near = np.cos(np.maximum(apart - ANGLE_SLACK, 0.0))
    far = np.cos(np.minimum(reach + ANGLE_SLACK, np.pi))
    small, large = window.norms.min(), window.norms.max()
    most = anchors.norms * np.where(near > 0, near * large, near * small)
    least = anchors.norms * np.where(far > 0, far * small, far * large)
    slack = SCORE_SLACK + 1e-9 * anchors.norms * large
    return least - slack, most + slack


class Best:
    """The ``k`` highest scores of every search so far; ties by the smaller id."""

    def __init__(self, searches: int, k: int):
        self.k = k
        self.held = [np.zeros(0, np.int64)] * 3  # search, score, id
        self.new: list[tuple[np.ndarray, ...]] = []
        self.waiting = 0
        # what a newcomer has to beat
        self.score = np.full(searches, np.iinfo(np.int64).min)
        self.id = np.full(searches, np.iinfo(np.int64).max)

    def add(self, search: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        self.new.append((search, score, ids))
        self.waiting += len(search)
        if self.waiting > 2 * self.k * len(self.score):
            self.settle()

    def settle(self) -> None:
        parts = [self.held, *self.new]
        search, score, ids = (np.concatenate([p[i] for p in parts]) for i in range(3))
        order = np.lexsort((ids, -score, search))
        search, score, ids = search[order], score[order], ids[order]
        start = np.searchsorted(search, search)
        place = np.arange(len(search)) - start
        kept = place < self.k
        self.held = [search[kept], score[kept], ids[kept]]
        last = place == self.k - 1
        self.score[search[last]], self.id[search[last]] = score[last], ids[last]
        self.new, self.waiting = [], 0


def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[Anchors]:
    for batch in batches:
        for first in range(0, batch.num_rows, WINDOW):
            yield Anchors.of(batch.slice(first, WINDOW))


def _search(
    batches: Iterator[pa.RecordBatch],
    anchors: Anchors,
    of: np.ndarray,
    floor: np.ndarray,
    ceiling: np.ndarray,
    same: bool,
    k: int,
) -> Iterator[pa.RecordBatch]:
    """The best ``k`` rows for each search among the rows of one task.

    Search i is for anchor ``of[i]`` and takes scores from ``floor[i]`` to
    ``ceiling[i]``, of rows with the anchor's label (not the anchor itself) or of rows
    with another one.
    """
    best = Best(len(of), k)
    for window in windows(batches):
        label, other = window.labels, window.labels.min() != window.labels.max()
        least, most = bounds(anchors, window)
        wanted = np.maximum(floor, best.score)
        open_ = (most[of] >= wanted) & (least[of] <= ceiling)
        mine = np.isin(anchors.labels, label)
        open_ &= (mine if same else other | ~mine)[of]
        searches = np.flatnonzero(open_)
        step = max(1, SCORES // len(label))
        for first in range(0, len(searches), step):
            part = searches[first : first + step]
            used, column = np.unique(of[part], return_inverse=True)
            scores = products(window.values, anchors.values[used])[:, column]
            alike = label[:, None] == anchors.labels[of[part]]
            good = alike & (window.ids[:, None] != anchors.ids[of[part]]) if same else ~alike
            good &= (scores >= floor[part]) & (scores <= ceiling[part])
            good &= (scores > best.score[part]) | (
                (scores == best.score[part]) & (window.ids[:, None] < best.id[part])
            )
            row, at = np.nonzero(good)
            if len(row):
                best.add(part[at], scores[row, at], window.ids[row])
    best.settle()
    yield pa.RecordBatch.from_arrays(
        [pa.array(x, pa.int64()) for x in best.held], ["search", "score", "id"]
    )


def _found(
    stored: DataFrame,
    anchors: Anchors,
    of: np.ndarray,
    floor: np.ndarray,
    ceiling: np.ndarray,
    same: bool,
    k: int,
) -> DataFrame:
    """``search, score, id, rank`` over all rows; each task hands on its best only."""
    sent = stored.sparkSession.sparkContext.broadcast((anchors, of, floor, ceiling))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _search(batches, *sent.value, same, k)

    best = Window.partitionBy("search").orderBy(F.desc("score"), "id")
    return (
        stored.select("id", "label", "q", "norm", "angles")
        .mapInArrow(run, "search bigint, score bigint, id bigint")
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
    )


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
) -> DataFrame:
    """For every anchor and each of its positives, the hardest negatives.

    Components are taken as ``floor(256 * x)``, scores are their integer inner
    products. The positives of an anchor are its ``positives`` best rows of the same
    label, itself left out; the negatives of a positive the ``negatives`` best rows of
    another label that score from ``low`` to ``high`` percent of the positive, ties by
    the smaller id. ``anchors`` is a condition on the id column, which has a name that
    the stored rows do not use (``id``, ``label``, ``q``, ``norm``, ``angles``). Returns ``anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score``; pairs without a
    negative have no row.

    Rows with a null id, label or vector, or with a component that is null, not
    finite or not below 2 ** 20 in size, take no part. Ids are whole numbers and name
    rows: of several rows of one id that with the least label, then vector, counts.
    Missing components of shorter vectors count as zeros; a zero vector scores 0 with
    all. An empty table gives an empty result; other columns are not read.

    Anchors are the stated queries: ``ANCHOR_BYTES`` of them are sent to all tasks at
    a time, one pass after the other, whatever their number. Of what is sent and
    collected nothing grows with the table: a pass gathers ``positives`` rows for
    each of its anchors.
    """
    spark = vectors.sparkSession
    stored = _stored(_rows(vectors, id_col, label_col, vector_col))
    chosen = stored.select("*", F.col("id").alias(id_col)).where(anchors)
    chosen = materialise(chosen.select("id", "label", "q", "norm", "angles"), "anchors")
    size = 32 + 4 * F.size("q") + 8 * F.size("angles")
    passes = -(-(chosen.agg(F.sum(size)).first()[0] or 0) // ANCHOR_BYTES)
    schema = (
        "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
        "positive_score bigint, negative_score bigint"
    )
    result = spark.createDataFrame([], schema)
    for number in range(passes):
        block = F.pmod(F.xxhash64("id"), F.lit(passes)) == number
        own = chosen.where(block).orderBy("id").toArrow()
        if not len(own):
            continue
        own = Anchors.of(own)
        everyone = np.arange(len(own.ids))
        lowest, highest = np.iinfo(np.int64).min, np.iinfo(np.int64).max
        near = _found(
            stored,
            own,
            everyone,
            np.full(len(everyone), lowest),
            np.full(len(everyone), highest),
            True,
            positives,
        )
        near = near.orderBy("search", "rank").toArrow()
        of, score, positive = (near.column(n).to_numpy() for n in ("search", "score", "id"))
        floor, ceiling = -(-score * low // 100), score * high // 100
        pairs = spark.createDataFrame(
            pa.table(
                {
                    "search": np.arange(len(of)),
                    "anchor_id": own.ids[of],
                    "positive_id": positive,
                    "positive_score": score,
                }
            )
        )
        hard = _found(stored, own, of, floor, ceiling, False, negatives)
        found = hard.join(pairs, "search").select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
        result = result.unionByName(materialise(found, "negatives"))
    return result
