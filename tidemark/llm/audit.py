"""How filters overlap: who removes what in every order they could be applied in.

A document is a row of a mask matrix: 0 for every filter it fails, infinity for the
others. An order is a column of a position matrix, the inverse of its permutation:
the step at which each filter acts. Their product in min-plus arithmetic, the least
sum over the filters, is the step at which the document is removed. Documents with
one mask behave alike, so Spark counts masks and the product is taken once for each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.scratch import materialise

FILTERS = "ABCDE"
# fixed values of the filters
MIN_WORDS = 100
DISTINCT_PERCENT = 80
CAPITALS_PERCENT = 10
SYMBOLS = b"#$%&*|"

# bytes of a text whose words are split at once
PIECE = 1 << 20
_NOT_CAPITAL = bytes(b for b in range(256) if not 65 <= b <= 90)
_CONTINUED = bytes(range(0x80, 0xC0))
_NOT_SYMBOL = bytes(b for b in range(256) if b not in SYMBOLS)


def word_counts(text: bytes) -> tuple[int, int]:
    """How many words, and how many different ones; words are parted by ASCII white space."""
    total, different, rest = 0, set(), b""
    for first in range(0, len(text), PIECE):
        words = (rest + text[first : first + PIECE]).split()
        ended = first + PIECE >= len(text) or text[first + PIECE - 1 : first + PIECE].isspace()
        rest = b"" if ended or not words else words.pop()
        total += len(words)
        different.update(words)
    return total, len(different)


def failures(text: bytes) -> int:
    """Bit k is set if a text fails filter k of A to D."""
    words, different = word_counts(text)
    capitals = len(text.translate(None, _NOT_CAPITAL))
    points = len(text.translate(None, _CONTINUED))
    return (
        (words < MIN_WORDS)
        | (100 * different < DISTINCT_PERCENT * words) << 1
        | (100 * capitals > CAPITALS_PERCENT * points) << 2
        | bool(text.translate(None, _NOT_SYMBOL)) << 3
    )


def _judged(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """``id, part, mask, digest`` of every row by its text alone."""
    part = F.coalesce(F.col(part_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"), part.alias("part")
    )
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks, digests = [], []
            for value in batch.column(1):
                text = value.as_py() or b""
                masks.append(failures(text))
                digests.append(hashlib.sha256(text).digest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(masks, pa.int32()),
                    pa.array(digests, pa.binary()),
                ],
                ["id", "part", "mask", "digest"],
            )

    return rows.mapInArrow(run, f"id {kind}, part string, mask int, digest binary")


def filter_masks(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """``part, mask, docs, good, toxic``: how many documents fail which filters.

    Bit k of ``mask`` is filter k of ``FILTERS``: under 100 words; under 80 different
    words of 100; over 10 capitals of 100 code points; a symbol of ``SYMBOLS``; a text
    identical to that of a smaller id, by SHA-256. ``good`` and ``toxic`` count those
    labelled quality 1 and toxic 1; several labels of an id count if one says so.

    A null text is an empty one, a null part the empty string. A row with a null id
    has no labels and is no copy of another, nor are rows that repeat the smallest
    id. Copies of one text meet as one row a task, and the rows that are not copies
    are found by text and id, so a group of copies is never in one task.
    """
    rows = materialise(_judged(docs, id_col, text_col, part_col), "filter-masks")
    named = rows.where("id IS NOT NULL")
    firsts = named.groupBy("digest").agg(F.min("id").alias("id"))
    firsts = materialise(firsts.withColumn("copy", F.lit(0)), "filter-firsts")
    told = labels.select(
        F.col(id_col).alias("id"),
        (F.col("quality") == 1).alias("good"),
        (F.col("toxic") == 1).alias("toxic"),
    ).where("id IS NOT NULL AND (good OR toxic)")
    told = told.groupBy("id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    told = materialise(told, "filter-labels")
    flagged = named.join(firsts, ["digest", "id"], "left").join(told, "id", "left")
    flagged = flagged.withColumn("copy", F.coalesce("copy", F.lit(1)))
    alone = rows.where("id IS NULL").withColumn("copy", F.lit(0))
    flagged = flagged.unionByName(alone, allowMissingColumns=True)
    one = {name: F.coalesce(F.col(name).cast("bigint"), F.lit(0)) for name in ("good", "toxic")}
    return (
        flagged.withColumn("mask", F.col("mask") + 16 * F.col("copy"))
        .groupBy("part", "mask")
        .agg(
            F.count(F.lit(1)).alias("docs"),
            F.sum(one["good"]).alias("good"),
            F.sum(one["toxic"]).alias("toxic"),
        )
    )


def removal_steps(masks: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Min-plus product of documents by filters and filters by orders.

    ``masks`` holds 0 where a document fails a filter and infinity elsewhere;
    ``positions`` the step of each filter in each order. Infinity: never removed.
    """
    steps = np.full((len(masks), positions.shape[1]), np.inf)
    for k in range(masks.shape[1]):
        np.minimum(steps, masks[:, k : k + 1] + positions[k], out=steps)
    return steps


def interactions(masks: np.ndarray, weights: dict[str, np.ndarray], filters: str) -> pa.Table:
    """The counts of one part for every order of its filters and each of their steps."""
    n = len(filters)
    orders = np.array(list(permutations(range(n))))  # the filter at each step
    positions = np.argsort(orders, axis=1).T + 1.0  # the step of each filter
    fails = (masks[:, None] >> np.arange(n) & 1).astype(bool)
    steps = removal_steps(np.where(fails, 0.0, np.inf), positions)
    gone = np.isfinite(steps)
    row, order = np.nonzero(gone)
    step = steps[row, order].astype(int) - 1

    def scattered(weight: np.ndarray) -> np.ndarray:
        counts = np.zeros((len(orders), n), np.int64)
        np.add.at(counts, (order, step), weight[row])
        return counts

    removed = scattered(weights["docs"])
    docs = weights["docs"]
    redundant = np.zeros_like(removed)
    shapley, unique = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for k in range(n):
        at = positions[k].astype(int) - 1
        late = fails[:, k, None] & (steps < positions[k])
        redundant[np.arange(len(orders)), at] = docs @ late
        shapley[k] = removed[np.arange(len(orders)), at].sum()
        unique[k] = docs[masks == 1 << k].sum()
    names = ["".join(filters[k] for k in each) for each in orders]
    return pa.table(
        {
            "filter_order": np.repeat(names, n).tolist(),
            "step": np.tile(np.arange(1, n + 1, dtype=np.int32), len(orders)),
            "kept": (docs.sum() - removed.cumsum(axis=1)).ravel(),
            "removed": removed.ravel(),
            "redundant": redundant.ravel(),
            "unique_fails": unique[orders].ravel(),
            "good_lost": scattered(weights["good"]).ravel(),
            "toxic_lost": scattered(weights["toxic"]).ravel(),
            "shapley": shapley[orders].ravel(),
        }
    )


COUNTS = "kept removed redundant unique_fails good_lost toxic_lost shapley".split()


def audit(masks: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Every order of the filters and each step of it, for every part.

    ``masks`` has ``part, mask, docs, good, toxic``, one row per part and mask, as
    ``filter_masks`` gives them; a part has at most ``2 ** len(filters)``. Returns
    ``part, filter_order, step``, the filter being that letter of the order, and the
    document counts ``kept`` after the step, ``removed`` at it, ``redundant`` (failing
    the filter, but gone before), ``unique_fails`` (failing no other), ``good_lost``
    and ``toxic_lost`` of the removed, and ``shapley`` (removed by the filter, summed
    over all orders). No documents, no rows.
    """

    def run(told: pa.Table) -> pa.Table:
        told = told.combine_chunks()
        column = {name: told.column(name).to_numpy() for name in ("mask", "docs", "good", "toxic")}
        found = interactions(column.pop("mask"), column, filters)
        part = pa.array([told.column("part")[0].as_py()] * len(found), pa.string())
        return found.add_column(0, "part", part)

    counts = ", ".join(f"{name} bigint" for name in COUNTS)
    return masks.groupBy("part").applyInArrow(
        run, f"part string, filter_order string, step int, {counts}"
    )
