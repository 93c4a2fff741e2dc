"""Lines that many documents share: two Bloom filters, then exact confirmation.

Every document sends the digests of its lines, never the lines, to the segment of
the filters that is responsible for them. A segment is a pair of Bloom filters, one
of digests seen once and one of those seen twice, over a bounded number of digests;
there are as many segments as the corpus needs. Only digests that the second filter
holds are suspected repeats, and only these go on to be counted exactly.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import slices
from tidemark.scratch import materialise

# UTF-8 bytes of text whose lines are compared inside a task before anything is sent
CHUNK_BYTES = 8 << 20
# digests a segment is made for; a filter has 16 bits for each, 4 of them set: of the
# digests that are there once, 1 in 400 is suspected
SEGMENT_KEYS = 1 << 17
SEGMENT_BITS = 16 * SEGMENT_KEYS
HASHES = 4

# what a sighting tells: the digest was in one document of its chunk, in this one of
# several, or (a notice without a document, one a chunk) in several
ONCE, AMONG, TWICE = 0, 1, 2


def digest(line: bytes, min_length: int) -> bytes | None:
    """128 bits of a line's key, or nothing if the key is too short to be dropped.

    The key is the line without ASCII white space at its ends, A-Z in lower case.
    """
    key = line.strip().lower()
    if len(key) < min_length:
        return None
    if len(key) < 4 * min_length and not key.isascii():
        if len(key.decode(errors="replace")) < min_length:
            return None
    return hashlib.blake2b(key, digest_size=16).digest()


def _sightings(docs: DataFrame, id_col: str, text_col: str, min_length: int) -> DataFrame:
    """``id, digest, kind``: each document's different digests, and the notices."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, CHUNK_BYTES):
                at, found = [], []
                for row, text in enumerate(part.column(1)):
                    lines = (text.as_py() or b"").split(b"\n")
                    own = {digest(line, min_length) for line in lines} - {None}
                    at.extend([row] * len(own))
                    found.extend(own)
                seen = Counter(found)
                several = [key for key, n in seen.items() if n > 1]
                kinds = [AMONG if seen[key] > 1 else ONCE for key in found]
                ids = part.column(0).take(pa.array(at + [None] * len(several), pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(found + several, pa.binary()),
                        pa.array(kinds + [TWICE] * len(several), pa.int8()),
                    ],
                    ["id", "digest", "kind"],
                )

    return rows.mapInArrow(run, f"id {kind}, digest binary, kind tinyint")


def _places(digests: pa.ChunkedArray) -> np.ndarray:
    """The bits of each digest in its segment's filters, a row each."""
    raw = np.frombuffer(b"".join(digests.to_pylist()), np.uint64).reshape(-1, 2)
    step = np.arange(HASHES, dtype=np.uint64)
    return ((raw[:, :1] + raw[:, 1:] * step) % np.uint64(SEGMENT_BITS)).astype(np.int64)


def suspects(told: pa.Table) -> pa.Table:
    """The sightings of one segment, out of one document of a chunk, that repeat.

    A bit joins the second filter when it is set for the second time or by a notice,
    so every digest that came twice has all its bits there.
    """
    once = np.zeros(SEGMENT_BITS, bool)
    twice = np.zeros(SEGMENT_BITS, bool)
    places = _places(told.column("digest"))
    noticed = told.column("kind").to_numpy() == TWICE
    for first in range(0, len(places), SEGMENT_KEYS):
        own = np.sort(places[first : first + SEGMENT_KEYS], axis=None)
        twice[own[once[own]]] = True
        twice[own[1:][own[1:] == own[:-1]]] = True
        once[own] = True
    twice[places[noticed]] = True
    repeated = twice[places].all(axis=1) & ~noticed
    return told.select(["id", "digest"]).filter(pa.array(repeated))


def _suspected(sightings: DataFrame) -> DataFrame:
    """``id, digest`` of every document's lines that another document may have."""
    told = sightings.where(F.col("kind") != AMONG)
    least = int(sightings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    segments = max(least, -(-told.count() // SEGMENT_KEYS))
    segment = F.pmod(F.xxhash64("digest"), F.lit(segments))
    kind = sightings.schema["id"].dataType.simpleString()
    answered = (
        told.withColumn("segment", segment)
        .groupBy("segment")
        .applyInArrow(suspects, f"id {kind}, digest binary")
    )
    return answered.unionByName(sightings.where(F.col("kind") == AMONG).drop("kind"))


def _rewritten(rows: DataFrame, min_length: int) -> DataFrame:
    """Texts without the lines whose digests are listed beside them."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, CHUNK_BYTES):
                texts, sizes, dropped = [], [], []
                for text, gone in zip(part.column(1), part.column(2)):
                    lines = (text.as_py() or b"").split(b"\n")
                    gone = set(gone.as_py() or ())
                    kept = lines
                    if gone:
                        kept = [x for x in lines if digest(x, min_length) not in gone]
                    texts.append(b"\n".join(kept))
                    sizes.append(len(lines))
                    dropped.append(len(lines) - len(kept))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(texts, pa.binary()),
                        pa.array(sizes, pa.int64()),
                        pa.array(dropped, pa.int64()),
                    ],
                    ["id", "text", "n_lines", "n_dropped"],
                )

    return rows.mapInArrow(run, f"id {kind}, text binary, n_lines bigint, n_dropped bigint")


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = 20,
    min_docs: int = 3,
) -> DataFrame:
    """Every document without the lines that ``min_docs`` documents or more share.

    Returns ``id_col, text, n_lines, n_dropped``, one row per row of ``docs``. Texts
    are split at ``\\n``; lines are equal if their keys are: white space (ASCII) at
    the ends taken off, A-Z in lower case. A key of at least ``min_length`` code
    points that is in at least ``min_docs`` rows stays in the rows with the largest
    id that has it, there as often as it is, and goes everywhere else.

    A null or empty text is one empty line. Each row counts as a document, rows that
    repeat an id too; decisions are made by id, so such rows are treated alike. A row
    with a null id counts as a holder of its lines but loses none, as no decision can
    name it, and is never the one that keeps a line from others. Other columns are
    not read; an empty table gives an empty result. Keys are compared by 128-bit
    BLAKE2b digests, so no line travels; only whole texts that meet their list of
    dropped digests may be shuffled, once.

    A line of a third of all documents leaves each chunk of ``CHUNK_BYTES`` of text
    as one notice, is counted by partial sums, and its drops are spread by document.
    """
    sightings = materialise(_sightings(docs, id_col, text_col, min_length), "line-sightings")
    suspected = materialise(_suspected(sightings), "line-suspects")
    confirmed = materialise(
        suspected.groupBy("digest")
        .agg(F.count(F.lit(1)).alias("holders"), F.max("id").alias("keeper"))
        .where(F.col("holders") >= min_docs)
        .select("digest", "keeper"),
        "line-repeats",
    )
    gone = materialise(
        suspected.join(confirmed, "digest")
        .where("id <> keeper")
        .groupBy("id")
        .agg(F.collect_set("digest").alias("gone"))
        .withColumnRenamed("id", "gone_id"),
        "line-drops",
    )
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    rows = rows.join(gone, F.col("id") == F.col("gone_id"), "left").drop("gone_id")
    return _rewritten(rows, min_length).select(
        F.col("id").alias(id_col),
        F.col("text").cast("string").alias("text"),
        "n_lines",
        "n_dropped",
    )
