"""A distributed positional inverted index with exact phrase and proximity search.

The index is a table of segments. A segment covers the documents of one stretch of
a scan task (about ``SEGMENT_WORDS`` words; a longer document has its own) and
holds a dictionary and, for each term, the sorted list of its positions. Documents
follow each other with a gap of one position, so no match crosses from one into
the next. Searches run inside segments: nothing but results leaves them, and a hot
term costs each segment no more than that segment's own positions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.scratch import materialise

SEGMENT_WORDS = 500_000
# candidate starts compared at once inside a segment
CANDIDATES = 1 << 20
# UTF-8 bytes of test items and their ids that one search takes; each two bytes are a
# word at most, and each word a window of that many numbers of four bytes
ITEM_BYTES = 4 << 20

# every byte that belongs to no word becomes a blank, after A-Z in lower case
_WORD = re.compile(rb"[0-9a-z\x80-\xff]")
_BLANKED = bytes(b if _WORD.match(bytes([b])) else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Runs of ASCII digits and letters (A-Z in lower case) and non-ASCII characters."""
    return text.lower().translate(_BLANKED).split() if text else []


# --- index -------------------------------------------------------------------


class _Builder:
    """Collects documents until a segment is full."""

    def __init__(self, vocabulary: frozenset[bytes] | None):
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        self.slots: dict[bytes, int] = {}
        if self.vocabulary is not None:
            self.slots = {w: i for i, w in enumerate(sorted(self.vocabulary))}
        self.parts, self.starts, self.sizes, self.ids = [], [], [], []
        self.end = 0

    def add(self, doc_id, text: bytes | None) -> None:
        words, slots = words_of(text), self.slots
        if self.vocabulary is None:
            found = (slots.setdefault(w, len(slots)) for w in words)
        else:
            get = slots.get
            found = (get(w, -1) for w in words)
        self.parts.append(np.fromiter(found, np.int32, len(words)))
        self.ids.append(doc_id)
        self.starts.append(self.end)
        self.sizes.append(len(words))
        self.end += len(words) + 1

    def segment(self) -> dict:
        at = [np.flatnonzero(p >= 0) + s for p, s in zip(self.parts, self.starts)]
        kept = [p[p >= 0] for p in self.parts]
        slots = np.concatenate([np.empty(0, np.int32), *kept])
        places = np.concatenate([np.empty(0, np.int64), *at]).astype(np.int32)
        places = places[np.argsort(slots, kind="stable")]
        counts = np.bincount(slots, minlength=len(self.slots)).astype(np.int32)
        terms = np.array(list(self.slots), object)
        present = counts > 0
        return {
            "ids": self.ids,
            "starts": np.array(self.starts, np.int32).tobytes(),
            "sizes": np.array(self.sizes, np.int32).tobytes(),
            "terms": b" ".join(terms[present].tolist()),
            "counts": counts[present].tobytes(),
            "positions": places.tobytes(),
        }


def build_index(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: frozenset[bytes] | None = None,
) -> DataFrame:
    """Segments with the postings of all terms, or of the terms of ``vocabulary``.

    Each row of ``docs`` is a document of its own, also if its id is null or
    repeated. Null and empty texts are documents without words.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Builder(vocabulary)
        types = None
        for batch in batches:
            types = pa.schema([("ids", pa.list_(batch.schema.field(0).type)), *_BINARY])
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.add(doc_id, text.as_py())
                if held.end >= SEGMENT_WORDS:
                    yield pa.RecordBatch.from_pylist([held.segment()], types)
                    held.clear()
        if held.ids:
            yield pa.RecordBatch.from_pylist([held.segment()], types)

    columns = ", ".join(f"{name} binary" for name, _ in _BINARY)
    return rows.mapInArrow(run, f"ids array<{kind}>, {columns}")


_BINARY = [
    (name, pa.binary()) for name in ("starts", "sizes", "terms", "counts", "positions")
]


class Segment:
    """One row of the index, ready to be searched."""

    def __init__(self, row: dict):
        self.ids = row["ids"]
        self.starts = np.frombuffer(row["starts"], np.int32)
        self.sizes = np.frombuffer(row["sizes"], np.int32)
        self.slots = {w: i for i, w in enumerate(row["terms"].split())}
        # the last slot stands for terms the segment does not have
        self.counts = np.append(np.frombuffer(row["counts"], np.int32), 0)
        self.first = np.cumsum(self.counts) - self.counts
        self.positions = np.frombuffer(row["positions"], np.int32)
        self.span = int(self.starts[-1] + self.sizes[-1]) + 1
        # term and position in one sorted list, for lookups in many lists at once
        owner = np.repeat(np.arange(len(self.counts)), self.counts)
        self.keys = owner * self.span + self.positions

    def slot(self, words: Sequence[bytes]) -> np.ndarray:
        missing = len(self.slots)
        return np.array([self.slots.get(w, missing) for w in words], np.int64)

    def postings(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``slots`` and where, for every position in their lists."""
        sizes = self.counts[slots]
        which = np.repeat(np.arange(len(slots)), sizes)
        inside = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return which, self.positions[self.first[slots][which] + inside]

    def has(self, slots: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Whether each term stands at its place."""
        inside = (places >= 0) & (places < self.span)
        wanted = slots * self.span + places
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        return inside & (self.keys[at] == wanted) if len(self.keys) else inside & False

    def document(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, places, "right") - 1

    def phrases(self, slots: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Row of ``slots`` (a phrase each) and place of every exact occurrence.

        A phrase starts from the positions of its rarest term, moved back by the
        term's offset; the lists of its other terms, rarer ones first and moved
        likewise, are intersected with these one after the other.
        """
        order = np.argsort(self.counts[slots], axis=1, kind="stable")
        rarest = np.take_along_axis(slots, order, 1)
        possible = np.flatnonzero((self.counts[slots] > 0).all(axis=1))
        cost = np.cumsum(self.counts[rarest[possible, 0]].astype(np.int64))
        for part in np.split(
            possible, np.flatnonzero(np.diff(cost // CANDIDATES)) + 1
        ) if len(possible) else []:
            which, places = self.postings(rarest[part, 0])
            which = part[which]
            places = places - order[which, 0]
            for turn in range(1, slots.shape[1]):
                if not len(which):
                    break
                good = self.has(rarest[which, turn], places + order[which, turn])
                which, places = which[good], places[good]
            if len(which):
                yield which, places

    def together(self, slots: np.ndarray, within: int) -> np.ndarray:
        """Places of the rarest term with all terms in one stretch of ``within`` words.

        A stretch starts at one of the terms; for each such start the next
        position of every other term is looked up.
        """
        slots = np.unique(slots)
        if not len(slots) or (self.counts[slots] == 0).any():
            return np.empty(0, np.int64)
        lists = [self.positions[self.first[s] : self.first[s] + self.counts[s]] for s in slots]
        rarest = min(lists, key=len)
        found = []
        for own in lists:
            reach = np.zeros(len(own), np.int64)
            for other in lists:
                at = np.searchsorted(other, own)
                after = np.append(other, self.span + within)[at]
                reach = np.maximum(reach, after - own)
            starts = own[reach < within]
            ends = starts + reach[reach < within]
            good = self.document(starts) == self.document(ends)
            place = rarest[np.searchsorted(rarest, starts[good])]
            found.append(place)
        return np.unique(np.concatenate(found))


# --- searches ----------------------------------------------------------------


def _item_blocks(items: DataFrame, item_col: str, text_col: str) -> tuple[DataFrame, int]:
    """The different test items with the number of their block, and how many blocks
    of about ``ITEM_BYTES`` there are; an item is never cut."""
    rows = items.select(F.col(item_col).alias("item"), F.col(text_col).cast("binary").alias("text"))
    rows = rows.where(F.octet_length("text") > 0).dropDuplicates(["item", "text"])
    size = F.octet_length("text") + F.coalesce(F.octet_length(F.col("item").cast("string")), F.lit(0))
    blocks = -(-(rows.agg(F.sum(size)).first()[0] or 0) // ITEM_BYTES) or 1
    return rows.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks))), blocks


def _block(rows: DataFrame, number: int) -> list[tuple]:
    """The items of one block, collected alone."""
    return [(r["item"], words_of(r["text"])) for r in rows.where(F.col("block") == number).collect()]


class _Phrases(NamedTuple):
    """Different phrases of one length: numbers of their terms, and where their items open."""

    terms: np.ndarray
    opens: np.ndarray
    items: np.ndarray


class _Windows(NamedTuple):
    names: list[str | None]
    terms: bytes
    by_size: dict[int, _Phrases]


def _windows(items: list[tuple], window: int) -> _Windows:
    """Different phrases by length, with the numbers of the items they come from."""
    numbers: dict[bytes, int] = {}
    by_size: dict[int, tuple[list, list]] = {}
    for item, (_, words) in enumerate(items):
        size = min(window, len(words))
        if size:
            found = (numbers.setdefault(w, len(numbers)) for w in words)
            phrases, owners = by_size.setdefault(size, ([], []))
            phrases.append(np.fromiter(found, np.int32, len(words)))
            owners.append(item)
    return _Windows(
        [None if item is None else str(item) for item, _ in items],
        b" ".join(numbers),
        {size: _different(size, *found) for size, found in by_size.items()},
    )


def _different(size: int, texts: list[np.ndarray], owners: list[int]) -> _Phrases:
    """All stretches of ``size`` terms, equal ones once with all their owners."""
    terms = np.concatenate([np.lib.stride_tricks.sliding_window_view(t, size) for t in texts])
    items = np.repeat(np.array(owners, np.int32), [len(t) - size + 1 for t in texts])
    whole = terms.view(np.dtype((np.void, 4 * size))).ravel()
    order = np.argsort(whole, kind="stable")  # items stay in order
    terms, items = terms[order], items[order]
    new = np.concatenate([[True], (terms[1:] != terms[:-1]).any(axis=1)])
    kept = new | np.concatenate([[True], items[1:] != items[:-1]])
    return _Phrases(terms[new], np.flatnonzero(new[kept]), items[kept])


def _search(index: DataFrame, windows) -> DataFrame:
    """One pass of a block's windows, a broadcast, over all segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, terms, by_size = windows.value
        terms = terms.split()
        for batch in batches:
            for row in batch.to_pylist():
                segment = Segment(row)
                slots = segment.slot(terms)
                edges = np.zeros(segment.span + 1, np.int32)
                found: list[set] = [set() for _ in segment.ids]
                for size, phrases in by_size.items():
                    for which, places in hits(segment, slots, size, phrases.terms):
                        np.add.at(edges, places, 1)
                        np.add.at(edges, places + size, -1)
                        pairs = np.unique(
                            np.stack([segment.document(places), which]), axis=1
                        )
                        opens = phrases.opens[pairs[1]].tolist()
                        closes = np.append(phrases.opens, len(phrases.items))[pairs[1] + 1]
                        for doc, a, b in zip(pairs[0].tolist(), opens, closes.tolist()):
                            found[doc].update(phrases.items[a:b].tolist())
                yield _answers(segment, edges, found, names, batch.schema.field("ids").type)

    def hits(segment: Segment, slots: np.ndarray, size: int, terms: np.ndarray):
        """Numbers and places of phrases, a part of them compared at once."""
        present = segment.counts[slots] > 0
        step = max(1, CANDIDATES // size)
        for at in range(0, len(terms), step):
            some = terms[at : at + step]
            possible = np.flatnonzero(present[some].all(axis=1))
            for which, places in segment.phrases(slots[some[possible]]):
                yield at + possible[which], places

    kind = index.schema["ids"].dataType.elementType.simpleString()
    return index.mapInArrow(
        run,
        f"id {kind}, n_words bigint, items array<string>,"
        " spans array<struct<first: bigint, last: bigint>>",
    )


def _answers(segment: Segment, edges, found, names, ids_type) -> pa.RecordBatch:
    covered = np.diff(np.concatenate([[0], (np.cumsum(edges) > 0).view(np.int8), [0]]))
    starts, ends = np.flatnonzero(covered == 1), np.flatnonzero(covered == -1)
    owner = segment.document(starts)
    base = segment.starts[owner]
    spans: list[list] = [[] for _ in segment.ids]
    for doc, first, last in zip(owner.tolist(), (starts - base).tolist(), (ends - base).tolist()):
        spans[doc].append({"first": first, "last": last})
    named = [sorted({names[n] for n in numbers} - {None}) for numbers in found]
    span = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(segment.ids, ids_type.value_type),
            pa.array(segment.sizes.astype(np.int64)),
            pa.array(named, pa.list_(pa.string())),
            pa.array(spans, span),
        ],
        ["id", "n_words", "items", "spans"],
    )


def phrase_matches(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 13,
) -> DataFrame:
    """Words of every document that lie in an occurrence of a window of an item.

    Returns, one row per row of ``docs``: ``id_col, n_words, items`` (ids of the
    items with a window in the document, as strings in order) and ``spans``
    (maximal runs of hit words, ``first`` inclusive, ``last`` exclusive). A window
    is ``window`` consecutive words of an item; an item with fewer words is one
    window. Null, empty and wordless texts and items match nothing. Items with
    equal windows are all named, an item with a null id never is though its words
    count as hit; repeated documents are answered each for themselves. Items beyond
    ``ITEM_BYTES`` are searched in several passes, each written before the next begins.
    """
    context = docs.sparkSession.sparkContext
    rows, blocks = _item_blocks(items, item_col, item_text_col)
    if blocks == 1:
        windows = _windows(_block(rows, 0), window)
        # postings of other terms would never be asked for
        vocabulary = frozenset(windows.terms.split())
        index = materialise(build_index(docs, id_col, text_col, vocabulary), "phrase-index")
        return _search(index, context.broadcast(windows)).withColumnRenamed("id", id_col)
    index = materialise(build_index(docs, id_col, text_col), "phrase-index")
    merged = None
    for number in range(blocks):
        windows = context.broadcast(_windows(_block(rows, number), window))
        # every pass returns the documents of a segment in the same places
        found = _search(index, windows).withColumn("row", F.monotonically_increasing_id())
        if number:
            found = found.where(F.size("spans") > 0)
        found = materialise(found, "phrase-pass")
        windows.destroy()
        merged = found if merged is None else merged.unionByName(found)
    return (
        merged.groupBy("row")
        .agg(
            F.first("id").alias(id_col),
            F.first("n_words").alias("n_words"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        )
        .withColumn("spans", _joined_spans())
        .drop("row")
    )


def _joined_spans():
    """Sorted spans of several passes as maximal runs."""
    return F.expr(
        """aggregate(spans, cast(array() as array<struct<first: bigint, last: bigint>>),
           (runs, s) -> if(size(runs) > 0 and s.first <= runs[size(runs) - 1].last,
             concat(slice(runs, 1, size(runs) - 1),
                    array(named_struct('first', runs[size(runs) - 1].first, 'last',
                                       greatest(runs[size(runs) - 1].last, s.last)))),
             concat(runs, array(s))))"""
    )


def proximity_matches(
    index: DataFrame, queries: dict[str, Sequence[str]], within: int
) -> DataFrame:
    """Documents in which all words of a query lie within ``within`` words.

    ``queries`` is a small dictionary of names and word lists, sent to every
    task. Returns ``id, query, places`` (word numbers in the document of the
    rarest word of each such stretch), one row per document and query found.
    A query without words, or with a word nobody uses, finds nothing.
    """
    wanted = {name: [w.encode() for w in words] for name, words in queries.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.schema.field("ids").type.value_type
            for row in batch.to_pylist():
                segment = Segment(row)
                ids, names, places = [], [], []
                for name, words in wanted.items():
                    at = segment.together(segment.slot(words), within)
                    owner = segment.document(at)
                    for doc in np.unique(owner).tolist():
                        ids.append(segment.ids[doc])
                        names.append(name)
                        places.append((at[owner == doc] - segment.starts[doc]).tolist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, kind), pa.array(names, pa.string()), pa.array(places, pa.list_(pa.int64()))],
                    ["id", "query", "places"],
                )

    kind = index.schema["ids"].dataType.elementType.simpleString()
    return index.mapInArrow(run, f"id {kind}, query string, places array<bigint>")


def contamination(matches: DataFrame, share: int = 20) -> DataFrame:
    """``phrase_matches`` with hit counts; contaminated if a ``share``-th of words is hit."""
    hit = F.aggregate(
        "spans", F.lit(0).cast("bigint"), lambda n, s: n + s["last"] - s["first"]
    )
    return (
        matches.withColumn("n_hit", hit)
        .withColumn("n_items", F.size("items").cast("bigint"))
        .withColumn(
            "contaminated",
            (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")),
        )
    )
