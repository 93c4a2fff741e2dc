"""Documents cut and packed into token windows of equal size by differencing.

A document's ids are cut into full windows, which need no company, and a rest that
is cut into pieces of at most ``PIECE`` ids. Pieces of some thousand documents at a
time are packed by the Karmarkar-Karp method for many sets: partial partitions
start with one piece each; the two with the largest imbalance are merged, the
largest sum of one with the smallest of the other, until one partition is left. Its
sums are the windows. If one exceeds the capacity, there are more windows and the
differencing starts again. The last pieces of a task make as many windows as they fill,
and what does not fit goes to windows of powers of two ids.
"""

from __future__ import annotations

import heapq
import json
import math
import re
import unicodedata
from bisect import insort
from collections.abc import Iterator
from functools import cache
from itertools import compress
from operator import not_
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.batches import slices
from tidemark.llm.workers import give_back

CAPACITY = 2048
END_ID = 1
PIECE = 512
# pieces packed together: enough for even windows, little enough for one task
GROUP = 2048
# words of a generation whose ids a worker remembers
REMEMBERED = 400_000
# bytes of text encoded at once, and packed together
ENCODED_BYTES = 1 << 20
PACKED_BYTES = 8 << 20


# --- token ids ---------------------------------------------------------------


class Encoder:
    """Ids of whole texts, each distinct word encoded once while it is remembered.

    The tokenizer drops white space and never merges across it, so a text's ids
    are those of its words one after the other. A full stop or comma behind a
    letter is a token of its own. Words of small letters only pass the tokenizer's
    normalizer and splitter unchanged, so they go through a copy without these,
    many at a time; every other word goes through the tokenizer as it is.

    Two generations of words are remembered: a word used again moves to the newer
    one, and the older one is forgotten when the newer one is full.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.remembered = remembered
        self.tokenizer = Tokenizer.from_file(path)
        settings = json.loads(Path(path).read_text())
        settings |= {"normalizer": None, "added_tokens": [], "pre_tokenizer": _BLANKS}
        self.plain = Tokenizer.from_str(json.dumps(settings))
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[bytes, bytes]
        self.older: dict[bytes, bytes]
        self.forget()

    def forget(self) -> None:
        self.known, self.older = {}, {}

    def _encode_plain(self, words: list[bytes]) -> None:
        groups = [words[i : i + 64] for i in range(0, len(words), 64)]
        for start in range(0, len(groups), 64):
            part = groups[start : start + 64]
            texts = [b" ".join(g).decode("latin-1").translate(_BYTE_LETTERS) for g in part]
            found = self.plain.encode_batch_fast(texts, add_special_tokens=False)
            for group, encoding in zip(part, found):
                ids = np.array(encoding.ids, "<u4")
                cuts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
                held = ids.tobytes()
                for word, first, last in zip(group, [0, *cuts], cuts):
                    self.known[word] = held[first:last]

    def _encode_any(self, words: list[bytes]) -> None:
        for start in range(0, len(words), 4096):
            part = words[start : start + 4096]
            texts = [word.decode() for word in part]
            found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            for word, encoding in zip(part, found):
                self.known[word] = np.array(encoding.ids, "<u4").tobytes()

    def _learn(self, words: set[bytes]) -> None:
        known, older = self.known, self.older
        plain, other, parted = set(), set(), []
        for word in words:
            if (ids := older.get(word)) is not None:
                known[word] = ids
                continue
            stem = word.rstrip(_MARKS)
            tail = word[len(stem) :]
            core = _plain_form(stem)
            if core is None:
                other.add(word)
                continue
            if core != word:
                parted.append((word, core, tail))
            for part, learnt in ((core, plain), (tail, other)):
                if part and part not in known:
                    if (ids := older.get(part)) is not None:
                        known[part] = ids
                    else:
                        learnt.add(part)
        self._encode_plain(list(plain))
        self._encode_any(list(other))
        for word, core, tail in parted:
            known[word] = known[core] + known[tail] if tail else known[core]

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of every text; a null text has none."""
        if len(self.known) > self.remembered:
            self.older, self.known = self.known, {}
        known, split, new = self.known, [], set()
        for text in texts:
            words = _lowered(text).split() if text else []
            ids = list(map(known.get, words))
            missing = list(compress(range(len(ids)), map(not_, ids)))
            new.update(words[k] for k in missing)
            split.append((ids, [(k, words[k]) for k in missing]))
        self._learn({word for word in new if word not in known})
        for ids, missing in split:
            for place, word in missing:
                ids[place] = known[word]
        return [b"".join(ids) for ids, _ in split]


# the letters that stand for bytes in the tokenizer's vocabulary: bytes that print
# in Latin-1 stand for themselves, the others, in order, for letters from U+0100 on
_PRINTED = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_LETTERS = {
    byte: chr(0x100 + place)
    for place, byte in enumerate(b for b in range(256) if b not in _PRINTED)
    if byte != 0x20  # kept between the words, to split at
}


_BLANKS = {"type": "WhitespaceSplit"}


@cache
def encoder(path: str, remembered: int) -> Encoder:
    """One encoder for all tasks that a worker runs."""
    return Encoder(path, remembered)


_BEFORE_MARK = re.compile(rb"[A-Z](?=[\x80-\xff])")


def _lowered(text: bytes) -> bytes:
    """A-Z in lower case, as the tokenizer does, unless that could make a special token.

    The tokenizer composes before it lower-cases, and a small letter may have a
    composed form that the capital has not. Marks that combine with A-Z have the lead
    bytes CC and CD; where there are any, a capital in front of a mark stays.
    """
    if b"<|" in text:
        return text
    lowered = text.lower()
    if b"\xcc" not in text and b"\xcd" not in text:
        return lowered
    kept = bytearray(lowered)
    for found in _BEFORE_MARK.finditer(text):
        kept[found.start()] = text[found.start()]
    return bytes(kept)


# ASCII characters that are no letter, digit or blank; a run of them is one token
# run of its own behind a letter
_MARKS = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())


def _plain_form(word: bytes) -> bytes | None:
    """A word of Latin letters in lower case, composed; None for any other word.

    Normalizing leaves such a form as it is, and splitting keeps it whole.
    """
    if word.isalpha():  # ASCII letters only
        return word.lower()
    text = word.decode().lower()
    if (
        text.isalpha()
        and max(text) < "\u0250"
        and unicodedata.is_normalized("NFC", text)
    ):
        return text.encode()
    return None


# --- differencing ------------------------------------------------------------


def _merge(a: list, b: list, count: int, nodes: list) -> list:
    """Two partial partitions as one: large sums of one meet small sums of the other.

    A partition is a rising list of its sums other than zero, each with the node
    that holds its members. ``a``, the longer one, is changed and returned.
    """
    shared = max(0, len(a) + len(b) - count)  # sums that meet no zero
    low, alone = a[:shared], b[shared:]
    del a[:shared]
    for (sum_a, node_a), (sum_b, node_b) in zip(reversed(low), b):
        nodes.append((node_a, node_b))
        alone.append((sum_a + sum_b, len(nodes) - 1))
    if len(alone) == 1:
        insort(a, alone[0])
    else:
        a += alone
        a.sort()
    return a


def difference(sizes: list[int], count: int) -> tuple[int, np.ndarray]:
    """The largest of ``count`` near-equal sums, and the set each size belongs to."""
    nodes: list = [None] * len(sizes)
    # by falling imbalance; a partition with a zero left has its largest sum as that
    heap = [(-s if count > 1 else 0, i, [(s, i)]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    turn = len(sizes)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heap[0][2]
        if len(a) < len(b):
            a, b = b, a
        part = _merge(a, b, count, nodes)
        least = part[0][0] if len(part) == count else 0
        heapq.heapreplace(heap, (least - part[-1][0], turn, part))
        turn += 1
    owner = np.empty(len(sizes), np.int64)
    for place, (_, root) in enumerate(heap[0][2]):
        todo = [root]
        while todo:
            node = todo.pop()
            if nodes[node] is None:
                owner[node] = place
            else:
                todo += nodes[node]
    return heap[0][2][-1][0], owner


def pack_sizes(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The window of every size; as many windows as differencing needs."""
    count = max(1, math.ceil(int(sizes.sum()) / capacity))
    while True:
        largest, owner = difference(sizes.tolist(), count)
        if largest <= capacity:
            return owner
        count += max(1, count // 400)


def cut(length: int, capacity: int, piece: int) -> list[int]:
    """Lengths of a document's pieces: full windows, then even parts of the rest."""
    whole, rest = divmod(length, capacity)
    parts = -(-rest // piece)
    return [capacity] * whole + [
        rest // parts + (k < rest % parts) for k in range(parts)
    ]


# --- operator ----------------------------------------------------------------

PIECES = (
    "start bigint, length bigint, ids binary, doc_tokens bigint,"
    " sequence_id bigint, offset bigint"
)


NAMES = ["id", *(column.split()[0] for column in PIECES.split(", "))]


def _pieces(ids: pa.Array, tokens: list[bytes], capacity: int, piece: int) -> pa.RecordBatch:
    """``id, start, length, ids, doc_tokens`` of the pieces of some documents."""
    doc, start, size = [], [], []
    for number, held in enumerate(tokens):
        at = 0
        for length in cut(len(held) // 4, capacity, piece):
            doc.append(number)
            start.append(at)
            size.append(length)
            at += length
    parts = [tokens[d][4 * s : 4 * (s + n)] for d, s, n in zip(doc, start, size)]
    columns = [
        ids.take(pa.array(doc, pa.int64())),
        pa.array(start, pa.int64()),
        pa.array(size, pa.int64()),
        pa.array(parts, pa.binary()),
        pa.array([len(tokens[d]) // 4 for d in doc], pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, NAMES[:5])


def _sizes(pieces: pa.RecordBatch) -> np.ndarray:
    return pieces.column(2).to_numpy()


def _placed(pieces: pa.RecordBatch, sequence: np.ndarray) -> pa.RecordBatch:
    """Pieces with their sequences and places in them: behind the pieces before there."""
    size = _sizes(pieces)
    order = np.argsort(sequence, kind="stable")
    running = np.cumsum(size[order]) - size[order]
    opens = np.flatnonzero(np.diff(sequence[order], prepend=-1))
    offset = np.empty(len(size), np.int64)
    offset[order] = running - np.repeat(running[opens], np.diff(np.append(opens, len(order))))
    return pa.RecordBatch.from_arrays(
        [*pieces.columns, pa.array(sequence), pa.array(offset)], NAMES
    )


def _split(pieces: pa.RecordBatch, edges: list[int]) -> pa.RecordBatch:
    """The same ids in the same order, cut at every edge (a number of ids) too."""
    size = _sizes(pieces)
    ends = np.cumsum(size)
    cuts = np.union1d(ends, np.array(edges, np.int64))
    cuts = cuts[cuts > 0]
    starts = np.concatenate([[0], cuts[:-1]])
    owner = np.searchsorted(ends, starts, side="right")
    inside = starts - (ends - size)[owner]
    length = cuts - starts
    held = pieces.column(3).take(pa.array(owner)).to_pylist()
    columns = [
        pieces.column(0).take(pa.array(owner)),
        pa.array(pieces.column(1).to_numpy()[owner] + inside),
        pa.array(length),
        pa.array([h[4 * i : 4 * (i + n)] for h, i, n in zip(held, inside, length)], pa.binary()),
        pieces.column(4).take(pa.array(owner)),
    ]
    return pa.RecordBatch.from_arrays(columns, NAMES[:5])


def end_sizes(total: int, capacity: int) -> list[int]:
    """Full windows, then windows of falling powers of two, for ``total`` ids."""
    whole, rest = divmod(total, capacity)
    powers = [1 << bit for bit in reversed(range(rest.bit_length())) if rest >> bit & 1]
    return [capacity] * whole + powers


def _packed_end(pieces: pa.RecordBatch, capacity: int) -> pa.RecordBatch:
    """The last pieces of a task, cut further, with sequences from 0 and places.

    As many windows as the ids fill are made by differencing. What is over, and what a
    window holds beyond the capacity, goes to windows of the sizes that ``end_sizes``
    names, which need no padding.
    """
    count = int(_sizes(pieces).sum()) // capacity
    pieces = _split(pieces, [count * capacity])
    inside = np.cumsum(_sizes(pieces)) <= count * capacity
    inner, over = pieces.filter(pa.array(inside)), [pieces.filter(pa.array(~inside))]
    placed = []
    if count:
        owner = difference(_sizes(inner).tolist(), count)[1]
        sums = np.bincount(owner, _sizes(inner), count).astype(np.int64)
        opens = np.cumsum(sums) - sums
        inner = inner.take(pa.array(np.argsort(owner, kind="stable")))
        inner = _split(inner, (opens + np.minimum(sums, capacity)).tolist())
        begins = np.cumsum(_sizes(inner)) - _sizes(inner)
        window = np.searchsorted(opens, begins, side="right") - 1
        fits = begins - opens[window] < capacity
        placed.append(_placed(inner.filter(pa.array(fits)), window[fits]))
        over.append(inner.filter(pa.array(~fits)))
    rest = _together(over)
    if rest is not None:
        edges = np.cumsum(end_sizes(int(_sizes(rest).sum()), capacity))
        rest = _split(rest, edges.tolist())
        window = np.searchsorted(edges, np.cumsum(_sizes(rest)))
        placed.append(_placed(rest, count + window))
    return _together(placed)


def _together(batches: list[pa.RecordBatch]) -> pa.RecordBatch | None:
    """One batch of all; None if there is no row."""
    found = pa.Table.from_batches(batches).combine_chunks().to_batches() if batches else []
    return found[0] if found and found[0].num_rows else None


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    piece: int = PIECE,
    end_id: int = END_ID,
    remembered: int = REMEMBERED,
    forget: bool = False,
) -> DataFrame:
    """Token windows of at most ``capacity`` ids that hold every document once.

    Returns one row per piece: ``id_col, start`` (ids of its document before it),
    ``length, ids`` (little-endian unsigned 32-bit), ``doc_tokens, sequence_id,
    offset`` (ids before it in its window). Every document ends with ``end_id``; a
    null or empty text is that id alone. Every row of ``docs`` is packed, repeated
    ones and null ids too; an empty table gives no pieces; other columns are not
    read. ``tokenizer`` is the path of a tokenizer file that every worker has. A
    worker keeps the ids of up to ``remembered`` words and as many older ones; fewer
    take less memory and more time, and change no result. With ``forget`` it keeps them
    no longer than its task, which leaves the memory to other stages.

    The rows of a scan task are packed with each other, so no row is shuffled:
    documents share windows with those read near them. Rests wait, over batches, until
    there are ``GROUP`` pieces; the last ones of a task end in windows of powers of two
    ids. A sequence's number is the task's and a count.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary"))
    kind = rows.schema["id"].dataType.simpleString()
    last = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, remembered).encode
        used = TaskContext.get().partitionId() << 40
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            for held in slices(batch, PACKED_BYTES):
                tokens: list[bytes] = []
                for part in slices(held, ENCODED_BYTES):
                    tokens += [t + last for t in encode(part.column(1).to_pylist())]
                pieces = _pieces(held.column(0), tokens, capacity, piece)
                full = _sizes(pieces) == capacity
                yield _placed(pieces.filter(pa.array(full)), used + np.arange(full.sum()))
                used += int(full.sum())
                waiting.append(pieces.filter(pa.array(~full)))
                while sum(map(len, waiting)) >= GROUP:
                    rests = _together(waiting)
                    group, waiting = rests.slice(0, GROUP), [rests.slice(GROUP)]
                    owner = pack_sizes(_sizes(group), capacity)
                    yield _placed(group, used + owner)
                    used += int(owner.max()) + 1
        if (rests := _together(waiting)) is not None:
            end = _packed_end(rests, capacity)
            sequence = pc.add(end.column(5), used)
            yield end.set_column(5, "sequence_id", sequence)
        if forget:
            encoder(tokenizer, remembered).forget()
            give_back()

    return rows.mapInArrow(run, f"id {kind}, {PIECES}").withColumnRenamed("id", id_col)
