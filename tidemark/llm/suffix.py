"""Repeated byte strings found by suffix arrays, and their removal.

Equal strings have to meet in one task before their suffixes can be compared. Every
string of ``LENGTH`` bytes has an anchor: the first of its ``GRAM``-byte pieces with
the least hash. Equal strings have equal anchors at equal places, so tasks hold one
range of anchor hashes each. A string is sent as part of a context: the stretch of
text whose strings share one anchor. Anchors seen only once cannot belong to a
repeated string and send nothing, and equal contexts are sent once from each task.
Strings of an anchor with very many different contexts are not kept together: each is
dealt by a 128-bit digest of its own and is repeated if its digest is.

A task sorts the suffixes of its contexts by the difference-cover method: suffixes
at two of three places are sorted by their triples, by recursion on the triples'
names where these tie, and the remaining third is sorted with their help and merged.
Symbols are words of eight bytes counted from the anchor, since equal strings agree
in that alignment; a string is then up to seven bytes and a suffix. Adjacent
prefixes give the groups of suffixes that agree far enough.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import slices
from tidemark.scratch import materialise

LENGTH, GRAM, WORD = 200, 64, 8
# text whose anchors or contexts are collected before they are sent
CHUNK_BYTES = 4 << 20
# what one task holds: anchors, bytes of contexts, bytes of documents
TASK_ANCHORS, TASK_CONTEXTS, TASK_TEXT = 1 << 19, 2 << 20, 4 << 20
# different contexts of an anchor that one task compares; of more, strings are dealt singly
HOT_CONTEXTS = 1 << 10
# rows of 8 to 50 bytes that are broadcast; more of them are joined by shuffle
MAX_BROADCAST = 1_000_000

_FACTOR = 0x9E3779B97F4A7C15
_SPREAD = np.uint64(0xD6E8FEB86659FD93)


# --- anchors -----------------------------------------------------------------


def _doubled(values: np.ndarray, width: int, join) -> np.ndarray:
    """``join`` over every ``width`` consecutive values, by doubling."""
    size = 1
    while 2 * size <= width:
        values = join(values[:-size], values[size:], size)
        size *= 2
    rest = width - size
    return join(values[:-rest], values[rest:], size) if rest else values


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of every ``gram`` consecutive bytes; ``gram`` is a power of two."""

    def join(a, b, size):
        return a * np.uint64(pow(_FACTOR, size, 1 << 64)) + b

    values = _doubled((data.astype(np.uint64) + np.uint64(1)) * _SPREAD, gram, join)
    values = (values ^ (values >> np.uint64(29))) * _SPREAD
    return values ^ (values >> np.uint64(32))


def anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Places of all pieces with the least hash of a string, their hashes, and the
    least hash of every string."""
    if len(data) < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    hashes = gram_hashes(data, gram)
    width = length - gram + 1
    least = _doubled(hashes, width, lambda a, b, _: np.minimum(a, b))
    edge = np.zeros(width - 1, np.uint64)
    around = np.concatenate([edge, least, edge])
    # the largest of the least hashes of the strings around a piece: its own, or it is none
    most = _doubled(around, width, lambda a, b, _: np.maximum(a, b))
    places = np.flatnonzero(most == hashes)
    return places, hashes[places], least


def strings_by_anchor(places, hashes, least) -> tuple[np.ndarray, ...]:
    """Place and hash of every first least piece, and its first and last string."""
    if not len(places):
        return places, hashes, places, places
    at = np.searchsorted(places, np.arange(len(least)))
    wrong = np.flatnonzero(hashes[at] != least)
    while len(wrong):
        at[wrong] += 1
        wrong = wrong[hashes[at[wrong]] != least[wrong]]
    first = np.flatnonzero(np.diff(at, prepend=-1))
    last = np.append(first[1:], len(at)) - 1
    return places[at[first]], hashes[at[first]], first, last


def spread(hashes: np.ndarray) -> np.ndarray:
    """Hashes of anchors over the whole range: as least ones they crowd at its start."""
    return hashes * _SPREAD


# --- suffix array ------------------------------------------------------------


def _names(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Rank of every key among the distinct ones, from 1, and how many there are."""
    distinct, names = np.unique(keys, return_inverse=True)
    return names + 1, len(distinct)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Places of all suffixes of a text of positive numbers, in order.

    Suffixes at places 1 and 2 modulo 3, a difference cover, are sorted by triple
    names, recursively; those at places 0 by first symbol and the next suffix; and
    both are merged, as any two have a shift of at most 2 that puts both into the
    cover.
    """
    size = len(text)
    if size < 4:
        return np.array(sorted(range(size), key=lambda i: text[i:].tolist()), np.int64)
    symbols, kinds = _names(text)
    symbols = np.concatenate([symbols, np.zeros(5, np.int64)])
    pairs, _ = _names(symbols[:-1] * (kinds + 1) + symbols[1:])
    pairs = np.concatenate([pairs, np.zeros(1, np.int64)])
    # the last of the ones reads a zero behind the end, which ends their half
    ones = np.arange(1, size + (size % 3 == 1), 3)
    twos = np.arange(2, size, 3)
    cover = np.concatenate([ones, twos])
    names, distinct = _names(pairs[cover] * (kinds + 1) + symbols[cover + 2])
    order = np.argsort(names, kind="stable") if distinct == len(cover) else suffix_array(names)
    rank = np.zeros(size + 5, np.int64)
    rank[cover[order]] = np.arange(1, len(cover) + 1)
    sampled = cover[order]
    sampled = sampled[sampled < size]
    zeros = np.arange(0, size, 3)
    base = len(cover) + 2
    first = symbols[zeros] * base + rank[zeros + 1]
    turn = np.argsort(first, kind="stable")
    zeros, first = zeros[turn], first[turn]
    second = pairs[zeros] * base + rank[zeros + 2]
    of_one, of_two = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    before = np.searchsorted(symbols[of_one] * base + rank[of_one + 1], first)
    before += np.searchsorted(pairs[of_two] * base + rank[of_two + 2], second)
    place = before + np.arange(len(zeros))
    result = np.empty(size, np.int64)
    taken = np.zeros(size, bool)
    taken[place] = True
    result[place] = zeros
    result[~taken] = sampled
    return result


def common_bytes(words: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Bytes that each suffix shares with the one before it in order, up to ``most``.

    ``words`` are big-endian numbers followed by as many as a comparison may read.
    """
    shared = np.zeros(len(order), np.int64)
    a, b = order[1:], order[:-1]
    left = np.arange(1, len(order))
    for step in range(-(-most // WORD)):
        differ = words[a + step] ^ words[b + step]
        stop = differ != 0
        if stop.any():
            shared[left[stop]] = step * WORD + _leading_bytes(differ[stop])
            go = ~stop
            a, b, left = a[go], b[go], left[go]
        if not len(left):
            break
    shared[left] = most
    return np.minimum(shared, most)


def _leading_bytes(values: np.ndarray) -> np.ndarray:
    """Zero bytes at the front of big-endian words that are not zero."""
    count = np.zeros(len(values), np.int64)
    for byte in range(1, WORD):
        count += values < (np.uint64(1) << np.uint64(64 - 8 * byte))
    return count


def repeated_strings(
    contexts: list[bytes], places: np.ndarray, counts: np.ndarray, length: int
) -> np.ndarray:
    """Which strings occur in two contexts; strings of all contexts one after another.

    ``places`` is the anchor's place in each context, ``counts`` the number of its
    strings, the first of which starts the context.
    """
    lead = places % WORD  # bytes before the first word
    sizes = np.array([len(c) for c in contexts])
    words_of = -(-(sizes - lead) // WORD)
    pad = [b"\0" * int(n) for n in words_of * WORD - (sizes - lead)]
    text = b"".join(c[k:] + p for c, k, p in zip(contexts, lead.tolist(), pad))
    words = np.frombuffer(text, ">u8").astype(np.uint64)
    order = suffix_array(words)
    padded = np.concatenate([words, np.zeros(length // WORD + 2, np.uint64)])
    shared = common_bytes(padded, order, length)
    context = np.repeat(np.arange(len(contexts)), words_of)
    opens = np.cumsum(words_of) - words_of
    inside = (np.arange(len(words)) - opens[context]) * WORD + lead[context]
    base = np.cumsum(counts) - counts
    result = np.zeros(int(counts.sum()), bool)
    # the bytes before a word, for strings that start up to seven bytes earlier
    head = np.concatenate([np.zeros(1, np.uint64), words[:-1]])
    for place in np.flatnonzero(inside < WORD).tolist():
        k = int(inside[place])
        head[place] = int.from_bytes(contexts[context[place]][:k], "big")
    for early in range(WORD):
        group = np.cumsum(shared < length - early)
        start = inside[order] - early
        good = (start >= 0) & (start < counts[context[order]])
        at, group, start = order[good], group[good], start[good]
        several = np.bincount(group)[group] > 1
        at, group, start = at[several], group[several], start[several]
        if not len(at):
            continue
        if early:
            mask = np.uint64((1 << (8 * early)) - 1)
            before, kinds = _names(head[at] & mask)
            group, _ = _names(group * (kinds + 1) + before)
        several = np.bincount(group)[group] > 1
        result[base[context[at[several]]] + start[several]] = True
    return result


# --- Spark jobs --------------------------------------------------------------


def _binary(values: np.ndarray) -> pa.Array:
    return pa.array([values.tobytes()], pa.binary())


def _anchor_rows(texts: DataFrame, tasks: int, length: int) -> DataFrame:
    """Anchor hashes with the keys of their documents, by range of hashes.

    A hash that a task sees twice is known to be repeated: its documents are
    returned at once, as task -1, and one mark of it is sent.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, CHUNK_BYTES):
                found = [
                    anchors(np.frombuffer(t.as_buffer(), np.uint8), length, GRAM)[1]
                    for t in part.column(1)
                ]
                keys = np.repeat(part.column(0).to_numpy(), [len(h) for h in found])
                hashes = spread(np.concatenate(found))
                order = np.argsort(hashes, kind="stable")
                hashes, keys = hashes[order], keys[order]
                _, first, count = np.unique(hashes, return_index=True, return_counts=True)
                many = np.repeat(count > 1, count)
                if many.any():
                    yield row(-1, hashes[many], keys[many], np.empty(0, bool))
                hashes, keys, twice = hashes[first], keys[first], count > 1
                edge = np.arange(1, tasks, dtype=np.float64) * (2.0**64 / tasks)
                cuts = [0, *np.searchsorted(hashes, edge.astype(np.uint64)), len(hashes)]
                for task, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    if a < b:
                        yield row(task, hashes[a:b], keys[a:b], twice[a:b])

    def row(task: int, hashes, keys, twice) -> pa.RecordBatch:
        columns = [pa.array([task], pa.int32()), _binary(hashes), _binary(keys), _binary(twice)]
        return pa.RecordBatch.from_arrays(columns, ["task", "hashes", "keys", "twice"])

    return texts.mapInArrow(run, "task int, hashes binary, keys binary, twice binary")


def _all(table: pa.Table, column: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table[column].to_pylist()), kind)


def _repeated_anchors(rows: DataFrame) -> DataFrame:
    """``key, hash`` of every anchor that occurs twice anywhere."""
    schema = "key bigint, hash bigint"

    def meet(table: pa.Table) -> pa.Table:
        hashes, keys = _all(table, "hashes", np.int64), _all(table, "keys", np.int64)
        twice = _all(table, "twice", bool)
        order = np.argsort(hashes, kind="stable")
        hashes, keys, twice = hashes[order], keys[order], twice[order]
        _, first, count = np.unique(hashes, return_index=True, return_counts=True)
        known = np.logical_or.reduceat(twice, first) | (count > 1)
        good = np.repeat(known, count) & ~twice  # of the others all documents are sent
        return pa.table({"key": keys[good], "hash": hashes[good]})

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            columns = [_all(table, c, np.int64) for c in ("keys", "hashes")]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "hash"])

    met = rows.where("task >= 0").groupBy("task").applyInArrow(meet, schema)
    at_once = rows.where("task < 0").select("hashes", "keys").mapInArrow(unpack, schema)
    return met.unionByName(at_once)


def _is_in(hashes: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Which hashes are among some sorted ones."""
    if not len(some):
        return np.zeros(len(hashes), bool)
    return some[np.minimum(np.searchsorted(some, hashes), len(some) - 1)] == hashes


def _contexts_of(part: pa.RecordBatch, some: np.ndarray, among: bool, length: int) -> Iterator[tuple]:
    """Contexts of the wanted anchors that are ``among`` some sorted ones, or are not:
    owner, anchor, its place, first and last string, and the whole text."""
    rows = zip(part.column(0).to_pylist(), part.column(1), part.column(2))
    for owner, text, wanted in rows:
        data = text.as_py()
        found = anchors(np.frombuffer(data, np.uint8), length, GRAM)
        own, hashes, first, last = strings_by_anchor(*found)
        hashes = spread(hashes)
        good = np.isin(hashes, wanted.values.to_numpy().view(np.uint64))
        good &= _is_in(hashes, some) == among
        columns = (x[good].tolist() for x in (own, hashes, first, last))
        for place, value, a, b in zip(*columns):
            yield owner, value, place, a, b, data


def _hot_anchors(wanted: DataFrame, suspects: DataFrame, length: int) -> tuple[np.ndarray, int]:
    """Sorted hashes of anchors with over ``HOT_CONTEXTS`` different contexts, and how often they occur."""
    seen = wanted.select(F.explode("hashes").alias("hash")).groupBy("hash").count()
    # each of them has that many anchors of the text to itself, so they are few
    busy = dict(map(tuple, seen.where(F.col("count") > HOT_CONTEXTS).collect()))
    if not busy:
        return np.empty(0, np.uint64), 0
    some = np.sort(np.array(list(busy), np.int64).view(np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, CHUNK_BYTES):
                pairs = set()
                for _, value, place, a, b, data in _contexts_of(part, some, True, length):
                    context = blake2b(b"%d " % (place - a) + data[a : b + length], digest_size=8)
                    pairs.add((value, int.from_bytes(context.digest(), "big")))
                if pairs:
                    columns = np.array(list(pairs), np.uint64).view(np.int64).T
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c) for c in columns], ["hash", "context"]
                    )

    kinds = suspects.mapInArrow(run, "hash bigint, context bigint").groupBy("hash")
    kinds = kinds.agg(F.count_distinct("context").alias("kinds"))
    hot = [r["hash"] for r in kinds.where(F.col("kinds") > HOT_CONTEXTS).collect()]
    return np.sort(np.array(hot, np.int64).view(np.uint64)), sum(busy[h] for h in hot)


def _by_digest(digests: np.ndarray) -> tuple[np.ndarray, ...]:
    """Order of digests of two words, then for each in order its group, and where groups open."""
    order = np.lexsort((digests[:, 1], digests[:, 0]))
    ordered = digests[order]
    new = np.concatenate([[True], (ordered[1:] != ordered[:-1]).any(axis=1)])
    return order, np.cumsum(new) - 1, np.flatnonzero(new)


def _hot_string_rows(suspects: DataFrame, hot: np.ndarray, tasks: int, length: int) -> DataFrame:
    """Strings of hot anchors as digests with their places, by range of digests.

    As with anchors, a string that a task sees twice is returned at once, as task -1,
    and one mark of it is sent.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, CHUNK_BYTES // 4):
                yield from sent(part)

    def sent(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        held, owners, firsts = [], [], []
        for owner, _, _, a, b, data in _contexts_of(part, hot, True, length):
            strings = (data[i : i + length] for i in range(a, b + 1))
            held.append(b"".join(blake2b(s, digest_size=16).digest() for s in strings))
            owners.append(np.full(b - a + 1, owner, np.int64))
            firsts.append(np.arange(a, b + 1))
        if not held:
            return
        digests = np.frombuffer(b"".join(held), np.uint64).reshape(-1, 2)
        owners, firsts = np.concatenate(owners), np.concatenate(firsts)
        order, group, opens = _by_digest(digests)
        twice = np.bincount(group) > 1
        many = order[twice[group]]
        if len(many):
            yield row(-1, digests[:0], owners[many], firsts[many], twice[:0])
        heads = order[opens]
        digests, owners, firsts = digests[heads], owners[heads], firsts[heads]
        edge = np.arange(1, tasks, dtype=np.float64) * (2.0**64 / tasks)
        cuts = [0, *np.searchsorted(digests[:, 0], edge.astype(np.uint64)), len(digests)]
        for task, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if a < b:
                yield row(task, digests[a:b], owners[a:b], firsts[a:b], twice[a:b])

    def row(task: int, *columns: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([task], pa.int32()), *map(_binary, columns)], names
        )

    names = ["task", "digests", "owners", "firsts", "twice"]
    return suspects.mapInArrow(
        run, "task int, " + ", ".join(f"{n} binary" for n in names[1:])
    )


def _hot_spans(rows: DataFrame, parts: int, length: int) -> DataFrame:
    """Spans of repeated strings of hot anchors, packed by part of the documents."""

    def meet(table: pa.Table) -> pa.Table:
        digests = _all(table, "digests", np.uint64).reshape(-1, 2)
        twice = _all(table, "twice", bool)
        order, group, opens = _by_digest(digests)
        known = np.logical_or.reduceat(twice[order], opens) | (np.bincount(group) > 1)
        good = order[known[group] & ~twice[order]]
        owners, firsts = _all(table, "owners", np.int64), _all(table, "firsts", np.int64)
        return joined(owners[good], firsts[good])

    def joined(owners: np.ndarray, firsts: np.ndarray) -> pa.Table:
        order = np.lexsort((firsts, owners))
        owners, firsts = owners[order], firsts[order]
        cut = (np.diff(owners) != 0) | (np.diff(firsts) > length)
        opens = np.flatnonzero(np.concatenate([[True], cut])[: len(owners)])
        closes = np.flatnonzero(np.concatenate([cut, [True]])[: len(owners)])
        return _packed(owners[opens], firsts[opens], firsts[closes] + length, parts)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for k in range(len(table)):
                one = table.slice(k, 1)
                found = joined(_all(one, "owners", np.int64), _all(one, "firsts", np.int64))
                yield from found.to_batches()

    schema = "part bigint, owners binary, firsts binary, lasts binary"
    met = rows.where("task >= 0").groupBy("task").applyInArrow(meet, schema)
    return met.unionByName(rows.where("task < 0").mapInArrow(unpack, schema))


def _packed(owner: np.ndarray, first: np.ndarray, last: np.ndarray, parts: int) -> pa.Table:
    """Spans as one row for each part of the documents."""
    part = owner % parts
    order = np.argsort(part, kind="stable")
    numbers, cuts = np.unique(part[order], return_index=True)
    pieces = [np.split(x[order], cuts[1:]) if len(x) else [] for x in (owner, first, last)]
    blobs = [pa.array([x.tobytes() for x in p], pa.binary()) for p in pieces]
    return pa.table([pa.array(numbers, pa.int64()), *blobs], ["part", "owners", "firsts", "lasts"])


def _context_rows(suspects: DataFrame, hot: np.ndarray, tasks: int, length: int) -> DataFrame:
    """Contexts of repeated anchors but hot ones, and where they occur, by range of hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, CHUNK_BYTES):
                yield from sent(part)

    def sent(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        numbers: dict[tuple, int] = {}
        owners, firsts, which = [], [], []
        for owner, value, place, a, b, data in _contexts_of(part, hot, False, length):
            context = (value, place - a, b - a + 1, data[a : b + length])
            which.append(numbers.setdefault(context, len(numbers)))
            owners.append(owner)
            firsts.append(a)
        if not numbers:
            return
        held = list(numbers)
        task_of = np.array([h * tasks >> 64 for h, _, _, _ in held])
        which, owners, firsts = map(np.array, (which, owners, firsts))
        order = np.argsort(task_of, kind="stable")
        renumbered = np.empty(len(held), np.int64)
        cuts = np.searchsorted(task_of[order], np.arange(tasks + 1))
        occurs = np.argsort(task_of[which], kind="stable")
        at = np.searchsorted(task_of[which][occurs], np.arange(tasks + 1))
        for task in range(tasks):
            mine = order[cuts[task] : cuts[task + 1]]
            if not len(mine):
                continue
            renumbered[mine] = np.arange(len(mine))
            seen = occurs[at[task] : at[task + 1]]
            some = [held[k] for k in mine.tolist()]
            columns = [
                pa.array([task], pa.int32()),
                _binary(np.array([c[0] for c in some], np.uint64)),
                _binary(np.array([(c[1], c[2], len(c[3])) for c in some], np.int32)),
                pa.array([b"".join(c[3] for c in some)], pa.binary()),
                _binary(renumbered[which[seen]].astype(np.int32)),
                _binary(owners[seen].astype(np.int64)),
                _binary(firsts[seen].astype(np.int32)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["task", "anchors", "shapes", "text", "which", "owners", "firsts"]
    return suspects.mapInArrow(
        run, "task int, " + ", ".join(f"{n} binary" for n in names[1:])
    )


def _judged(rows: DataFrame, parts: int, length: int) -> DataFrame:
    """Spans of repeated strings, packed by part of the documents."""

    def judge(table: pa.Table) -> pa.Table:
        known: dict[tuple, int] = {}
        which, owners, firsts = [], [], []
        for row in table.to_pylist():
            anchors_ = np.frombuffer(row["anchors"], np.uint64).tolist()
            shapes = np.frombuffer(row["shapes"], np.int32).reshape(-1, 3)
            ends = np.cumsum(shapes[:, 2]).tolist()
            numbers = []
            for value, (place, count, size), end in zip(anchors_, shapes.tolist(), ends):
                context = (value, place, count, row["text"][end - size : end])
                numbers.append(known.setdefault(context, len(known)))
            which.append(np.array(numbers)[np.frombuffer(row["which"], np.int32)])
            owners.append(np.frombuffer(row["owners"], np.int64))
            firsts.append(np.frombuffer(row["firsts"], np.int32).astype(np.int64))
        which, owners, firsts = map(np.concatenate, (which, owners, firsts))
        return spans(list(known), which, owners, firsts)

    def spans(held: list[tuple], which, owners, firsts) -> pa.Table:
        counts = np.array([c[2] for c in held])
        base = np.cumsum(counts) - counts
        hit = np.zeros(int(counts.sum()), bool)
        # a context that occurs twice is repeated whole; others need company
        twice = np.bincount(which, minlength=len(held)) > 1
        hit[np.repeat(twice, counts)] = True
        _, group, size = np.unique([c[0] for c in held], return_inverse=True, return_counts=True)
        several = np.flatnonzero(size[group] > 1)
        if len(several):
            some = [held[k] for k in several.tolist()]
            found = repeated_strings(
                [c[3] for c in some], np.array([c[1] for c in some]), counts[several], length
            )
            own = np.repeat(base[several], counts[several]) + _count_up(counts[several])
            hit[own] |= found
        edge = np.zeros(len(hit), bool)
        edge[base] = True
        opens = np.flatnonzero(hit & (edge | ~np.concatenate([[False], hit[:-1]])))
        closes = np.flatnonzero(hit & np.concatenate([edge[1:] | ~hit[1:], [True]]))
        context = np.searchsorted(base, opens, "right") - 1
        # every occurrence of a context has its runs
        runs = np.bincount(context, minlength=len(held))
        start = np.cumsum(runs) - runs
        many = runs[which]
        run = np.repeat(start[which], many) + _count_up(many)
        origin = np.repeat(firsts, many) - base[context[run]]
        owner = np.repeat(owners, many)
        first, last = origin + opens[run], origin + closes[run] + length
        return _packed(owner, first, last, parts)

    found = rows.groupBy("task").applyInArrow(
        judge, "part bigint, owners binary, firsts binary, lasts binary"
    )
    return found


def _count_up(sizes: np.ndarray) -> np.ndarray:
    """0, 1, … for every size, one after the other."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def merged_spans(first: np.ndarray, last: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of the bytes that spans cover."""
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(last[order])
    opens = np.flatnonzero(np.concatenate([[True], first[1:] > reach[:-1]]))
    closes = np.append(opens[1:], len(first)) - 1
    return list(zip(first[opens].tolist(), reach[closes].tolist()))


def _cut_out(suspects: DataFrame, spans: DataFrame, parts: int) -> DataFrame:
    """``digest, kept, spans`` of every document that spans were looked for in."""
    span = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        owners = _all(right, "owners", np.int64)
        order = np.argsort(owners, kind="stable")
        owners = owners[order]
        first = _all(right, "firsts", np.int64)[order]
        last = _all(right, "lasts", np.int64)[order]
        digests, kept, runs = [], [], []
        columns = (left[c] for c in ("owner", "digest", "text"))
        for owner, digest, text in zip(*columns):
            a, b = np.searchsorted(owners, [owner.as_py(), owner.as_py() + 1])
            found = merged_spans(first[a:b], last[a:b]) if a < b else []
            data, at, rest = text.as_py(), 0, []
            for start, end in found:
                rest.append(data[at:start])
                at = end
            digests.append(digest.as_py())
            kept.append(b"".join([*rest, data[at:]]))
            runs.append([{"first": x, "last": y} for x, y in found])
        columns = [pa.array(digests, pa.binary()), pa.array(kept, pa.binary()), pa.array(runs, span)]
        return pa.table(columns, ["digest", "kept", "spans"])

    owned = suspects.select(F.expr(f"owner % {parts}").alias("part"), "owner", "digest", "text")
    return (
        owned.groupBy("part")
        .cogroup(spans.groupBy("part"))
        .applyInArrow(
            cut, "digest binary, kept binary, spans array<struct<first: bigint, last: bigint>>"
        )
    )


# --- operator ----------------------------------------------------------------


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH
) -> DataFrame:
    """Take out every byte that lies in a string of ``length`` bytes that is elsewhere too.

    Returns one row per row of ``docs``: ``id_col, n_bytes, n_removed, n_spans,
    kept_sha256`` and ``spans``, the removed runs of bytes (null if none), ``first``
    inclusive, ``last`` exclusive. "Elsewhere" is any other place in any text, the same one
    included; strings are those of the input and do not cross texts. Texts are
    UTF-8 bytes, a null text none. Rows with equal texts of at least ``length``
    bytes lose all of it. Repeated rows and null ids are answered like others; an
    empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), data.alias("text")).withColumns(
        {"digest": F.unhex(F.sha2("text", 256)), "size": F.octet_length("text").cast("bigint")}
    )
    lean = materialise(rows.select("id", "digest", "size"), "repeat-digests")
    classes = lean.groupBy("digest").agg(
        F.count(F.lit(1)).alias("copies"), F.min("id").alias("id"), F.max("size").alias("size")
    )
    classes = materialise(classes, "repeat-classes")
    # one text of each class stands for all
    copied = classes.where("copies > 1").select("digest", F.col("id").alias("first"))
    few = copied.count() <= MAX_BROADCAST
    texts = (
        rows.where(F.col("size") >= length)
        .join(F.broadcast(copied) if few else copied, "digest", "left")
        .where("first IS NULL OR id = first")
        .select(F.xxhash64("digest").alias("key"), "text", "digest")
    )
    total = lean.agg(F.sum("size")).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / 50 / TASK_ANCHORS))
    sent = materialise(_anchor_rows(texts.select("key", "text"), tasks, length), "repeat-anchors")
    wanted = _repeated_anchors(sent).groupBy("key").agg(F.collect_list("hash").alias("hashes"))
    wanted = materialise(wanted, "repeat-wanted")
    found = wanted.agg(F.count(F.lit(1)), F.sum(F.size("hashes"))).first()
    if found[0] <= MAX_BROADCAST:  # then other documents' texts need not be moved
        texts = texts.join(F.broadcast(wanted.select("key")), "key", "left_semi")
    suspects = (
        texts.join(wanted, "key")
        .dropDuplicates(["key", "digest"])  # rows that repeat id and text
        .select("digest", "text", "hashes")
        .withColumn("owner", F.monotonically_increasing_id())
    )
    suspects = materialise(suspects, "repeat-suspects")
    contexts = (found[1] or 0) * (length + length // 3)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(contexts / TASK_CONTEXTS))
    held = suspects.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(held / TASK_TEXT))
    looked = suspects.select("owner", "text", "hashes")
    hot, often = _hot_anchors(wanted, looked, length)
    sent = _context_rows(looked, hot, tasks, length)
    # by number, so that small data still keep all tasks
    spans = _judged(sent.repartition(tasks, "task"), parts, length)
    if len(hot):
        strings = often * (length - GRAM + 1)
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(strings / TASK_ANCHORS))
        strings = materialise(_hot_string_rows(looked, hot, tasks, length), "repeat-strings")
        spans = spans.unionByName(_hot_spans(strings, parts, length))
    cut = _cut_out(suspects, spans, parts).select(
        "digest",
        "spans",
        F.octet_length("kept").cast("bigint").alias("n_kept"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
    whole = classes.where(F.col("copies") > 1).where(F.col("size") >= length)
    whole = whole.select(
        "digest",
        F.array(
            F.struct(F.lit(0).cast("bigint").alias("first"), F.col("size").alias("last"))
        ).alias("spans"),
        F.lit(0).cast("bigint").alias("n_kept"),
        F.sha2(F.lit("").cast("binary"), 256).alias("kept_sha256"),
    )
    changed = cut.join(whole, "digest", "left_anti").unionByName(whole)
    changed = materialise(changed, "repeat-changed")
    return lean.join(changed, "digest", "left").select(
        F.col("id").alias(id_col),
        F.col("size").alias("n_bytes"),
        (F.col("size") - F.coalesce("n_kept", "size")).alias("n_removed"),
        F.coalesce(F.size("spans").cast("bigint"), F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", F.lower(F.hex("digest"))).alias("kept_sha256"),
        "spans",
    )
