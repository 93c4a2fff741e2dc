"""Secrets in texts: known patterns, and strings that compress badly where they matter.

A string near a word that announces a secret is measured with a zstandard dictionary
of common identifiers: its novelty is the number of bytes that the string adds to
its compressed surroundings, per character. Names and prose repeat what the
dictionary or the surroundings hold and add little; keys add almost all of theirs.
A string that its surroundings repeat is measured against them without the repeats.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import slices

# fixed patterns of the three base kinds
ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so shorter ones never match
KINDS = ("assign", "access", "hex", "novel")

# words that announce a secret, and how far from one a string may be, on either side
SENSITIVE = (
    "password passwd secret token api_key apikey api-key credential bearer"
    " authorization private_key access_key"
).split()
_SENSITIVE = re.compile("(?ai:" + "|".join(SENSITIVE) + ")")
REACH = 64
LEAST = 16
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST)
# where a run of such characters may be a name and its value
_PARTED = re.compile(_SENSITIVE.pattern + "|=+")
# surroundings compressed with a candidate, on both sides
AROUND = 256
# compressed bytes a character of a reported string adds at least
NOVELTY = 0.6

IDENTIFIERS = (
    "access_token api_key apikey authorization base64 bearer client_id client_secret"
    " config configuration connection const credentials database default def encoding"
    " environment export false function header host http https import int json key"
    " license localhost login name none null object password path port private_key"
    " public request response return secret self server session static string token"
    " true type url user username utf-8 value var version www import os sys Licensed"
    " under the and for with that this are was not from have you but all can will"
    " 0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ"
)
SCANNED_BYTES = 8 << 20


class Novelty:
    """Marginal compressed size against the identifiers and the text around."""

    def __init__(self, dictionary: str = IDENTIFIERS):
        words = zstandard.ZstdCompressionDict(
            dictionary.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT
        )
        self.compressor = zstandard.ZstdCompressor(level=9, dict_data=words)

    def per_character(self, text: str, start: int, end: int) -> float:
        around = text[max(0, start - AROUND) : start] + text[end : end + AROUND]
        return self._added(around, text[start:end])

    def without_repeats(self, text: str, start: int, end: int) -> float:
        """As above, but against surroundings without the string; 0 if they do not repeat it."""
        before = _without(text, text[start:end], max(0, start - AROUND), start)
        after = _without(text, text[start:end], end, min(len(text), end + AROUND))
        if before is None and after is None:
            return 0.0
        if before is None:
            before = text[max(0, start - AROUND) : start]
        if after is None:
            after = text[end : end + AROUND]
        return self._added(before + after, text[start:end])

    def _added(self, around: str, string: str) -> float:
        alone = len(self.compressor.compress(around.encode()))
        # behind its surroundings, so that a repeat of either side is found
        whole = len(self.compressor.compress((around + string).encode()))
        return (whole - alone) / len(string)


def _without(text: str, string: str, first: int, last: int) -> str | None:
    """``text[first:last]`` without all of ``string`` that reaches into it; None if none does."""
    kept, at, size = [], first, len(string)
    place = text.find(string, max(0, first - size + 1), last + size - 1)
    if place < 0:
        return None
    while place >= 0:
        kept.append(text[at:place])
        at = place + size
        place = text.find(string, at, last + size - 1)
    return "".join([*kept, text[at:last]])


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Start, kind and end of every match of a base kind."""
    spans = []
    if ":" in text or "=" in text:
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return spans


def candidates(text: str) -> Iterator[list[tuple[int, int]]]:
    """Runs near a sensitive word: the whole of each, and its parts if it has several."""
    lowered = text.lower()
    if not any(word in lowered for word in SENSITIVE):
        return
    words = [word.span() for word in _SENSITIVE.finditer(text)]
    near = 0
    for found in CANDIDATE.finditer(text):
        start, end = found.span()
        while near < len(words) and words[near][1] + REACH < start:
            near += 1
        if near == len(words):
            return
        if words[near][0] > end + REACH:
            continue
        cuts = [cut.span() for cut in _PARTED.finditer(text, start, end)]
        opens, closes = [start, *(b for _, b in cuts)], [*(a for a, _ in cuts), end]
        parts = [(a, b) for a, b in zip(opens, closes) if b - a >= LEAST]
        yield [(start, end), *(p for p in parts if p != (start, end))]


def _spans_over(
    text: str, known: list, measure: Callable[[str, int, int], float]
) -> list[tuple[int, int, int]]:
    """Candidates with a measure of ``NOVELTY`` that no known span covers: whole runs, else parts."""
    spans = []
    # of the known spans that start before a candidate ends, how far any reaches
    order = sorted((start, end) for start, _, end in known)
    starts = [start for start, _ in order]
    reach = [0, *accumulate((end for _, end in order), max)]
    for whole, *parts in candidates(text):
        for group in ([whole], parts):
            found = [
                (start, 3, end)
                for start, end in group
                if reach[bisect_left(starts, end)] <= start
                and measure(text, start, end) >= NOVELTY
            ]
            if found:
                spans += found
                break
    return spans


def novel_spans(text: str, known: list, novelty: Novelty) -> list[tuple[int, int, int]]:
    """Badly compressible strings near a sensitive word that no base match covers."""
    return _spans_over(text, known, novelty.per_character)


def repeated_spans(text: str, known: list, novelty: Novelty) -> list[tuple[int, int, int]]:
    """The same of strings that would be novel if their surroundings did not repeat them."""
    return _spans_over(text, known, novelty.without_repeats)


def scan(text: str | None, novelty: Novelty) -> list[tuple[int, int, int]]:
    if not text:
        return []
    known = base_spans(text)
    known += novel_spans(text, known, novelty)
    return sorted(known + repeated_spans(text, known, novelty))


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Spans of secrets in every text, as ``id_col, spans``.

    ``spans`` is an array of ``kind, start, last`` in code points, ``last``
    exclusive, by start and then kind. Matches of a kind do not overlap, those of
    different kinds may; ``novel`` ones overlap no other. Every row of ``docs`` is
    answered, repeated ones and null ids too; null and empty texts have no spans;
    an empty table gives an empty result; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary"))
    kind = rows.schema["id"].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("last", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty()
        for batch in batches:
            for part in slices(batch, SCANNED_BYTES):
                texts = part.column(1).cast(pa.string()).to_pylist()
                found = [
                    [
                        {"kind": KINDS[k], "start": start, "last": last}
                        for start, k, last in scan(text, novelty)
                    ]
                    for text in texts
                ]
                spans = pa.array(found, pa.list_(span))
                yield pa.RecordBatch.from_arrays([part.column(0), spans], ["id", "spans"])

    schema = f"id {kind}, spans array<struct<kind: string, start: bigint, last: bigint>>"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def of_kind(*kinds: str) -> Column:
    return F.filter("spans", lambda s: s["kind"].isin(*kinds))


def written(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["last"])), ","
    )
