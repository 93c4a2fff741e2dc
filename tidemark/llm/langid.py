"""Language of a text from unigram pieces, all segmentations summed.

A language is a probability for every piece of a fixed public vocabulary. A word's
likelihood in a language is the sum over all ways to cut it into pieces, found by
the forward algorithm; a text's is the product over its words. Probabilities are
fitted by expectation maximisation on labelled words, starting from equal ones: the
forward-backward expectations are computed in Spark tasks and summed per piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import slices
from tidemark.llm.workers import give_back
from tidemark.scratch import materialise

UNKNOWN = "und"
START = "▁"  # marks the beginning of a word in the vocabulary
# labelled documents per language that the model is fitted on, about
SAMPLE = 400
ROUNDS = 3
# probability of a character that no piece holds; it tells nothing about languages
FLOOR = 1e-6
SMOOTHING = 0.1
# longer words are cut, so that products stay within the range of doubles
LONGEST_WORD = 40
REMEMBERED = 150_000
SCORED_BYTES = 1 << 20

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """The vocabulary as hashes of its pieces, for lookups of many substrings."""

    def __init__(self, pieces: list[str]):
        texts = sorted(set(filter(None, pieces)))
        texts = [p for p in texts if p == p.lower() and _letters(p.removeprefix(START))]
        hashes = np.array([self.hash_of(p) for p in texts], np.uint64)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.texts = [texts[k] for k in order.tolist()]
        self.longest = max(map(len, texts), default=0)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.hashes >> np.uint64(44)] = True

    @staticmethod
    def hash_of(text: str) -> int:
        value = 0
        for letter in text:
            value = (value * int(_FACTOR) + _mixed(ord(letter))) % (1 << 64)
        return value

    def found(self, words: list[str]) -> tuple[np.ndarray, list]:
        """Lengths, and for each piece length: word, first place and piece number."""
        lengths = np.array([len(w) for w in words])
        width = int(lengths.max())
        flat = np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-32-le"), "<u4")
        mixed = _mixed(flat.astype(np.uint64)).reshape(len(words), width)
        value = np.zeros((len(words), width + 1), np.uint64)
        places = []
        for size in range(1, min(self.longest, width) + 1):
            value = value[:, :-1] * _FACTOR + mixed[:, size - 1 :]
            word, first = np.nonzero(self.maybe[value >> np.uint64(44)])
            wanted = value[word, first]
            at = np.minimum(np.searchsorted(self.hashes, wanted), len(self.hashes) - 1)
            hit = self.hashes[at] == wanted
            places.append((word[hit], first[hit], at[hit]))
        return lengths, places


def _mixed(code):
    """A letter's code spread over 64 bits, the same for ints and arrays."""
    if isinstance(code, int):
        return ((code + 1) * 0xD6E8FEB86659FD93) % (1 << 64)
    return (code + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)


def _letters(text: str) -> bool:
    return not text or text.isalpha()


def _by_end(places: list, width: int) -> list[list]:
    """The same places, listed by the place behind them."""
    ends: list[list] = [[] for _ in range(width + 1)]
    for size, (word, first, piece) in enumerate(places, 1):
        order = np.argsort(first, kind="stable")
        word, first, piece = word[order], first[order], piece[order]
        cuts = np.searchsorted(first, np.arange(width + 1))
        for start in range(width - size + 1):
            part = slice(cuts[start], cuts[start + 1])
            if cuts[start] < cuts[start + 1]:
                ends[start + size].append((start, word[part], piece[part]))
    return ends


def forward(ends: list, chances: np.ndarray, words: int) -> np.ndarray:
    """Summed probability of all segmentations of every prefix, per language."""
    alpha = np.zeros((len(ends), words, chances.shape[1]))
    alpha[0] = 1
    for end in range(1, len(ends)):
        alpha[end] = alpha[end - 1] * FLOOR
        for start, word, piece in ends[end]:
            alpha[end, word] += alpha[start, word] * chances[piece]
    return alpha


def backward(ends: list, chances: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Summed probability of all segmentations of every suffix, per language."""
    beta = np.zeros((len(ends), len(lengths), chances.shape[1]))
    beta[lengths, np.arange(len(lengths))] = 1
    for end in range(len(ends) - 1, 0, -1):
        beta[end - 1] += beta[end] * FLOOR
        for start, word, piece in ends[end]:
            beta[start, word] += beta[end, word] * chances[piece]
    return beta


def log_chances(pieces: Pieces, chances: np.ndarray, words: list[str]) -> np.ndarray:
    """Log-likelihood of every word in every language."""
    out = np.empty((len(words), chances.shape[1]))
    order = np.argsort([len(w) for w in words], kind="stable")
    for start in range(0, len(words), 4096):
        part = order[start : start + 4096]
        lengths, places = pieces.found([START + words[k] for k in part.tolist()])
        alpha = forward(_by_end(places, int(lengths.max())), chances, len(part))
        out[part] = np.log(alpha[lengths, np.arange(len(part))])
    return out


# --- words of a text ---------------------------------------------------------


def word_parts(token: str) -> list[str]:
    """Runs of letters, none longer than ``LONGEST_WORD``."""
    if not token.isalpha():
        token = "".join(c if c.isalpha() else " " for c in token)
    return [
        run[k : k + LONGEST_WORD]
        for run in token.split()
        for k in range(0, len(run), LONGEST_WORD)
    ]


class Scorer:
    """Log-likelihoods of texts, with every distinct token scored once at a time."""

    def __init__(self, pieces: Pieces, chances: np.ndarray):
        self.pieces, self.chances = pieces, chances
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.scores = np.zeros((0, self.chances.shape[1] + 1))

    def _learn(self, tokens: list[str]) -> None:
        parts, owner = [], []
        for number, token in enumerate(tokens):
            for part in word_parts(token):
                parts.append(part)
                owner.append(number)
        scores = np.zeros((len(tokens), self.chances.shape[1] + 1))
        if parts:
            found = log_chances(self.pieces, self.chances, parts)
            counted = np.column_stack([found, np.ones(len(parts))])
            np.add.at(scores, np.array(owner), counted)
        first = len(self.place)
        self.place.update(zip(tokens, range(first, first + len(tokens))))
        self.scores = np.concatenate([self.scores, scores])

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Per text: a log-likelihood for every language, and the number of words."""
        if len(self.place) > REMEMBERED:
            self.clear()
        split = [t.lower().split() if t else [] for t in texts]
        new: set[str] = set()
        known = self.place
        for tokens in split:
            new.update(compress(tokens, (t not in known for t in tokens)))
        if new:
            self._learn(sorted(new))
        out = np.zeros((len(texts), self.scores.shape[1]))
        for number, tokens in enumerate(split):
            if tokens:
                at = np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))
                out[number] = self.scores[at].sum(axis=0)
        return out


# --- fitting -----------------------------------------------------------------


def _sample_words(labelled: DataFrame, sample: int) -> DataFrame:
    """``lang, word, n`` over about ``sample`` documents of every language."""
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    draw = F.pmod(F.xxhash64("id", "text"), F.lit(1_000_000)) / 1_000_000
    share = F.lit(0.0)
    for lang, size in sizes.items():
        share = F.when(F.col("lang") == lang, min(1.0, sample / size)).otherwise(share)
    words = F.split(F.regexp_replace(F.lower("text"), r"\P{L}+", " "), " ")
    # all parts of a long word, as in prediction
    parts = F.regexp_extract_all("word", F.lit("(.{1,%d})" % LONGEST_WORD), F.lit(1))
    return (
        labelled.where(draw < share)
        .select("lang", F.explode(words).alias("word"))
        .where("word <> ''")
        .select("lang", F.explode(parts).alias("word"))
        .groupBy("lang", "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _expected(words: DataFrame, pieces: Pieces, chances: np.ndarray, langs: list[str]):
    """Expected use of every piece in every language under ``chances``."""
    model = words.sparkSession.sparkContext.broadcast((pieces, chances))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, chances = model.value
        use = np.zeros_like(chances)
        for batch in batches:
            rows = batch.to_pydict()
            column = np.array([langs.index(x) for x in rows["lang"]])
            texts, n = [START + w for w in rows["word"]], np.array(rows["n"], float)
            order = np.argsort([len(t) for t in texts], kind="stable")
            for first in range(0, len(order), 4096):
                part = order[first : first + 4096]
                lengths, places = pieces.found([texts[k] for k in part.tolist()])
                ends = _by_end(places, int(lengths.max()))
                alpha = forward(ends, chances, len(part))
                beta = backward(ends, chances, lengths)
                mine, every = column[part], np.arange(len(part))
                weight = n[part] / alpha[lengths, every, mine]
                for end, found in enumerate(ends):
                    for start, word, piece in found:
                        lang = mine[word]
                        share = alpha[start, word, lang] * beta[end, word, lang]
                        share *= chances[piece, lang] * weight[word]
                        np.add.at(use, (piece, lang), share)
        at = np.nonzero(use)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at[0]), pa.array(at[1]), pa.array(use[at])], ["piece", "lang", "n"]
        )

    found = words.mapInArrow(run, "piece bigint, lang bigint, n double")
    return found.groupBy("piece", "lang").agg(F.sum("n").alias("n"))


class Model:
    def __init__(self, langs: list[str], pieces: Pieces, chances: np.ndarray):
        self.langs, self.pieces, self.chances = langs, pieces, chances


def fit(
    docs: DataFrame,
    vocabulary: str,
    train: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample: int = SAMPLE,
) -> Model:
    """Piece probabilities from the rows where ``train`` holds and a label is given.

    At most about ``sample`` documents of a language are read for it, drawn by a
    hash. What comes back to the driver is one number per piece and language.
    """
    path = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
    pieces = Pieces([path.id_to_piece(k) for k in range(path.get_piece_size())])
    labelled = docs.where(train).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    )
    labelled = labelled.where("lang IS NOT NULL AND text IS NOT NULL")
    words = materialise(_sample_words(labelled, sample), "language-words")
    langs = sorted(r["lang"] for r in words.select("lang").distinct().collect())
    size = len(pieces.texts)
    chances = np.full((size, len(langs)), 1 / size)
    for _ in range(ROUNDS if langs else 0):
        found = _expected(words, pieces, chances, langs).toArrow()
        use = np.full(chances.shape, SMOOTHING)
        use[found["piece"].to_numpy(), found["lang"].to_numpy()] += found["n"].to_numpy()
        chances = use / use.sum(axis=0)
    return Model(langs, pieces, chances)


def predict(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, lang_pred, score`` for every row, from the text alone.

    The score is the share of the predicted language in the likelihood of all
    learned ones, from 0 to 1; of equal ones the first in order is taken. A text
    that is null or has no letter is ``und`` with score 0, as is every text if no
    language was learned. Repeated rows and null ids are answered like others; an
    empty table gives an empty result; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary"))
    kind = rows.schema["id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        scorer = Scorer(model.pieces, model.chances)
        names = np.array([*model.langs, UNKNOWN], object)
        try:
            for batch in batches:
                for part in slices(batch, SCORED_BYTES):
                    texts = part.column(1).cast(pa.string()).to_pylist()
                    found = scorer.score(texts)
                    likely, words = found[:, :-1], found[:, -1]
                    best = np.full(len(texts), len(model.langs))
                    score = np.zeros(len(texts))
                    if model.langs:
                        known = words > 0
                        best[known] = likely[known].argmax(axis=1)
                        apart = likely - likely.max(axis=1, keepdims=True)
                        score[known] = 1 / np.exp(apart[known]).sum(axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), pa.array(names[best], pa.string()), pa.array(score)],
                        ["id", "lang_pred", "score"],
                    )
        finally:
            scorer.clear()
            give_back()

    found = rows.mapInArrow(run, f"id {kind}, lang_pred string, score double")
    return found.withColumnRenamed("id", id_col)
