"""Toxicity by a bidirectional gated recurrent network with attention, in numpy.

A word enters the network through its characters (embeddings of its character
n-grams, averaged, and the most telling n-gram) and as a whole (an embedding of its
own and how telling the word is). Telling means how many more toxic training
documents hold a word or n-gram than chance explains. Both directions of a gated recurrent
layer read a window of words; attention weighs their states; a linear layer gives
the window's score. A document's score is that of its highest window, over windows
that overlap and cover the whole text.

Training sees document labels only, so the window that counts as toxic is chosen
anew in each round: first the one with the most telling words, then the one the
network scores highest.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import slices

WINDOW, STRIDE = 64, 32
HIDDEN, EMBEDDED = 8, 6
BUCKETS = 1 << 18
GRAMS = (3, 4)
# longer words are read in parts, so that n-grams cover every character
LONGEST = 24
# labelled documents the network is fitted on, at most about, and the longest that is
# taken whole: of a longer one a passage of so many characters is taken
TOXIC_SAMPLE, OTHER_SAMPLE, SAMPLE_BYTES, PASSAGE = 1500, 3000, 40_000, 20_000
# rounds of training, more for few documents until there are enough steps
ROUNDS, LEAST_STEPS, RATE, BATCH = 4, 300, 0.01, 128
QUIET_WINDOWS = 4  # of a training document that is not toxic
REMEMBERED = 120_000
WORDS_AT_ONCE = 8192
SCORED_BYTES = 4 << 20
SEED = 7

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)


# --- words to numbers --------------------------------------------------------


def words_of(text: str | None) -> list[str]:
    """Words in lower case; other characters than letters part them."""
    if not text:
        return []
    return [
        part
        for token in text.lower().split()
        for part in (_parts(token) if len(token) > LONGEST or not token.isalpha() else (token,))
    ]


def _parts(token: str) -> list[str]:
    letters = "".join(c if c.isalpha() else " " for c in token)
    return [w[k : k + LONGEST] for w in letters.split() for k in range(0, len(w), LONGEST)]


def buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every word, and of its n-grams with 0 where it has fewer."""
    width = max(map(len, words)) + 2
    text = "".join(f"^{w}$".ljust(width, "\0") for w in words).encode("utf-32-le")
    codes = np.frombuffer(text, "<u4").astype(np.uint64).reshape(len(words), width)
    mixed = (codes + np.uint64(1)) * _SPREAD
    lengths = np.array([len(w) + 2 for w in words])
    value, grams = np.zeros((len(words), width + 1), np.uint64), []
    for size in range(1, max(GRAMS) + 1):
        if size > width:
            break
        value = value[:, :-1] * _FACTOR + mixed[:, size - 1 :]
        if size in GRAMS:
            inside = np.arange(value.shape[1]) + size <= lengths[:, None]
            grams.append(np.where(inside, _bucket(value + np.uint64(size)), 0))
    whole = np.zeros(len(words), np.uint64)
    for place in range(width):
        whole = np.where(place < lengths, whole * _FACTOR + mixed[:, place], whole)
    return _bucket(whole), np.concatenate(grams, axis=1)


def _bucket(value: np.ndarray) -> np.ndarray:
    """1 to ``BUCKETS - 1``."""
    value = (value ^ (value >> np.uint64(31))) * _SPREAD
    return 1 + ((value >> np.uint64(40)) % np.uint64(BUCKETS - 1)).astype(np.int64)


def windows(count: int) -> list[tuple[int, int]]:
    """First and last place of overlapping windows over ``count`` words."""
    starts = range(0, max(1, count - WINDOW + STRIDE), STRIDE)
    return [(s, min(s + WINDOW, count)) for s in starts] if count else []


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


# --- network -----------------------------------------------------------------


@dataclass
class Network:
    """Tables of the inputs and weights of the layers."""

    word_excess: np.ndarray
    gram_excess: np.ndarray
    weights: dict[str, np.ndarray]

    @classmethod
    def new(cls, word_excess: np.ndarray, gram_excess: np.ndarray) -> Network:
        rng = np.random.default_rng(SEED)
        inputs = 2 * EMBEDDED + 2

        def drawn(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        weights = {
            "words": drawn(BUCKETS, EMBEDDED, scale=0.05),
            "grams": drawn(BUCKETS, EMBEDDED, scale=0.05),
            "attend": drawn(2 * HIDDEN, HIDDEN, scale=0.3),
            "focus": drawn(HIDDEN, scale=0.3),
            "out": drawn(2 * HIDDEN, scale=0.3),
            "bias": np.zeros(1, np.float32),
        }
        for side in ("f", "b"):  # forward, backward
            weights[f"in_{side}"] = drawn(inputs, 3 * HIDDEN, scale=inputs**-0.5)
            weights[f"gate_{side}"] = np.zeros(3 * HIDDEN, np.float32)
            weights[f"state_{side}"] = drawn(HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5)
        return cls(word_excess, gram_excess, weights)

    def inputs(self, word: np.ndarray, grams: np.ndarray) -> np.ndarray:
        """Input vectors of words given by their buckets."""
        parts = range(0, len(word), WORDS_AT_ONCE) or [0]
        cuts = [slice(k, k + WORDS_AT_ONCE) for k in parts]
        return np.concatenate([self._inputs(word[c], grams[c]) for c in cuts])

    def _inputs(self, word: np.ndarray, grams: np.ndarray) -> np.ndarray:
        some = (grams > 0).sum(axis=1, keepdims=True)
        chars = self.weights["grams"][grams]
        chars = (chars * (grams > 0)[..., None]).sum(axis=1) / np.maximum(some, 1)
        return np.column_stack(
            [
                chars,
                self.weights["words"][word],
                self.gram_excess[grams].max(axis=1),
                self.word_excess[word],
            ]
        ).astype(np.float32)

    def gates(self, inputs: np.ndarray) -> list[np.ndarray]:
        """What the inputs add to the gates, for each direction."""
        return [inputs @ self.weights[f"in_{s}"] + self.weights[f"gate_{s}"] for s in "fb"]

    def forward(self, gates: list[np.ndarray], mask: np.ndarray, keep: bool = False):
        """Scores before the last sigmoid of windows laid out by place and window."""
        w, (places, count) = self.weights, mask.shape
        states = np.zeros((2, places + 1, count, HIDDEN), np.float32)
        trace: list[list] = [[], []]
        for side, name in enumerate("fb"):
            recurrent = w[f"state_{name}"]
            state = states[side, 0]
            for turn in range(places):
                place = turn if side == 0 else places - 1 - turn
                added, own = gates[side][place], state @ recurrent
                two = _sigmoid(added[:, : 2 * HIDDEN] + own[:, : 2 * HIDDEN])
                stay, reset = two[:, :HIDDEN], two[:, HIDDEN:]
                fresh = np.tanh(added[:, 2 * HIDDEN :] + reset * own[:, 2 * HIDDEN :])
                there = mask[place][:, None]
                new = np.where(there, fresh + stay * (state - fresh), state)
                if keep:
                    trace[side].append((stay, reset, fresh, own, state))
                state = states[side, turn + 1] = new
        both = np.concatenate([states[0, 1:], states[1, :0:-1]], axis=2)
        heard = np.tanh(both @ w["attend"])
        focus = np.where(mask, heard @ w["focus"], -1e9)
        share = np.exp(focus - focus.max(axis=0))
        share /= share.sum(axis=0)
        pooled = (share[..., None] * both).sum(axis=0)
        score = pooled @ w["out"] + w["bias"][0]
        return score, ((both, heard, share, pooled, trace) if keep else None)

    def backward(self, gates, mask, kept, slope: np.ndarray):
        """Gradients of the weights and of both directions' gate inputs."""
        w, (both, heard, share, pooled, trace) = self.weights, kept
        places = len(mask)
        grads = {"out": pooled.T @ slope, "bias": slope.sum(keepdims=True)}
        d_pooled = slope[:, None] * w["out"]
        d_share = (both * d_pooled).sum(axis=2)
        d_focus = share * (d_share - (share * d_share).sum(axis=0))
        d_heard = d_focus[..., None] * w["focus"] * (1 - heard**2)
        flat = both.reshape(-1, 2 * HIDDEN)
        grads["focus"] = heard.reshape(-1, HIDDEN).T @ d_focus.ravel()
        grads["attend"] = flat.T @ d_heard.reshape(-1, HIDDEN)
        d_both = share[..., None] * d_pooled + d_heard @ w["attend"].T
        d_gates = []
        for side, name in enumerate("fb"):
            recurrent = w[f"state_{name}"]
            d_recurrent = np.zeros_like(recurrent)
            d_added = np.zeros_like(gates[side])
            d_state = np.zeros_like(trace[side][0][4])
            part = d_both[..., side * HIDDEN : (side + 1) * HIDDEN]
            for turn in range(places - 1, -1, -1):
                place = turn if side == 0 else places - 1 - turn
                stay, reset, fresh, own, state = trace[side][turn]
                there = mask[place][:, None]
                d_new = d_state + part[place]
                d_now = np.where(there, d_new, 0)
                d_fresh = d_now * (1 - stay) * (1 - fresh**2)
                d_reset = d_fresh * own[:, 2 * HIDDEN :] * reset * (1 - reset)
                d_stay = d_now * (state - fresh) * stay * (1 - stay)
                d_added[place] = np.concatenate([d_stay, d_reset, d_fresh], axis=1)
                d_own = np.concatenate([d_stay, d_reset, d_fresh * reset], axis=1)
                d_recurrent += state.T @ d_own
                d_state = np.where(there, d_now * stay + d_own @ recurrent.T, d_new)
            grads[f"state_{name}"] = d_recurrent
            d_gates.append(d_added)
        return grads, d_gates


# --- training ----------------------------------------------------------------


def _excess(seen: Iterator[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """How many more toxic documents hold a bucket than chance explains, in deviations."""
    yes, no = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for found, label in zip(seen, toxic):
        (yes if label else no)[np.unique(found)] += 1
    rate = (yes + no) / len(toxic)
    expected = toxic.sum() * rate
    excess = (yes - expected) / np.sqrt(expected * (1 - rate) + 1)
    excess[0] = 0
    return (np.clip(excess, -4, 12) / 4).astype(np.float32)


def _gathered(rows: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    """Sums of the vectors that belong to each of ``count`` rows."""
    sums = [np.bincount(rows, column, count) for column in values.T]
    return np.stack(sums, axis=1).astype(np.float32)


class Trainer:
    """Adam over the windows that count in a round."""

    def __init__(self, texts: Iterable[list[str]], toxic: np.ndarray):
        place: dict[str, int] = {}
        # numbers at once: the words of all documents as text would be far larger
        self.docs = [
            np.array([place.setdefault(w, len(place)) for w in words], np.int32)
            for words in texts
        ]
        vocabulary = list(place)
        self.toxic = toxic
        # room for the n-grams of the longest word in every row
        most = sum(LONGEST + 3 - size for size in GRAMS)
        self.word = np.zeros(len(vocabulary), np.int32)
        self.grams = np.zeros((len(vocabulary), most), np.int32)
        for start in range(0, len(vocabulary), WORDS_AT_ONCE):
            part = slice(start, start + WORDS_AT_ONCE)
            self.word[part], found = buckets(vocabulary[part])
            self.grams[part, : found.shape[1]] = found
        used = [np.unique(d) for d in self.docs]
        tables = [_excess((t[u] for u in used), toxic) for t in (self.word, self.grams)]
        self.net = Network.new(*tables)
        self.spans = [windows(len(d)) for d in self.docs]
        self.moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.net.weights.items()}
        self.steps = 0

    def layout(self, chosen: list[tuple[int, int, int]]):
        """Word numbers by place and window, and which places are filled."""
        ids = np.zeros((WINDOW, len(chosen)), np.int64)
        mask = np.zeros((WINDOW, len(chosen)), bool)
        for column, (doc, first, last) in enumerate(chosen):
            ids[: last - first, column] = self.docs[doc][first:last]
            mask[: last - first, column] = True
        return ids, mask

    def told(self) -> list[np.ndarray]:
        """Per document and window: how telling its most telling words are together."""
        told = self.net.inputs(self.word, self.grams)[:, -2:]
        each = told.max(axis=1)
        return [
            np.array([np.sort(each[d[a:b]])[-3:].sum() for a, b in spans])
            for d, spans in zip(self.docs, self.spans)
        ]

    def scores(self) -> list[np.ndarray]:
        inputs = self.net.inputs(self.word, self.grams)
        every = [(k, a, b) for k, spans in enumerate(self.spans) for a, b in spans]
        found = np.empty(len(every), np.float32)
        for start in range(0, len(every), 1024):
            ids, mask = self.layout(every[start : start + 1024])
            gates = self.net.gates(inputs[ids])
            found[start : start + 1024] = self.net.forward(gates, mask)[0]
        return np.split(found, np.cumsum([len(s) for s in self.spans])[:-1])

    def round(self, ranks: list[np.ndarray], rng) -> None:
        """One pass over the highest window of toxic and the highest few of other documents."""
        chosen, labels = [], []
        for doc, rank in enumerate(ranks):
            count = 1 if self.toxic[doc] else QUIET_WINDOWS
            for number in np.argsort(-rank, kind="stable")[:count].tolist():
                chosen.append((doc, *self.spans[doc][number]))
                labels.append(self.toxic[doc])
        labels = np.array(labels, np.float32)
        order = rng.permutation(len(chosen))
        for start in range(0, len(order), BATCH):
            part = order[start : start + BATCH]
            self.step([chosen[k] for k in part.tolist()], labels[part])

    def step(self, chosen, labels: np.ndarray) -> None:
        net, w = self.net, self.net.weights
        ids, mask = self.layout(chosen)
        used, back = np.unique(ids, return_inverse=True)
        grams, word = self.grams[used], self.word[used]
        own = net.inputs(word, grams)
        inputs = own[back.reshape(ids.shape)]
        gates = net.gates(inputs)
        score, kept = net.forward(gates, mask, keep=True)
        slope = ((_sigmoid(score) - labels) / len(labels)).astype(np.float32)
        grads, d_gates = net.backward(gates, mask, kept, slope)
        flat = inputs.reshape(-1, inputs.shape[-1])
        d_inputs = 0
        for name, d in zip("fb", d_gates):
            d = d.reshape(-1, 3 * HIDDEN)
            grads[f"in_{name}"], grads[f"gate_{name}"] = flat.T @ d, d.sum(axis=0)
            d_inputs = d_inputs + d @ w[f"in_{name}"].T
        d_own = _gathered(back.ravel(), d_inputs, len(used))
        self.move_rows("words", word, d_own[:, EMBEDDED : 2 * EMBEDDED])
        some = (grams > 0).sum(axis=1, keepdims=True)
        share = d_own[:, :EMBEDDED] / np.maximum(some, 1)
        row, column = np.nonzero(grams)
        self.move_rows("grams", grams[row, column], share[row])
        self.steps += 1
        for name, grad in grads.items():
            first, second = self.moments[name]
            first += 0.1 * (grad - first)
            second += 0.001 * (grad**2 - second)
            mean = first / (1 - 0.9**self.steps)
            spread = np.sqrt(second / (1 - 0.999**self.steps)) + 1e-8
            w[name] -= RATE * mean / spread

    def move_rows(self, name: str, rows: np.ndarray, grads: np.ndarray) -> None:
        """Adagrad over the rows of a table that a step used."""
        used, back = np.unique(rows, return_inverse=True)
        grad = _gathered(back, grads, len(used))
        seen = self.moments[name][1]
        seen[used] += grad**2
        self.net.weights[name][used] -= RATE * grad / (np.sqrt(seen[used]) + 1e-8)


def train(texts: Iterable[list[str]], toxic: np.ndarray) -> Network:
    """A network fitted on documents given as words; none of them may be empty."""
    trainer = Trainer(texts, toxic)
    rng = np.random.default_rng(SEED)
    ranks = trainer.told()
    rounds = 0
    while rounds < ROUNDS or trainer.steps < LEAST_STEPS:
        trainer.round(ranks, rng)
        rounds += 1
        if rounds % 2 == 0:
            ranks = trainer.scores()
    return trainer.net


def fit(
    docs: DataFrame,
    labels: DataFrame,
    train_rows: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Network | None:
    """Fit on labelled rows where ``train_rows`` (over the id column) holds.

    At most about ``TOXIC_SAMPLE`` toxic and ``OTHER_SAMPLE`` other documents are
    drawn by a hash of their ids and brought to the driver, of those of more than
    ``SAMPLE_BYTES`` a passage of ``PASSAGE`` characters at a place that a hash gives.
    None is returned if one of the two classes has no document with words.
    """
    label = F.max(F.col(label_col).cast("int")).alias("_label")
    known = labels.where(train_rows & F.col(label_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("_id")).agg(label)
    sizes = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    most = {1: TOXIC_SAMPLE, 0: OTHER_SAMPLE}
    share = F.lit(0.0)
    for value, wanted in most.items():
        part = min(1.0, wanted / max(1, sizes.get(value, 0)))
        share = F.when(F.col("_label") == value, part).otherwise(share)
    draw = F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) / 1_000_000
    # bounded by the sample sizes, so that no other document's text is moved
    drawn = F.broadcast(known.where(draw < share))
    places = F.greatest(F.char_length("_text") - PASSAGE, F.lit(0)) + 1
    start = F.pmod(F.xxhash64("_id", F.lit(SEED)), places).cast("int") + 1
    passage = F.substring(F.col("_text"), start, F.lit(PASSAGE))
    whole = F.octet_length("_text") <= SAMPLE_BYTES
    rows = (
        docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
        .where(F.col("_text").isNotNull())
        .join(drawn, "_id")
        .withColumn("_text", F.when(whole, F.col("_text")).otherwise(passage))
        .select("_id", "_text", "_label")
        .collect()
    )
    rows = sorted(rows, key=lambda r: (r["_id"], r["_text"]))
    rows = [r for r in rows if words_of(r["_text"])]
    toxic = np.array([r["_label"] == 1 for r in rows], bool)
    if not toxic.any() or toxic.all():
        return None
    return train((words_of(r["_text"]) for r in rows), toxic)


# --- scoring -----------------------------------------------------------------


class Scorer:
    """Scores of whole texts; gate inputs of a word are computed once at a time."""

    def __init__(self, net: Network):
        self.net = net
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.gates = [np.zeros((0, 3 * HIDDEN), np.float32) for _ in "fb"]

    def _learn(self, words: list[str]) -> None:
        words.sort(key=len)
        parts = []
        for start in range(0, len(words), WORDS_AT_ONCE):
            part = words[start : start + WORDS_AT_ONCE]
            parts.append(self.net.gates(self.net.inputs(*buckets(part))))
        first = len(self.place)
        self.place.update(zip(words, range(first, first + len(words))))
        for side in range(2):
            self.gates[side] = np.concatenate([self.gates[side], *[p[side] for p in parts]])

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Highest score over all windows of every text; 0 without words."""
        if len(self.place) > REMEMBERED:
            self.clear()
        split = [words_of(t) for t in texts]
        new = list({w for words in split for w in words if w not in self.place})
        if new:
            self._learn(new)
        get = self.place.__getitem__
        ids = [np.fromiter(map(get, words), np.int64, len(words)) for words in split]
        flat = np.concatenate([*ids, np.zeros(1, np.int64)])
        owner, first, size, base = [], [], [], 0
        for number, words in enumerate(ids):
            for a, b in windows(len(words)):
                owner.append(number)
                first.append(base + a)
                size.append(b - a)
            base += len(words)
        owner, first, size = map(np.array, (owner, first, size))
        best = np.full(len(texts), -np.inf)
        order = np.argsort(size, kind="stable")  # windows of like length together
        for start in range(0, len(order), 2048):
            part = order[start : start + 2048]
            at = np.arange(int(size[part].max()))[:, None]
            mask = at < size[part]
            words = flat[np.where(mask, first[part] + at, 0)]
            found, _ = self.net.forward([g[words] for g in self.gates], mask)
            np.maximum.at(best, owner[part], found)
        return _sigmoid(best)


def score(
    docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, score`` for every row of ``docs``, from 0 to 1, from the text alone.

    Texts that are null, empty or without letters score 0, as does every text if
    there was nothing to learn from. Repeated rows and null ids are answered like
    others; an empty table gives an empty result; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary"))
    kind = rows.schema["id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value) if sent.value else None
        for batch in batches:
            for part in slices(batch, SCORED_BYTES):
                found = np.zeros(part.num_rows)
                if scorer:
                    found = scorer.score(part.column(1).cast(pa.string()).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(found, pa.float64())], ["id", "score"]
                )

    return rows.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)
