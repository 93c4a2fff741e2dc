"""Deduplication, language, phrases and packing against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import langid, packing, phrases, simhash
from tidemark.llm import components as components_module
from tidemark.llm.components import components
from tidemark.llm.exact_dedup import exact_duplicates
from tidemark.llm.oracle import ORACLE
from tidemark.llm.queries import QUERIES, language_model
from tests.test_queries import comparable
from tidemark.scratch import materialise

DATA = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def frame(spark, rows, schema="doc_id bigint, text string"):
    return spark.createDataFrame(rows, schema)


def awkward(spark):
    """Nulls, empty and long texts, ties, repeated rows and clashing columns."""
    rows = [
        (1, "a b c d", "x", 1),
        (2, "a  b\tc d", None, 2),
        (2, "a  b\tc d", None, 2),
        (3, None, "y", None),
        (4, "", "z", 3),
        (None, "only", "x", 1),
        (5, "é " * 30_000, "x", 1),
        (6, " \n ", None, None),
    ]
    schema = "doc_id bigint, text string, hash string, print int"
    return frame(spark, rows, schema)


@pytest.fixture(scope="module")
def documents(spark):
    return {
        r["doc_id"]: r["text"] or ""
        for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()
    }


def test_queries_equal_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels", "embeddings"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    for name, sql in ORACLE.items():
        got = QUERIES[name](spark, DATA).toArrow()
        assert comparable(got) == comparable(con.sql(sql).to_arrow_table()), name


# --- exact duplicates --------------------------------------------------------


def test_exact_duplicates_of_awkward_rows(spark):
    found = exact_duplicates(awkward(spark)).collect()
    rows = sorted((r["doc_id"] or 0, r["keep_id"], r["group_size"], r["kept"]) for r in found)
    assert rows == [
        (0, None, 1, True),
        (1, 2, 3, False),
        (2, 2, 3, True),
        (2, 2, 3, True),
        (3, 6, 3, False),
        (4, 6, 3, False),
        (5, 5, 1, True),
        (6, 6, 3, True),
    ]
    empty = exact_duplicates(awkward(spark).limit(0))
    assert empty.count() == 0


def test_colliding_hashes_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(F, "md5", lambda c: F.lit("00" * 16))
    docs = frame(spark, [(1, "a"), (2, "a "), (3, "b"), (4, "c")])
    found = {r["doc_id"]: r for r in exact_duplicates(docs).collect()}
    assert {k: r["keep_id"] for k, r in found.items()} == {1: 2, 2: 2, 3: 3, 4: 4}
    assert found[1]["text_sha256"] == hashlib.sha256(b"a").hexdigest()


# --- near duplicates ---------------------------------------------------------


def slow_fingerprint(text, size=3):
    text = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(
        1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes)
    )


def slow_components(prints):
    parent = {k: k for k in prints}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    keys = sorted(prints)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 3 and root(a) != root(b):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {k: root(k) for k in keys}


def test_near_duplicates_equal_brute_force(spark, documents):
    found = QUERIES["op8_simhash_near_dedup"](spark, DATA).collect()
    prints = {k: slow_fingerprint(t) for k, t in documents.items()}
    assert {r["doc_id"]: r["fingerprint"] for r in found} == {
        k: f"{v:016x}" for k, v in prints.items()
    }
    assert {r["doc_id"]: r["component_id"] for r in found} == slow_components(prints)


def test_forests_keep_the_components_of_all_links():
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (2, 4000)).astype(np.uint64)
    near = centres[rng.integers(0, 40, 4000)] ^ flips[0] ^ flips[1]
    prints = np.unique(np.concatenate([near, rng.integers(0, 1 << 63, 3000, dtype=np.uint64)]))
    place = {p: k for k, p in enumerate(prints.tolist())}
    blocks = np.array_split(prints, 5)
    a, b = [], []
    for i in range(5):
        for j in range(i, 5):
            x, y = simhash.forest(blocks[i], None if i == j else blocks[j], 3)
            a += x.tolist()
            b += y.tolist()
    got, want = np.arange(len(prints)), np.arange(len(prints))
    simhash.merge(got, np.array([place[x] for x in a]), np.array([place[x] for x in b]))
    i, j = np.nonzero(np.bitwise_count(prints[:, None] ^ prints) <= 3)
    simhash.merge(want, i, j)
    assert (got == want).all() and len(a) < len(prints) * 5


def test_near_duplicates_of_awkward_rows(spark):
    found = simhash.near_duplicates(awkward(spark)).collect()
    by_id = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in found}
    assert len(found) == 8
    assert by_id[3] == by_id[4] == by_id[6] == ("0" * 16, 3)
    assert by_id[1] == by_id[2] and by_id[None][1] is None
    assert simhash.near_duplicates(awkward(spark).limit(0)).count() == 0


def test_components_of_a_path_and_a_star(spark):
    path = [(k, k + 1) for k in range(1, 60)]
    star = [(100, k) for k in range(101, 300)]
    links = frame(spark, path + star + [(7, 7), (None, 3)], "a bigint, b bigint")
    roots = {r["node"]: r["root"] for r in components(links).collect()}
    assert roots == {k: 1 for k in range(1, 61)} | {k: 100 for k in range(100, 300)}


@pytest.mark.parametrize("star", [components_module._large_star, components_module._small_star])
def test_a_hub_is_split(spark, star):
    """No aggregate between shuffle and join, so the partition of a hub may be cut."""
    hub = 0 if star is components_module._large_star else 500_000
    rows = spark.range(200_000).selectExpr(f"IF(id % 3 < 2, {hub}L, id) AS a", "id + 300000 AS b")
    links = materialise(rows, "hub-links")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    kept = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        found = star(links)
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)
    assert "skew=true" in plan


# --- phrases -----------------------------------------------------------------


def slow_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def slow_matches(docs, items, window=13):
    windows = defaultdict(set)
    for item, text in items:
        words = slow_words(text)
        size = min(window, len(words))
        for k in range(len(words) - size + 1 if words else 0):
            windows[tuple(words[k : k + size])].add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        words, hit, found = slow_words(text), set(), set()
        for size in sizes:
            for k in range(len(words) - size + 1):
                if of := windows.get(tuple(words[k : k + size])):
                    hit.update(range(k, k + size))
                    found |= of
        names = ",".join(sorted(map(str, found)))
        out.append((doc, len(words), len(hit), len(found), names))
    return out


def test_decontamination_equals_brute_force(spark, documents):
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    found = QUERIES["op10_decontamination"](spark, DATA).collect()
    want = slow_matches(documents.items(), items)
    assert sorted(tuple(r) for r in found) == sorted(
        (doc, n, hit, k, hashlib.sha256(names.encode()).hexdigest(), hit > 0 and 20 * hit >= n)
        for doc, n, hit, k, names in want
    )
    assert sum(r["n_hit"] > 0 for r in found) >= 3


@pytest.mark.parametrize("item_bytes", [1 << 20, 40])
def test_phrases_in_crowded_texts(spark, monkeypatch, item_bytes):
    monkeypatch.setattr(phrases, "ITEM_BYTES", item_bytes)
    monkeypatch.setattr(phrases, "CANDIDATES", 50)
    rng = random.Random(3)
    docs = [(k, " ".join(rng.choices("aAb,", k=rng.randrange(60)))) for k in range(80)]
    docs += [(90, None), (91, ""), (92, "a b a"), (92, "a b a")]
    items = [(k, " ".join(rng.choices("ab", k=n))) for k, n in enumerate((0, 1, 3, 5, 6, 7, 9))]
    items += [(50, None), (51, "q r s")]
    got = phrases.phrase_matches(
        frame(spark, docs), frame(spark, items, "item_id bigint, text string"), window=5
    )
    rows = phrases.contamination(got).collect()
    assert sorted(
        (r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], ",".join(r["items"])) for r in rows
    ) == sorted(slow_matches(docs, items, 5))
    none = phrases.phrase_matches(frame(spark, docs), frame(spark, [], "item_id int, text string"))
    assert none.where("size(spans) > 0").count() == 0


def test_each_block_of_items_is_searched_before_the_next(spark, monkeypatch):
    steps, windows, written = [], phrases._windows, phrases.materialise

    def built(items, window):
        steps.append("built")
        return windows(items, window)

    def kept(found, label, *others):
        steps.append(label)
        return written(found, label, *others)

    monkeypatch.setattr(phrases, "ITEM_BYTES", 2000)
    monkeypatch.setattr(phrases, "_windows", built)
    monkeypatch.setattr(phrases, "materialise", kept)
    rng = random.Random(4)
    items = [(k, " ".join(rng.choices("abcdef", k=rng.randrange(1, 60)))) for k in range(100)]
    docs = [(k, f"x {items[k][1]} y {items[k + 20][1]}") for k in range(40)] + [(None, items[5][1])]
    got = phrases.phrase_matches(
        frame(spark, docs), frame(spark, items * 2, "item_id bigint, text string")
    )
    rows = phrases.contamination(got).collect()
    assert sorted(
        ((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], ",".join(r["items"])) for r in rows),
        key=str,
    ) == sorted(slow_matches(docs, items, 13), key=str)
    assert steps[0] == "phrase-index" and len(steps) > 5
    assert steps[1:] == ["built", "phrase-pass"] * (len(steps) // 2)


def test_windows_take_little_memory():
    rng = random.Random(5)
    items = [(k, [b"%d" % rng.randrange(9000) for _ in range(200)]) for k in range(200)]
    tracemalloc.start()
    held = phrases._windows(items, 13)
    size, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held and size < 40_000 * 100


def test_proximity(spark):
    docs = frame(spark, [(1, "x a q q b"), (2, "a q q q b"), (3, "b, a"), (4, "a"), (5, None)])
    index = phrases.build_index(docs)
    found = phrases.proximity_matches(index, {"ab": ["a", "b"], "none": ["zz"]}, within=4)
    assert sorted((r["id"], r["query"]) for r in found.collect()) == [(1, "ab"), (3, "ab")]


# --- language ----------------------------------------------------------------


def test_long_pieces_count_and_long_words_are_learned_whole(spark):
    whole = "▁" + "information"
    pieces = langid.Pieces([whole, "▁in", "formation", "a"])
    assert whole in pieces.texts
    got = langid.log_chances(pieces, np.array([[0.25]] * 4), ["information"])
    assert np.allclose(np.exp(got), 0.25 + 0.25**2)
    word = "".join(random.Random(6).choices("abcdeé字𠀀", k=97))
    rows = spark.createDataFrame([(1, f"{word}, {word.upper()}", "x")], "id int, text string, lang string")
    found = {r["word"]: r["n"] for r in langid._sample_words(rows, 10).collect()}
    assert found == dict.fromkeys(langid.word_parts(word), 2)


def slow_chance(pieces, chances, word):
    """Sum over all segmentations by recursion."""
    place = {p: k for k, p in enumerate(pieces.texts)}

    def total(rest):
        if not rest:
            return 1.0
        whole = langid.FLOOR * total(rest[1:])
        for size in range(1, len(rest) + 1):
            if rest[:size] in place:
                whole = whole + chances[place[rest[:size]]] * total(rest[size:])
        return whole

    return np.log(total(langid.START + word))


def test_forward_sums_all_segmentations():
    pieces = langid.Pieces(["▁", "a", "b", "ab", "▁a", "aba", "▁ab", "B", "ba"])
    assert "B" not in pieces.texts
    chances = np.random.default_rng(1).random((len(pieces.texts), 2))
    words = ["a", "ab", "abab", "xa", "babab"]
    got = langid.log_chances(pieces, chances, words)
    assert np.allclose(got, [slow_chance(pieces, chances, w) for w in words])


def slow_language(model, text):
    """Language and score of a text: every word's segmentations summed from its end."""
    place = {p: k for k, p in enumerate(model.pieces.texts)}
    likely, words = np.zeros(len(model.langs)), 0
    for run in re.findall(r"[^\W\d_]+", (text or "").lower()):
        for first in range(0, len(run), langid.LONGEST_WORD):
            word = langid.START + run[first : first + langid.LONGEST_WORD]
            after = [np.ones(len(model.langs))]  # sums of the rests, shortest first
            for start in range(len(word) - 1, -1, -1):
                total = langid.FLOOR * after[-1]
                for end in range(start + 1, len(word) + 1):
                    if (piece := place.get(word[start:end])) is not None:
                        total = total + model.chances[piece] * after[len(word) - end]
                after.append(total)
            likely += np.log(after[-1])
            words += 1
    if not words:
        return "und", 0.0
    best = int(likely.argmax())
    return model.langs[best], 1 / np.exp(likely - likely[best]).sum()


def test_language_equals_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("length(text) < 4000")
    docs = docs.unionByName(
        spark.createDataFrame(
            [(-1, "12 !"), (-2, "x" * 99 + " naïve"), (-3, None), (-4, "日本語 ab1c")],
            "doc_id bigint, text string",
        ),
        allowMissingColumns=True,
    )
    model = language_model(docs)
    found = {r["doc_id"]: r for r in langid.predict(docs, model).collect()}
    texts = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert len(found) == len(texts) > 100
    for doc, text in texts:
        lang, score = slow_language(model, text)
        assert found[doc]["lang_pred"] == lang, doc
        assert found[doc]["score"] == pytest.approx(score, abs=1e-6), doc
    assert {r["lang_pred"] for r in found.values()} == {*model.langs, "und"}


def test_language_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op3_language_id"](spark, DATA).join(labels, "doc_id").collect()
    held = [r for r in found if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in found)
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.9 * len(held) > 30


def test_language_of_awkward_rows(spark):
    schema = "doc_id bigint, text string, lang string, id int"
    rows = [
        (1, "le chat et la souris", "fr", 1),
        (1, "le chat et la souris", "fr", 1),
        (2, "the cat and the mouse", "en", None),
        (3, None, "en", None),
        (4, "12 + 3 = ²", "fr", None),
        (None, "the house", None, None),
        (5, "the " * 20_000 + "z" * 5000, None, None),
    ]
    docs = frame(spark, rows, schema)
    vocabulary = public_tokenizers.path("piece_bpe_32k.model")
    model = langid.fit(docs, vocabulary, F.lit(True))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(docs, model).collect()}
    assert got[3] == got[4] == ("und", 0.0)
    assert got[1][0] == "fr" and got[None][0] == got[5][0] == "en"
    assert all(0 <= score <= 1 for _, score in got.values())
    nothing = langid.fit(docs.limit(0), vocabulary, F.lit(True))
    assert {r["lang_pred"] for r in langid.predict(docs, nothing).collect()} == {"und"}
    assert langid.predict(docs.limit(0), model).count() == 0


# --- packing -----------------------------------------------------------------


def check_packed(rows, tokens, capacity=2048):
    """Every id once, in order, gapless windows; returns the share that is no padding."""
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_window[r["sequence_id"]].append((r["offset"], r["length"]))
    assert by_doc.keys() == tokens.keys()
    for doc, pieces in by_doc.items():
        ids, at = tokens[doc], 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids)) and r["length"] > 0
            part = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(part)
            at += r["length"]
        assert at == len(ids)
    for pieces in by_window.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    fills = [sum(length for _, length in pieces) for pieces in by_window.values()]
    room = sum(n if n & (n - 1) == 0 else capacity for n in fills)
    return sum(map(len, tokens.values())) / room


def test_packing_holds_every_id_once(spark, documents):
    found = QUERIES["op5_packing"](spark, DATA).collect()
    reader = Tokenizer.from_file(TOKENIZER)
    tokens = {k: reader.encode(t, add_special_tokens=False).ids + [1] for k, t in documents.items()}
    assert check_packed(found, tokens) > 0.97
    # tasks of three documents
    docs = spark.read.parquet(f"{DATA}/documents.parquet").repartition(67, "doc_id")
    found = packing.pack(docs, TOKENIZER).withColumn("ids_crc32", F.crc32("ids")).collect()
    assert check_packed(found, tokens) > 0.97


@pytest.mark.parametrize("seed", range(6))
def test_the_end_of_a_task_is_filled(seed):
    """Any ids over any pieces: whole windows, then powers of two, no id lost."""
    rng = np.random.default_rng(seed)
    capacity = [64, 64, 100, 64, 1, 2048][seed]
    docs = [rng.integers(1, 99, n, dtype="<u4").tobytes() for n in rng.integers(1, 400, 1 + 9 * seed)]
    pieces = packing._pieces(pa.array(range(len(docs))), docs, capacity, max(1, capacity // 4))
    found = packing._packed_end(pieces, capacity).to_pylist()
    rows = [
        {"doc_id": r["id"], "ids_crc32": zlib.crc32(r["ids"]), **r} for r in found
    ]
    tokens = {k: np.frombuffer(d, "<u4").tolist() for k, d in enumerate(docs)}
    check_packed(rows, tokens, capacity)
    fills = defaultdict(int)
    for r in found:
        fills[r["sequence_id"]] += r["length"]
    whole = sum(map(len, docs)) // 4 // capacity
    ends = [n for k, n in sorted(fills.items()) if k >= whole]
    assert all(n == capacity or n & (n - 1) == 0 for n in ends)
    assert packing.end_sizes(3000, 2048) == [2048, 512, 256, 128, 32, 16, 8]


def test_packing_of_awkward_rows(spark):
    texts = {
        1: "It's 3.14, don't <|endoftext|> x<|startoftext|>. <|ENDOFTEXT|> ÀB ẞ ǅx ΑΣ. Σ,",
        2: "\x1ca\x85b　c İ ﬁ 12,5. a..b, foo-bar... naïve. é. x́, É!!",
        3: None,
        4: "",
        5: "word, " * 3000,
        6: "a" * 3000,
        7: "日本語 テキスト. 한국어,%%",
    }
    docs = frame(spark, [(k, t, 1) for k, t in texts.items()], "doc_id bigint, text string, ids int")
    found = packing.pack(docs, TOKENIZER).withColumn("ids_crc32", F.crc32("ids")).collect()
    reader = Tokenizer.from_file(TOKENIZER)
    check_packed(
        found,
        {k: reader.encode(t or "", add_special_tokens=False).ids + [1] for k, t in texts.items()},
    )
    assert packing.pack(docs.limit(0), TOKENIZER).count() == 0
    twice = packing.pack(docs.where("doc_id = 4").unionAll(docs.where("doc_id = 4")), TOKENIZER)
    assert twice.count() == 2


def test_differencing_is_near_equal():
    largest, owner = packing.difference([8, 7, 6, 5, 4], 2)
    assert largest == 16 and sorted(np.bincount(owner, [8, 7, 6, 5, 4])) == [14, 16]
    sizes = np.random.default_rng(2).integers(1, 500, 3000)
    largest, owner = packing.difference(sizes.tolist(), 100)
    sums = np.bincount(owner, sizes)
    assert largest == sums.max() and sums.max() - sums.min() < 30
    assert (packing.pack_sizes(np.array([2047, 2, 2047]), 2048).max()) == 2


def test_ids_of_letters_with_marks():
    """The tokenizer composes before it lower-cases: not all capitals have what small letters have."""
    pairs = ["T\u0308", "H\u0331", "J\u030c", "W\u030a", "Y\u030a", "T\u1dca\u0308", "=\u0338"]
    rng = np.random.default_rng(2)
    letters = list("abtThHjJwWyYzZéÉßẞİıﬁ1.,<|'= ") + ["\u0308", "\u0331", "\u030c", "\u030a", "\u0338", "\u1dca", "\u212b", "\u00a0"]
    texts = pairs + ["".join(rng.choice(letters, int(n))) for n in rng.integers(1, 24, 6000)]
    reader = Tokenizer.from_file(TOKENIZER)
    got = packing.Encoder(TOKENIZER).encode([t.encode() for t in texts])
    want = [e.ids for e in reader.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == want


@pytest.mark.parametrize("distance", [0, 1, 3, 6])
def test_rotated_index_finds_every_component(spark, monkeypatch, distance):
    """Chains over all bits, and a node so crowded that it is cut into many blocks."""
    monkeypatch.setattr(simhash, "BLOCK", 64)
    rng = np.random.default_rng(distance)
    seeds = rng.integers(0, 2**64, 300, np.uint64)
    crowded = np.uint64(0xABCD << 48) | rng.integers(0, 2**20, 700, np.uint64)
    prints = [seeds, crowded, np.array([0, 2**64 - 1], np.uint64)]
    for _ in range(4):
        flips = np.zeros(len(prints[-1] if len(prints[-1]) > 2 else seeds), np.uint64)
        for _ in range(distance):
            flips |= np.uint64(1) << rng.integers(0, 64, len(flips), np.uint64)
        prints.append((prints[-1] if len(prints[-1]) > 2 else seeds) ^ flips)
    prints = np.unique(np.concatenate(prints))
    table = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "print bigint")
    links = simhash._links(simhash._blocks(table, distance), distance).collect()
    place = {int(x): k for k, x in enumerate(prints.view(np.int64))}
    got, want = np.arange(len(prints)), np.arange(len(prints))
    simhash.merge(got, np.array([place[r.a] for r in links], int), np.array([place[r.b] for r in links], int))
    i, j = np.nonzero(np.bitwise_count(prints[:, None] ^ prints[None]) <= distance)
    simhash.merge(want, i, j)
    assert (got == want).all()
