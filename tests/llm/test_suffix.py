"""Removal of repeated strings against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import suffix
from tidemark.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"


def slow_removal(docs, length=200):
    texts = [(doc, (text or "").encode()) for doc, text in docs]
    seen = Counter(t[i : i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = []
    for doc, t in texts:
        hit = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                hit[i : i + length] = b"\1" * length
        kept = bytes(b for b, h in zip(t, hit) if not h)
        runs = sum(h and not (i and hit[i - 1]) for i, h in enumerate(hit))
        out.append((doc, len(t), sum(hit), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows_of(found):
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return sorted((tuple(r[n] for n in names) for r in found.collect()), key=str)


def test_suffix_arrays_are_sorted():
    rng = np.random.default_rng(6)
    for size in [*range(1, 40), 300, 1000]:
        for kinds in (1, 2, 50):
            text = rng.integers(1, kinds + 1, size)
            order = suffix.suffix_array(text)
            assert order.tolist() == sorted(range(size), key=lambda i: text[i:].tolist())


def test_anchors_of_equal_strings_are_equal():
    rng = random.Random(2)
    text = bytes(rng.choices(b"ab", k=400)) + b"a" * 500 + bytes(rng.choices(b"abcd", k=400))
    data = np.frombuffer(text + text[100:900], np.uint8)
    place, value, first, last = suffix.strings_by_anchor(*suffix.anchors(data, 200, 64))
    assert first[0] == 0 and last[-1] == len(data) - 200
    assert (first[1:] == last[:-1] + 1).all()
    hashes = suffix.gram_hashes(data, 64)
    for p, v, a, b in zip(place, value, first, last):
        for i in range(a, b + 1):
            window = hashes[i : i + 137]
            assert p == i + window.argmin() and v == window.min()


@pytest.mark.parametrize("tasks", [1, 7])
def test_removal_equals_brute_force(spark, monkeypatch, tasks):
    monkeypatch.setattr(suffix, "CHUNK_BYTES", 3000)
    monkeypatch.setattr(suffix, "MAX_BROADCAST", 0 if tasks > 1 else 1000)
    spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
    rng = random.Random(tasks)

    def noise(n):
        return "".join(rng.choices("abcdefgh é", k=n))

    passages = [noise(n) for n in (199, 200, 201, 450, 700)]
    docs = []
    for k in range(60):
        parts = [noise(rng.randrange(300))]
        for _ in range(rng.randrange(4)):
            passage = rng.choice(passages)
            cut = rng.randrange(60)
            parts += [passage[cut:] if rng.random() < 0.4 else passage, noise(rng.randrange(90))]
        docs.append((k, "".join(parts)))
    docs += [(100 + k, docs[k][1]) for k in range(5)]  # copies
    docs += [(110, "x" * 199), (111, "x" * 199), (112, "y" * 200), (113, "z" * 201)]
    docs += [(114, passages[4] * 2), (115, "ab" * 400), (116, "\0" * 300 + "q"), (117, "short")]
    docs += [(118, None), (119, ""), (None, passages[3] + "!"), (120, noise(5000))]
    docs += [(117, "short"), (121, passages[4]), (121, passages[4])]
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id bigint, text string, digest int")
    try:
        assert rows_of(suffix.remove_repeats(frame)) == slow_removal(docs)
        assert suffix.remove_repeats(frame.limit(0)).count() == 0
        assert rows_of(suffix.remove_repeats(frame.where("doc_id = 110"))) == slow_removal(
            [(110, "x" * 199)]
        )
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "6")


def test_removal_over_the_documents_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    want = slow_removal([tuple(r) for r in docs])
    assert rows_of(QUERIES["op4_suffix_array_dedup"](spark, DATA)) == want
    assert sum(r[2] > 0 for r in want) > 5


@pytest.mark.parametrize("chunk", [3000, 1 << 20])
def test_no_task_holds_all_contexts_of_a_common_edge(spark, monkeypatch, chunk):
    monkeypatch.setattr(suffix, "HOT_CONTEXTS", 4, raising=False)
    monkeypatch.setattr(suffix, "CHUNK_BYTES", chunk)
    most, judged = [0], suffix._judged

    def spied(rows, *others):
        kinds = {}
        for row in rows.collect():
            values = np.frombuffer(row["anchors"], np.uint64).tolist()
            shapes = np.frombuffer(row["shapes"], np.int32).reshape(-1, 3)
            ends = np.cumsum(shapes[:, 2]).tolist()
            for value, (place, count, size), end in zip(values, shapes.tolist(), ends):
                text = row["text"][end - size : end]
                kinds.setdefault(value, set()).add((place, count, text))
        most[0] = max(map(len, kinds.values()), default=0)
        return judged(rows, *others)

    monkeypatch.setattr(suffix, "_judged", spied)
    rng = random.Random(5)

    def noise(n):
        return "".join(rng.choices("abcdefgh é", k=n))

    passage, pairs = noise(600), [noise(250) for _ in range(10)]
    docs = [(k, noise(250) + passage + noise(250)) for k in range(30)]
    # edges that differ but occur twice, and one edge many times in one text
    docs += [(40 + k, noise(50) + passage + pairs[k // 2] + noise(9)) for k in range(20)]
    docs += [(70, "".join(noise(90) + passage[:230] for _ in range(12))), (71, "ab" * 300)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert rows_of(suffix.remove_repeats(frame)) == slow_removal(docs)
    assert 0 < most[0] <= 4
