"""Shared lines, filter audits and hard negatives against brute force and SQL."""

from __future__ import annotations

import os
import re
from collections import defaultdict
from itertools import permutations

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.test_queries import TABLES, comparable
from tidemark.llm import audit, lines, negatives
from tidemark.llm.oracle import ORACLE
from tidemark.llm.queries import QUERIES

DATA = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    got = QUERIES[name](spark, DATA).toArrow()
    want = con.sql(ORACLE[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    assert len(got) == len(want) > 0
    assert comparable(got) == comparable(want)


# --- shared lines ------------------------------------------------------------

SPACE = " \t\n\x0b\x0c\r"


def line_key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(SPACE))


def slow_lines(rows, least, holders):
    held = defaultdict(list)
    for doc, text in rows:
        for key in {line_key(x) for x in (text or "").split("\n")}:
            if len(key) >= least:
                held[key].append(doc)
    keeper = {
        key: max((d for d in docs if d is not None), default=None)
        for key, docs in held.items()
        if len(docs) >= holders
    }
    out = []
    for doc, text in rows:
        own = (text or "").split("\n")
        kept = [
            x for x in own
            if doc is None or keeper.get(line_key(x)) is None or keeper[line_key(x)] == doc
        ]
        out.append((doc, "\n".join(kept), len(own), len(own) - len(kept)))
    return sorted(out, key=repr)


def deduped(spark, rows, **how):
    schema = "doc_id bigint, text string, digest string, id int, gone string, kind int"
    docs = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], schema)
    return sorted(map(tuple, lines.line_dedup(docs, **how).collect()), key=repr)


def test_shared_lines_of_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(lines, "CHUNK_BYTES", 500)
    common = "A line that very many documents share"
    rows = [(k, f"{common}\nown line of document number {k}\n{common.upper()} ") for k in range(40)]
    rows += [(100 + k, f"only twice in the whole table {k // 2}\nshort\nshort") for k in range(8)]
    rows += [(200, None), (201, ""), (202, "\n"), (203, "\n\n"), (204, f"\x0b{common}\r\n\x0c")]
    rows += [(205 + k, " " + common) for k in range(3)]  # no ASCII white space: another key
    rows += [(210 + k, "é" * n) for n in (19, 20) for k in range(3)]
    rows += [(220 + k, "ÄÖÜ is not lower-cased here" if k % 2 else "äöü is not lower-cased here") for k in range(6)]
    rows += [(300, f"said thrice in three rows of an id {k}") for k in (1, 1, 1)]
    rows += [(301, "said by two of one id, one of other"), (301, "said by two of one id, one of other\nand"), (302, "said by two of one id, one of other")]
    rows += [(None, f"{common}\nheld by nobody with an id") for _ in range(4)]
    rows += [(400 + k, "x" * 200_000 + "\n" + f"a long text of {k}\n" * 5000) for k in range(3)]
    rows += [(400 + k, "y" * 30) for k in range(4)]
    assert deduped(spark, rows) == slow_lines(rows, 20, 3)
    assert deduped(spark, rows, min_length=1, min_docs=2) == slow_lines(rows, 1, 2)
    assert deduped(spark, []) == []


def test_no_repeat_escapes_the_filters(monkeypatch):
    monkeypatch.setattr(lines, "SEGMENT_KEYS", 1 << 12)
    monkeypatch.setattr(lines, "SEGMENT_BITS", 16 << 12)
    rng = np.random.default_rng(1)
    keys = [rng.bytes(16) for _ in range(4000)]
    told = pa.table(
        {
            "id": pa.array([*range(4000), *range(200), None, None], pa.int64()),
            "digest": pa.array(keys + keys[:200] + keys[300:302], pa.binary()),
            "kind": pa.array([lines.ONCE] * 4200 + [lines.TWICE] * 2, pa.int8()),
        }
    )
    got = lines.suspects(told)
    found = defaultdict(int)
    for key in got.column("digest").to_pylist():
        found[key] += 1
    assert all(found[key] == 2 for key in keys[:200])
    assert all(found[key] == 1 for key in keys[300:302])
    assert len(found) - 202 < 4000 / 100  # few that are there once
    assert got.column("id").null_count == 0


# --- filter audit ------------------------------------------------------------


def fails(rows, k):
    doc, text = rows[k]
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    ids = [d for d, t in rows if (t or "") == text and d is not None]
    return {
        "A": len(words) < 100,
        "B": 100 * len(set(words)) < 80 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)),
        "E": doc is not None and doc > min(ids),
    }


def slow_audit(docs, labels):
    rows = [(d, t) for d, t, _ in docs]
    judged = []
    for k, (doc, _, lang) in enumerate(docs):
        own = [(q, t) for d, q, t in labels if d == doc and d is not None]
        judged.append((lang or "", fails(rows, k), any(q == 1 for q, _ in own), any(t == 1 for _, t in own)))
    out = []
    for part in {j[0] for j in judged}:
        mine = [j[1:] for j in judged if j[0] == part]
        share = defaultdict(int)
        steps = []
        for order in permutations("ABCDE"):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [j for j in left if j[0][letter]]
                failing = [j for j in mine if j[0][letter]]
                left = [j for j in left if not j[0][letter]]
                only = sum(sum(j[0].values()) == 1 for j in failing)
                share[letter] += len(gone)
                lost = sum(j[1] for j in gone), sum(j[2] for j in gone)
                steps.append(
                    (part, "".join(order), step, len(left), len(gone), len(failing) - len(gone), only, *lost)
                )
        out += [(*s, share[s[1][s[2] - 1]]) for s in steps]
    return sorted(out)


def audited(spark, docs, labels):
    schema = "doc_id bigint, text string, lang string, mask int, part string, good int"
    docs = spark.createDataFrame([(*r, 1, "p", 0) for r in docs], schema)
    labels = spark.createDataFrame(
        [(*r, "x") for r in labels], "doc_id bigint, quality int, toxic int, lang string"
    )
    return sorted(map(tuple, audit.audit(audit.filter_masks(docs, labels)).collect()))


def test_audit_of_awkward_rows(spark):
    rng = np.random.default_rng(3)
    words = ["alpha", "BETA", "g#mma", "delta", "Epsilon", "é", "z|"]
    docs = []
    for k in range(60):
        size = int(rng.integers(0, 160))
        text = " ".join(f"w{j}" if rng.random() < 0.7 else str(rng.choice(words)) for j in range(size))
        docs.append((k, text, ["en", "de", "", None][k % 4]))
    docs += [(100 + k, docs[3][1], "en") for k in range(40)]  # a large group of copies
    docs += [(200, None, "xx"), (201, "", "xx"), (202, " \t\x0b", "xx"), (203, "ÄÖ " * 200, None)]
    docs += [(None, docs[3][1], "en"), (None, docs[3][1], "en"), (None, None, None)]
    docs += [(3, docs[3][1], "en"), (5, "SOMETHING else", "en"), (300, "word " * 300_000, "de")]
    labels = [(k, k % 2, k % 3 == 0) for k in range(0, 120, 2)]
    labels = [(k, q, int(t)) for k, q, t in labels] + [(3, 0, 1), (3, 1, None), (4, None, None), (None, 1, 1), (999, 1, 1)]
    assert audited(spark, docs, labels) == slow_audit(docs, labels)
    assert audited(spark, [], labels) == []
    assert len(audited(spark, [(1, "x", "en")], [])) == 600


def test_words_of_long_texts(monkeypatch):
    monkeypatch.setattr(audit, "PIECE", 7)
    for text in (b"", b"   ", b"a" * 50, b"one two  three one\ttwo four\x0bfive ", b"1234567 1234567", b"123456 7 1"):
        words = text.split()
        assert audit.word_counts(text) == (len(words), len(set(words)))


def test_min_plus_product():
    rng = np.random.default_rng(5)
    masks = np.where(rng.random((9, 4)) < 0.5, 0.0, np.inf)
    steps = rng.permuted(np.tile(np.arange(1.0, 5)[:, None], 6), axis=0)
    want = (masks[:, :, None] + steps[None]).min(axis=1)
    assert (audit.removal_steps(masks, steps) == want).all()


# --- hard negatives ----------------------------------------------------------


def slow_negatives(rows, every, positives, count, low, high):
    kept = {}
    for vec, vector, label in rows:
        if vec is None or label is None or vector is None:
            continue
        if any(x is None or not np.isfinite(x) for x in vector):
            continue
        whole = [int(np.floor(256 * float(np.float32(x)))) for x in vector]
        kept[vec] = min(kept.get(vec, (label, whole)), (label, whole))
    out = []
    for a in sorted(v for v in kept if v % every == 0):
        label, own = kept[a]
        scored = sorted(
            (-sum(x * y for x, y in zip(own, q)), v, other)
            for v, (other, q) in kept.items()
            if v != a
        )
        for p_score, p, _ in [s for s in scored if s[2] == label][:positives]:
            hard = [
                (v, -s) for s, v, other in scored
                if other != label and low * -p_score <= 100 * -s <= high * -p_score
            ]
            out += [(a, p, r, v, -p_score, s) for r, (v, s) in enumerate(hard[:count], 1)]
    return sorted(out)


def mined(spark, rows, every, **how):
    schema = "vec_id bigint, embedding array<float>, label int, norm double, id string, q int"
    vectors = spark.createDataFrame([(*r, 1.0, "x", 2) for r in rows], schema)
    found = negatives.hard_negatives(vectors, F.col("vec_id") % every == 0, **how)
    return sorted(map(tuple, found.collect()))


def test_negatives_of_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ANCHOR_BYTES", 4000)  # several passes
    monkeypatch.setattr(negatives, "WINDOW", 16)
    monkeypatch.setattr(negatives, "SCORES", 100)
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(4, 6))
    rows = [
        (k, (centres[k % 4] + rng.normal(size=6) * (0.1, 0.8)[k % 2]).tolist(), int(k % 3))
        for k in range(240)
    ]
    rows += [(300 + k, [0.5, 0.5, 0.0, 0.0, 0.0, 0.0], k % 2) for k in range(120)]  # one hot vector
    rows += [(500, [0.0] * 6, 0), (501, [], 1), (502, None, 1), (503, [1.0] * 6, None), (None, [1.0] * 6, 1)]
    rows += [(504, [float("nan")] * 6, 1), (505, [float("inf")] + [1.0] * 5, 1), (506, [None] + [1.0] * 5, 1)]
    rows += [(510, [1.0, 2.0], 0), (520, [1.0, 2.0, 0.5, 0.0, 0.0, 0.0, 9.0], 1), rows[7], rows[10], (20, [1.0] * 6, 0)]
    rows += [(530, [3000.0, -2.0, 1.0], 2), (540, [-1.0] * 6, 9)]
    assert mined(spark, rows, 10) == slow_negatives(rows, 10, 5, 3, 50, 95)
    assert mined(spark, rows, 7, positives=2, negatives=4, low=0, high=100) == slow_negatives(rows, 7, 2, 4, 0, 100)
    assert mined(spark, [], 10) == []
    assert mined(spark, [(0, [1.0], 1)], 10) == []
    assert mined(spark, [(0, [], 1), (1, [], 1), (2, [], 2)], 10) == [(0, 1, 1, 2, 0, 0)]


def test_bounds_hold_every_score():
    rng = np.random.default_rng(9)
    for width, spread in ((3, 0.01), (8, 0.3), (64, 1.0)):
        centre = rng.normal(size=width)
        values = np.floor(256 * (centre + spread * rng.normal(size=(40, width))))
        values[0] = 0
        values[1] = -values[2]
        norms = np.linalg.norm(values, axis=1)
        references = negatives.directions(values, 5)
        turned = negatives.angles(values, norms, references)
        ids = np.arange(len(values))
        everyone = negatives.Anchors(ids, ids, values, norms, turned)
        for first, last in ((0, 40), (2, 3), (10, 20), (1, 3)):
            least, most = negatives.bounds(everyone, everyone.part(first, last))
            scores = values @ values[first:last].T
            assert (scores >= least[:, None]).all() and (scores <= most[:, None]).all()


def test_angles_spare_scores(spark):
    """Rows in tight bunches: most windows are not scored."""
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(20, 32))
    values = np.floor(256 * np.repeat(centres, 200, axis=0) + rng.normal(size=(4000, 32)))
    norms = np.linalg.norm(values, axis=1)
    turned = negatives.angles(values, norms, negatives.directions(values[::7], 16))
    ids = np.arange(4000)
    everyone = negatives.Anchors(ids, ids, values, norms, turned)
    anchors = everyone.part(0, 200)
    floor = (values[:200] ** 2).sum(axis=1) * 0.8
    reached = [
        (negatives.bounds(anchors, everyone.part(k, k + 200))[1] >= floor).mean()
        for k in range(0, 4000, 200)
    ]
    assert reached[0] == 1 and np.mean(reached) < 0.3
