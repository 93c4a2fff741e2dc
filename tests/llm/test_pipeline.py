"""The pipeline against brute force, stage by stage and whole."""

from __future__ import annotations

import re
from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.test_text_operators import (
    DATA,
    TOKENIZER,
    check_packed,
    slow_components,
    slow_fingerprint,
    slow_matches,
)
from tidemark.llm.filters import RANKED, ROW, numbered, without

STAGES = dict(corpus_pipeline.STAGES)


def slow_stages(rows, items):
    """What each of the first four stages keeps, by whole rows ``(doc_id, text, ...)``."""
    rank = lambda k: (rows[k][0] is None, rows[k][0] or 0, k)
    text = {k: row[1] or "" for k, row in enumerate(rows)}
    kept = [k for k in text if any(c.isalpha() for c in text[k])]
    yield kept
    first = {}
    for k in sorted(kept, key=lambda k: (-len(text[k]), rank(k))):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text[k]), k)
    kept = [k for k in kept if k in first.values()]
    yield kept
    order = sorted(kept, key=rank)
    roots = slow_components({place: slow_fingerprint(text[k]) for place, k in enumerate(order)})
    kept = [k for place, k in enumerate(order) if roots[place] == place]
    yield kept
    hits = slow_matches([(k, text[k]) for k in kept], items)
    yield [k for k, n, hit, _, _ in hits if not (hit > 0 and 20 * hit >= n)]


def benchmark_items(spark):
    return [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]


def awkward_rows(items):
    words = [f"word{k}" for k in range(400)]
    near = " ".join(words)
    rows = [
        (1, "clean text about rivers", "a"),
        (1, "12 34", "a"),  # rejected; the row above has its id and stays
        (2, "the same row twice over", "b"),
        (2, "the same row twice over", "b"),
        (None, "no id but clean and alone", None),
        (None, "no id and copied", "c"),
        (None, "no id  and copied", "c"),
        (None, "...", "c"),
        (7, "the same row  twice over", "b"),  # the longest copy of id 2
        (8, None, None),
        (9, "", "x"),
        (11, near, "x"),
        (10, near + " word1", "x"),
        (None, near + " word2", "x"),
        (11, "another text of the id eleven", "x"),
        (12, items[0][1], "bench"),
        (None, items[1][1] + " no id", "bench"),
        (12, "a clean text with the id of a contaminated one", "x"),
        (13, "word " * 20_000, "long"),
    ]
    return [row + (k, b"f", 0.5) for k, row in enumerate(rows)]


SCHEMA = "doc_id bigint, text string, lang string, n int, file binary, place double"


@pytest.mark.parametrize("files", [1, 4])
def test_stages_decide_by_row(spark, tmp_path, files):
    items = benchmark_items(spark)
    rows = awkward_rows(items)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(files, "n")
    frame.write.parquet(f"{tmp_path}/0")
    docs = spark.read.parquet(f"{tmp_path}/0")
    stages = corpus_pipeline.STAGES[:4]
    for number, ((name, stage), kept) in enumerate(zip(stages, slow_stages(rows, items))):
        stage(spark, docs, DATA).write.parquet(f"{tmp_path}/{number + 1}")
        docs = spark.read.parquet(f"{tmp_path}/{number + 1}")
        assert docs.columns == frame.columns, name
        found = [tuple(r) for r in docs.orderBy("n").collect()]
        # of rows that differ in nothing that is read, either may stay
        short = [(*r[:3], r[4:]) for r in found]
        assert Counter(short) == Counter((*rows[k][:3], rows[k][4:]) for k in kept), name
    ids = {r[0] for r in found}
    assert {1, 7, None} <= ids and len(found) > 5
    tokens = STAGES["packing"](spark, docs, DATA).agg(F.sum("length")).first()[0]
    reader = Tokenizer.from_file(TOKENIZER)
    assert tokens == sum(len(reader.encode(r[1], add_special_tokens=False).ids) + 1 for r in found)


def test_pipeline_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    kept = list(slow_stages(rows, benchmark_items(spark)))[-1]
    assert 0 < len(kept) < len(rows)
    reader = Tokenizer.from_file(TOKENIZER)
    tokens = {
        rows[k][0]: reader.encode(rows[k][1], add_special_tokens=False).ids + [1] for k in kept
    }
    found = corpus_pipeline.run(spark, DATA).withColumn("ids_crc32", F.crc32("ids"))
    assert check_packed(found.collect(), tokens) > 0.97


def test_empty_documents_pass_all_stages(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/0")
    docs = spark.read.parquet(f"{tmp_path}/0")
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, DATA)
        assert found.count() == 0, name
        assert name == "packing" or found.columns == docs.columns


def test_rows_have_names_of_their_own(spark):
    frame = spark.createDataFrame([(None, "a")] * 5 + [(3, "a")] * 5, "doc_id bigint, text string")
    named = numbered(frame)
    assert named.select(ROW).distinct().count() == named.select(RANKED).distinct().count() == 10
    least = named.agg(F.min(RANKED)).first()[0]
    assert least["id"] == 3
    gone = named.where(F.col(ROW) == F.lit(least["place"]))
    assert without(named, gone.select(RANKED)).count() == 9
    assert without(named, gone.select(ROW)).columns == frame.columns
