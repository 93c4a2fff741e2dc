"""Raw documents to training sequences, stage by stage.

Every stage takes what its predecessor kept, decides over all of it, and hands on
the rows that stay with all their columns; the last one returns token windows.
Decisions are about rows, not ids: rows that share an id are decided each for itself,
of repeated rows one stays, and rows without an id are decided like others. Where
several rows may stay the one with the smallest id does, and one without only if none
has an id.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.exact_dedup import exact_duplicates
from tidemark.llm.filters import RANKED, ROW, numbered, without
from tidemark.llm.langid import UNKNOWN, predict
from tidemark.llm.packing import pack
from tidemark.llm.phrases import contamination, phrase_matches
from tidemark.llm.queries import language_model
from tidemark.llm.simhash import near_duplicates
from tidemark.llm.workers import with_package
from tidemark.scratch import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; texts without a letter go."""
    with_package(spark)
    docs = numbered(docs)
    found = predict(docs, language_model(docs), id_col=ROW)
    return without(docs, found.where(F.col("lang_pred") == UNKNOWN))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts equal but for white space."""
    docs = numbered(docs)
    return without(docs, exact_duplicates(docs, id_col=RANKED).where("NOT kept"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by fingerprints three bits apart."""
    with_package(spark)
    docs = numbered(docs)
    groups = near_duplicates(docs, id_col=RANKED, words=3, distance=3)
    return without(docs, groups.where(F.col(RANKED) != F.col("component_id")))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with less than a twentieth of their words from the benchmark."""
    with_package(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    docs = numbered(docs)
    matches = phrase_matches(docs, items, id_col=ROW, window=13)
    return without(docs, contamination(matches, share=20).where("contaminated"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows over every document that is left."""
    with_package(spark)
    # workers still hold memory of earlier stages, and the next run's find theirs
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return pack(docs, tokenizer, remembered=150_000, forget=True)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("decontamination", decontaminated),
    ("packing", packed),
]

# a fitted model, a tokenizer and a graph search are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
