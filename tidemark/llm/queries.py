"""One query per operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import langid, toxicity, warc
from tidemark.llm.audit import audit, filter_masks
from tidemark.llm.exact_dedup import exact_duplicates
from tidemark.llm.lines import line_dedup
from tidemark.llm.negatives import hard_negatives
from tidemark.llm.packing import pack
from tidemark.llm.phrases import contamination, phrase_matches
from tidemark.llm.secrets import KINDS, find_secrets, of_kind, written
from tidemark.llm.sharding import shard
from tidemark.llm.simhash import near_duplicates
from tidemark.llm.suffix import remove_repeats
from tidemark.llm.workers import with_package

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(with_package(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


@query
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, distance=3)


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrase_matches(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=13
    )
    return contamination(found, share=20).select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    pieces = pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def remainder(column: str, of: int) -> Column:
    """A fixed fold of a row: the checksum of its id as text; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % of, F.lit(0))


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs, language_model(docs)).withColumn("held_out", in_language_test())
    return found.select("doc_id", "held_out", "lang_pred", "score")


def in_language_test() -> Column:
    return remainder("doc_id", 3) == 1


def language_model(docs: DataFrame) -> langid.Model:
    """A model fitted on two thirds of the labelled rows."""
    vocabulary = public_tokenizers.path("piece_bpe_32k.model")
    return langid.fit(docs, vocabulary, ~in_language_test())


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    def page(name: str) -> Column:
        number = F.regexp_extract(name, "^<urn:page:(.*)>$", 1)
        return F.nullif(number, F.lit("")).cast("bigint")

    return warc.archive(table(spark, sf_dir, "pages")).select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page("refers_to").alias("refers_to"),
    )


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 4) == 2
    net = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs, net).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"), shards=40).withColumns(
        {"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}
    )


@query
def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = KINDS[:3]
    counts = {f"n_{kind}": F.size(of_kind(kind)).cast("bigint") for kind in base}
    return find_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *[column.alias(name) for name, column in counts.items()],
        F.sha2(written(of_kind(*base)), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


@query
def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), length=200).drop("spans")


@query
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(table(spark, sf_dir, "documents"), min_length=20, min_docs=3)
    return found.withColumn("kept_sha256", F.sha2("text", 256)).drop("text")


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(filter_masks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
    vectors = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.coalesce(shifted, F.col("label"))
    )
    return hard_negatives(
        vectors, F.col("vec_id") % 50 == 0, positives=5, negatives=3, low=50, high=95
    )
