"""Streams into the product dimension: staging with expectations, then versions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.cleaning import BATCH
from tidemark.operators.feed import change_feed, taken
from tidemark.operators.history import END, START, apply_changes
from tidemark.operators.quality import expect_all_or_drop, expectation_counts
from tidemark.scratch import materialise, names_in
from tidemark.sources.tables import (
    BUCKET,
    BUCKETS,
    bucket_count,
    empty_like,
    origin,
    overwrite_partitions,
    publish,
    publish_buckets,
    show_batches,
    stream_table,
    table_exists,
    table_root,
    touched_buckets,
    with_bucket,
)

# The rules a product must pass.
PRODUCT_RULES = {
    "rule1": "product_id IS NOT NULL",
    "rule2": "product_name IS NOT NULL",
}

COUNTS = T.StructType(
    [
        T.StructField("rows_checked", T.LongType()),
        T.StructField("rule", T.StringType()),
        T.StructField("failures", T.LongType()),
    ]
)


def expectations_of(stage: str) -> str:
    """The table that says how many rows of each batch broke which rule."""
    return f"{stage}_expectations"


def publish_with_feed(df: DataFrame, table: str, feed: str, keys: Sequence[str]) -> int:
    """Rewrite ``table`` as ``df`` and add what that changes to the ``feed`` table.

    The feed only grows, so a stream can follow a table that is overwritten by every
    load. A load stopped between the two writes notes its changes once more.
    """
    spark = df.sparkSession
    stored = materialise(df, "rewritten")
    before = spark.table(table) if table_exists(spark, table) else stored.limit(0)
    changes = change_feed(before, stored, keys)
    home = f"{table_root(spark, feed)}/data"
    number = len([n for n in names_in(spark, home) if n.startswith(f"{BATCH}=")])
    changes.write.mode("overwrite").parquet(f"{home}/{BATCH}={number}")
    show_batches(spark, feed, changes.schema, home, BATCH)
    return publish(stored, table)


def stage_table(
    spark: SparkSession,
    source: str,
    stage: str,
    rules: Mapping[str, str],
    kinds: Sequence[str] | None = None,
) -> DataFrame:
    """Stream the rows ``source`` gained into the ``stage`` table.

    The source only grows. If it is a change feed, ``kinds`` says which changes are
    taken and the others are skipped; otherwise every row is a change to be applied.
    A source replayed into a new folder is staged anew, also into a new folder.

    Rows that break a rule are dropped and counted. A batch is a partition of the
    stage and of ``expectations_of(stage)``, written under its number by plain
    aggregation: a batch that fails and is repeated overwrites what it had counted.
    """
    home = f"{table_root(spark, stage)}/of-{origin(spark, source)}"
    rows = stream_table(spark, source).drop(BATCH)
    if kinds is not None:
        rows = taken(rows, kinds)

    def take(batch: DataFrame, batch_id: int) -> None:
        counts = expectation_counts(batch, rules).select(*COUNTS.names)
        folder = f"{BATCH}={batch_id}"
        counts.write.mode("overwrite").parquet(f"{home}/expectations/{folder}")
        kept = expect_all_or_drop(batch, rules)
        kept.write.mode("overwrite").parquet(f"{home}/data/{folder}")

    query = (
        rows.writeStream.foreachBatch(take)
        .option("checkpointLocation", f"{home}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    show_batches(spark, expectations_of(stage), COUNTS, f"{home}/expectations", BATCH)
    return show_batches(spark, stage, rows.schema, f"{home}/data", BATCH)


def expectation_totals(spark: SparkSession, stage: str) -> DataFrame:
    """Rows checked and failures of each rule over all batches of a stage."""
    return (
        spark.table(expectations_of(stage))
        .groupBy("rule")
        .agg(F.sum("rows_checked").alias("rows_checked"), F.sum("failures").alias("failures"))
    )


def create_history_table(
    changes: DataFrame, table: str, keys: Sequence[str], sequence_by: str, buckets: int = BUCKETS
) -> None:
    """Declare an empty version table for the rows of ``changes`` if missing."""
    spark = changes.sparkSession
    if table_exists(spark, table):
        return
    empty = empty_like(spark, changes.schema).withColumn(START, F.col(sequence_by))
    if sequence_by not in keys:
        empty = empty.drop(sequence_by)
    open_end = F.lit(None).cast(empty.schema[START].dataType)
    publish_buckets(empty.withColumn(END, open_end), table, keys, buckets)


def merge_changes(batch: DataFrame, table: str, keys: Sequence[str], sequence_by: str) -> list[int]:
    """Apply a batch of changes to the buckets its keys fall into; returns these.

    The other buckets are neither read nor written. Changes delivered twice give the
    same table.
    """
    spark = batch.sparkSession
    own = with_bucket(batch.dropna(subset=list(keys)), keys, bucket_count(spark, table))
    stored = materialise(own, "changes")
    touched, held = touched_buckets(stored, table)
    if touched:
        versions = apply_changes(held, stored, keys, sequence_by)
        overwrite_partitions(versions, table, BUCKET)
    return touched


def apply_stream(
    changes: DataFrame,
    source: str,
    table: str,
    keys: Sequence[str],
    sequence_by: str,
    buckets: int = BUCKETS,
) -> None:
    """Apply the changes streamed from ``source`` to a version table.

    Changes delivered twice, after a failure or by a replayed source, give the same
    table. ``buckets`` counts for a table that is not there yet.
    """
    spark = changes.sparkSession
    progress = f"{table_root(spark, table)}_progress/of-{origin(spark, source)}"

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_changes(batch, table, keys, sequence_by)

    create_history_table(changes, table, keys, sequence_by, buckets)
    query = (
        changes.writeStream.foreachBatch(merge)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    spark.catalog.refreshTable(table)
