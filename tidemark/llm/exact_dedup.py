"""Exact duplicates: 128-bit content hash first, bytes inside a hash group second."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.scratch import materialise

# ASCII white space, deleted before texts are compared
WHITE_SPACE = r"[\x20\x09-\x0D]+"


def _hashed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Own columns only, so that no further column of ``docs`` can clash."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("id"),
        F.char_length(text).alias("length"),
        F.regexp_replace(text, WHITE_SPACE, "").alias("normal"),
    ).withColumn("hash", F.unhex(F.md5("normal")))


def _classes(hashed: DataFrame) -> DataFrame:
    """One row per distinct normalised text, found by hash and then by bytes.

    Copies meet in the map tasks already, so a group that holds a third of all
    rows reaches the shuffle as one row per task.
    """
    first = F.min(F.struct(-F.col("length"), F.col("id").isNull(), F.col("id")))
    return (
        hashed.groupBy("hash", "normal")
        .agg(F.count(F.lit(1)).alias("group_size"), first.alias("first"))
        .select(
            "hash",
            "normal",
            F.col("first.id").alias("keep_id"),
            "group_size",
            F.sha2("normal", 256).alias("text_sha256"),
        )
    )


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every row's group of equal texts and the row of that group which stays.

    Returns ``id_col, keep_id, group_size, kept, text_sha256``, one row per row
    of ``docs``. Texts are equal if they are so without ASCII white space; a
    null text is an empty one, and all empty texts are equal. The longest
    original stays, of equally long ones the smallest id; a null id loses to any
    other. Rows that repeat both id and text get the same answer. An empty table
    gives an empty result; other columns are not read.

    Two texts whose hashes collide are told apart by their bytes: grouping is by
    hash and text, and only hashes with several texts (none, unless somebody
    made them) need the text again when rows are matched to their group.
    """
    hashed = _hashed(docs, id_col, text_col)
    classes = materialise(
        _classes(hashed).select("hash", "keep_id", "group_size", "text_sha256"),
        "exact-classes",
    )
    collided = classes.groupBy("hash").count().where("count > 1").select("hash")
    matched = hashed.select("id", "hash").join(classes, "hash")
    if not collided.isEmpty():
        # told apart by their bytes; both sides hold only the collided hashes
        single = hashed.select("id", "hash").join(collided, "hash", "left_anti")
        shared = hashed.join(collided, "hash", "left_semi")
        matched = (
            single.join(classes, "hash")
            .drop("hash")
            .unionByName(
                shared.select("id", "hash", "normal")
                .join(_classes(shared), ["hash", "normal"])
                .drop("hash", "normal")
            )
        )
    return matched.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
