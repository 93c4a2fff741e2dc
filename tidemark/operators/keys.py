"""Dense surrogate keys without a one-task window over the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.scratch import materialise

# monotonically_increasing_id keeps the partition above 33 bits of row number
_ROW_BITS = 33


def stamped_ranges(df: DataFrame, sort: Sequence[Column | str], label: str) -> DataFrame:
    """The rows range-partitioned and sorted, stored with ``_part`` and ``_place``.

    ``_part`` rises with the ranges, ``_place`` counts from 0 in each.
    """
    stamp = F.monotonically_increasing_id()
    stamped = (
        df.repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .withColumn("_row_id", stamp)
        .withColumn("_part", F.shiftright("_row_id", _ROW_BITS).cast("int"))
        .withColumn("_place", F.col("_row_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
    )
    return materialise(stamped.drop("_row_id"), label)


def dense_keys(
    df: DataFrame, by: Sequence[str], out: str, after: Column | int = 0
) -> DataFrame:
    """Number the rows ``after + 1 …`` in the order of ``by``, which must be unique.

    Rows are range-partitioned and sorted; a row's key is its place in its
    partition plus the row count of the partitions before it. The only
    unpartitioned window runs over those counts, one row per partition.
    """
    stored = stamped_ranges(df, by, "dense-keys")
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        stored.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            F.col("_part"),
            F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        )
    )
    start = after if isinstance(after, Column) else F.lit(after)
    # bounded broadcast: one row per shuffle partition
    return stored.join(F.broadcast(offsets), "_part").select(
        *df.columns,
        (start.cast("bigint") + F.col("_before") + F.col("_place") + 1).alias(out),
    )


def max_key(existing: DataFrame, key: str) -> Column:
    """Highest key in use as a scalar subquery; 0 for an empty table."""
    return F.coalesce(existing.agg(F.max(key).alias("m")).scalar(), F.lit(0))


def add_new_keys(
    existing: DataFrame, new: DataFrame, by: Sequence[str], key: str
) -> DataFrame:
    """Known rows keep their key; ``new`` rows get the following ones."""
    keyed = dense_keys(new, by, key, after=max_key(existing, key))
    return existing.unionByName(keyed)
