"""Ordered windows over groups of any size.

A plain window puts a whole group into one task. The helpers here cut a frame
into *spans*: contiguous ranges of (group, order) of even size, so a group that
holds a third of all rows is spread over a third of the spans. Each operator
computes its window inside a span and then adds what earlier or later spans of
the same group contribute. At most two groups of a span reach over its edges,
so that correction table has at most two rows per span and may be broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.scratch import materialise

SPAN = "_span"
_SALT = "_span_salt"

Order = Sequence[tuple[str, str]]


def sort_columns(order: Order) -> list[Column]:
    """``[("a", "desc"), ("b", "asc")]`` as sort expressions."""
    directions = {"asc": F.asc, "desc": F.desc}
    return [directions[direction](name) for name, direction in order]


def span_count(stored: DataFrame) -> int:
    """As many spans as the stored input has scan tasks, so that they grow with it.

    The session's shuffle partitions are the least number.
    """
    least = int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, stored.rdd.getNumPartitions())


def split_into_spans(
    df: DataFrame, group: Sequence[str], order: Order, unique: bool
) -> DataFrame:
    """Add the span number, ascending with (group, order), one partition per span.

    Windows by span and group then need no further shuffle, and no two spans
    share a task by chance, as they would if their numbers were hashed. The input
    is stored first, as finding the ranges reads it once more.

    Rows equal in every sort column would all fall into one span; unless the
    caller knows (group, order) is ``unique``, a row id of the stored input
    breaks such ties. The id is taken from files, so a re-run task gets the
    same ids.
    """
    sort = [F.asc(g) for g in group] + sort_columns(order)
    stored = materialise(df, "spans-input")
    spans = span_count(stored)
    if not unique:
        stored = stored.withColumn(_SALT, F.monotonically_increasing_id())
        sort.append(F.asc(_SALT))
    return (
        stored.repartitionByRange(spans, *sort)
        .withColumn(SPAN, F.spark_partition_id())
        .drop(_SALT)
        .repartitionById(spans, F.col(SPAN))
    )


def join_edges(
    df: DataFrame, edges: DataFrame, group: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Attach an edge table (at most two rows per span) by span and group."""
    renamed = edges.select(
        F.col(SPAN).alias("_edge_span"),
        *[F.col(g).alias(f"_edge_{g}") for g in group],
        *columns,
    )
    match = F.col(SPAN) == F.col("_edge_span")
    for g in group:
        match = match & F.col(g).eqNullSafe(F.col(f"_edge_{g}"))
    return df.join(F.broadcast(renamed), match, "left").drop(
        "_edge_span", *[f"_edge_{g}" for g in group]
    )
