"""Rank functions per group (dense_rank, rank, row_number) and top-N per group.

Rows of one value share their rank and dense_rank, so these are found for the
different values, from how many rows have each, and joined back: the rows are not
sorted, and not shuffled either while the values are few. row_number sorts the rows
once, in ranges that cut groups anywhere, and counts on from range to range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.keys import stamped_ranges
from tidemark.operators.spans import (
    SPAN,
    Order,
    join_edges,
    sort_columns,
    split_into_spans,
)
from tidemark.scratch import materialise

_RANKS = ("row_number", "rank", "dense_rank")


def ranked(
    df: DataFrame,
    outputs: Mapping[str, str],
    partition: Sequence[str],
    order: Order,
    tie_breaker: Sequence[str] = (),
) -> DataFrame:
    """Add rank columns, e.g. ``{"dense_rank": "flag", "row_number": "row_flag"}``.

    ``rank`` and ``dense_rank`` order by ``order`` alone; ``row_number`` also by
    ``tie_breaker``, which must make the order total. Groups and values may have any
    number of rows. Ranks are bigint, as a group may outgrow an int. ``df`` is read
    more than once.
    """
    unknown = set(outputs) - set(_RANKS)
    if unknown:
        raise ValueError(f"not a rank function: {sorted(unknown)}")
    if "row_number" in outputs and not tie_breaker:
        raise ValueError("row_number needs tie_breaker columns for a total order")
    out = df
    if "row_number" in outputs:
        out = _numbered(out, partition, order, tie_breaker, outputs["row_number"])
    by_value = {name: outputs[name] for name in ("rank", "dense_rank") if name in outputs}
    if by_value:
        out = _ranked_by_value(out, by_value, partition, order)
    return out.select(*df.columns, *outputs.values())


def _joined(df: DataFrame, small: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``small``, which is stored, attached by ``columns``, nulls being equal.

    No side is broadcast by hint: Spark broadcasts what it finds small in the files,
    and otherwise splits the partitions of a hot value.
    """
    renamed = small.withColumnsRenamed({c: f"_of_{c}" for c in columns})
    match = F.lit(True)
    for c in columns:
        match = match & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return df.join(renamed, match).drop(*[f"_of_{c}" for c in columns])


def _ranked_by_value(df, outputs, partition, order) -> DataFrame:
    group, values = list(partition), [name for name, _ in order if name not in partition]
    counts = df.groupBy(*group, *values).agg(F.count(F.lit(1)).alias("_rows"))
    spread = split_into_spans(counts, group, order, unique=True)
    here = W.partitionBy(SPAN, *group).orderBy(*sort_columns(order))
    so_far = F.sum("_rows").over(here.rowsBetween(W.unboundedPreceding, -1))
    local = {"rank": F.coalesce(so_far, F.lit(0)) + 1, "dense_rank": F.row_number().over(here)}
    stored = materialise(
        spread.withColumns({f"_{n}": column.cast("bigint") for n, column in local.items()}),
        "value-counts",
    )
    chain = W.partitionBy(*group).orderBy(SPAN).rowsBetween(W.unboundedPreceding, -1)
    edges = (
        stored.groupBy(SPAN, *group)
        .agg(F.sum("_rows").alias("_in_span"), F.count(F.lit(1)).alias("_values"))
        .withColumn("_before_rank", F.sum("_in_span").over(chain))
        .withColumn("_before_dense_rank", F.sum("_values").over(chain))
        .filter(F.col("_before_rank").isNotNull())
    )
    before = [f"_before_{name}" for name in local]
    whole = join_edges(stored, edges, group, before).select(
        *group,
        *values,
        *[
            (F.coalesce(F.col(f"_before_{name}"), F.lit(0)) + F.col(f"_{name}")).alias(out)
            for name, out in outputs.items()
        ],
    )
    return _joined(df, materialise(whole, "value-ranks"), [*group, *values])


def _numbered(df, partition, order, tie_breaker, out) -> DataFrame:
    group = list(partition)
    sort = [*map(F.asc, group), *sort_columns(order), *map(F.asc, tie_breaker)]
    stored = stamped_ranges(df, sort, "row-numbers")
    chain = W.partitionBy(*group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    heads = (
        stored.groupBy("_part", *group)
        .agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(chain), F.lit(0)))
        .drop("_rows")
    )
    found = _joined(stored, materialise(heads, "row-heads"), ["_part", *group])
    number = F.col("_place") - F.col("_first") + F.col("_before") + 1
    return found.select(*df.columns, number.alias(out))


def top_n_per_group(
    df: DataFrame,
    n: int,
    partition: Sequence[str],
    order: Order,
    out: str,
) -> DataFrame:
    """Rows whose dense rank in the group is at most ``n``.

    The rank filter sits directly on the window, so Spark limits each group on
    the map side and a hot group never reaches one task whole.
    """
    window = W.partitionBy(*partition).orderBy(*sort_columns(order))
    return df.withColumn(out, F.dense_rank().over(window)).filter(F.col(out) <= n)
