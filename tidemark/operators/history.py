"""Type 2 history: one row per version, valid in [start, end)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.cleaning import ARRIVED, keep_first
from tidemark.operators.spans import SPAN, join_edges, split_into_spans
from tidemark.scratch import materialise

START = "__START_AT"
END = "__END_AT"


def build_versions(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    start: str = START,
    end: str = END,
) -> DataFrame:
    """Every change as a version that ends where the key's next change starts.

    Changes are ordered by ``sequence_by`` whatever their order of arrival. Several
    rows with one (key, sequence) are one change, corrected: the one delivered last
    counts, if rows say when they were. Keys are cut into spans, so one with any
    number of changes is not put into one task.
    """
    changes = changes.dropna(subset=[*keys, sequence_by])
    newest = [(ARRIVED, "desc")] if ARRIVED in changes.columns else []
    distinct = keep_first(changes, [*keys, sequence_by], newest)
    versions = _ended_by_span(distinct, list(keys), sequence_by, start, end)
    if sequence_by != start and sequence_by not in keys:
        versions = versions.drop(sequence_by)
    return versions


def _ended_by_span(distinct: DataFrame, keys, sequence_by, start, end) -> DataFrame:
    versions = distinct.withColumn(start, F.col(sequence_by))
    spread = split_into_spans(versions, keys, [(start, "asc")], unique=True)
    window = W.partitionBy(SPAN, *keys).orderBy(start)
    stored = materialise(
        spread.withColumn(end, F.lead(start).over(window)), "versions"
    )
    # the last version of a key in a span ends at the key's first one in the next
    edges = (
        stored.groupBy(SPAN, *keys)
        .agg(F.min(start).alias("_head"))
        .withColumn("_next", F.lead("_head").over(W.partitionBy(*keys).orderBy(SPAN)))
        .filter(F.col("_next").isNotNull())
    )
    joined = join_edges(stored, edges, keys, ["_next"])
    return joined.select(
        *versions.columns, F.coalesce(F.col(end), F.col("_next")).alias(end)
    )


def apply_changes(
    history: DataFrame | None,
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
) -> DataFrame:
    """The history after one batch of changes.

    Keys in the batch are rebuilt from all their changes, so late changes fall
    into place and a replayed batch changes nothing; other keys are kept. Versions
    keep when they were delivered, if the changes say so: a correction replaces its
    version, in whichever order the two are loaded.
    """
    batch = changes.withColumn(START, F.col(sequence_by))
    if sequence_by not in keys:
        batch = batch.drop(sequence_by)
    if history is None:
        return build_versions(batch, keys, START)
    touched = _touched_keys(batch, keys)
    recorded = history.join(touched, list(keys), "left_semi").drop(END)
    rebuilt = build_versions(recorded.unionByName(batch), keys, START)
    untouched = history.join(touched, list(keys), "left_anti")
    return untouched.unionByName(rebuilt).select(*history.columns)


def _touched_keys(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The batch's keys, stored.

    Spark splits a skewed join side only where both sides come straight from
    their shuffles; an aggregate in between would keep a hot key in one task.
    """
    return materialise(batch.select(*keys).dropna().distinct(), "touched-keys")


def current_versions(history: DataFrame, end: str = END) -> DataFrame:
    return history.filter(F.col(end).isNull())
