"""What changed between two states of a table that is rewritten."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.upsert import row_digest
from tidemark.scratch import materialise

CHANGE = "_change"
INSERT, UPDATE, DELETE = "insert", "update", "delete"


def change_feed(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows that came, changed or went, with ``_change`` saying which.

    Keys are unique in both states; a null in a key equals a null. Rows that came or
    changed are those of ``after``, rows that went those of ``before``; a column that
    only one state has is null in the rows of the other, and makes no change by
    itself. The states meet by key and 128-bit digest of the row, so only changed
    rows travel whole.
    """
    shared = [c for c in after.columns if c in before.columns]
    old, new = (
        df.select(*[F.col(k).alias(f"{side}_{k}") for k in keys], row_digest(shared).alias(side))
        for df, side in ((before, "_old"), (after, "_new"))
    )
    same_key = [F.col(f"_old_{k}").eqNullSafe(F.col(f"_new_{k}")) for k in keys]
    change = (
        F.when(F.col("_old").isNull(), INSERT)
        .when(F.col("_new").isNull(), DELETE)
        .when(F.col("_old") != F.col("_new"), UPDATE)
    )
    here = F.col("_new").isNotNull()
    changed = old.join(new, same_key, "full").select(
        *[F.when(here, F.col(f"_new_{k}")).otherwise(F.col(f"_old_{k}")).alias(f"_key_{k}") for k in keys],
        change.alias(CHANGE),
    )
    changed = materialise(changed.filter(F.col(CHANGE).isNotNull()), "changes")

    def rows_of(state: DataFrame, wanted) -> DataFrame:
        match = [state[k].eqNullSafe(F.col(f"_key_{k}")) for k in keys]
        found = state.join(changed.filter(wanted), match, "inner")
        return found.select(*state.columns, CHANGE)

    gone = F.col(CHANGE) == DELETE
    return rows_of(after, ~gone).unionByName(rows_of(before, gone), allowMissingColumns=True)


def taken(feed: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """The rows of those kinds, as rows of the table; the other changes are skipped."""
    return feed.filter(F.col(CHANGE).isin(list(kinds))).drop(CHANGE)
