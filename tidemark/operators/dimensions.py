"""Type 1 dimension: one row per business key, overwritten in place."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.cleaning import Preference, keep_first
from tidemark.operators.keys import dense_keys, max_key
from tidemark.operators.upsert import row_digest
from tidemark.scratch import materialise

CREATED = "create_date"
UPDATED = "update_date"


def _run_time(source: DataFrame, run_ts: dt.datetime | None) -> Column:
    """One constant for the whole run; later reads must not see a later clock."""
    if run_ts is None:
        run_ts = source.sparkSession.sql("SELECT current_timestamp()").first()[0]
    return F.lit(run_ts).cast("timestamp")


def first_type1_load(
    source: DataFrame,
    key: str,
    surrogate: str,
    run_ts: dt.datetime | None = None,
    order: Preference = (),
) -> DataFrame:
    now = _run_time(source, run_ts)
    rows = keep_first(source.dropna(subset=[key]), [key], order)
    dated = rows.withColumns({CREATED: now, UPDATED: now})
    return dense_keys(dated, [key], surrogate)


def apply_type1(
    target: DataFrame,
    source: DataFrame,
    key: str,
    surrogate: str,
    run_ts: dt.datetime | None = None,
    order: Preference = (),
    only_changed: bool = False,
    after: Column | None = None,
) -> DataFrame:
    """The dimension after one load of ``source``.

    Known keys keep their surrogate key and create date and take the source's
    attributes; new keys get the next surrogate keys; target rows the source
    does not mention stay. ``only_changed`` leaves the update date of rows whose
    attributes are the same. ``after`` is the highest surrogate key in use, if
    ``target`` is a part of the dimension.

    Source and target meet in one full join on the business key, unique on both
    sides. Its result is stored split by new and known, so that numbering the
    new rows does not run the join again.
    """
    attributes = [c for c in source.columns if c != key]
    housekeeping = [surrogate, CREATED, UPDATED]
    if set(target.columns) != {key, *attributes, *housekeeping}:
        raise ValueError(
            f"target columns {target.columns} do not fit source {source.columns}"
        )
    now = _run_time(source, run_ts)
    rows = keep_first(source.dropna(subset=[key]), [key], order)
    old = target.select(*[F.col(c).alias(f"_old_{c}") for c in target.columns])
    both = rows.withColumn("_in_source", F.lit(True)).join(
        old, F.col(key) == F.col(f"_old_{key}"), "full"
    )

    in_source = F.coalesce(F.col("_in_source"), F.lit(False))
    same = F.lit(False)
    if only_changed:
        same = row_digest(attributes).eqNullSafe(row_digest(attributes, "_old_"))
    touched = in_source & ~same
    merged = both.select(
        F.coalesce(F.col(key), F.col(f"_old_{key}")).alias(key),
        *[
            F.when(in_source, F.col(c)).otherwise(F.col(f"_old_{c}")).alias(c)
            for c in attributes
        ],
        F.coalesce(F.col(f"_old_{CREATED}").cast("timestamp"), now).alias(CREATED),
        F.when(touched, now).otherwise(F.col(f"_old_{UPDATED}")).alias(UPDATED),
        F.col(f"_old_{surrogate}").cast("bigint").alias(surrogate),
        F.col(f"_old_{surrogate}").isNull().alias("_is_new"),
    )
    stored = materialise(merged, "type1", partition_by=["_is_new"])
    known = stored.filter(~F.col("_is_new")).drop("_is_new")
    new = stored.filter("_is_new").drop("_is_new", surrogate)
    highest = max_key(target, surrogate) if after is None else after
    keyed = dense_keys(new, [key], surrogate, after=highest)
    return known.unionByName(keyed).select(*target.columns)
