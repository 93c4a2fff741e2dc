"""Upsert: replace the rows whose key matches, insert the others, keep the rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.cleaning import Preference, keep_first


class DuplicateKeys(ValueError):
    """The source of an upsert has several rows for one key."""


def row_digest(
    columns: Sequence[str], prefix: str = "", schema: T.StructType | None = None
) -> Column:
    """128 bits of a row's values, for a comparison that moves no values.

    ``prefix`` is what the columns are called beside these names. With the ``schema``
    instants are digested as numbers, which takes a fraction of the time; both sides of
    a comparison have to be told theirs then.
    """
    kinds = {f.name: f.dataType for f in schema or ()}
    told = [_counted(F.col(f"{prefix}{c}"), kinds.get(c)).alias(c) for c in sorted(columns)]
    return F.unhex(F.md5(F.to_json(F.struct(*told), _EXACT)))


def _counted(column: Column, kind: T.DataType | None) -> Column:
    """Instants, in structs too, as microseconds since 1970; other values as they are."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.StructType) and len(kind):
        fields = [_counted(column[f.name], f.dataType).alias(f.name) for f in kind]
        return F.when(column.isNotNull(), F.struct(*fields))
    return column


# every field is written, and instants to the last microsecond
_EXACT = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def one_row_per_key(
    source: DataFrame,
    keys: Sequence[str],
    latest: Preference | None = None,
) -> DataFrame:
    """Check the source, or reduce it when ``latest`` gives an order to choose by.

    Rows with a null key never match and are all kept, as in a SQL merge.
    """
    has_null = F.lit(False)
    for key in keys:
        has_null = has_null | F.col(key).isNull()
    if latest is not None:
        return keep_first(source.filter(~has_null), keys, latest).unionByName(
            source.filter(has_null)
        )
    repeated = source.filter(~has_null).groupBy(*keys).count().filter("count > 1")
    example = repeated.limit(1).collect()
    if example:
        raise DuplicateKeys(f"several source rows for {example[0].asDict()}")
    return source


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    latest: Preference | None = None,
    unique: bool = False,
) -> DataFrame:
    """Target rows without a source row, and all source rows.

    ``unique`` skips the check of a source known to have one row per key.
    """
    missing = [c for c in target.columns if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    if not unique:
        source = one_row_per_key(source, keys, latest)
    source = source.select(*target.columns)
    untouched = target.join(source.select(*keys), list(keys), "left_anti")
    return untouched.select(*target.columns).unionByName(source)
