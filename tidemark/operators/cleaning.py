"""Column clean-up, filters and de-duplication."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED = "_rescued_data"
# when a row was delivered, and in which file; of rows with one key the newest counts
ARRIVED = "_arrived_at"
# the ingest batch that took a row; bronze tables are partitioned by it
BATCH = "_batch"


def drop_rescued(df: DataFrame) -> DataFrame:
    """The declared columns alone."""
    return df.drop(RESCUED, ARRIVED, BATCH)


def part_after(column: str, separator: str, index: int = 1) -> Column:
    """The ``index``-th part of a text, counted from 0; null when there is none."""
    parts = F.split(column, re.escape(separator), index + 2)
    return F.get(parts, F.lit(index))


def full_name(*columns: str) -> Column:
    """Parts joined by a blank; null if any part is null."""
    spaced = [F.col(columns[0])]
    for name in columns[1:]:
        spaced += [F.lit(" "), F.col(name)]
    return F.concat(*spaced)


def parsed_timestamp(column: str) -> Column:
    """Timestamp from text, date or timestamp; null for text that is none."""
    return F.try_to_timestamp(F.col(column))


def in_year(column: str, year: int) -> Column:
    """``year(column) = year`` as a range, which reaches the file scan."""
    first, following = dt.date(year, 1, 1), dt.date(year + 1, 1, 1)
    return (F.col(column) >= F.lit(first)) & (F.col(column) < F.lit(following))


def large_sales_of(df: DataFrame, year: int, above: float) -> DataFrame:
    return df.filter(in_year("order_date", year) & (F.col("amount") > above))


def without_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys)) if keys else df


def fill_nulls(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(values)) if values else df


# columns that rows are ordered by: a name rises, a pair says which way
Preference = Sequence[str | tuple[str, str]]


def _directions(order: Preference) -> list[tuple[str, str]]:
    pairs = [(o, "asc") if isinstance(o, str) else tuple(o) for o in order]
    if bad := [o for o in pairs if o[1] not in ("asc", "desc")]:
        raise ValueError(f"neither asc nor desc: {bad}")
    return pairs


def _falling(column: Column, kind: T.DataType) -> Column:
    """A value that rises where ``column`` falls; nulls come last."""
    if isinstance(kind, T.StructType):
        turned = F.struct(
            *[_falling(column[f.name], f.dataType).alias(f.name) for f in kind.fields]
        )
    elif isinstance(kind, T.IntegralType):
        turned = F.bitwise_not(column)
    elif isinstance(kind, T.DecimalType):
        turned = -column
    elif isinstance(kind, T.FractionalType):
        place = F.when(column.isNull(), 2).when(F.isnan(column), 0).otherwise(1)
        return F.struct(place.cast("byte").alias("place"), (-column).alias("turned"))
    elif isinstance(kind, T.BooleanType):
        turned = ~column
    elif isinstance(kind, T.DateType):
        turned = -F.unix_date(column)
    elif isinstance(kind, T.TimestampType):
        turned = -F.unix_micros(column)
    elif isinstance(kind, (T.StringType, T.BinaryType, T.TimestampNTZType)):
        # digits in reverse, and behind the end what is greater than any digit
        text = F.hex(column.cast("string") if isinstance(kind, T.TimestampNTZType) else column)
        digits = "0123456789ABCDEF"
        turned = F.concat(F.translate(text, digits, digits[::-1]), F.lit("G"))
    else:
        raise ValueError(f"no falling order of {kind.simpleString()}")
    return F.struct(column.isNull().alias("absent"), turned.alias("turned"))


def _turned_back(falling: Column, kind: T.DataType) -> Column | None:
    """The value that ``_falling`` was made of; None for types that cannot be had back."""
    turned = falling["turned"]
    if isinstance(kind, T.IntegralType):
        return F.bitwise_not(turned)
    if isinstance(kind, (T.DecimalType, T.FractionalType)):
        return (-turned).cast(kind)
    if isinstance(kind, T.BooleanType):
        return ~turned
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(-turned)
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(-turned)
    return None


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def keep_first(df: DataFrame, keys: Sequence[str], order: Preference) -> DataFrame:
    """One row per key, the first in ``order``, e.g. ``[("amount", "desc"), "line"]``.

    Columns not named break ties, so the surviving row never depends on
    partitioning. It is the least row of its key, which Spark finds by partial
    aggregation: copies of a hot key leave a map task as one row. Columns that have
    no order, such as maps, are compared by their JSON text. A value that falls is
    carried once, turned, where it can be turned back.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(list(keys))
    kinds = {f.name: f.dataType for f in df.schema}
    rank, named, back = [], set(), {}
    odd = [c for c in rest if not _orderable(kinds[c])]
    for number, (name, direction) in enumerate(_directions(order)):
        if direction == "desc":
            rank.append(_falling(F.col(name), kinds[name]).alias(f"_rank{number}"))
            value = _turned_back(F.col("_first")[f"_rank{number}"], kinds[name])
            if value is not None and not odd and name in rest and name not in named:
                back[name] = value
                named.add(name)
        elif name not in keys and name not in named:
            rank.append(F.col(name))
            named.add(name)
    plain = [c for c in rest if c not in named and c not in odd]
    if odd:
        text = F.to_json(F.struct(*odd)).alias("_text")
        first = F.min_by(F.struct(*rest), F.struct(*rank, *plain, text))
    else:
        first = F.min(F.struct(*rank, *plain))
    kept = df.groupBy(*keys).agg(first.alias("_first"))
    return kept.select(
        *[
            F.col(c) if c in keys else back.get(c, F.col("_first")[c]).alias(c)
            for c in df.columns
        ]
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, matched by column name, duplicates kept."""
    return reduce(DataFrame.unionByName, frames)


def union_distinct_on(
    frames: Sequence[DataFrame], keys: Sequence[str], order: Preference = ()
) -> DataFrame:
    """Split files put together again, one row per key.

    ``order`` says which row of a key counts, then the later of the frames does.
    """
    numbered = [df.withColumn("_frame", F.lit(n)) for n, df in enumerate(frames)]
    return keep_first(union_all(numbered), keys, [*order, ("_frame", "desc")]).drop("_frame")


@dataclass(frozen=True)
class Rules:
    """What the rows of a dataset have to meet, and how its values are written."""

    required: Sequence[str] = ()
    positive: Sequence[str] = ()
    dates: Sequence[str] = ()
    trimmed: Sequence[str] = ()
    defaults: Mapping[str, object] = field(default_factory=dict)


# The columns and the default of the batch load's datasets.
BATCH_RULES = {
    "customers": Rules(required=["customer_id"], trimmed=["customer_name"]),
    "orders": Rules(
        required=["order_id", "customer_id", "amount"],
        positive=["amount"],
        dates=["order_date"],
    ),
    "products": Rules(required=["product_id"], defaults={"category": "Uncategorized"}),
}


def cleaned(df: DataFrame, rules: Rules) -> DataFrame:
    """The rows that meet ``rules``, with their values written as the rules say."""
    rewritten = {c: F.to_date(c) for c in rules.dates}
    rewritten |= {c: F.trim(c) for c in rules.trimmed}
    kept = without_null_keys(df, rules.required)
    for measure in rules.positive:
        kept = kept.filter(F.col(measure) > 0)
    return fill_nulls(kept.withColumns(rewritten), rules.defaults)
