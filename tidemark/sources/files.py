"""Parquet files of a dataset: name patterns, their schemas, values that do not fit."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.cleaning import ARRIVED, RESCUED
from tidemark.scratch import names_in, read_text, write_text

# A file stream ignores files much older than the newest one it has seen, a week
# by default. Files may arrive late with their old date, so no age is too old.
ANY_AGE = {"maxFileAge": "36500d"}


def dataset_glob(folder: str, name: str) -> str:
    """Pattern for every delivery of a dataset: its name, or that, ``_`` and more."""
    return f"{folder.rstrip('/')}/{{{name},{name}_*}}.parquet"


def own_files(files: DataFrame, name: str, others: Sequence[str] = ()) -> DataFrame:
    """The rows whose ``path`` is one of the dataset's own files.

    ``others`` are datasets too; those whose names continue ``name``, as
    ``orders_archive`` does ``orders``, match its pattern without belonging to it.
    """
    longer = [re.escape(o) for o in others if o.startswith(f"{name}_")]
    if not longer:
        return files
    foreign = f"/({'|'.join(longer)})(_[^/]*)?\\.parquet(/|$)"
    return files.filter(~F.col("path").rlike(foreign))


# the file a row was read from, while its batch is made
_FILE = "_tidemark_file"


# --- schemas ------------------------------------------------------------------


def merged_schema(spark: SparkSession, paths: Sequence[str]) -> T.StructType | None:
    """Union of the files' columns, from one read of each footer by the cluster.

    None if a column has different types in them.
    """
    try:
        return spark.read.option("mergeSchema", "true").parquet(*paths).schema
    except (PySparkException, Py4JJavaError) as error:  # the latter in a stream's callback
        if "CANNOT_MERGE" not in str(error):
            raise
        return None


def by_schema(
    spark: SparkSession, paths: Sequence[str]
) -> Iterator[tuple[list[str], T.StructType]]:
    """The files in runs whose columns have one type each, and the columns of a run.

    Files that fit together are found by halving: where types change c times among
    n files, some c log n runs of footers are read again, otherwise none.
    """
    schema = merged_schema(spark, paths)
    if schema is not None:
        yield list(paths), schema
        return
    half = len(paths) // 2
    yield from by_schema(spark, paths[:half])
    yield from by_schema(spark, paths[half:])


class Ledger:
    """Which files' footers were read, and what they said.

    Kept beside a table, for all its generations: a replay and a repeated batch read
    no footer again. An entry is one small file with the files of one read.
    """

    def __init__(self, spark: SparkSession, location: str):
        self.spark, self.location = spark, location

    def _known(self, paths: Sequence[str]) -> dict[str, str]:
        if not names_in(self.spark, self.location):
            return {}
        noted = self.spark.read.schema("paths array<string>, schema string").json(self.location)
        wanted = self.spark.createDataFrame([(p,) for p in paths], "path string")
        entries = noted.select(F.explode("paths").alias("path"), "schema")
        found = entries.join(F.broadcast(wanted), "path", "left_semi")
        return {row["path"]: row["schema"] for row in found.collect()}

    def groups(self, paths: Sequence[str], label: str) -> list[tuple[list[str], T.StructType]]:
        """The files by schema; footers of files without an entry are read and noted.

        ``paths`` are the files of one batch, whose number is limited; ``label``
        names the entry.
        """
        known = self._known(paths)
        unread = [p for p in paths if p not in known]
        read = list(by_schema(self.spark, unread)) if unread else []
        if read:
            entries = [{"paths": own, "schema": schema.json()} for own, schema in read]
            text = "\n".join(map(json.dumps, entries))
            write_text(self.spark, text, f"{self.location}/{label}.json")
        for own, schema in read:
            known |= dict.fromkeys(own, schema.json())
        groups: dict[str, list[str]] = {}
        for path in paths:
            groups.setdefault(known[path], []).append(path)
        return [(own, T.StructType.fromJson(json.loads(text))) for text, own in groups.items()]

    def columns(self) -> T.StructType:
        """Union of the columns of all files, the type read first where several differ."""
        noted = self.spark.read.schema("paths array<string>, schema string").json(self.location)
        texts = [row["schema"] for row in noted.select("schema").distinct().collect()]
        return union_of_columns(T.StructType.fromJson(json.loads(t)) for t in sorted(texts))


def union_of_columns(schemas) -> T.StructType:
    """All columns in the order they come up, each with its first type."""
    found: dict[str, T.StructField] = {}
    for schema in schemas:
        for field in schema:
            found.setdefault(field.name.lower(), field)
    return T.StructType(list(found.values()))


def stored_schema(spark: SparkSession, location: str) -> T.StructType | None:
    """The schema declared by the first load, or None before it."""
    text = read_text(spark, f"{location}/declared.json")
    return None if text is None else T.StructType.fromJson(json.loads(text))


def store_schema(spark: SparkSession, schema: T.StructType, location: str) -> None:
    write_text(spark, schema.json(), f"{location}/declared.json")


# --- values that do not fit -----------------------------------------------------

_ORDERED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _castable(found: T.DataType, declared: T.DataType) -> bool:
    """Whether SQL knows a cast between the two; nested types are taken as they are only."""
    nested = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
    if isinstance(found, nested) or isinstance(declared, nested):
        return False
    if isinstance(declared, T.StringType):
        return not isinstance(found, T.BinaryType)
    if isinstance(found, T.StringType):
        return not isinstance(declared, T.BinaryType)
    numbers = isinstance(found, T.NumericType), isinstance(declared, T.NumericType)
    return all(numbers) or not any(numbers) and all(isinstance(t, _ORDERED) for t in (found, declared))


def fitted(column: Column, found: T.DataType, declared: T.DataType) -> tuple[Column, Column]:
    """The value in the declared type, null if it does not fit, and whether it fits.

    A number or a time fits only if casting it back gives it again, so 1.5 is no
    integer and no time of day becomes a date; a text fits if it can be read.
    """
    if found == declared:
        return column, F.lit(True)
    if not _castable(found, declared):
        return F.lit(None).cast(declared), column.isNull()
    value = column.try_cast(declared)
    fits = value.isNotNull()
    if isinstance(found, _ORDERED) and isinstance(declared, _ORDERED):
        fits = value.try_cast(found).eqNullSafe(column)
    fits = fits | column.isNull()
    return F.when(fits, value), fits


def conformed(
    df: DataFrame, declared: T.StructType, added: Sequence[str] = ()
) -> DataFrame:
    """The declared columns, and as JSON what a row has beside them.

    ``_rescued_data`` holds the columns that were not declared and the values that
    do not fit the declared type of their column; it is null if there are none.
    """
    found = {f.name.lower(): f for f in df.schema if f.name not in added}
    values, rescued = [], []
    for field in declared:
        own = found.pop(field.name.lower(), None)
        if own is None:
            values.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        column = F.col(f"`{own.name}`")
        value, fits = fitted(column, own.dataType, field.dataType)
        values.append(value.alias(field.name))
        if own.dataType != field.dataType:
            rescued.append(F.when(~fits, column).alias(field.name))
    rescued += [F.col(f"`{f.name}`") for f in found.values()]
    text = F.lit(None).cast("string")
    if rescued:
        text = F.nullif(F.to_json(F.struct(*rescued)), F.lit("{}"))
    return df.select(*values, text.alias(RESCUED), *added)


def delivery(name: str, file: Column) -> Column:
    """The delivery that a file of a dataset belongs to, which may be a folder of files."""
    return F.regexp_extract(file, f"/({re.escape(name)}(?:_[^/]*)?\\.parquet)(?:/|$)", 1)


def read_files(
    spark: SparkSession,
    groups: Sequence[tuple[list[str], T.StructType]],
    declared: T.StructType,
) -> DataFrame:
    """Files of several schemas as one frame of declared columns, with their ``file``."""
    frames = [
        conformed(
            spark.read.schema(schema).parquet(*paths).withColumn(_FILE, F.col("_metadata.file_path")),
            declared,
            [_FILE],
        )
        for paths, schema in groups
    ]
    rows = frames[0]
    for frame in frames[1:]:
        rows = rows.union(frame)
    return rows


def arrivals(name: str, listed: DataFrame) -> DataFrame:
    """``read, arrived``: every listed file, when its delivery was written, and its name.

    ``listed`` has ``file, modificationTime`` of the files of a batch, whose number is
    limited. Both belong to the files, so a replay orders rows as the loads one by one
    did.
    """
    told = listed.select(
        F.col("file").alias("read"), delivery(name, F.col("file")).alias("file"), "modificationTime"
    )
    written = F.min("modificationTime").over(W.partitionBy("file"))
    return told.select("read", F.struct(written.alias("delivered"), "file").alias("arrived"))


def with_arrival(rows: DataFrame, arrived: DataFrame) -> DataFrame:
    """``_arrived_at`` in place of the file, looked up by the file's whole path."""
    told = rows.join(F.broadcast(arrived), F.col(_FILE) == F.col("read"), "left")
    return told.withColumn(ARRIVED, F.col("arrived")).drop(_FILE, "read", "arrived")


def read_dataset(
    spark: SparkSession, folder: str, name: str, declared: T.StructType | None = None
) -> DataFrame:
    """All files of a dataset in one batch, what does not fit rescued."""
    listing = spark.read.format("binaryFile").load(dataset_glob(folder, name))
    paths = sorted(row["path"] for row in listing.select("path").collect())
    groups = list(by_schema(spark, paths))
    declared = declared or union_of_columns(schema for _, schema in groups)
    return read_files(spark, groups, declared).drop(_FILE)
