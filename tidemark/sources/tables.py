"""Catalog tables over Parquet: scans, overwrites and merges by Spark's own writers.

What replaces a table is computed into the shared folder first, so it may read the
table itself and a failed computation changes nothing. Then Spark overwrites the
table, or those of its partitions that the rows fall into. One writer per table is
assumed, and readers are not kept from a table while it is overwritten; of a load
stopped just then, the rows still lie in the shared folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.cleaning import Preference
from tidemark.operators.upsert import one_row_per_key, row_digest, upsert
from tidemark.scratch import delete_folder, materialise, names_in, scratch_path
from tidemark.sources.files import ANY_AGE

_MODE = "spark.sql.sources.partitionOverwriteMode"


def ensure_layers(
    spark: SparkSession, root: str, layers: Sequence[str], prefix: str = ""
) -> dict[str, str]:
    """Create one schema per layer under ``root``; returns layer -> schema name."""
    names = {layer: f"{prefix}{layer}" for layer in layers}
    for layer, name in names.items():
        spark.sql(
            f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{root.rstrip('/')}/{layer}'"
        )
    return names


def table_exists(spark: SparkSession, table: str) -> bool:
    """Whether the table is there; any other failure is raised, not read as absent."""
    return spark.catalog.tableExists(table)


def query_table(
    spark: SparkSession, table: str, columns: Sequence[str] = ("*",)
) -> DataFrame:
    return spark.sql(f"SELECT {', '.join(columns)} FROM {table}")


def stream_table(spark: SparkSession, table: str) -> DataFrame:
    """New rows of an append-only table."""
    return spark.readStream.options(**ANY_AGE).table(table)


def empty_like(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


def no_rows(df: DataFrame) -> DataFrame:
    """The columns of ``df`` by a predicate that is never true; nothing is read for it."""
    return df.filter("1 = 0")


def table_root(spark: SparkSession, table: str) -> str:
    database, name = table.rsplit(".", 1)
    location = spark.catalog.getDatabase(database).locationUri
    return f"{location.rstrip('/')}/{name}"


def table_location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return described.filter("col_name = 'Location'").first().data_type


def origin(spark: SparkSession, source: str) -> str:
    """Short name for the folder a table shows now; progress is kept per folder."""
    place = table_location(spark, source).encode()
    return hashlib.sha256(place).hexdigest()[:12]


# --- tables over files that others write ------------------------------------------


def point_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    location: str,
    parts: Sequence[str] = (),
) -> DataFrame:
    """Make ``table`` show the files under ``location``, creating it if missing.

    A table with ``parts`` that moves to another place is declared anew, as its
    partitions are listed with their places.
    """
    if table_exists(spark, table) and table_location(spark, table).rstrip("/") != location:
        if parts:
            spark.sql(f"DROP TABLE {table}")
        else:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
    if not table_exists(spark, table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        partitioned = f"PARTITIONED BY ({', '.join(parts)})" if parts else ""
        spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet {partitioned} "
            f"LOCATION '{location}'"
        )
    spark.catalog.refreshTable(table)
    return spark.table(table)


def batches(spark: SparkSession, table: str) -> set[int]:
    """Numbers of the batches a table shows; one a load."""
    shown = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return {int(row.partition.split("=")[1]) for row in shown}


def show_batches(
    spark: SparkSession, table: str, schema: T.StructType, location: str, part: str
) -> DataFrame:
    """Make ``table`` show every folder ``part=number`` under ``location``.

    Called when all batches written there are whole; folders that a stopped load did
    not get to show are shown too.
    """
    point_table(spark, table, T.StructType([*schema, T.StructField(part, T.LongType())]), location, [part])
    found = [name for name in names_in(spark, location) if name.startswith(f"{part}=")]
    new = sorted({int(name.split("=")[1]) for name in found} - batches(spark, table))
    if new:
        added = " ".join(f"PARTITION ({part} = {n}) LOCATION '{location}/{part}={n}'" for n in new)
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {added}")
        spark.catalog.refreshTable(table)
    return spark.table(table)


# --- tables that are overwritten ----------------------------------------------------


@contextmanager
def _touched_only(spark: SparkSession) -> Iterator[None]:
    """Overwrites replace the partitions that get rows, instead of the whole table."""
    before = spark.conf.get(_MODE)
    spark.conf.set(_MODE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(_MODE, before)


def publish(df: DataFrame, table: str, parts: Sequence[str] = ()) -> int:
    """Replace the table's content by ``df``; returns the number of rows written."""
    spark = df.sparkSession
    folder = scratch_path(spark, "publish")
    rows = write_parquet(df, folder)
    stored = spark.read.schema(df.schema).parquet(folder).select(*df.columns)
    stored.write.mode("overwrite").partitionBy(*parts).saveAsTable(table)
    delete_folder(spark, folder)
    return rows


def overwrite_partitions(
    df: DataFrame, table: str, part: str, touched: Sequence | None = None
) -> None:
    """Replace the partitions that ``df`` has rows of; others of ``touched`` go.

    ``df`` may read the table: Spark moves the new files in when all are written.
    Without ``touched`` no partition can become empty. A partition is written by one
    task, or by several if it is large.
    """
    spark = df.sparkSession
    written = Observation()
    spread = df.select(*spark.table(table).columns).hint("rebalance", F.col(part))
    # as many values as partitions are overwritten
    values = F.collect_set(F.struct(part)).alias("values")
    with _touched_only(spark):
        spread.observe(written, values).write.mode("overwrite").insertInto(table)
    filled = {row[0] for row in written.get["values"]}
    gone = [value for value in touched or () if value not in filled]
    if gone:
        specs = ["NULL" if value is None else f"'{value}'" for value in gone]
        dropped = ", ".join(f"PARTITION ({part} = {spec})" for spec in specs)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {dropped}")
    spark.catalog.refreshTable(table)


# a table partitioned by a hash of its key: a load rewrites the buckets it touches. A
# large table should have more of them, some GB each
BUCKET = "_bucket"
BUCKETS = 8
_PROPERTY = "tidemark.buckets"


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def publish_buckets(df: DataFrame, table: str, keys: Sequence[str], buckets: int = BUCKETS) -> int:
    """Replace the table by the rows in buckets; the table remembers how many."""
    rows = publish(with_bucket(df, keys, buckets), table, [BUCKET])
    df.sparkSession.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_PROPERTY}' = '{buckets}')")
    return rows


def bucket_count(spark: SparkSession, table: str) -> int:
    return int(spark.sql(f"SHOW TBLPROPERTIES {table} ('{_PROPERTY}')").first()["value"])


def touched_buckets(changed: DataFrame, table: str) -> tuple[list[int], DataFrame]:
    """The buckets of some rows, at most ``bucket_count``, and what the table has there."""
    touched = sorted(row[0] for row in changed.select(BUCKET).distinct().collect())
    return touched, changed.sparkSession.table(table).filter(F.col(BUCKET).isin(touched))


def create_or_merge(
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    latest: Preference | None = None,
) -> int:
    """First load writes ``source`` whole, later loads upsert it on ``keys``."""
    spark = source.sparkSession
    source = _merge_source(source, keys, latest, unique=False)
    if not table_exists(spark, table):
        return publish(source, table)
    return publish(upsert(spark.table(table), source, keys, unique=True), table)


def _merge_source(source: DataFrame, keys, latest, unique: bool) -> DataFrame:
    """The source with one row per key, stored, since a merge reads it repeatedly."""
    if latest is not None:
        return materialise(one_row_per_key(source, keys, latest), "merge-source")
    stored = materialise(source, "merge-source")
    return stored if unique else one_row_per_key(stored, keys)


def create_or_merge_partitions(
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    partition: str,
    latest: Preference | None = None,
    unique: bool = False,
    newest: str | None = None,
) -> list:
    """Upsert into a table partitioned by a coarse column, e.g. the year.

    Source rows the table already holds as they are change nothing and are left
    out first, by key and digest of the row, so a load of all orders writes only the
    partitions in which some order is new or different: those of the changed rows
    and those where a matching target row lies now. ``unique`` says that the source
    is known to have one row per key and need not be checked. With ``newest``, a column,
    source rows for which the table holds a greater one change nothing either. Returns
    the values of the partitions written; the catalog has an entry for each.
    """
    spark = source.sparkSession
    kind = source.schema[partition].dataType
    if not isinstance(kind, (T.IntegralType, T.DateType)):
        raise ValueError(f"partition by an integer or a date, not {kind.simpleString()}")
    if not table_exists(spark, table):
        if latest is not None:
            source = one_row_per_key(source, keys, latest)
        elif not unique:  # read twice: for the check too
            source = _merge_source(source, keys, latest, unique)
        spread = source.hint("rebalance", F.col(partition))
        spread.write.partitionBy(partition).saveAsTable(table)
        return _values(spark.table(table), partition)
    if latest is not None or not unique:
        source = _merge_source(source, keys, latest, unique)

    target = spark.table(table)
    lacking = _not_held(source.select(*target.columns), target, keys, newest)
    changed = materialise(lacking, "merge-changes")
    holding = changed.select(partition)
    if partition not in keys:
        # a matching row may lie in another partition than its new version
        matched = target.join(changed.select(*keys), list(keys), "left_semi")
        holding = holding.union(matched.select(partition))
    touched = _values(holding, partition)
    if touched:
        affected = F.col(partition).isin([v for v in touched if v is not None])
        if None in touched:
            affected = affected | F.col(partition).isNull()
        merged = upsert(target.filter(affected), changed, keys, unique=True)
        overwrite_partitions(merged, table, partition, touched)
    return touched


# a row is compared by so many numbers and times themselves; by a digest of the rest
_COMPARED = 8


def _not_held(
    source: DataFrame, target: DataFrame, keys: Sequence[str], newest: str | None = None
) -> DataFrame:
    """Source rows with no equal row in the target, nor one with a greater ``newest``.

    One join of the keys, ``newest``, a few columns of fixed size and a digest of all
    others; what is wide is not moved.
    """
    others = [f for f in target.schema if f.name not in (*keys, newest)]
    short = [f for f in others if isinstance(f.dataType, _SHORT) and f.dataType == source.schema[f.name].dataType]
    short = short if len(short) <= _COMPARED else []
    rest = [f.name for f in others if f not in short]
    moved = [*keys, *[f.name for f in short], *([newest] if newest else [])]
    held = target.select(
        *[F.col(c).alias(f"_held_{c}") for c in moved], _rest_digest(target, rest).alias("_held")
    )
    told = source.withColumn("_digest", _rest_digest(source, rest))
    gone = F.col("_digest").eqNullSafe(F.col("_held"))
    for field in short:
        gone = gone & _identical(F.col(field.name), F.col(f"_held_{field.name}"), field.dataType)
    if newest is not None:
        gone = gone & F.col(newest).eqNullSafe(F.col(f"_held_{newest}"))
        gone = gone | (F.col(f"_held_{newest}") > F.col(newest))
    same = [F.col(k).eqNullSafe(F.col(f"_held_{k}")) for k in keys]
    return told.join(held, [*same, gone], "left_anti").drop("_digest")


_SHORT = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _rest_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    return row_digest(columns, schema=df.schema) if columns else F.lit(None).cast("binary")


def _identical(a: Column, b: Column, kind: T.DataType) -> Column:
    """Equal or both null; 0.0 is not -0.0, as in a digest."""
    same = a.eqNullSafe(b)
    if isinstance(kind, T.FractionalType):
        same = same & (a.isNull() | (a != 0) | (a.cast("string") == b.cast("string")))
    return same


def _values(df: DataFrame, partition: str) -> list:
    return [row[0] for row in df.select(partition).distinct().collect()]


# --- files --------------------------------------------------------------------------


def write_parquet(df: DataFrame, path: str) -> int:
    """Overwrite ``path``; returns the rows written, counted in the same pass."""
    written = Observation()
    df.observe(written, F.count(F.lit(1)).alias("rows")).write.mode(
        "overwrite"
    ).parquet(path)
    return written.get["rows"]


def export_csv(df: DataFrame, path: str) -> None:
    """CSV files with a header line, written by the tasks that hold the rows."""
    df.write.mode("overwrite").option("header", "true").csv(path)
