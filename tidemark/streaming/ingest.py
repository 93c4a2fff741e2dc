"""Incremental Parquet ingest: each source file enters the bronze table once.

The stream is one of file names: Spark's file source says which files are new, and
every batch reads its files with the schemas that they have. A batch is a partition
of the bronze table, overwritten if the batch is repeated and seen once it is whole;
later stages take the partitions they have not had.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.cleaning import ARRIVED, BATCH, RESCUED
from tidemark.sources.files import (
    ANY_AGE,
    Ledger,
    arrivals,
    dataset_glob,
    own_files,
    read_files,
    store_schema,
    stored_schema,
    union_of_columns,
    with_arrival,
)
from tidemark.sources.tables import (
    show_batches,
    table_exists,
    table_location,
    table_root,
)

# The datasets of the sales model.
DATASETS = ("orders", "customer", "products", "regions")

LISTED = "path string, modificationTime timestamp, length bigint, content binary"
ARRIVAL = T.StructType(
    [T.StructField("delivered", T.TimestampType()), T.StructField("file", T.StringType())]
)


class Ingest:
    """One dataset on its way into one table.

    A row is as old as the first file of its delivery that is in its batch.

    A *generation* is a target folder with its own checkpoint and schema. A full
    replay fills the next generation and then points the table at it: a fresh
    checkpoint on an old target would repeat or lose files.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        name: str,
        table: str,
        full_refresh: bool = False,
        max_files_per_batch: int = 10_000,
        others: Sequence[str] = (),
    ):
        self.spark = spark
        self.table = table
        self.name, self.others = name, others
        self.pattern = dataset_glob(folder, name)
        self.max_files = max_files_per_batch
        generation = 0
        if table_exists(spark, table):
            live = table_location(spark, table).rstrip("/").removesuffix("/data")
            generation = int(live.rsplit("gen=", 1)[1]) + bool(full_refresh)
        root = table_root(spark, table)
        self.home, self.ledger = f"{root}/gen={generation}", f"{root}/ledger"

    def _declared(self, spark: SparkSession, schemas) -> T.StructType:
        """The schema of the first batch: its union of columns, the oldest file's types."""
        declared = stored_schema(spark, f"{self.home}/schema")
        if declared is None:
            declared = union_of_columns(schemas)
            store_schema(spark, declared, f"{self.home}/schema")
        return declared

    def _take(self, batch: DataFrame, batch_id: int) -> None:
        """Write one batch; ``max_files_per_batch`` limits the names collected here."""
        spark = batch.sparkSession
        own = own_files(batch, self.name, self.others)
        listed = own.orderBy("modificationTime", "path").toArrow()
        if not len(listed):
            return
        paths = listed.column("path").to_pylist()
        label = f"{self.home.rsplit('/', 1)[1]}-batch={batch_id}"
        groups = Ledger(spark, self.ledger).groups(paths, label)
        declared = self._declared(spark, [schema for _, schema in groups])
        rows = with_arrival(
            read_files(spark, groups, declared),
            arrivals(self.name, spark.createDataFrame(listed)),
        )
        rows.write.mode("overwrite").parquet(f"{self.home}/data/{BATCH}={batch_id}")

    def start(self) -> StreamingQuery:
        files = (
            self.spark.readStream.format("binaryFile")
            .schema(LISTED)
            .option("maxFilesPerTrigger", self.max_files)
            .options(**ANY_AGE)
            .load(self.pattern)
        )
        return (
            files.select("path", "modificationTime", F.col("_metadata.file_path").alias("file"))
            .writeStream.foreachBatch(self._take)
            .option("checkpointLocation", f"{self.home}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )

    def finish(self, query: StreamingQuery) -> DataFrame:
        """Wait for the files present at the start, then expose them as the table."""
        query.awaitTermination()
        declared = stored_schema(self.spark, f"{self.home}/schema")
        if declared is None:
            raise FileNotFoundError(f"no file matches {self.pattern}")
        added = [(RESCUED, T.StringType()), (ARRIVED, ARRIVAL)]
        schema = T.StructType([*declared, *(T.StructField(*f) for f in added)])
        return show_batches(self.spark, self.table, schema, f"{self.home}/data", BATCH)


def ingest(
    spark: SparkSession, folder: str, name: str, table: str, **options
) -> DataFrame:
    """Append the files of one dataset that the table has not seen yet."""
    job = Ingest(spark, folder, name, table, **options)
    return job.finish(job.start())


def ingest_all(
    spark: SparkSession,
    folder: str,
    schema: str,
    names: Sequence[str] = DATASETS,
    **options,
) -> dict[str, DataFrame]:
    """Ingest several datasets side by side, one stream each."""
    jobs = {
        n: Ingest(spark, folder, n, f"{schema}.{n}", others=names, **options)
        for n in names
    }
    running = {n: job.start() for n, job in jobs.items()}
    return {n: jobs[n].finish(query) for n, query in running.items()}
