"""Intermediate results kept in the cluster's shared folder.

An operator that reads one intermediate result twice writes it as Parquet
instead of caching it: a lost executor then costs a re-read, not a re-run, and
the second pass reads only the columns it needs.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a private one in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    folder = spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder all executors can reach"
        )
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used: ``<shared>/<application>/<label>-<id>``."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/{app}/{label}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> bool:
    """Delete what this application wrote to its scratch folder.

    Frames returned by operators may still read from it: call this after their
    results have been written. Returns whether there was anything to delete.
    """
    return delete_folder(spark, f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")


def _located(spark: SparkSession, folder: str):
    """A folder's file system and its path there."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(context._jsc.hadoopConfiguration()), path


def delete_folder(spark: SparkSession, folder: str) -> bool:
    """Delete a folder; returns whether it was there."""
    system, path = _located(spark, folder)
    return system.delete(path, True)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of a folder's files and folders; none if it is not there."""
    system, path = _located(spark, folder)
    if not system.exists(path):
        return []
    return [status.getPath().getName() for status in system.listStatus(path)]


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """Keep a small text as one file; it is there whole or not at all."""
    system, place = _located(spark, path)
    unfinished = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    stream = system.create(unfinished, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    system.delete(place, False)
    system.rename(unfinished, place)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A text kept by ``write_text``, or None if there is none."""
    system, place = _located(spark, path)
    if not system.exists(place):
        return None
    stream = system.open(place)
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return text


def materialise(
    df: DataFrame, label: str, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of the written files."""
    path = scratch_path(df.sparkSession, label)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
