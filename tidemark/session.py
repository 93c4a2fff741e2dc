"""Session settings every operator relies on."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Result = TypeVar("Result")

MIB = 1024 * 1024

# Runtime SQL settings, safe to set on a session somebody else built.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join side even when that costs one more exchange above it
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # tables and stored results take two thirds of the space they have with Snappy
    "spark.sql.parquet.compression.codec": "zstd",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shuffle_partitions(
    data_bytes: int, target_mib: int = 256, floor: int = 8, ceiling: int = 30_000
) -> int:
    """Shuffle partitions near ``target_mib`` each.

    The ceiling keeps map outputs times partitions fetchable; past it partitions
    grow and their sorts spill.
    """
    return min(ceiling, max(floor, math.ceil(data_bytes / (target_mib * MIB))))


def scan_split_bytes(data_bytes: int, tasks: int = 100_000) -> int:
    """Bytes per scan task: Spark's 128 MiB, more if that made too many map outputs."""
    return min(1024 * MIB, max(128 * MIB, math.ceil(data_bytes / tasks)))


def side_by_side(
    spark: SparkSession, jobs: Mapping[str, Callable[[], Result]]
) -> dict[str, Result]:
    """Run independent jobs at once, so that a small one does not wait its turn.

    The first failure is raised after all jobs have ended. Every job has a copy of the
    caller's local properties: Spark keeps there which query a thread runs, and jobs
    that shared one took each other's away.
    """
    with ThreadPoolExecutor(max(1, len(jobs))) as pool:
        started = {
            name: pool.submit(inheritable_thread_target(spark)(job)) for name, job in jobs.items()
        }
    return {name: job.result() for name, job in started.items()}


def session(
    app: str = "tidemark",
    master: str | None = None,
    data_bytes: int | None = None,
    **extra: str,
) -> SparkSession:
    """Build a session; ``data_bytes`` (largest input) sizes scans and shuffles.

    AQE merges small shuffle partitions afterwards, so the estimate may be
    generous. ``extra`` takes dotted keys through ``**{"spark.x": "y"}``.
    """
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if data_bytes is not None:
        builder = builder.config(
            "spark.sql.shuffle.partitions", str(shuffle_partitions(data_bytes))
        ).config("spark.sql.files.maxPartitionBytes", str(scan_split_bytes(data_bytes)))
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
