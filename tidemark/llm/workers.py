"""Python workers that can import this package, and what they hold between tasks."""

from __future__ import annotations

import ctypes
import gc
import sys
from pathlib import Path

import pyarrow as pa
from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def with_package(spark: SparkSession) -> SparkSession:
    """Let workers on machines that see this checkout import it from where it lies.

    Elsewhere the folder is not there and changes nothing: ship the package with
    ``--py-files`` or install it, as for any library.
    """
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(":")
    if ROOT not in paths:
        environment["PYTHONPATH"] = ":".join([ROOT, *filter(None, paths)])
    return spark


def give_back() -> None:
    """Return to the machine what a worker's allocators keep but no longer use.

    Workers outlive their tasks, and what one holds is missing to every later stage.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)):
        trim(0)
