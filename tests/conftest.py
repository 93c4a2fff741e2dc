from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tidemark.session import session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    spark = session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "6",
            "spark.checkpoint.dir": str(shared / "checkpoints"),
            "spark.sql.warehouse.dir": str(shared / "warehouse"),
            "spark.driver.memory": "4g",
            # small test frames must still be spread over several partitions
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def layer(spark, tmp_path):
    """A fresh schema for the tables of one test."""
    name = f"t_{tmp_path.name.lower().replace('-', '_')}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    return name
