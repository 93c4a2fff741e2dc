"""Every registered query against its SQL counterpart."""

from __future__ import annotations

import datetime as dt
import os

import duckdb
import pytest

from __spark_entry__ import entry
from tidemark.plans.oracle import ORACLE
from tidemark.plans.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
DATA = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def comparable(arrow):
    """Rows with columns in name order and instants without a zone."""
    rows = []
    for row in arrow.select(sorted(arrow.column_names)).to_pylist():
        values = [
            v.replace(tzinfo=None) if isinstance(v, dt.datetime) else v
            for v in row.values()
        ]
        rows.append(repr(values))
    return sorted(rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, DATA).toArrow()
    want = duck.sql(ORACLE[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    assert len(got) == len(want) > 0
    assert comparable(got) == comparable(want)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert entry(spark).count() > 0
