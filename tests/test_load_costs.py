"""What a load leaves out: work whose result it has, and bytes nobody reads."""

from __future__ import annotations

import datetime as dt
import re
import threading

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tidemark.operators.cleaning import ARRIVED, keep_first
from tidemark.operators.facts import build_order_facts
from tidemark.operators.joins import known_or
from tidemark.plans import layers, stand_ins
from tidemark.scratch import names_in, scratch_path, shared_dir
from tidemark.session import side_by_side
from tidemark.sources import files, tables
from tidemark.sources.files import arrivals, with_arrival

DATA = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_jobs_side_by_side_have_their_own_properties(spark):
    together = threading.Barrier(2, timeout=60)

    def job(name):
        spark.sparkContext.setLocalProperty("tidemark.test", name)
        together.wait()
        return spark.sparkContext.getLocalProperty("tidemark.test")

    found = side_by_side(spark, {n: lambda n=n: job(n) for n in "ab"})
    assert found == {"a": "a", "b": "b"}


def test_a_load_without_new_orders_builds_no_facts(spark, tmp_path, monkeypatch):
    folder, root = f"{tmp_path}/in", f"{tmp_path}/wh"
    stand_ins.write_dataset_files(spark, DATA, folder)
    day = dt.datetime(2024, 1, 1)
    split = []
    partition_by = DataFrameWriter.partitionBy
    monkeypatch.setattr(
        DataFrameWriter, "partitionBy", lambda w, *c: split.append(c) or partition_by(w, *c)
    )
    names = layers.load_warehouse(spark, folder, root, "product_id", "no_orders_", day)
    # no task sorts its rows by the batch that all of them are of
    assert ("_batch",) not in split
    facts = spark.table(f"{names['gold']}.fact_orders")
    before = facts.count()

    def refuse(*_):
        raise AssertionError("facts built of no orders")

    monkeypatch.setattr(layers, "build_order_facts", refuse)
    layers.load_warehouse(spark, folder, root, "product_id", "no_orders_", day)
    assert spark.table(f"{names['gold']}.fact_orders").count() == before > 0


def test_a_first_load_is_not_stored_twice(spark, layer, monkeypatch):
    def refuse(*_):
        raise AssertionError("stored before it is written")

    monkeypatch.setattr(tables, "materialise", refuse)
    rows = spark.createDataFrame([(1, 2000), (2, None)], "id int, year int")
    years = tables.create_or_merge_partitions(rows, f"{layer}.f", ["id"], "year", unique=True)
    assert set(years) == {2000, None}


def test_narrow_rows_are_compared_without_a_digest(spark):
    data = [(1, 0.0, dt.datetime(2024, 1, 1)), (2, None, None), (3, float("nan"), None), (4, 5.0, None)]
    schema = "id int, amount double, at timestamp"
    target = spark.createDataFrame(data, schema)
    source = spark.createDataFrame(
        [(1, -0.0, data[0][2]), (2, None, None), (3, float("nan"), None), (4, 6.0, None), (5, 1.0, None)],
        schema,
    )
    lacking = tables._not_held(source, target, ["id"])
    assert sorted(r.id for r in lacking.collect()) == [1, 4, 5]
    assert "md5" not in plan_of(lacking)


def test_older_rows_and_equal_ones_leave_in_one_join(spark):
    schema = "id int, v string, at struct<delivered: int, file: string>"
    target = spark.createDataFrame([(1, "a", (5, "x")), (2, "b", (5, "x")), (None, "n", (5, "x"))], schema)
    source = spark.createDataFrame(
        [(1, "z", (4, "w")), (2, "c", (5, "y")), (3, "d", (1, "w")), (None, "n", (5, "x"))], schema
    )
    lacking = tables._not_held(source, target, ["id"], "at")
    assert sorted(r.id for r in lacking.collect()) == [2, 3]
    assert plan_of(lacking).count("Join LeftAnti") == 1


def test_a_falling_value_is_carried_once(spark):
    df = spark.createDataFrame([(1, 2.5, 7), (1, float("nan"), 8), (2, None, 9)], "k int, v double, n long")
    top = keep_first(df, ["k"], [("v", "desc"), ("n", "desc")])
    assert sorted(map(repr, map(tuple, top.collect()))) == ["(1, nan, 8)", "(2, None, 9)"]
    carried = keep_first(df, ["k"], [("v", "desc"), ("n", "desc")])._jdf.queryExecution().analyzed().toString()
    assert "_rank1, v#" not in carried and "_rank0, v#" not in carried


def test_arrival_is_looked_up_by_file(spark):
    listed = spark.createDataFrame(
        [("/in/orders_a.parquet/1", dt.datetime(2024, 1, 2)), ("/in/orders_a.parquet/0", dt.datetime(2024, 1, 1))],
        "file string, modificationTime timestamp",
    )
    rows = spark.createDataFrame([("/in/orders_a.parquet/1", 1)], f"{files._FILE} string, n int")
    told = with_arrival(rows, arrivals("orders", listed))
    row = told.first()
    assert tuple(row[ARRIVED]) == (dt.datetime(2024, 1, 1), "orders_a.parquet")
    assert told.columns == ["n", ARRIVED]


def test_stored_results_are_packed_with_zstd(spark):
    place = scratch_path(spark, "codec")
    spark.range(10).write.parquet(place)
    assert any(".zstd." in name for name in names_in(spark, place))


@pytest.fixture
def large_dimensions(spark):
    """What is larger than 20 KB is not broadcast."""
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {name: spark.conf.get(name, None) for name in names}
    for name in names:
        spark.conf.set(name, "20KB")
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_orders_are_shuffled_once_however_large_the_dimensions(spark, large_dimensions):
    numbers = spark.range(50_000)
    customers = numbers.select(F.col("id").alias("customer_id"), (F.col("id") + 7).alias("DimCustomerKey"))
    products = numbers.filter("id <> 3").select(F.col("id").alias("product_id"))
    orders = spark.range(6000).select(
        (F.col("id") / 2).cast("bigint").alias("order_id"),
        F.when(F.col("id") >= 2, (F.col("id") / 2).cast("bigint")).alias("customer_id"),
        (F.col("id") / 2).cast("bigint").alias("product_id"),
        F.col("id").alias("amount"),
    )
    facts = build_order_facts(orders, customers, products, [("amount", "desc")])
    rows = {r.order_id: r for r in facts.collect()}
    plan = facts._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    moved = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert sorted(moved) == ["_dim_customer_id", "customer_id"]
    assert len(rows) == facts.count() == 3000
    assert all(r.amount == 2 * n + 1 for n, r in rows.items())
    assert (rows[0].DimCustomerKey, rows[0].DimProductKey) == (-1, 0)
    assert (rows[3].DimCustomerKey, rows[3].DimProductKey) == (10, -1)
    assert (rows[4].DimCustomerKey, rows[4].DimProductKey) == (11, 4)


def test_known_keys_are_found_as_a_lookup_finds_them(spark):
    facts = spark.createDataFrame([(1, 5), (2, None), (3, 6), (4, 5)], "id int, p bigint")
    dimension = spark.createDataFrame([(5,), (None,)], "q int")
    found = known_or(facts, facts, dimension, "p", "q", "key")
    assert dict(found.dtypes) == {"id": "int", "p": "bigint", "key": "int"}
    assert sorted((r.id, r.key) for r in found.collect()) == [(1, 5), (2, -1), (3, -1), (4, 5)]


def test_both_files_of_the_orders_are_written_in_one_pass(spark, tmp_path):
    folder = f"{tmp_path}/in"
    stand_ins.write_dataset_files(spark, DATA, folder)
    home = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"
    assert not [name for name in names_in(spark, home) if name.startswith("sales")]
    sales = stand_ins.sales(spark, DATA).drop("line_no").withColumnRenamed("amount", "total_amount")
    ends = {"first": "order_date < DATE'1998-07-01'", "second": "order_date >= DATE'1998-01-01'"}
    both = spark.read.parquet(files.dataset_glob(folder, "orders"))
    assert sorted(both.columns) == sorted(sales.columns)
    for end, condition in ends.items():
        (name,) = [n for n in names_in(spark, folder) if n.startswith("orders") and n.endswith(f"{end}.parquet")]
        got = spark.read.parquet(f"{folder}/{name}").select(*sales.columns)
        want = sales.filter(condition)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert both.count() == sum(sales.filter(c).count() for c in ends.values())
