"""A key holding a third or more of all rows must not end up in one task."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.operators.facts import build_order_facts
from tidemark.operators.history import (
    END,
    START,
    _touched_keys,
    apply_changes,
    build_versions,
)
from tidemark.operators.joins import enrich, look_up_key
from tidemark.operators.upsert import upsert
from tidemark.plans import kpis

# Thresholds small enough for test data; everything else as in a real session.
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
}
ROWS = 40_000


@pytest.fixture
def small_thresholds(spark):
    before = {key: spark.conf.get(key, None) for key in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def hot_orders(spark, tmp_path):
    """Half of the orders have one customer, or none."""
    orders = spark.range(ROWS).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 997).alias("customer_id"),
        (F.col("id") % 50).alias("product_id"),
        F.xxhash64("id").alias("amount"),
    )
    orders.repartition(8).write.parquet(f"{tmp_path}/orders")
    return spark.read.parquet(f"{tmp_path}/orders")


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def customers(spark):
    return spark.range(997).select(F.col("id").alias("customer_id"), F.lit(1).alias("region_id"))


@pytest.mark.parametrize("hot", ["a value", "null"])
def test_hot_fact_key_is_split_in_the_lookup(spark, small_thresholds, hot_orders, hot):
    if hot == "null":
        hot_orders = hot_orders.withColumn("customer_id", F.nullif("customer_id", F.lit(1)))
    dim = customers(spark).withColumn("key", F.col("customer_id") + 1000)
    joined = look_up_key(hot_orders, dim, {"customer_id": "customer_id"}, "key", "DimCustomerKey")
    assert "skew=true" in final_plan(joined)
    assert joined.count() == ROWS


def test_hot_customer_is_split_when_facts_are_built(spark, small_thresholds, hot_orders):
    """Copies are looked for where the lookup's shuffle put them, unless it was split."""
    dim = customers(spark).withColumn("DimCustomerKey", F.col("customer_id") + 1000)
    products = spark.range(1, 50).select(F.col("id").alias("product_id"))
    twice = hot_orders.unionAll(hot_orders.withColumn("amount", F.lit(None).cast("bigint")))
    facts = build_order_facts(twice, dim, products, [("amount", "desc")])
    assert "skew=true" in final_plan(facts)
    assert facts.count() == ROWS
    want = hot_orders.agg(F.count("amount"), F.bit_xor("amount")).first()
    assert facts.agg(F.count("amount"), F.bit_xor("amount")).first() == want
    assert facts.filter("DimCustomerKey <> customer_id + 1000").isEmpty()
    assert facts.filter("DimProductKey <> IF(product_id = 0, -1, product_id)").isEmpty()


def test_hot_customer_is_split_in_the_star_join(spark, small_thresholds, hot_orders):
    products = spark.range(50).select(F.col("id").alias("product_id"))
    regions = spark.createDataFrame([(1, "North")], "region_id int, region_name string")
    wide = enrich(hot_orders, customers(spark), products, regions)
    assert "skew=true" in final_plan(wide)
    assert wide.count() == ROWS


def test_hot_null_keys_are_split_in_the_upsert(spark, small_thresholds, hot_orders):
    target = hot_orders.withColumn(
        "order_id", F.when(F.col("customer_id") != 1, F.col("order_id"))
    )
    merged = upsert(target, target.filter("order_id < 100"), ["order_id"])
    assert "skew=true" in final_plan(merged)
    assert merged.count() == ROWS


def test_hot_history_key_is_split(spark, small_thresholds, tmp_path):
    """Half of the stored versions belong to one key, which gets one more change."""
    changes = spark.range(ROWS).select(
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 997).alias("id"),
        F.xxhash64("id").alias("v"),
        F.col("id").alias("seq"),
    )
    stored = f"{tmp_path}/history"
    build_versions(changes, ["id"], "seq").repartition(8).drop("seq").write.parquet(stored)
    history = spark.read.parquet(stored)
    late = spark.createDataFrame([(1, 0, ROWS + 5), (2, 0, 3)], "id long, v long, seq long")
    touched = _touched_keys(late, ["id"])
    for how in ("left_semi", "left_anti"):
        assert "skew=true" in final_plan(history.join(touched, "id", how))
    got = apply_changes(history, late, ["id"], "seq")
    assert got.count() == ROWS + 2
    assert got.filter(F.col(END).isNull()).count() == 997
    gaps = got.groupBy("id").agg(F.min(START), F.count(END), F.count(F.lit(1)).alias("n"))
    assert gaps.filter(F.col(f"count({END})") != F.col("n") - 1).isEmpty()


def test_report_sums_a_hot_customer_before_the_shuffle(spark, hot_orders):
    """Shuffled rows are bounded by keys times tasks, not by sales."""
    sales = hot_orders.withColumn("amount", F.lit(1.0))
    people = customers(spark).withColumn("customer_name", F.lit("x"))
    regions = spark.createDataFrame(
        [(1, "North", "NO")], "region_id int, region_name string, country string"
    )
    report = kpis.region_revenue(sales, people, regions)
    assert report.first().revenue == float(ROWS)
    plan = report._jdf.queryExecution().sparkPlan().toString().splitlines()
    scan = next(i for i, line in enumerate(plan) if "FileScan" in line)
    above = [line for line in plan[:scan] if "Project" not in line and "Filter" not in line]
    assert "HashAggregate" in above[-1] and "partial_sum(" in above[-1]
