"""The layered load: bronze files, silver tables, gold dimensions and facts."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.registry import register_discount
from tidemark.operators.cleaning import (
    ARRIVED,
    BATCH,
    RESCUED,
    Preference,
    full_name,
    keep_first,
    parsed_timestamp,
    part_after,
)
from tidemark.operators.dimensions import apply_type1, first_type1_load
from tidemark.operators.facts import FACT_KEYS, build_order_facts
from tidemark.operators.history import current_versions
from tidemark.operators.joins import UNKNOWN_KEY
from tidemark.operators.keys import max_key
from tidemark.operators.upsert import row_digest
from tidemark.scratch import materialise, read_text, write_text
from tidemark.session import side_by_side
from tidemark.sources.tables import (
    BUCKET,
    BUCKETS,
    batches,
    bucket_count,
    create_or_merge_partitions,
    ensure_layers,
    origin,
    overwrite_partitions,
    publish_buckets,
    query_table,
    show_batches,
    stream_table,
    table_exists,
    table_location,
    table_root,
    touched_buckets,
    with_bucket,
)
from tidemark.streaming.changes import (
    PRODUCT_RULES,
    apply_stream,
    stage_table,
)
from tidemark.streaming.ingest import DATASETS, ingest_all

LAYERS = ("bronze", "silver", "gold")
CUSTOMER_KEY = "DimCustomerKey"
# 128 bits of a dimension row's attributes
DIGEST = "_digest"
# the number of an order's delivery, the newest first
_DELIVERY = "_delivery"


def silver_customers(bronze: DataFrame) -> DataFrame:
    return (
        bronze.drop(RESCUED)
        .withColumns(
            {
                "domains": part_after("email", "@"),
                "full_name": full_name("first_name", "last_name"),
            }
        )
        .drop("first_name", "last_name")
    )


def customers_per_domain(customers: DataFrame) -> DataFrame:
    return (
        customers.groupBy("domains")
        .agg(F.count("customer_id").alias("total_customers"))
        .orderBy(F.desc("total_customers"), "domains")
    )


def customers_of_domain(customers: DataFrame, domain: str) -> DataFrame:
    return customers.filter(F.col("domains") == domain)


def silver_orders(bronze: DataFrame) -> DataFrame:
    return _with_year(
        bronze.drop(RESCUED).withColumn("order_date", parsed_timestamp("order_date"))
    )


def _with_year(orders: DataFrame) -> DataFrame:
    return orders.withColumn("year", F.year("order_date"))


def silver_products(bronze: DataFrame) -> DataFrame:
    return discounted(bronze.drop(RESCUED, ARRIVED))


def discounted(products: DataFrame) -> DataFrame:
    discount = register_discount(products.sparkSession)
    return products.withColumn("discounted_price", F.expr(f"{discount}(price)"))


def silver_regions(bronze: DataFrame) -> DataFrame:
    return bronze.drop(RESCUED, ARRIVED)


# dataset -> (silver table, transformation)
SILVER = {
    "customer": ("customers_silver", silver_customers),
    "orders": ("orders_silver", silver_orders),
    "products": ("products_silver", silver_products),
    "regions": ("regions_silver", silver_regions),
}


def load_silver(spark: SparkSession, bronze: str, silver: str) -> dict[str, list[int]]:
    """Clean the bronze batches the silver tables lack; returns the batches of each."""
    jobs = {
        table: partial(_clean_batches, spark, f"{bronze}.{dataset}", f"{silver}.{table}", transform)
        for dataset, (table, transform) in SILVER.items()
    }
    return side_by_side(spark, jobs)


def _clean_batches(
    spark: SparkSession, source: str, table: str, transform: Callable[[DataFrame], DataFrame]
) -> list[int]:
    """Add the silver batches that are missing, each made of the bronze batch of its number.

    A source replayed into a new folder is cleaned anew, into a folder of its own.
    """
    home = f"{table_root(spark, table)}/of-{origin(spark, source)}"
    here = table_exists(spark, table) and table_location(spark, table).rstrip("/") == home
    new = sorted(batches(spark, source) - (batches(spark, table) if here else set()))
    if here and not new:
        return []
    cleaned = transform(spark.table(source))
    for number in new:  # one folder at a time, so that no task sorts its rows by batch
        own = cleaned.filter(F.col(BATCH) == number).drop(BATCH)
        own.write.mode("overwrite").parquet(f"{home}/{BATCH}={number}")
    show_batches(spark, table, cleaned.drop(BATCH).schema, home, BATCH)
    return new


def load_customer_dimension(
    spark: SparkSession,
    source: DataFrame,
    table: str,
    run_ts: dt.datetime | None = None,
    only_changed: bool = False,
    order: Preference = (),
    buckets: int = BUCKETS,
) -> list[int]:
    """First load or merge, whichever the table's existence calls for.

    Of rows with one customer the newest delivery counts, then ``order``. The
    dimension keeps a digest of every row's attributes. With ``only_changed`` a load
    first joins keys and digests alone; the wide rows are read and written again in
    the buckets with a customer that is new or different, and nowhere else. Without
    it every customer of the source takes the load's update date. Returns the buckets
    written; ``buckets`` counts for the first load.
    """
    key = "customer_id"
    source = source.dropna(subset=[key])
    if ARRIVED in source.columns:
        source = keep_first(source, [key], [(ARRIVED, "desc"), *order]).drop(ARRIVED)
    told = source.withColumn(DIGEST, row_digest([c for c in source.columns if c != key]))
    if not table_exists(spark, table):
        dimension = first_type1_load(told, key, CUSTOMER_KEY, run_ts, order)
        publish_buckets(dimension, table, [key], buckets)
        return list(range(buckets))
    held = spark.table(table)
    told = with_bucket(told, [key], bucket_count(spark, table))
    if only_changed:
        same = held.select(F.col(key).alias("_held_key"), F.col(DIGEST).alias("_held"))
        match = [F.col(key) == F.col("_held_key"), F.col(DIGEST) == F.col("_held")]
        told = told.join(same, match, "left_anti")
    told = materialise(told, "customers")
    touched, target = touched_buckets(told, table)
    if touched:
        highest = max_key(held, CUSTOMER_KEY)
        dimension = apply_type1(
            target, told, key, CUSTOMER_KEY, run_ts, order, only_changed, highest
        )
        overwrite_partitions(dimension, table, BUCKET)
    return touched


def load_product_dimension(
    spark: SparkSession,
    bronze: str,
    gold: str,
    sequence_by: str,
    rules: Mapping[str, str] = PRODUCT_RULES,
    buckets: int = BUCKETS,
) -> DataFrame:
    """New product rows, checked, into the version table ``gold.dimproducts``.

    The stage streams from bronze, which only grows: the silver products are
    rewritten by each load, so a stream of them would miss or repeat changes.
    """
    stage = f"{gold}.dimproducts_stage"
    table = f"{gold}.dimproducts"
    stage_table(spark, f"{bronze}.products", stage, rules)
    changes = discounted(stream_table(spark, stage).drop(RESCUED, BATCH))
    apply_stream(changes, stage, table, ["product_id"], sequence_by, buckets)
    return spark.table(table)


def load_order_facts(
    spark: SparkSession,
    silver: str,
    gold: str,
    order: Preference = (),
    point_in_time: bool = False,
) -> list:
    """New orders merged into ``gold.fact_orders``; returns the years written.

    Read are the silver batches not merged yet, and the facts that have an unknown
    key, as their customer or product may have come. Of rows with one key the newest
    delivery counts, then ``order``, whenever each is loaded: facts keep when they
    were delivered, and an order that is older than its fact changes nothing.

    Orders take the current version of their product, or with ``point_in_time`` the
    one that held at their date, if the versions' sequence is a time; as versions may
    come late, all orders are looked up then.
    """
    source, table = f"{silver}.orders_silver", f"{gold}.fact_orders"
    progress = f"{table_root(spark, table)}_progress/{origin(spark, source)}.json"
    orders, found, merged = spark.table(source), batches(spark, source), set()
    if table_exists(spark, table) and not point_in_time:
        merged = set(json.loads(read_text(spark, progress) or "[]"))
        orders = orders.filter(F.col(BATCH).isin(sorted(found - merged)))
    orders = orders.drop(BATCH)
    if merged:
        unknown = f"DimCustomerKey = {UNKNOWN_KEY} OR DimProductKey = {UNKNOWN_KEY}"
        orders = orders.union(spark.table(table).filter(unknown).select(*orders.columns))
        if orders.isEmpty():
            write_text(spark, json.dumps(sorted(found)), progress)
            return []
    customers = query_table(spark, f"{gold}.dim_customers", [CUSTOMER_KEY, "customer_id"])
    products = spark.table(f"{gold}.dimproducts")
    if not point_in_time:
        products = current_versions(products)
    told, deliveries = _by_delivery(orders)
    at = "order_date" if point_in_time else None
    # the year follows from the date and need not be moved
    facts = build_order_facts(told.drop("year"), customers, products, [_DELIVERY, *order], at)
    facts = _with_year(facts).join(F.broadcast(deliveries), _DELIVERY).drop(_DELIVERY)
    columns = [*orders.columns, *[c for c in facts.columns if c not in orders.columns]]
    years = create_or_merge_partitions(
        facts.select(*columns), table, FACT_KEYS, "year", unique=True, newest=ARRIVED
    )
    write_text(spark, json.dumps(sorted(found)), progress)
    return years


def _by_delivery(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The orders with the number of their delivery in its place, and the numbers.

    The newest delivery is 1, so an order compares and moves a number and no time and
    name. There is one row per delivery, which one task numbers and all are sent.
    """
    rows = orders.select(ARRIVED).distinct()
    place = F.row_number().over(W.orderBy(F.desc(ARRIVED)))
    deliveries = materialise(rows.withColumn(_DELIVERY, place), "deliveries")
    numbers = deliveries.withColumnRenamed(ARRIVED, "_delivered")
    match = F.col(ARRIVED).eqNullSafe(F.col("_delivered"))
    return orders.join(F.broadcast(numbers), match).drop(ARRIVED, "_delivered"), deliveries


def load_warehouse(
    spark: SparkSession,
    folder: str,
    root: str,
    product_sequence: str,
    prefix: str = "",
    run_ts: dt.datetime | None = None,
    full_refresh: bool = False,
    datasets: Sequence[str] = DATASETS,
    point_in_time: bool = False,
    buckets: int = BUCKETS,
) -> dict[str, str]:
    """Bring all layers up to date with the files in ``folder``.

    ``buckets`` is the number of parts that a first load cuts a dimension into.

    Returns layer -> schema name. Running it again without new files changes
    nothing but the customers' update date.
    """
    names = ensure_layers(spark, root, LAYERS, prefix)
    bronze, silver, gold = (names[layer] for layer in LAYERS)
    ingest_all(spark, folder, bronze, datasets, full_refresh=full_refresh)
    load_silver(spark, bronze, silver)
    load_customer_dimension(
        spark,
        query_table(spark, f"{silver}.customers_silver").drop(BATCH),
        f"{gold}.dim_customers",
        run_ts,
        buckets=buckets,
    )
    load_product_dimension(spark, bronze, gold, product_sequence, buckets=buckets)
    load_order_facts(spark, silver, gold, [("total_amount", "desc")], point_in_time)
    return names
