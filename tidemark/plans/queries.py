"""Queries over the test tables, one or more per operator."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.registry import (
    register_discount,
    register_orders_by_year,
    register_upper,
)
from tidemark.operators import (
    asof,
    cleaning,
    dimensions,
    facts,
    feed,
    history,
    joins,
    keys,
    quality,
)
from tidemark.operators.ranking import ranked
from tidemark.operators.upsert import upsert
from tidemark.plans import batch, kpis, layers, stand_ins
from tidemark.plans.stand_ins import table
from tidemark.scratch import scratch_path
from tidemark.session import apply_settings
from tidemark.sources import files, tables
from tidemark.streaming import changes as change_stream
from tidemark.streaming.ingest import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The state before an incremental load: what an earlier load had brought in.
KNOWN_CUSTOMERS = "c_acctbal >= 0"
RUN_TS = dt.datetime(2024, 1, 1)


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(apply_settings(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def _layers(spark: SparkSession, label: str, *names: str) -> list[str]:
    """Fresh schemas under a fresh folder of the shared scratch space."""
    root = scratch_path(spark, label)
    prefix = f"{label}_{uuid.uuid4().hex[:8]}_"
    return list(tables.ensure_layers(spark, root, names, prefix).values())


# --- sources and sinks ------------------------------------------------------


@query
def bronze_ingest(spark, sf_dir):
    (bronze,) = _layers(spark, "bronze_ingest", "bronze")
    return cleaning.drop_rescued(ingest(spark, sf_dir, "orders", f"{bronze}.orders"))


@query
def bronze_ingest_in_steps(spark, sf_dir):
    """Files arriving one after the other, and a run that finds nothing new."""
    (bronze,) = _layers(spark, "ingest_steps", "bronze")
    folder = scratch_path(spark, "ingest-steps-files")
    target = f"{bronze}.orders"
    orders = table(spark, sf_dir, "orders")
    early = F.col("o_orderdate") < F.lit(dt.date(1998, 1, 1))
    orders.filter(early).write.parquet(f"{folder}/orders_first.parquet")
    ingest(spark, folder, "orders", target)
    orders.filter(~early).write.parquet(f"{folder}/orders_second.parquet")
    ingest(spark, folder, "orders", target)
    return cleaning.drop_rescued(ingest(spark, folder, "orders", target))


@query
def bronze_ingest_many_files(spark, sf_dir):
    """Every delivery of a dataset, however named; a longer dataset's are not its."""
    (bronze,) = _layers(spark, "ingest_many", "bronze")
    folder = scratch_path(spark, "ingest-many-files")
    target = f"{bronze}.orders"
    orders = table(spark, sf_dir, "orders")
    deliveries = ("", "_first", "_third", "_2024_01", "_2024_02_05", "_late")
    part = F.pmod("o_orderkey", F.lit(len(deliveries)))
    orders.limit(10).write.parquet(f"{folder}/orders_archive_2023.parquet")
    for number, ending in enumerate(deliveries):
        orders.filter(part == number).write.parquet(f"{folder}/orders{ending}.parquet")
        if number % 2:
            ingest(spark, folder, "orders", target, others=["orders_archive"])
    return cleaning.drop_rescued(spark.table(target))


@query
def bronze_full_refresh(spark, sf_dir):
    """A replay replaces the table instead of appending to it."""
    (bronze,) = _layers(spark, "full_refresh", "bronze")
    target = f"{bronze}.customer"
    ingest(spark, sf_dir, "customer", target)
    replayed = ingest(spark, sf_dir, "customer", target, full_refresh=True)
    return cleaning.drop_rescued(replayed)


@query
def schema_drift_rescued(spark, sf_dir):
    """Columns a dataset's schema did not declare arrive as JSON."""
    (bronze,) = _layers(spark, "schema_drift", "bronze")
    folder = scratch_path(spark, "schema-drift-files")
    target = f"{bronze}.products"
    part = table(spark, sf_dir, "part")
    narrow = part.select("p_partkey", "p_name").filter("p_size <= 25")
    narrow.write.parquet(f"{folder}/products_first.parquet")
    ingest(spark, folder, "products", target)
    wide = part.select("p_partkey", "p_name", "p_brand", "p_size").filter("p_size > 25")
    wide.write.parquet(f"{folder}/products_second.parquet")
    return ingest(spark, folder, "products", target).drop(cleaning.ARRIVED, cleaning.BATCH)


@query
def schema_drift_type_change(spark, sf_dir):
    """Columns that change their type: what fits arrives, the rest is kept as JSON."""
    (bronze,) = _layers(spark, "type_change", "bronze")
    folder = scratch_path(spark, "type-change-files")
    target = f"{bronze}.products"
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size", "p_retailprice")
    third = F.col("p_partkey") % 3
    as_text = F.when(F.col("p_size") <= 40, F.col("p_size").cast("string")).otherwise("n/a")
    deliveries = {
        "products_first": {},
        "products_second": {
            "p_size": as_text,
            "p_type": F.length("p_type"),
            "p_retailprice": F.floor("p_retailprice"),
        },
        "products_third": {
            "p_size": F.struct(F.col("p_size").alias("value"), F.lit("cm").alias("unit")),
            "p_type": F.array("p_type"),
        },
    }
    for number, (name, changed) in enumerate(deliveries.items()):
        own = part.filter(third == number).withColumns(changed)
        own.write.parquet(f"{folder}/{name}.parquet")
        ingest(spark, folder, "products", target)
    return spark.table(target).drop(cleaning.ARRIVED, cleaning.BATCH)


@query
def batch_copy(spark, sf_dir):
    path = scratch_path(spark, "batch-copy")
    tables.write_parquet(spark.read.parquet(f"{sf_dir}/customer.parquet"), path)
    return spark.read.parquet(path)


@query
def overwrite_table(spark, sf_dir):
    """Publish a table, then publish it again from itself."""
    (silver,) = _layers(spark, "overwrite_table", "silver")
    name = f"{silver}.products_silver"
    tables.publish(table(spark, sf_dir, "part"), name)
    tables.publish(spark.table(name).drop("p_size"), name)
    return spark.table(name)


@query
def csv_export(spark, sf_dir):
    path = scratch_path(spark, "csv-export")
    report = kpis.monthly_revenue(stand_ins.sales(spark, sf_dir))
    tables.export_csv(report, path)
    return spark.read.schema(report.schema).option("header", "true").csv(path)


@query
def row_count(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("row_count"))


# --- projections, filters, scalar functions ----------------------------------


@query
def project_drop_rename(spark, sf_dir):
    (silver,) = _layers(spark, "project", "silver")
    tables.publish(table(spark, sf_dir, "orders"), f"{silver}.orders")
    renamed = (
        tables.query_table(spark, f"{silver}.orders")
        .withColumnsRenamed({"o_orderkey": "order_id", "o_custkey": "customer_id"})
        .drop("o_orderstatus", "o_orderdate", "o_orderpriority", "no_such_column")
    )
    return renamed.select(
        "order_id", "customer_id", F.col("o_totalprice").alias("total_amount")
    )


@query
def split_domain(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", cleaning.part_after("url", "/", 2).alias("domains")
    )


@query
def domain_counts(spark, sf_dir):
    hosts = split_domain(spark, sf_dir).withColumnRenamed("page_id", "customer_id")
    return layers.customers_per_domain(hosts)


@query
def filter_equals(spark, sf_dir):
    customers = layers.silver_customers(stand_ins.named_customers(spark, sf_dir))
    return layers.customers_of_domain(customers, "building.com")


@query
def concat_full_name(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", cleaning.full_name("c_name", "c_mktsegment").alias("full_name")
    )


@query
def cast_date_year(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("order_date"),
        F.year("o_orderdate").alias("year"),
    )


@query
def parse_timestamp(spark, sf_dir):
    texts = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("string").alias("order_date")
    )
    return texts.withColumn("order_date", cleaning.parsed_timestamp("order_date"))


@query
def filter_year_amount(spark, sf_dir):
    return cleaning.large_sales_of(stand_ins.sales(spark, sf_dir), 1997, 10000)


@query
def drop_null_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("amount"),
        F.col("o_orderdate").alias("order_date"),
    )
    return cleaning.cleaned(orders, cleaning.BATCH_RULES["orders"])


@query
def fill_nulls(spark, sf_dir):
    products = stand_ins.products(spark, sf_dir).withColumn(
        "category", F.when(F.col("category") != "PROMO", F.col("category"))
    )
    return cleaning.cleaned(products, cleaning.BATCH_RULES["products"]).select("product_id", "category")


@query
def trim_name(spark, sf_dir):
    customers = stand_ins.customers(spark, sf_dir).withColumn(
        "customer_name", F.concat(F.lit("  "), "customer_name", F.lit(" "))
    )
    return cleaning.cleaned(customers, cleaning.BATCH_RULES["customers"]).select("customer_id", "customer_name")


@query
def sql_udf_discount(spark, sf_dir):
    discount = register_discount(spark)
    return stand_ins.products(spark, sf_dir).select(
        "product_id", "price",
        F.round(F.expr(f"{discount}(price)"), 4).alias("discounted_price"),
    )


@query
def py_udf_upper(spark, sf_dir):
    upper = register_upper(spark)
    stand_ins.products(spark, sf_dir).createOrReplaceTempView("upper_products")
    return spark.sql(
        f"SELECT product_id, brand, {upper}(brand) AS brand_upper FROM upper_products"
    )


@query
def sql_udtf_orders_by_year(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("order_date")
    )
    orders.createOrReplaceTempView("orders_of_all_years")
    by_year = register_orders_by_year(spark, "orders_of_all_years")
    return spark.sql(f"SELECT * FROM {by_year}(1997)")


# --- set operations and de-duplication ---------------------------------------


@query
def union_split_dedup(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    first, second = customer.filter("c_acctbal >= 0"), customer.filter("c_acctbal < 5000")
    return cleaning.union_distinct_on([first, second], ["c_custkey"])


@query
def dedup_keep_first(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        "l_shipdate",
    )
    return cleaning.keep_first(
        lines,
        ["l_orderkey", "l_linenumber"],
        ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"],
    )


# --- joins -------------------------------------------------------------------


def _known_customers(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").filter(KNOWN_CUSTOMERS)


@query
def left_join_unmatched(spark, sf_dir):
    known = _known_customers(spark, sf_dir).select(
        F.col("c_custkey").alias("dim_id"), (F.col("c_custkey") + 1).alias("dim_key")
    )
    return joins.look_up_key(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"),
        known, {"o_custkey": "dim_id"}, "dim_key", "dim_key", unknown=None,
    )


@query
def split_new_old(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey")
    known = _known_customers(spark, sf_dir).select("c_custkey")
    return joins.mark_new_rows(customer, known, {"c_custkey": "c_custkey"})


@query
def empty_scan(spark, sf_dir):
    """Before a first load the known keys are the target's columns without a row."""
    customer = table(spark, sf_dir, "customer")
    known = tables.no_rows(customer.select(F.col("c_custkey").alias("known_key")))
    return joins.mark_new_rows(customer.select("c_custkey"), known, {"c_custkey": "known_key"})


@query
def enriched_master_join(spark, sf_dir):
    enriched = joins.enrich(
        stand_ins.sales(spark, sf_dir),
        stand_ins.customers(spark, sf_dir),
        stand_ins.products(spark, sf_dir),
        stand_ins.regions(spark, sf_dir),
    )
    return enriched.select(
        "order_id", "line_no", "amount", "customer_name", "category", "country",
        "region_name",
    )


@query
def orders_with_region(spark, sf_dir):
    return joins.orders_with_region(
        stand_ins.sales(spark, sf_dir),
        stand_ins.customers(spark, sf_dir),
        stand_ins.regions(spark, sf_dir),
    )


# --- aggregations ------------------------------------------------------------


@query
def kpi_monthly_revenue(spark, sf_dir):
    return kpis.monthly_revenue(stand_ins.sales(spark, sf_dir))


@query
def kpi_category_revenue(spark, sf_dir):
    return kpis.category_revenue(
        stand_ins.sales(spark, sf_dir), stand_ins.products(spark, sf_dir)
    )


def _star(spark, sf_dir) -> list[DataFrame]:
    return [
        stand_ins.sales(spark, sf_dir),
        stand_ins.customers(spark, sf_dir),
        stand_ins.regions(spark, sf_dir),
    ]


@query
def kpi_region_revenue(spark, sf_dir):
    return kpis.region_revenue(*_star(spark, sf_dir))


@query
def kpi_top_customers(spark, sf_dir):
    return kpis.top_customers(*_star(spark, sf_dir))


@query
def sql_region_category(spark, sf_dir):
    sales, customers, regions = _star(spark, sf_dir)
    products = stand_ins.products(spark, sf_dir)
    return kpis.region_category_report(spark, sales, customers, products, regions)


@query
def sql_country_category(spark, sf_dir):
    """The same report by country: more groups than the report has rows."""
    sales, customers, regions = _star(spark, sf_dir)
    by_country = regions.withColumn("region_name", F.col("country"))
    products = stand_ins.products(spark, sf_dir)
    return kpis.region_category_report(spark, sales, customers, products, by_country)


# --- windows, sorts, limits --------------------------------------------------


@query
def rank_family(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
        F.year("l_shipdate").alias("year"), "l_quantity",
    )
    outputs = {"dense_rank": "flag", "rank": "rank_flag"}
    return ranked(lines, outputs, ["year"], [("l_quantity", "desc")])


@query
def row_number_by_year(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("year"), "o_totalprice"
    )
    return ranked(
        orders, {"row_number": "row_flag"}, ["year"], [("o_totalprice", "desc")],
        tie_breaker=["o_orderkey"],
    )


@query
def rank_in_region_top5(spark, sf_dir):
    return kpis.ranked_in_region(kpi_top_customers(spark, sf_dir))


@query
def top_k_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


# --- keys, upsert, dimensions, facts -----------------------------------------


@query
def surrogate_key(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey")
    return keys.dense_keys(customer, ["c_custkey"], "dim_customer_key")


@query
def surrogate_key_incremental(spark, sf_dir):
    known = _known_customers(spark, sf_dir).select("c_custkey")
    existing = keys.dense_keys(known, ["c_custkey"], "dim_customer_key")
    customer = table(spark, sf_dir, "customer").select("c_custkey")
    new = customer.join(known, "c_custkey", "left_anti")
    return keys.add_new_keys(existing, new, ["c_custkey"], "dim_customer_key")


@query
def scd1_dim_customer(spark, sf_dir):
    """A load that changes a segment, adds customers, and omits some known ones."""
    (gold,) = _layers(spark, "scd1", "gold")
    name = f"{gold}.dim_customers"
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), "c_mktsegment", "c_acctbal"
    )
    first = customer.filter("c_acctbal >= 0").drop("c_acctbal")
    layers.load_customer_dimension(spark, first, name, RUN_TS)
    building = F.col("c_mktsegment") == "BUILDING"
    segment = F.when(building, "CONSTRUCTION").otherwise(F.col("c_mktsegment"))
    later = customer.filter("c_acctbal < 8000").select(
        "customer_id", segment.alias("c_mktsegment")
    )
    next_run = RUN_TS + dt.timedelta(days=1)
    layers.load_customer_dimension(spark, later, name, next_run, only_changed=True)
    return spark.table(name).drop(tables.BUCKET, layers.DIGEST)


@query
def load_clock(spark, sf_dir):
    """A load without a given time takes one clock for all its rows."""
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"))
    dim = dimensions.first_type1_load(customer, "customer_id", "DimCustomerKey")
    created, updated = F.col(dimensions.CREATED), F.col(dimensions.UPDATED)
    age = F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp(created)
    return dim.agg(
        F.count(F.lit(1)).alias("customers"),
        F.countDistinct(created).alias("clocks"),
        F.count_if(created != updated).alias("updated_later"),
        F.count_if((age < 0) | (age > 3600)).alias("off_the_clock"),
    )


@query
def fact_upsert(spark, sf_dir):
    """Loaded orders to the end of 1998, corrected and continued from 1998 on."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"
    )
    target = orders.filter(F.col("o_orderdate") < F.lit(dt.date(1999, 1, 1)))
    source = orders.filter(
        F.col("o_orderdate") >= F.lit(dt.date(1998, 1, 1))
    ).withColumn("o_totalprice", F.round(F.col("o_totalprice") + 1, 2))
    return upsert(target, source, ["o_orderkey", "o_custkey"])


@query
def create_or_merge(spark, sf_dir):
    """The same merge on a table by year; some corrected orders change their year."""
    (gold,) = _layers(spark, "merge", "gold")
    name = f"{gold}.fact_orders"
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year")
    )
    tables.create_or_merge_partitions(
        orders.filter("year <= 1998"), name, ["o_orderkey"], "year"
    )
    moved = F.when(F.col("o_totalprice") > 400000, F.col("year") - 1)
    corrected = orders.filter("year >= 1998").withColumn(
        "year", F.coalesce(moved, F.col("year"))
    )
    tables.create_or_merge_partitions(corrected, name, ["o_orderkey"], "year")
    return spark.table(name)


@query
def fact_build(spark, sf_dir):
    known = _known_customers(spark, sf_dir).select(
        F.col("c_custkey").alias("customer_id")
    )
    customers = keys.dense_keys(known, ["customer_id"], "DimCustomerKey")
    # a third of the products is unknown, often several of an order
    products = stand_ins.products(spark, sf_dir).filter("product_id % 3 <> 0")
    return facts.build_order_facts(
        stand_ins.sales(spark, sf_dir),
        customers,
        products,
        [("amount", "desc"), "line_no"],
    ).drop("line_no")


@query
def scd2_dim(spark, sf_dir):
    return history.build_versions(
        table(spark, sf_dir, "events").select("user_id", "event_type", "ts"),
        ["user_id"], "ts", "start_at", "end_at",
    )


@query
def scd2_reference_degenerate(spark, sf_dir):
    """Sequence equal to the key: one version per product, never ended."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return history.build_versions(
        part, ["p_partkey"], "p_partkey", "start_at", "end_at"
    )


@query
def current_version(spark, sf_dir):
    return history.current_versions(scd2_dim(spark, sf_dir), "end_at").drop("end_at")


@query
def scd2_stream(spark, sf_dir):
    """Changes streamed in two batches whose times interleave."""
    bronze, gold = _layers(spark, "scd2_stream", "bronze", "gold")
    folder = scratch_path(spark, "scd2-files")
    source, target = f"{bronze}.events", f"{gold}.dimusers"
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    late = F.col("event_type").isin("click", "error")
    for name, part in [("events_first", ~late), ("events_second", late)]:
        events.filter(part).write.parquet(f"{folder}/{name}.parquet")
        ingest(spark, folder, "events", source)
        stream = cleaning.drop_rescued(tables.stream_table(spark, source))
        change_stream.apply_stream(stream, source, target, ["user_id"], "ts")
    return _versions_of(spark, target)


def _versions_of(spark, target) -> DataFrame:
    versions = spark.table(target).drop(tables.BUCKET, cleaning.ARRIVED)
    return versions.withColumnsRenamed({history.START: "start_at", history.END: "end_at"})


@query
def scd2_corrected_version(spark, sf_dir):
    """Versions delivered again with another value, before and after a first load."""
    bronze, gold = _layers(spark, "scd2_corrected", "bronze", "gold")
    folder = scratch_path(spark, "scd2-corrected-files")
    source, target = f"{bronze}.events", f"{gold}.dimusers"
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    lower, upper = F.lower("event_type"), F.upper("event_type")
    deliveries = {
        "events_a": events.withColumn("event_type", lower),
        "events_b": events.filter("event_type = 'click'").withColumn("event_type", upper),
        "events_c": events.filter("event_type = 'error'").withColumn("event_type", upper),
    }
    for name, rows in deliveries.items():
        rows.write.parquet(f"{folder}/{name}.parquet")
        if name == "events_a":
            continue  # taken together with the next one
        ingest(spark, folder, "events", source)
        stream = tables.stream_table(spark, source).drop(cleaning.RESCUED, cleaning.BATCH)
        change_stream.apply_stream(stream, source, target, ["user_id"], "ts")
    return _versions_of(spark, target)


def _changed_parts(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Two states of the products: some dearer, some gone, some new."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    dearer = F.when(F.col("p_partkey") % 3 == 0, F.col("p_retailprice") + 1)
    after = part.filter("p_partkey % 7 <> 0").withColumn(
        "p_retailprice", F.coalesce(dearer, F.col("p_retailprice"))
    )
    return part.filter("p_partkey % 5 <> 0"), after


@query
def change_feed(spark, sf_dir):
    return feed.change_feed(*_changed_parts(spark, sf_dir), ["p_partkey"])


@query
def skip_changes(spark, sf_dir):
    """A table rewritten by a load: the stage follows its feed and takes new rows only."""
    silver, gold = _layers(spark, "skip_changes", "silver", "gold")
    silver_parts, changes = f"{silver}.parts", f"{silver}.parts_feed"
    stage = f"{gold}.parts_stage"
    for state in _changed_parts(spark, sf_dir):
        change_stream.publish_with_feed(state, silver_parts, changes, ["p_partkey"])
        change_stream.stage_table(
            spark, changes, stage, {"rule1": "p_name IS NOT NULL"}, [feed.INSERT]
        )
    return spark.table(stage).drop(cleaning.BATCH)


@query
def fact_build_as_of(spark, sf_dir):
    """Every other event takes the version its user had an hour after it."""
    events = table(spark, sf_dir, "events")
    versions = history.build_versions(
        events.filter("event_id % 2 = 0").select("user_id", "event_type", "ts"), ["user_id"], "ts"
    )
    facts = events.filter("event_id % 2 = 1").select(
        "event_id", "user_id", (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("at")
    )
    return asof.look_up_as_of(
        facts, versions.withColumn("valid_from", F.col(history.START)), {"user_id": "user_id"},
        "at", history.START, ["event_type", "valid_from"], history.END,
    )


# --- data quality ------------------------------------------------------------


EVENT_RULES = {"rule1": "event_id IS NOT NULL", "rule2": "user_id IS NOT NULL"}


def _events_with_nulls(spark, sf_dir) -> DataFrame:
    return _with_nulls(table(spark, sf_dir, "events"))


def _with_nulls(events: DataFrame) -> DataFrame:
    return events.select(
        F.when(F.col("event_type") != "error", F.col("event_id")).alias("event_id"),
        F.when(F.col("value") < 10, F.col("user_id")).alias("user_id"),
    )


@query
def expectation_counts(spark, sf_dir):
    return quality.expectation_counts(_events_with_nulls(spark, sf_dir), EVENT_RULES)


@query
def expect_or_drop(spark, sf_dir):
    """A stream into a staging table that drops rows breaking a rule."""
    bronze, gold = _layers(spark, "expect", "bronze", "gold")
    folder = scratch_path(spark, "expect-files")
    events = _events_with_nulls(spark, sf_dir)
    events.write.parquet(f"{folder}/events.parquet")
    ingest(spark, folder, "events", f"{bronze}.events")
    stage = change_stream.stage_table(
        spark, f"{bronze}.events", f"{gold}.events_stage", EVENT_RULES
    )
    return cleaning.drop_rescued(stage)


@query
def expectation_log(spark, sf_dir):
    """What every batch of a staging stream broke, over two deliveries."""
    bronze, gold = _layers(spark, "expectation_log", "bronze", "gold")
    folder = scratch_path(spark, "expectation-log-files")
    source, stage = f"{bronze}.events", f"{gold}.events_stage"
    for name, part in [("a", "value < 5"), ("b", "value >= 5")]:
        own = table(spark, sf_dir, "events").filter(part)
        _with_nulls(own).write.parquet(f"{folder}/events_{name}.parquet")
        ingest(spark, folder, "events", source)
        change_stream.stage_table(spark, source, stage, EVENT_RULES)
    return change_stream.expectation_totals(spark, stage)


# --- whole loads -------------------------------------------------------------


def _warehouse(spark, sf_dir, label: str) -> dict[str, str]:
    folder = scratch_path(spark, f"{label}-files")
    stand_ins.write_dataset_files(spark, sf_dir, folder)
    return layers.load_warehouse(
        spark, folder, scratch_path(spark, label), "product_id",
        f"{label}_{uuid.uuid4().hex[:8]}_", RUN_TS,
    )


@query
def warehouse_customers(spark, sf_dir):
    names = _warehouse(spark, sf_dir, "wh_customers")
    dim = spark.table(f"{names['gold']}.dim_customers")
    return dim.drop(dimensions.CREATED, dimensions.UPDATED, tables.BUCKET, layers.DIGEST)


@query
def warehouse_products(spark, sf_dir):
    names = _warehouse(spark, sf_dir, "wh_products")
    products = _versions_of(spark, f"{names['gold']}.dimproducts")
    return products.withColumn("discounted_price", F.round("discounted_price", 4))


@query
def warehouse_facts(spark, sf_dir):
    names = _warehouse(spark, sf_dir, "wh_facts")
    return spark.table(f"{names['gold']}.fact_orders").drop(cleaning.ARRIVED)


def _redelivered(spark, sf_dir, label, dataset, key, measure, low, high, loads=2):
    """A load after a delivery that lowers and raises a measure by key, and one before."""
    folder, root = scratch_path(spark, f"{label}-files"), scratch_path(spark, label)
    prefix = f"{label}_{uuid.uuid4().hex[:8]}_"
    stand_ins.write_dataset_files(spark, sf_dir, folder)

    def load():
        return layers.load_warehouse(spark, folder, root, "product_id", prefix, RUN_TS)

    if loads > 1:
        load()
    third = F.col(key) % 3
    known = spark.read.parquet(files.dataset_glob(folder, dataset)).filter(third < 2)
    changed = known.withColumn(measure, F.when(third == 0, low).otherwise(high))
    changed.write.parquet(f"{folder}/{dataset}_2024_03_01.parquet")
    return load()


@query
def warehouse_customers_updated(spark, sf_dir):
    names = _redelivered(
        spark, sf_dir, "wh_updated", "customer", "customer_id", "balance",
        F.lit(-100000.0), F.lit(100000.0),
    )
    dim = spark.table(f"{names['gold']}.dim_customers")
    return dim.drop(dimensions.CREATED, dimensions.UPDATED, tables.BUCKET, layers.DIGEST)


@query
def warehouse_facts_corrected(spark, sf_dir):
    names = _redelivered(
        spark, sf_dir, "wh_corrected", "orders", "order_id", "total_amount",
        F.lit(0.5), F.lit(1000000.0),
    )
    return spark.table(f"{names['gold']}.fact_orders").drop(cleaning.ARRIVED)


@query
def warehouse_same_hour(spark, sf_dir):
    """Orders and their corrections, delivered one after the other and loaded at once."""
    names = _redelivered(
        spark, sf_dir, "wh_same_hour", "orders", "order_id", "total_amount",
        F.lit(0.5), F.lit(1000000.0), loads=1,
    )
    return spark.table(f"{names['gold']}.fact_orders").drop(cleaning.ARRIVED)


def _batch_load(spark, sf_dir) -> str:
    """The batch load to its silver tables, which lie in the returned folder."""
    source, bronze, silver = (
        scratch_path(spark, f"batch-{step}") for step in ("files", "bronze", "silver")
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        # the order table has no product: its priority class stands in for one
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("product_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_totalprice").alias("amount"),
    )
    stand_ins.write_split(
        orders, source, "orders",
        "order_date < DATE'1998-07-01'", "order_date >= DATE'1998-01-01'",
    )
    stand_ins.write_split(
        stand_ins.customers(spark, sf_dir), source, "customer",
        "region_id < 15", "region_id >= 10",
    )
    stand_ins.write_split(
        stand_ins.products(spark, sf_dir), source, "products",
        stand_ins.FIRST_PRODUCTS, stand_ins.SECOND_PRODUCTS,
    )
    stand_ins.regions(spark, sf_dir).write.parquet(f"{source}/regions.parquet")
    batch.copy_files(spark, source, bronze)
    batch.load_silver(spark, bronze, silver)
    return silver


@query
def batch_enriched(spark, sf_dir):
    """The batch load from copied files to the enriched orders."""
    return spark.read.parquet(f"{_batch_load(spark, sf_dir)}/orders_enriched")


def _exported(spark, sf_dir, report: str) -> DataFrame:
    """The batch load to its four reports, and one of them as its CSV files have it."""
    silver, gold = _batch_load(spark, sf_dir), scratch_path(spark, "batch-gold")
    exports = scratch_path(spark, "batch-exports")
    batch.load_gold(spark, silver, gold)
    batch.export_reports(spark, gold, exports)
    schema = spark.read.parquet(f"{gold}/{report}").schema
    return spark.read.schema(schema).option("header", "true").csv(f"{exports}/{report}")


@query
def export_monthly_revenue(spark, sf_dir):
    return _exported(spark, sf_dir, "monthly_revenue")


@query
def export_category_revenue(spark, sf_dir):
    return _exported(spark, sf_dir, "category_revenue")


@query
def export_region_revenue(spark, sf_dir):
    return _exported(spark, sf_dir, "region_revenue")


@query
def export_top_customers(spark, sf_dir):
    return _exported(spark, sf_dir, "top_customers")
