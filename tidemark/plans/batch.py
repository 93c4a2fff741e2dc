"""The batch load: copied files, one enriched table, four reports, CSV exports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.cleaning import (
    BATCH_RULES,
    cleaned,
    union_distinct_on,
)
from tidemark.operators.joins import enrich
from tidemark.plans import kpis
from tidemark.session import side_by_side
from tidemark.sources.tables import export_csv, write_parquet

# The files of the batch load and the reports it exports.
FILES = (
    "customer_first",
    "customer_second",
    "orders_first",
    "orders_second",
    "products_first",
    "products_second",
    "regions",
)
REPORTS = ("monthly_revenue", "category_revenue", "region_revenue", "top_customers")


def copy_files(
    spark: SparkSession, source: str, target: str, names: Sequence[str] = FILES
) -> dict[str, int]:
    """Copy the file sets as they are, all at once; returns the rows of each."""

    def copy(name: str) -> int:
        files = spark.read.parquet(f"{source}/{name}.parquet")
        return write_parquet(files, f"{target}/{name}")

    return side_by_side(spark, {name: partial(copy, name) for name in names})


def cleaned_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Split files united, one row per id, cleaned."""

    def united(name: str, key: str) -> DataFrame:
        halves = [
            spark.read.parquet(f"{folder}/{name}_{half}")
            for half in ("first", "second")
        ]
        return union_distinct_on(halves, [key])

    return {
        "customers": cleaned(united("customer", "customer_id"), BATCH_RULES["customers"]),
        "orders": cleaned(united("orders", "order_id"), BATCH_RULES["orders"]),
        "products": cleaned(united("products", "product_id"), BATCH_RULES["products"]),
        "regions": spark.read.parquet(f"{folder}/regions"),
    }


def load_silver(spark: SparkSession, bronze: str, silver: str) -> dict[str, int]:
    """Write the cleaned tables and the enriched orders; returns the rows of each."""
    cleaned = cleaned_tables(spark, bronze)
    rows = side_by_side(
        spark,
        {n: partial(write_parquet, df, f"{silver}/{n}") for n, df in cleaned.items()},
    )
    orders, customers, products, regions = (
        spark.read.parquet(f"{silver}/{name}")
        for name in ("orders", "customers", "products", "regions")
    )
    enriched = enrich(orders, customers, products, regions)
    rows["orders_enriched"] = write_parquet(enriched, f"{silver}/orders_enriched")
    return rows


def load_gold(spark: SparkSession, silver: str, gold: str) -> dict[str, int]:
    """Write the four reports; returns the rows of each.

    They are summed from the cleaned tables rather than from the enriched one,
    so that no report scans columns of all four tables per order.
    """
    orders, customers, products, regions = (
        spark.read.parquet(f"{silver}/{name}")
        for name in ("orders", "customers", "products", "regions")
    )
    reports = {
        "monthly_revenue": kpis.monthly_revenue(orders),
        "category_revenue": kpis.category_revenue(orders, products),
        "region_revenue": kpis.region_revenue(orders, customers, regions),
        "top_customers": kpis.top_customers(orders, customers, regions),
    }
    return side_by_side(
        spark,
        {n: partial(write_parquet, reports[n], f"{gold}/{n}") for n in REPORTS},
    )


def export_reports(spark: SparkSession, gold: str, folder: str) -> None:
    for name in REPORTS:
        export_csv(spark.read.parquet(f"{gold}/{name}"), f"{folder}/{name}")
