"""The sales model's entities, derived from the TPC-H-like test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# The two product files: every product is in one, some are in both.
FIRST_PRODUCTS = "category <> 'PROMO'"
SECOND_PRODUCTS = "category IN ('PROMO', 'SMALL', 'LARGE')"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sales(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order line: the model's orders, where a product is needed."""
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("l_extendedprice").alias("amount"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_nationkey").alias("region_id"),
    )


def named_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with e-mail and name parts; the segment gives the mail domain."""
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.concat("c_name", F.lit("@"), F.lower("c_mktsegment"), F.lit(".com")).alias(
            "email"
        ),
        F.initcap("c_mktsegment").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.col("c_acctbal").alias("balance"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
    )


def regions(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return nation.join(
        region, nation.n_regionkey == region.r_regionkey, "left"
    ).select(
        F.col("n_nationkey").alias("region_id"),
        F.col("r_name").alias("region_name"),
        F.col("n_name").alias("country"),
    )


def write_split(df: DataFrame, folder: str, name: str, first: str, second: str) -> None:
    """Write ``df`` as the two files of a dataset; the two conditions may overlap."""
    df.filter(first).write.parquet(f"{folder}/{name}_first.parquet")
    df.filter(second).write.parquet(f"{folder}/{name}_second.parquet")


def write_split_once(df: DataFrame, folder: str, name: str, first: str, second: str) -> None:
    """The same of a ``df`` that is dear to compute, in one pass and stored nowhere else.

    A row of both files is written to both. The files are the folders of one partitioned
    write, ``<name>_part=first.parquet`` and ``<name>_part=second.parquet``.
    """
    part = f"{name}_part"
    files = [
        F.when(F.expr(condition), F.lit(f"{ending}.parquet"))
        for ending, condition in (("first", first), ("second", second))
    ]
    dealt = df.withColumn(part, F.explode(F.array_compact(F.array(*files))))
    dealt.write.mode("append").partitionBy(part).parquet(folder)


def write_dataset_files(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """The seven input files of the layered load; each pair shares some rows."""
    write_split(
        named_customers(spark, sf_dir),
        folder, "customer", "balance >= 0", "balance < 5000",
    )
    orders = sales(spark, sf_dir).select(
        "order_id",
        "customer_id",
        "product_id",
        "order_date",
        F.col("amount").alias("total_amount"),
    )
    # the two files overlap: orders and lines are joined once for both
    write_split_once(
        orders, folder, "orders",
        "order_date < DATE'1998-07-01'", "order_date >= DATE'1998-01-01'",
    )
    write_split(
        products(spark, sf_dir), folder, "products", FIRST_PRODUCTS, SECOND_PRODUCTS
    )
    regions(spark, sf_dir).write.parquet(f"{folder}/regions.parquet")
