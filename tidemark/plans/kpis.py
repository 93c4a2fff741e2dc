"""Revenue reports over sales facts.

Facts are summed per dimension key before the dimension is joined. The partial
sums are built on the map side, so a customer or product holding a third of all
sales reaches the shuffle as one row per task, and the join runs over keys
instead of sales. Sums of partial sums give the same report as joining first,
also if a key had several dimension rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ranking import top_n_per_group

TOP_CUSTOMERS = 100
REPORT_ROWS = 50
TOP_IN_REGION = 5

_AMOUNT, _AMOUNTS, _ORDERS = "_amount", "_amounts", "_orders"


def _partial(sales: DataFrame, keys: Sequence[str]) -> DataFrame:
    return sales.groupBy(*keys).agg(
        F.sum("amount").alias(_AMOUNT),
        F.count("amount").alias(_AMOUNTS),
        F.count("order_id").alias(_ORDERS),
    )


def _revenue():
    return F.round(F.sum(_AMOUNT), 2)


def _orders():
    return F.sum(_ORDERS)


def _average():
    return F.round(F.try_divide(F.sum(_AMOUNT), F.sum(_AMOUNTS)), 2)


def monthly_revenue(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy(
            F.year("order_date").alias("year"), F.month("order_date").alias("month")
        )
        .agg(
            F.round(F.sum("amount"), 2).alias("total_revenue"),
            F.count("order_id").alias("total_orders"),
            F.round(F.avg("amount"), 2).alias("avg_order_value"),
        )
        .orderBy("year", "month")
    )


def category_revenue(sales: DataFrame, products: DataFrame) -> DataFrame:
    per_product = _partial(sales, ["product_id"])
    return (
        per_product.join(products, "product_id", "left")
        .groupBy("category")
        .agg(_revenue().alias("revenue"), _orders().alias("total_orders"))
        .orderBy(F.desc("revenue"))
    )


def _located(customers: DataFrame, regions: DataFrame) -> DataFrame:
    return customers.join(regions, "region_id", "left")


def region_revenue(
    sales: DataFrame, customers: DataFrame, regions: DataFrame
) -> DataFrame:
    per_customer = _partial(sales, ["customer_id"])
    return (
        per_customer.join(_located(customers, regions), "customer_id", "left")
        .groupBy("region_name", "country")
        .agg(
            _revenue().alias("revenue"),
            _orders().alias("total_orders"),
            _average().alias("avg_order_value"),
        )
        .orderBy(F.desc("revenue"))
    )


def top_customers(
    sales: DataFrame,
    customers: DataFrame,
    regions: DataFrame,
    n: int = TOP_CUSTOMERS,
) -> DataFrame:
    """The ``n`` customers with the highest spend; the id decides ties."""
    per_customer = _partial(sales, ["customer_id"])
    return (
        per_customer.join(_located(customers, regions), "customer_id", "left")
        .groupBy("customer_id", "customer_name", "region_name")
        .agg(_revenue().alias("total_spend"), _orders().alias("order_count"))
        .orderBy(F.desc("total_spend"), "customer_id")
        .limit(n)
    )


def ranked_in_region(top: DataFrame, n: int = TOP_IN_REGION) -> DataFrame:
    """Of the top customers, the best ``n`` spending ranks of each region."""
    return top_n_per_group(
        top, n, ["region_name"], [("total_spend", "desc")], "rank_in_region"
    )


def region_category_report(
    spark: SparkSession,
    sales: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    regions: DataFrame,
    rows: int = REPORT_ROWS,
) -> DataFrame:
    """Revenue by region and category, in SQL over registered views.

    Sales meet the products row by row, since summing per customer and product
    first would hardly shrink them; per customer and category it does.
    """
    views = {
        "sales": sales,
        "customers": customers,
        "products": products,
        "regions": regions,
    }
    for name, frame in views.items():
        frame.createOrReplaceTempView(f"report_{name}")
    return spark.sql(f"""
        WITH per_customer AS (
            SELECT s.customer_id, p.category, count(s.order_id) AS orders,
                   sum(s.amount) AS amount, count(s.amount) AS amounts
            FROM report_sales s LEFT JOIN report_products p
              ON s.product_id = p.product_id
            GROUP BY s.customer_id, p.category
        )
        SELECT r.region_name, s.category,
               sum(s.orders) AS total_orders,
               round(sum(s.amount), 2) AS revenue,
               round(try_divide(sum(s.amount), sum(s.amounts)), 2) AS avg_order_value
        FROM per_customer s
        LEFT JOIN report_customers c ON s.customer_id = c.customer_id
        LEFT JOIN report_regions r ON c.region_id = r.region_id
        GROUP BY r.region_name, s.category
        ORDER BY revenue DESC, region_name, category
        LIMIT {rows}
    """)
