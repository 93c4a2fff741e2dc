"""Scalar and table functions callable from SQL text and ``expr``."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: what a customer pays after the discount, as a share of the price.
DISCOUNTED_SHARE = "0.90"


def register_discount(spark: SparkSession, name: str = "discount_func") -> str:
    """SQL function ``name(DOUBLE) RETURNS DOUBLE``; Spark inlines its body.

    A name with a schema is stored in the catalog, a plain one in the session.
    """
    kind = "FUNCTION" if "." in name else "TEMPORARY FUNCTION"
    spark.sql(
        f"CREATE OR REPLACE {kind} {name}(p_price DOUBLE) RETURNS DOUBLE "
        f"RETURN p_price * CAST({DISCOUNTED_SHARE} AS DOUBLE)"
    )
    return name


def register_upper(spark: SparkSession, name: str = "upper_func") -> str:
    """Python function ``name(STRING) RETURNS STRING``; Arrow batches, null stays null.

    Kept for queries that call it by name; ``F.upper`` needs no Python worker.
    """

    # nested, so that executors need no copy of this package
    def upper(texts: pd.Series) -> pd.Series:
        return texts.str.upper()

    spark.udf.register(name, F.pandas_udf(upper, T.StringType()))
    return name


def register_orders_by_year(
    spark: SparkSession, orders: str, name: str = "orders_by_year"
) -> str:
    """Table function ``name(year)`` over a view or table with ``order_date``.

    The year becomes a date range, which the file scan can use to skip data.
    """
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(p_year INT) "
        "RETURNS TABLE(order_id BIGINT, year INT) RETURN "
        f"SELECT order_id, CAST(year(order_date) AS INT) AS year FROM {orders} "
        "WHERE order_date >= make_date(p_year, 1, 1) "
        "AND order_date < make_date(p_year + 1, 1, 1)"
    )
    return name
