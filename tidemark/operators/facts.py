"""Order facts: one row per order, customer and product, with dimension keys."""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.asof import look_up_as_of
from tidemark.operators.cleaning import Preference, keep_first
from tidemark.operators.history import END, START
from tidemark.operators.joins import UNKNOWN_KEY, known_or, look_up_key

FACT_KEYS = ["order_id", "customer_id", "product_id"]


def build_order_facts(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    order: Preference = (),
    at: str | None = None,
) -> DataFrame:
    """Facts from orders and the two dimensions.

    ``products`` holds one row per product: pass the current versions of a
    history. With ``at``, a column of the orders, it is the history itself, and an
    order takes the version that held at that time, whose start it keeps as
    ``product_valid_from``. ``order`` says which copy of a natural key survives; copies go by
    natural keys, so lines of several unknown products stay apart. An order without
    a dimension row gets the unknown key -1. Natural keys are kept: facts are
    merged on them, so a dimension row that arrives later replaces the -1.

    All columns of the orders move once: copies of a key have one customer, so where the
    lookup shuffles by customer they are together already. If a hot customer is split
    there, Spark shuffles once more. Products add no value of their own, so only their
    numbers are compared, which reads ``orders`` a second time.
    """
    located = look_up_key(
        orders, customers, {"customer_id": "customer_id"}, "DimCustomerKey", "DimCustomerKey"
    )
    keyed = keep_first(located, FACT_KEYS, order)
    if at is None:
        numbers = orders.select("product_id")
        return known_or(keyed, numbers, products, "product_id", "product_id", "DimProductKey")
    dated = products.select("product_id", START, END)
    found = look_up_as_of(keyed, dated, {"product_id": "product_id"}, at, START, [START], END)
    known = F.when(F.col(START).isNotNull(), F.col("product_id"))
    return found.withColumn("DimProductKey", F.coalesce(known, F.lit(UNKNOWN_KEY))).withColumnRenamed(
        START, "product_valid_from"
    )
