"""Left joins of facts to dimensions.

No side is broadcast by hint: Spark broadcasts a dimension it has measured to be
small, and otherwise shuffles, splitting skewed partitions of the fact side. It
can split only sides that come straight from their shuffle, so a dimension that
was just aggregated or de-duplicated by the join key should be written first, as
the layered and the batch load do.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.scratch import materialise

UNKNOWN_KEY = -1


def enrich(
    orders: DataFrame, customers: DataFrame, products: DataFrame, regions: DataFrame
) -> DataFrame:
    """Every order with its customer, product and region, matched or not.

    Regions are attached to the customers first: that join runs over customers,
    not over orders, and the orders are then joined twice instead of three times.
    """
    located = customers.join(regions, "region_id", "left")
    return orders.join(located, "customer_id", "left").join(
        products, "product_id", "left"
    )


def orders_with_region(
    orders: DataFrame, customers: DataFrame, regions: DataFrame
) -> DataFrame:
    located = customers.join(regions, "region_id", "left")
    return orders.join(located, "customer_id", "left").select(
        "order_id", "customer_name", "region_name", "country", "amount", "order_date"
    )


def look_up_key(
    facts: DataFrame,
    dimension: DataFrame,
    on: Mapping[str, str],
    key: str,
    out: str,
    unknown: int | None = UNKNOWN_KEY,
) -> DataFrame:
    """Attach ``dimension[key]`` as ``out``; ``on`` maps fact to dimension columns.

    A fact without a dimension row gets ``unknown``, or null if that is None.
    """
    wanted = dimension.select(
        *[F.col(d).alias(f"_dim_{d}") for d in on.values()], F.col(key).alias(out)
    )
    match = [facts[f] == wanted[f"_dim_{d}"] for f, d in on.items()]
    joined = facts.join(wanted, match, "left").drop(*[f"_dim_{d}" for d in on.values()])
    if unknown is None:
        return joined
    return joined.withColumn(out, F.coalesce(F.col(out), F.lit(unknown)))


def known_or(
    facts: DataFrame,
    told: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    key: str,
    out: str,
    unknown: int = UNKNOWN_KEY,
) -> DataFrame:
    """``fact_key`` as ``out`` where ``dimension[key]`` has it, ``unknown`` elsewhere.

    As a lookup of ``key`` itself, but facts are not shuffled for it: their different
    keys are, as ``told`` has them, which may be a frame the facts come from. Those the
    dimension lacks are stored, mostly few, and joined back, by a shuffle if they are many.
    """
    wanted = dimension.select(F.col(key).alias("_dim_key"))
    found = told.select(F.col(fact_key).alias("_lacking")).dropna().distinct()
    lacking = found.join(wanted, F.col("_lacking") == F.col("_dim_key"), "left_anti")
    stored = materialise(lacking, "lacking-keys")
    joined = facts.join(stored, facts[fact_key] == stored["_lacking"], "left")
    here = F.col(fact_key).isNotNull() & F.col("_lacking").isNull()
    value = F.when(here, F.col(fact_key).cast(dimension.schema[key].dataType))
    return joined.withColumn(out, F.coalesce(value, F.lit(unknown))).drop("_lacking")


def mark_new_rows(
    source: DataFrame, known: DataFrame, on: Mapping[str, str], out: str = "side"
) -> DataFrame:
    """Tag each source row ``new`` or ``old`` with one join, not one per half."""
    keys = known.select(*[F.col(k).alias(f"_known_{k}") for k in on.values()])
    match = [source[s] == keys[f"_known_{k}"] for s, k in on.items()]
    first = f"_known_{next(iter(on.values()))}"
    side = F.when(F.col(first).isNull(), "new").otherwise("old")
    return source.join(keys, match, "left").select(*source.columns, side.alias(out))
