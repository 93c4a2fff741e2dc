from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions.registry import (
    register_discount,
    register_orders_by_year,
    register_upper,
)
from tidemark.operators import cleaning
from tidemark.operators.joins import enrich
from tidemark.plans import kpis, layers

from conftest import DATA


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_domain_of_malformed_addresses(spark):
    df = spark.createDataFrame([("a@gmail.com",), ("noat",), (None,), ("a@b@c",)], "e string")
    got = [r[0] for r in df.select(cleaning.part_after("e", "@")).collect()]
    assert got == ["gmail.com", None, None, "b"]


@pytest.mark.parametrize("separator", [".", "|", "//", "$"])
def test_separator_is_literal(spark, separator):
    df = spark.createDataFrame([(f"left{separator}right",)], "t string")
    assert df.select(cleaning.part_after("t", separator)).first()[0] == "right"


def test_full_name_is_null_if_a_part_is(spark):
    df = spark.createDataFrame([("A", None), ("B", "C"), (None, None)], "f string, l string")
    got = [r[0] for r in df.select(cleaning.full_name("f", "l")).collect()]
    assert got == [None, "B C", None]


def test_bad_timestamps_become_null(spark):
    texts = ["2024-01-02 03:04:05", "2024-13-01", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(cleaning.parsed_timestamp("t")).collect()]
    assert got == [dt.datetime(2024, 1, 2, 3, 4, 5), None, None, None]


def test_typed_dates_become_timestamps(spark):
    when = dt.datetime(2024, 1, 2, 3, 4, 5)
    df = spark.createDataFrame(
        [(when, when, when.date())], "t timestamp, n timestamp_ntz, d date"
    ).select(*[cleaning.parsed_timestamp(c).alias(c) for c in "tnd"])
    assert {f.dataType.typeName() for f in df.schema} == {"timestamp"}
    assert tuple(df.first()) == (when, when, dt.datetime(2024, 1, 2))


def test_year_filter_reaches_the_scan(spark):
    orders = spark.read.parquet(f"{DATA}/orders.parquet")
    cut = orders.filter(cleaning.in_year("o_orderdate", 1997)).select("o_orderkey")
    plan = plan_of(cut)
    pushed = plan[plan.index("PushedFilters") :].split("]")[0]
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan
    assert cut.count() == orders.filter(F.year("o_orderdate") == 1997).count()


def test_keep_first_is_deterministic_and_total(spark):
    rng = random.Random(3)
    data = [(1 if rng.random() < 0.5 else rng.randrange(9), rng.randrange(4), i) for i in range(300)]
    want = sorted(min((r for r in data if r[0] == k), key=lambda r: r[1:]) for k in {r[0] for r in data})
    for parts in (1, 7):
        df = spark.createDataFrame(data, "k int, o int, id int").repartition(parts)
        kept = cleaning.keep_first(df, ["k"], ["o"])
        assert sorted(tuple(r) for r in kept.collect()) == want
    # copies are cut to one per task before the shuffle
    fresh = spark.createDataFrame(data, "k int, o int, id int")
    plan = plan_of(cleaning.keep_first(fresh, ["k"], ["o"]))
    assert "Window" not in plan and "partial_min(" in plan


def test_keep_first_takes_any_type_both_ways(spark):
    """Falling orders of every type put nulls last, as SQL does, and maps are no obstacle."""
    moments = [dt.datetime(2024, 1, 1, 0, 0, 0, n) for n in (0, 1, 2)]
    values = {
        "int": [-(2**31), 0, 2**31 - 1, None],
        "bigint": [-(2**63), -1, 2**63 - 1, None],
        "double": [float("-inf"), -0.5, 2.0, float("nan"), None],
        "decimal(9,2)": [Decimal("-1.50"), Decimal("0.00"), Decimal("7.25"), None],
        "boolean": [False, True, None],
        "date": [dt.date(1960, 1, 1), dt.date(2024, 1, 1), None],
        "timestamp": [*moments, None],
        "timestamp_ntz": [*moments, None],
        "string": ["", "a", "aa", "ab", "b", "é", None],
        "binary": [b"", b"\x00", b"\x00\xff", b"\xff", None],
        "struct<x:string,y:int>": [("a", 1), ("a", 2), ("b", None), ("b", 0), None],
    }
    for kind, rising in values.items():
        data = [(k, v, n) for k in (1, 2) for n, v in enumerate(rising)]
        df = spark.createDataFrame(data, f"k int, v {kind}, n int").repartition(5)
        order = sorted(range(len(rising)), key=lambda n: (rising[n] is None, -n))
        for _ in rising:
            top = cleaning.keep_first(df, ["k"], [("v", "desc")])
            assert {r["n"] for r in top.collect()} == {order[0]}, (kind, order)
            df = df.filter(F.col("n") != order.pop(0))
            if len(order) < len(rising) - 2:
                break
    tagged = [(1, {"b": 1}, 2), (1, {"a": 1}, 2), (1, {"a": 1}, 3), (2, None, 1)]
    df = spark.createDataFrame(tagged, "k int, tags map<string,int>, n int")
    assert rows(cleaning.keep_first(df, ["k"], [("n", "desc")])) == [(1, {"a": 1}, 3), (2, None, 1)]
    assert rows(cleaning.keep_first(df, ["k"], [])) == [(1, {"a": 1}, 2), (2, None, 1)]
    with pytest.raises(ValueError, match="asc nor desc"):
        cleaning.keep_first(df, ["k"], [("n", "down")])


def test_the_later_of_two_split_files_wins(spark):
    old = spark.createDataFrame([(1, "z@new"), (2, "b")], "id int, email string")
    new = spark.createDataFrame([("a@old", 1)], "email string, id int")
    assert rows(cleaning.union_distinct_on([old, new], ["id"])) == [(1, "a@old"), (2, "b")]
    assert rows(cleaning.union_distinct_on([new, old], ["id"]).select("id", "email")) == [(1, "z@new"), (2, "b")]


def test_union_matches_names_and_keeps_duplicates(spark):
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    b = spark.createDataFrame([("x", 1), ("y", 2)], "v string, id int")
    assert rows(cleaning.union_all([a, b])) == [(1, "x"), (1, "x"), (2, "y")]
    assert rows(cleaning.union_distinct_on([a, b], ["id"])) == [(1, "x"), (2, "y")]


def test_clean_orders_customers_products(spark):
    when = dt.datetime(2024, 1, 5, 10)
    orders = spark.createDataFrame(
        [(1, 1, 5.0, when), (2, None, 5.0, when), (3, 1, 0.0, when), (4, 1, None, when)],
        "order_id int, customer_id int, amount double, order_date timestamp",
    )
    assert rows(cleaning.cleaned(orders, cleaning.BATCH_RULES["orders"])) == [(1, 1, 5.0, dt.date(2024, 1, 5))]
    customers = spark.createDataFrame([(1, " A "), (None, "B")], "customer_id int, customer_name string")
    assert rows(cleaning.cleaned(customers, cleaning.BATCH_RULES["customers"])) == [(1, "A")]
    products = spark.createDataFrame([(1, None), (None, "c")], "product_id int, category string")
    assert rows(cleaning.cleaned(products, cleaning.BATCH_RULES["products"])) == [(1, "Uncategorized")]


def test_silver_tables(spark):
    customers = spark.createDataFrame(
        [(1, "a@x.com", "A", "B", None)],
        "customer_id int, email string, first_name string, last_name string, _rescued_data string",
    )
    silver = layers.silver_customers(customers)
    assert silver.columns == ["customer_id", "email", "domains", "full_name"]
    assert rows(layers.customers_per_domain(silver)) == [("x.com", 1)]
    assert layers.customers_of_domain(silver, "gmail.com").isEmpty()
    orders = spark.createDataFrame([(1, "2024-01-05", None)], "order_id int, order_date string, _rescued_data string")
    assert rows(layers.silver_orders(orders)) == [(1, dt.datetime(2024, 1, 5), 2024)]
    products = spark.createDataFrame([(1, 10.0, None)], "product_id int, price double, _rescued_data string")
    assert rows(layers.silver_products(products)) == [(1, 10.0, 9.0)]
    regions = spark.createDataFrame([(1, None)], "region_id int, _rescued_data string")
    assert layers.silver_regions(regions).columns == ["region_id"]


def test_discount_is_inlined_and_upper_is_null_safe(spark):
    discount, upper = register_discount(spark), register_upper(spark)
    df = spark.createDataFrame([(1.0, "straße"), (None, None)], "p double, b string")
    priced = df.select(F.expr(f"{discount}(p)").alias("d"))
    assert "* 0.9)" in plan_of(priced) and rows(priced) == [(0.9,), (None,)]
    shout = df.select(F.expr(f"{upper}(b)").alias("u"))
    assert "ArrowEvalPython" in plan_of(shout) and rows(shout) == [("STRASSE",), (None,)]


def test_discount_stored_in_a_schema(spark, layer):
    name = register_discount(spark, f"{layer}.discount_func")
    assert spark.sql(f"SELECT {name}(10D) AS d").first().d == 9.0


def test_table_function_prunes_by_date(spark):
    orders = spark.read.parquet(f"{DATA}/orders.parquet").selectExpr(
        "o_orderkey AS order_id", "o_orderdate AS order_date"
    )
    orders.createOrReplaceTempView("tf_orders")
    name = register_orders_by_year(spark, "tf_orders")
    got = spark.sql(f"SELECT * FROM {name}(1996)")
    assert {r.year for r in got.collect()} == {1996}
    plan = plan_of(got)
    assert "GreaterThanOrEqual(o_orderdate" in plan[plan.index("PushedFilters") :]


ORDERS = "order_id int, customer_id int, product_id int, order_date date, amount double"
DAY = dt.date(2024, 1, 5)


def star(spark):
    sales = [(1, 1, 1, DAY, 10.0), (2, 1, 1, DAY, None), (3, 7, 2, DAY, 2.5), (None, None, None, DAY, 1.0)]
    return (
        spark.createDataFrame(sales, ORDERS),
        spark.createDataFrame([(1, "Ann", 1)], "customer_id int, customer_name string, region_id int"),
        spark.createDataFrame([(1, "pens", 1.0)], "product_id int, category string, price double"),
        spark.createDataFrame([(1, "North", "NO")], "region_id int, region_name string, country string"),
    )


def test_reports_equal_aggregates_of_the_enriched_table(spark):
    """Summing before the joins gives what summing after them gives, nulls included."""
    sales, customers, products, regions = star(spark)
    wide = enrich(sales, customers, products, regions)
    measures = [
        F.round(F.sum("amount"), 2),
        F.count("order_id"),
        F.round(F.avg("amount"), 2),
    ]

    def direct(keys, count):
        return rows(wide.groupBy(*keys).agg(*measures[:count]))

    assert rows(kpis.category_revenue(sales, products)) == direct(["category"], 2)
    assert rows(kpis.region_revenue(sales, customers, regions)) == direct(["region_name", "country"], 3)
    assert rows(kpis.top_customers(sales, customers, regions)) == direct(
        ["customer_id", "customer_name", "region_name"], 2
    )
    report = kpis.region_category_report(spark, sales, customers, products, regions)
    got = rows(report, "region_name", "category", "revenue", "total_orders", "avg_order_value")
    assert got == direct(["region_name", "category"], 3)


def test_top_customers_is_a_top_k_not_a_sort(spark):
    sales, customers, _, regions = star(spark)
    plan = plan_of(kpis.top_customers(sales, customers, regions))
    assert "TakeOrderedAndProject" in plan
    ranked = kpis.ranked_in_region(kpis.top_customers(sales, customers, regions), 1)
    # dense rank per region; the customers without a region form one group
    assert len(rows(ranked)) == 2
