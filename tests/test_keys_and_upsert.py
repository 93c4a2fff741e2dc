from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.dimensions import apply_type1, first_type1_load
from tidemark.operators.facts import build_order_facts
from tidemark.operators.joins import look_up_key, mark_new_rows
from tidemark.operators.keys import add_new_keys, dense_keys, max_key
from tidemark.operators.upsert import DuplicateKeys, upsert

RUN = dt.datetime(2024, 1, 1)
NEXT = dt.datetime(2024, 1, 2)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)


def test_dense_keys_are_gap_free_and_ordered(spark):
    ids = random.Random(4).sample(range(100_000), 997)
    df = spark.createDataFrame([(i,) for i in ids], "id int").repartition(10)
    keyed = dense_keys(df, ["id"], "k")
    assert rows(keyed) == sorted(
        ((i, k) for k, i in enumerate(sorted(ids), 1)), key=repr
    )
    assert keyed.schema["k"].dataType.typeName() == "long"


@pytest.mark.parametrize("count", [0, 1])
def test_dense_keys_of_tiny_input(spark, count):
    df = spark.range(count)
    assert [r.k for r in dense_keys(df, ["id"], "k").collect()] == [1] * count


def test_dense_keys_read_data_in_no_single_task(spark):
    """The only one-partition step is over the per-partition counts."""
    plan = dense_keys(spark.range(50), ["id"], "k")._jdf.queryExecution()
    text = plan.executedPlan().toString()
    window = text.index("Window [sum(_rows")
    assert text.count("SinglePartition") == 1
    assert "partial_count" in text[window:]


def test_new_keys_follow_the_highest_and_start_at_one(spark):
    empty = spark.createDataFrame([], "id long, k long")
    first = add_new_keys(empty, spark.range(3), ["id"], "k")
    assert rows(first, "id", "k") == [(0, 1), (1, 2), (2, 3)]
    old = spark.createDataFrame([(50, 7), (51, 9)], "id long, k long")
    both = add_new_keys(old, spark.range(2), ["id"], "k")
    assert rows(both, "id", "k") == [(0, 10), (1, 11), (50, 7), (51, 9)]
    assert empty.select(max_key(empty, "k")).count() == 0


TARGET = [(1, "a"), (2, "b"), (None, "n")]


def test_upsert_replaces_inserts_and_keeps(spark):
    target = spark.createDataFrame(TARGET, "id int, v string")
    source = spark.createDataFrame([("B", 2), ("C", 3), ("N", None)], "v string, id int")
    got = rows(upsert(target, source, ["id"]))
    # a null key never matches: both such rows stay, as in a SQL merge
    assert got == sorted(
        [(1, "a"), (2, "B"), (3, "C"), (None, "n"), (None, "N")], key=repr
    )


def test_upsert_rejects_or_reduces_duplicate_source_rows(spark):
    target = spark.createDataFrame(TARGET, "id int, v string")
    source = spark.createDataFrame([(2, "x"), (2, "y")], "id int, v string")
    with pytest.raises(DuplicateKeys):
        upsert(target, source, ["id"])
    reduced = upsert(target, source, ["id"], latest=[("v", "desc")])
    assert (2, "y") in rows(reduced) and (2, "x") not in rows(reduced)


def test_upsert_needs_the_target_columns(spark):
    target = spark.createDataFrame(TARGET, "id int, v string")
    with pytest.raises(ValueError, match="lacks"):
        upsert(target, spark.createDataFrame([(1,)], "id int"), ["id"])


def test_upsert_row_count_property(spark):
    rng = random.Random(9)
    for _ in range(3):
        left = rng.sample(range(60), 25)
        right = rng.sample(range(60), 25)
        target = spark.createDataFrame([(i, "t") for i in left], "id int, v string")
        source = spark.createDataFrame([(i, "s") for i in right], "id int, v string")
        got = dict(rows(upsert(target, source, ["id"])))
        assert got == {**{i: "t" for i in left}, **{i: "s" for i in right}}


def test_type1_first_and_later_load(spark):
    first = spark.createDataFrame(
        [("c", "x"), ("a", "x"), ("a", "x"), (None, "x")], "id string, v string"
    )
    dim = first_type1_load(first, "id", "k", RUN)
    assert rows(dim, "id", "v", "k", "create_date", "update_date") == [
        ("a", "x", 1, RUN, RUN), ("c", "x", 2, RUN, RUN),
    ]
    later = spark.createDataFrame(
        [("a", "y"), ("b", "x"), (None, "z")], "id string, v string"
    )
    dim = apply_type1(dim, later, "id", "k", NEXT)
    assert rows(dim, "id", "v", "k", "create_date", "update_date") == [
        ("a", "y", 1, RUN, NEXT), ("b", "x", 3, NEXT, NEXT), ("c", "x", 2, RUN, RUN),
    ]


@pytest.mark.parametrize("only_changed, updated", [(False, NEXT), (True, RUN)])
def test_type1_reload_changes_at_most_the_update_date(spark, only_changed, updated):
    source = spark.createDataFrame([(1, "x"), (2, None)], "id int, v string")
    dim = first_type1_load(source, "id", "k", RUN)
    again = apply_type1(dim, source, "id", "k", NEXT, only_changed=only_changed)
    assert rows(again, "id", "v", "k", "create_date", "update_date") == [
        (1, "x", 1, RUN, updated), (2, None, 2, RUN, updated),
    ]


def test_type1_clears_an_attribute_that_became_null(spark):
    old = spark.createDataFrame([(1, "x")], "id int, v string")
    dim = first_type1_load(old, "id", "k", RUN)
    cleared = spark.createDataFrame([(1, None)], "id int, v string")
    changed = apply_type1(dim, cleared, "id", "k", NEXT, only_changed=True)
    assert rows(changed, "v", "update_date") == [(None, NEXT)]


def test_type1_without_a_run_time_takes_one_clock_for_all_rows(spark):
    dim = first_type1_load(spark.range(40), "id", "k")
    assert dim.select("create_date").distinct().count() == 1
    assert dim.filter("create_date = update_date").count() == 40


def test_type1_empty_dimension_gives_keys_from_one(spark):
    source = spark.createDataFrame([(5, "x")], "id int, v string")
    empty = first_type1_load(source.limit(0), "id", "k", RUN)
    assert rows(apply_type1(empty, source, "id", "k", NEXT), "id", "k") == [(5, 1)]


def test_lookup_of_missing_and_null_keys(spark):
    facts = spark.createDataFrame([(1,), (2,), (None,)], "c int")
    dim = spark.createDataFrame([(1, 10)], "id int, k long")
    got = look_up_key(facts, dim, {"c": "id"}, "k", "key")
    assert rows(got) == sorted([(1, 10), (2, -1), (None, -1)], key=repr)
    kept = look_up_key(facts, dim, {"c": "id"}, "k", "key", unknown=None)
    assert rows(kept) == sorted([(1, 10), (2, None), (None, None)], key=repr)


def test_new_and_old_rows(spark):
    source = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    known = spark.createDataFrame([(1,), (3,)], "id int")
    got = mark_new_rows(source, known, {"id": "id"})
    assert rows(got) == sorted([(1, "old"), (2, "new"), (None, "new")], key=repr)


def test_facts_keep_one_row_per_natural_key(spark):
    orders = spark.createDataFrame(
        [(1, 1, 7, 10.0), (1, 1, 7, 20.0), (1, 9, 7, 5.0), (2, None, 8, 1.0), (2, None, 9, 2.0)],
        "order_id int, customer_id int, product_id int, total_amount double",
    )
    customers = spark.createDataFrame([(1, 100)], "customer_id int, DimCustomerKey long")
    products = spark.createDataFrame([(7,)], "product_id int")
    facts = build_order_facts(orders, customers, products, [("total_amount", "desc")])
    names = ["order_id", "total_amount", "DimCustomerKey", "DimProductKey"]
    assert set(facts.columns) == {*names, "customer_id", "product_id"}
    # lines of two unknown products stay apart
    assert rows(facts, *names) == [
        (1, 20.0, 100, 7), (1, 5.0, -1, 7), (2, 1.0, -1, -1), (2, 2.0, -1, -1),
    ]
