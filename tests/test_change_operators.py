"""Point-in-time lookups and change feeds by definition."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.asof import look_up_as_of
from tidemark.operators.feed import change_feed, taken
from tidemark.operators.upsert import row_digest


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def slow_as_of(facts, versions):
    out = []
    for key, at, number in facts:
        held = [v for v in versions if None not in (key, at, v[1]) and v[0] == key and v[1] <= at]
        last = max(held, key=lambda v: v[1], default=None)
        if last and last[2] is not None and at >= last[2]:
            last = None
        out.append((key, at, number, last and last[3]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_as_of_by_definition(spark, seed):
    """Over half of the facts have one key, and its versions lie in few of the spans."""
    rng = random.Random(seed)
    versions = []
    for key in range(12):
        starts = sorted(rng.sample(range(0, 1000), rng.choice([0, 1, 2, 60])))
        ends = [*starts[1:], None]
        versions += [
            (key, s, rng.choice([e, s + 1]), rng.choice([f"{key}-{s}", None]))
            for s, e in zip(starts, ends)
        ]
    versions += [(None, 5, None, "x"), (3, None, None, "y")]
    facts = [
        (rng.choice([4, 4, 4, 4, *range(14), None]), rng.choice([*range(-5, 1100), None]), n)
        for n in range(1500)
    ]
    facts += facts[:200]
    told = spark.createDataFrame(facts, "k int, at int, n int")
    known = spark.createDataFrame(versions, "key int, begin int, until int, v string")
    got = look_up_as_of(told, known, {"k": "key"}, "at", "begin", ["v"], "until")
    assert got.columns == ["k", "at", "n", "v"]
    assert rows(got) == slow_as_of(facts, versions)
    endless = [(k, s, None, v) for k, s, _, v in versions if s is not None]
    assert rows(look_up_as_of(told, known, {"k": "key"}, "at", "begin", ["v"])) == slow_as_of(facts, endless)
    assert look_up_as_of(told.limit(0), known, {"k": "key"}, "at", "begin", ["v"]).isEmpty()
    none = look_up_as_of(told, known.limit(0), {"k": "key"}, "at", "begin", ["v"])
    assert none.count() == len(facts) and none.filter("v IS NOT NULL").isEmpty()


def test_as_of_has_no_range_join_and_spreads_a_hot_key(spark):
    facts = spark.range(20_000).select(F.lit(1).alias("k"), "id")
    versions = spark.range(0, 20_000, 5000).select(F.lit(1).alias("k"), F.col("id").alias("s"))
    got = look_up_as_of(facts, versions, {"k": "k"}, "id", "s", ["s"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "SortMergeJoin" not in plan
    # what the plan scans was written by as many tasks as there are spans
    files = [f for f in got.inputFiles() if "/as-of-" in f]
    assert len(files) >= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert got.filter(F.col("s") != F.floor(F.col("id") / 5000) * 5000).isEmpty()


def test_feed_by_definition(spark):
    schema = "a int, b string, v double, tags map<string,int>"
    before = [(1, "x", 1.0, {"t": 1}), (2, "x", None, None), (3, "x", 3.0, None), (None, "n", 1.0, None), (4, None, 4.0, None)]
    after = [(1, "x", 1.0, {"t": 1}), (2, "x", 0.0, None), (5, "x", 5.0, None), (None, "n", 2.0, None), (4, None, 4.0, None)]
    old, new = (spark.createDataFrame(state, schema) for state in (before, after))
    got = change_feed(old, new, ["a", "b"])
    assert rows(got.drop("tags")) == sorted(
        [(2, "x", 0.0, "update"), (3, "x", 3.0, "delete"), (5, "x", 5.0, "insert"), (None, "n", 2.0, "update")],
        key=repr,
    )
    assert rows(taken(got, ["delete"]).drop("tags")) == [(3, "x", 3.0)]
    assert change_feed(new, new, ["a", "b"]).isEmpty()
    assert change_feed(old.limit(0), new, ["a", "b"]).filter("_change = 'insert'").count() == 5
    wider = change_feed(old, new.withColumn("more", F.lit(1)), ["a", "b"])
    assert rows(wider.groupBy("_change").count()) == [("delete", 1), ("insert", 1), ("update", 2)]
    assert wider.filter("_change = 'delete'").first()["more"] is None


def test_digest_tells_nulls_and_neighbours_apart(spark):
    data = [(None, "a"), ("a", None), ("", "a"), ("a", ""), (None, None), ('"', ","), ("a", "a")]
    df = spark.createDataFrame(data, "x string, y string")
    assert df.select(row_digest(["x", "y"])).distinct().count() == len(data)
    assert df.select(row_digest(["y", "x"]).alias("d")).exceptAll(df.select(row_digest(["x", "y"]))).isEmpty()
