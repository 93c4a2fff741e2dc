from __future__ import annotations

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.ranking import ranked, top_n_per_group
from tidemark.operators.spans import SPAN, span_count, split_into_spans
from tidemark.scratch import materialise

from test_skew import SMALL, final_plan

OUT = {"dense_rank": "d", "rank": "r", "row_number": "n"}


def skewed_rows(seed: int, size: int = 600):
    """A group, and inside it a value, that hold well over a third of the rows."""
    rng = random.Random(seed)
    rows = []
    for i in range(size):
        group = "hot" if rng.random() < 0.6 else rng.choice(["a", "b", None])
        value = 5.0 if rng.random() < 0.5 else rng.choice([1.0, 2.0, 7.0, 9.5, None])
        rows.append((group, value, i))
    return rows


def expected(rows):
    """Ranks by definition, one group at a time."""
    result = []
    for group in {r[0] for r in rows}:
        members = [r for r in rows if r[0] == group]
        # descending order puts nulls last
        members.sort(key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))
        seen = []
        for position, (_, value, key) in enumerate(members, 1):
            if not seen or seen[-1][0] != value:
                seen.append((value, position))
            result.append((group, value, key, len(seen), seen[-1][1], position))
    return sorted(result, key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3, 4, 5])
def test_ranks_by_definition(spark, seed):
    rows = skewed_rows(seed)
    df = spark.createDataFrame(rows, "g string, v double, id int")
    got = ranked(df, OUT, ["g"], [("v", "desc")], tie_breaker=["id"])
    assert got.columns == ["g", "v", "id", "d", "r", "n"]
    found = sorted([tuple(r) for r in got.collect()], key=repr)
    assert found == expected(rows)


def test_split_ranks_of_identical_rows(spark):
    """Copies cannot be told apart, yet must not all share one task."""
    df = spark.range(500).select(F.lit("g").alias("g"), F.lit(1).alias("v"))
    got = ranked(df, {"rank": "r", "dense_rank": "d"}, ["g"], [("v", "asc")], [])
    assert got.groupBy("r", "d").count().collect()[0].asDict() == {
        "r": 1, "d": 1, "count": 500,
    }
    spans = split_into_spans(df, ["g"], [("v", "asc")], unique=False)
    sizes = [r["count"] for r in spans.groupBy(SPAN).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 300


def test_ranks_are_bigint(spark):
    df = spark.createDataFrame([("g", 1, 1)], "g string, v int, id int")
    got = ranked(df, OUT, ["g"], [("v", "desc")], ["id"])
    assert [got.schema[name].dataType.simpleString() for name in "drn"] == ["bigint"] * 3
    assert ranked(df.limit(0), OUT, ["g"], [("v", "desc")], ["id"]).isEmpty()


def with_plain_windows(df, group, order):
    """The same ranks by windows over whole groups."""
    by_value = W.partitionBy(*group).orderBy(*order)
    total = W.partitionBy(*group).orderBy(*order, "id")
    ranks = {"d": F.dense_rank().over(by_value), "r": F.rank().over(by_value)}
    ranks["n"] = F.row_number().over(total)
    return df.withColumns({name: rank.cast("bigint") for name, rank in ranks.items()})


def test_several_order_columns(spark):
    rows = [("g", i % 3, i % 5, i) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, a int, b int, id int")
    order = [("a", "desc"), ("b", "asc")]
    split = ranked(df, OUT, ["g"], order, ["id"])
    plain = with_plain_windows(df, ["g"], [F.desc("a"), "b"])
    columns = ["id", "d", "r", "n"]
    assert split.select(columns).exceptAll(plain.select(columns)).isEmpty()


def test_ranks_over_the_whole_frame(spark):
    df = spark.createDataFrame([(i % 7, i) for i in range(300)], "v int, id int")
    order = [("v", "desc")]
    split = ranked(df, OUT, [], order, ["id"])
    plain = with_plain_windows(df, [], [F.desc("v")])
    assert split.count() == 300 and split.exceptAll(plain).isEmpty()


def test_row_number_needs_a_total_order(spark):
    with pytest.raises(ValueError, match="tie_breaker"):
        ranked(spark.range(1), {"row_number": "n"}, ["id"], [("id", "asc")])


def test_spans_grow_with_the_stored_input(spark):
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert span_count(materialise(spark.range(10), "t")) == least
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        stored = materialise(spark.range(200_000).select(F.xxhash64("id")), "t")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20KB")
        assert span_count(stored) > 10 * least
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranked_result_has_no_shuffle_of_the_rows(spark):
    """Ranks of few values are joined to a scan that is neither sorted nor shuffled."""
    df = materialise(spark.range(100).withColumn("g", F.col("id") % 3), "t")
    outputs = {"rank": "r", "dense_rank": "d"}
    plan = plan_of(ranked(df, outputs, ["g"], [("id", "desc")]))
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 1
    assert "Sort [" not in plan and "hashpartitioning" not in plan
    plan = plan_of(ranked(df, OUT, ["g"], [("id", "desc")], ["id"]))
    assert "SortMergeJoin" not in plan and "Sort [" not in plan


def test_hot_value_is_split_where_values_are_many(spark, tmp_path):
    """Half of the rows have one value, and the table of values is not broadcast."""
    value = F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id"))
    rows = spark.range(40_000).select("id", (F.col("id") % 2).alias("g"), value.alias("v"))
    rows.repartition(8).write.parquet(f"{tmp_path}/rows")
    before = {key: spark.conf.get(key, None) for key in SMALL}
    try:
        for key, setting in SMALL.items():
            spark.conf.set(key, setting)
        got = ranked(spark.read.parquet(f"{tmp_path}/rows"), {"rank": "r"}, ["g"], [("v", "asc")])
        assert "skew=true" in final_plan(got)
        assert got.filter("g = 0 AND r <> 1").isEmpty()
        assert got.filter("g = 1").select("r").distinct().count() == 20_000
    finally:
        for key, setting in before.items():
            spark.conf.unset(key) if setting is None else spark.conf.set(key, setting)


def test_top_n_limits_on_the_map_side(spark):
    df = spark.range(100).withColumn("g", F.col("id") % 3)
    top = top_n_per_group(df, 2, ["g"], [("id", "desc")], "place")
    assert plan_of(top).count("WindowGroupLimit") == 2
    assert sorted((r.g, r.id, r.place) for r in top.collect()) == [
        (0, 96, 2), (0, 99, 1), (1, 94, 2), (1, 97, 1), (2, 95, 2), (2, 98, 1),
    ]


def test_split_plan_has_no_window_over_a_whole_group(spark):
    """The window is by span and runs on the spans' own partitions."""
    df = spark.range(100).withColumn("g", F.col("id") % 3)
    spread = split_into_spans(df, ["g"], [("id", "asc")], unique=True)
    window = W.partitionBy(SPAN, "g").orderBy("id")
    plan = plan_of(spread.withColumn("n", F.row_number().over(window)))
    assert "rangepartitioning(g" in plan and f"partition_id({SPAN}" in plan
    assert plan.count("Exchange") == 2 and plan.count("Window [") == 1


def test_each_span_has_a_partition_of_its_own(spark):
    df = spark.range(6000).withColumn("g", F.col("id") % 2)
    spread = split_into_spans(df, ["g"], [("id", "asc")], unique=True)
    per_task = (
        spread.groupBy(F.spark_partition_id().alias("task"))
        .agg(F.countDistinct(SPAN).alias("spans"), F.count(F.lit(1)).alias("rows"))
        .collect()
    )
    assert len(per_task) == 6 and {r.spans for r in per_task} == {1}
    assert max(r["rows"] for r in per_task) < 2 * 6000 / 6
