from __future__ import annotations

import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemark.operators.history import (
    END,
    START,
    apply_changes,
    build_versions,
    current_versions,
)
from tidemark.operators.cleaning import ARRIVED, BATCH
from tidemark.operators.quality import expect_all_or_drop
from tidemark.sources.tables import publish, stream_table
from tidemark.streaming import changes
from tidemark.streaming.changes import (
    PRODUCT_RULES,
    BUCKET,
    apply_stream,
    create_history_table,
    expectation_totals,
    merge_changes,
    publish_with_feed,
    stage_table,
)

SCHEMA = "id int, v string, seq int"
CHANGES = [(1, "a", 10), (1, "A", 20), (1, "Z", 15), (1, "old", 5), (3, "c", 7)]
VERSIONS = [
    (1, "A", 20, None), (1, "Z", 15, 20), (1, "a", 10, 15), (1, "old", 5, 10),
    (3, "c", 7, None),
]


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def versions(df):
    return rows(df, "id", "v", START, END)


def test_versions_in_order_of_sequence(spark):
    df = spark.createDataFrame(CHANGES, SCHEMA)
    got = build_versions(df, ["id"], "seq")
    assert versions(got) == sorted(VERSIONS, key=repr)
    assert rows(current_versions(got), "id", "v") == [(1, "A"), (3, "c")]


def test_history_does_not_depend_on_arrival_or_replay(spark):
    for seed in range(3):
        arrival = CHANGES[:]
        random.Random(seed).shuffle(arrival)
        history = None
        for batch in (arrival[:2], arrival[2:4], arrival[4:], arrival[1:3]):
            df = spark.createDataFrame(batch, SCHEMA)
            history = apply_changes(history, df, ["id"], "seq")
        assert versions(history) == sorted(VERSIONS, key=repr)


def test_intervals_are_gap_free_with_one_open(spark):
    """One key holds more than half of the changes and spans many partitions."""
    rng = random.Random(11)
    changes = [
        (0 if rng.random() < 0.6 else rng.randrange(1, 30), str(i), i)
        for i in range(800)
    ]
    df = spark.createDataFrame(changes, SCHEMA)
    got = build_versions(df, ["id"], "seq")
    by_key = {}
    for key, start, end in rows(got, "id", START, END):
        by_key.setdefault(key, []).append((start, end))
    assert sum(map(len, by_key.values())) == 800
    for intervals in by_key.values():
        intervals.sort()
        assert [e for _, e in intervals] == [s for s, _ in intervals[1:]] + [None]


def test_versions_are_joined_to_edges_without_a_shuffle(spark):
    feed = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], SCHEMA)
    plan = build_versions(feed, ["id"], "seq")._jdf.queryExecution().executedPlan()
    assert "SortMergeJoin" not in plan.toString()
    assert "BroadcastHashJoin" in plan.toString()


def test_changes_without_key_or_sequence_are_left_out(spark):
    df = spark.createDataFrame([(None, "x", 1), (1, "x", None), (2, "x", 1)], SCHEMA)
    assert versions(build_versions(df, ["id"], "seq")) == [(2, "x", 1, None)]


def test_sequence_equal_to_key_never_ends_a_version(spark):
    df = spark.createDataFrame([(1, "x", 0), (1, "y", 0), (2, "x", 0)], SCHEMA)
    got = build_versions(df, ["id"], "id")
    assert rows(got, "id", START, END) == [(1, 1, None), (2, 2, None)]


def test_expectations_drop_and_count(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None), (None, None)], "x int, y string")
    seen = Observation()
    rules = {"has_x": "x IS NOT NULL", "x_small": "x < 3", "has_y": "y IS NOT NULL"}
    kept = expect_all_or_drop(df, rules, seen)
    assert [tuple(r) for r in kept.collect()] == [(1, "a")]
    # x < 3 is null for a null x, which counts as a failure
    assert seen.get == {"rows": 4, "has_x": 2, "x_small": 3, "has_y": 2}


def test_streamed_product_versions(spark, layer):
    """Table -> stage with rules -> versions; a second run without new rows is idle."""
    schema = "product_id int, product_name string, seq int"
    source, stage, dim = (f"{layer}.{n}" for n in ("products", "stage", "dimproducts"))
    spark.sql(f"CREATE TABLE {source} ({schema}) USING parquet")

    def arrive(*new):
        spark.createDataFrame(new, schema).write.insertInto(source)
        stage_table(spark, source, stage, PRODUCT_RULES)
        apply_stream(stream_table(spark, stage).drop(BATCH), stage, dim, ["product_id"], "seq")
        return rows(spark.table(dim), "product_id", "product_name", START, END)

    assert arrive((1, "a", 10), (None, "b", 1), (2, None, 1)) == [(1, "a", 10, None)]
    assert rows(expectation_totals(spark, stage), "rule", "rows_checked", "failures") == [
        ("rule1", 3, 1), ("rule2", 3, 1),
    ]
    assert arrive((1, "early", 5), (3, "c", 1)) == [
        (1, "a", 10, None), (1, "early", 5, 10), (3, "c", 1, None),
    ]
    stage_table(spark, source, stage, PRODUCT_RULES)
    assert rows(expectation_totals(spark, stage), "rule", "rows_checked", "failures") == [
        ("rule1", 5, 1), ("rule2", 5, 1),
    ]
    apply_stream(stream_table(spark, stage).drop(BATCH), stage, dim, ["product_id"], "seq")
    assert spark.table(dim).count() == 3 and spark.table(stage).count() == 3


def test_stream_into_empty_source_declares_the_target(spark, layer):
    source, dim = f"{layer}.p", f"{layer}.d"
    publish(spark.createDataFrame([], "product_id int, seq int"), source)
    apply_stream(stream_table(spark, source), source, dim, ["product_id"], "seq")
    assert spark.table(dim).columns == ["product_id", START, END, BUCKET]


def test_a_corrected_version_replaces_the_earlier_delivery(spark):
    """Whichever of the two is loaded first, and also if both come in one load."""
    schema = f"id int, v string, seq int, {ARRIVED} struct<delivered: int, file: string>"
    old, new = (1, "m", 10, (1, "a")), (1, "Z", 10, (1, "b"))
    other = (1, "n", 20, (0, "c"))
    for loads in ([old, new, other],), ([old], [new, other]), ([new], [other, old]):
        held = None
        for load in loads:
            held = apply_changes(held, spark.createDataFrame(load, schema), ["id"], "seq")
        assert versions(held) == [(1, "Z", 10, 20), (1, "n", 20, None)]


def test_one_changed_key_rewrites_one_bucket(spark, layer):
    name = f"{layer}.d"
    first = spark.range(200).selectExpr("id", "'a' AS v", "1 AS seq")
    create_history_table(first, name, ["id"], "seq", buckets=8)
    assert merge_changes(first, name, ["id"], "seq") == list(range(8))
    before = set(spark.table(name).inputFiles())
    (touched,) = merge_changes(
        spark.createDataFrame([(7, "b", 2), (None, "x", 1)], "id bigint, v string, seq int"),
        name, ["id"], "seq",
    )
    kept = {f for f in before if f"{BUCKET}={touched}/" not in f}
    after = set(spark.table(name).inputFiles())
    assert kept < after and not (before - kept) & after
    assert spark.table(name).count() == 201
    assert rows(spark.table(name).filter("id = 7"), "v", START, END) == [("a", 1, 2), ("b", 2, None)]
    assert merge_changes(first.limit(0), name, ["id"], "seq") == []


def test_expectations_of_many_batches_with_one_repeated(spark, layer, monkeypatch):
    source, stage = f"{layer}.p", f"{layer}.stage"
    spark.sql(f"CREATE TABLE {source} (product_id int, product_name string) USING parquet")
    data = spark.range(105).selectExpr("cast(id AS int) AS product_id", "if(id % 5 = 0, null, 'x') AS product_name")
    data.repartition(105, "product_id").write.insertInto(source)
    options = {"maxFilesPerTrigger": "1"}
    real, failed = changes.expect_all_or_drop, []

    def once(batch, rules):
        if len(failed) == 0 and batch.sparkSession.table(source).count():
            failed.append(1)
            raise RuntimeError("stopped")
        return real(batch, rules)

    with monkeypatch.context() as patched:
        patched.setattr(
            changes, "stream_table", lambda s, t: s.readStream.options(**options).table(t).withColumn(BATCH, F.lit(0))
        )
        patched.setattr(changes, "expect_all_or_drop", once)
        with pytest.raises(Exception, match="stopped"):
            stage_table(spark, source, stage, PRODUCT_RULES)
        stage_table(spark, source, stage, PRODUCT_RULES)
    files = len(spark.table(source).inputFiles())
    assert files > 60 and spark.table(f"{stage}_expectations").select(BATCH).distinct().count() == files
    assert rows(expectation_totals(spark, stage), "rule", "rows_checked", "failures") == [
        ("rule1", 105, 0), ("rule2", 105, 21),
    ]
    assert spark.table(stage).count() == 84


def test_a_rewritten_table_reaches_the_versions(spark, layer):
    silver, feed_table, stage, dim = (f"{layer}.{n}" for n in ("silver", "feed", "stage", "dim"))
    schema = "product_id int, product_name string, seq int"
    states = [
        [(1, "a", 1), (2, "b", 1)],
        [(1, "A", 2), (2, "b", 1), (3, "c", 2)],
        [(1, "A", 2), (3, "c", 2)],
    ]
    for state in states:
        publish_with_feed(spark.createDataFrame(state, schema), silver, feed_table, ["product_id"])
        stage_table(spark, feed_table, stage, PRODUCT_RULES, ["insert", "update"])
        apply_stream(stream_table(spark, stage).drop(BATCH), stage, dim, ["product_id"], "seq")
    assert rows(spark.table(feed_table), "product_id", "_change") == [
        (1, "insert"), (1, "update"), (2, "delete"), (2, "insert"), (3, "insert"),
    ]
    assert rows(spark.table(dim), "product_id", "product_name", START, END) == [
        (1, "A", 2, None), (1, "a", 1, 2), (2, "b", 1, None), (3, "c", 2, None),
    ]
