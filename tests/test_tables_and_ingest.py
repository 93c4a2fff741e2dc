from __future__ import annotations

import datetime as dt
import os
import time
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.operators.cleaning import ARRIVED, BATCH, RESCUED
from tidemark.operators.upsert import DuplicateKeys
from tidemark.plans import batch, layers, stand_ins
from tidemark.scratch import clear_scratch, materialise, shared_dir
from tidemark.session import scan_split_bytes, shuffle_partitions, side_by_side
from tidemark.sources import files, tables
from tidemark.streaming.ingest import Ingest, ingest, ingest_all

from conftest import DATA


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)


def put(spark, folder, name, data, schema):
    spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")


# --- publishing ---------------------------------------------------------------


def test_publish_counts_rows_and_reads_itself(spark, layer):
    name = f"{layer}.t"
    assert tables.publish(spark.range(5), name) == 5
    for expected in (10, 20, 40):
        doubled = spark.table(name).union(spark.table(name))
        assert tables.publish(doubled, name) == expected
        assert spark.table(name).count() == expected


def test_failed_publish_leaves_the_live_version(spark, layer):
    name = f"{layer}.t"
    tables.publish(spark.range(5), name)
    broken = spark.range(5).select(F.raise_error(F.lit("boom")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="boom"):
        tables.publish(broken, name)
    assert spark.table(name).count() == 5


def test_publish_takes_a_new_schema(spark, layer):
    name = f"{layer}.t"
    tables.publish(spark.range(2), name)
    tables.publish(spark.range(3).withColumn("v", F.lit("x")), name)
    assert spark.table(name).columns == ["id", "v"]
    assert spark.table(name).filter("v = 'x'").count() == 3


def test_create_or_merge_twice_changes_nothing(spark, layer):
    name = f"{layer}.t"
    source = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert tables.create_or_merge(source, name, ["id"]) == 2
    assert tables.create_or_merge(source, name, ["id"]) == 2
    assert rows(spark.table(name)) == [(1, "a"), (2, "b")]


SALES = "id int, v string, year int"


def test_partition_merge_writes_touched_partitions_only(spark, layer):
    name = f"{layer}.f"
    first = [(1, "a", 2000), (2, "b", 2001), (3, "c", 2002), (4, "d", None)]
    tables.create_or_merge_partitions(
        spark.createDataFrame(first, SALES), name, ["id"], "year"
    )
    # 1 moves from 2000 to 2003, so 2000 becomes empty; 4 keeps its null year
    changes = [(1, "A", 2003), (4, "D", None), (5, "e", 2002)]
    touched = tables.create_or_merge_partitions(
        spark.createDataFrame(changes, SALES), name, ["id"], "year"
    )
    assert set(touched) == {2000, 2002, 2003, None}
    assert rows(spark.table(name), "id", "v", "year") == sorted(
        [(1, "A", 2003), (2, "b", 2001), (3, "c", 2002), (4, "D", None), (5, "e", 2002)],
        key=repr,
    )
    listed = {r.partition for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    assert "year=2000" not in listed and len(listed) == 4
    pruned = spark.table(name).filter("year = 2001")
    assert len(pruned.inputFiles()) == 1 and "/year=2001/" in pruned.inputFiles()[0]
    for round_ in range(4):
        again = spark.createDataFrame([(2, f"b{round_}", 2001)], SALES)
        assert tables.create_or_merge_partitions(again, name, ["id"], "year") == [2001]
        assert spark.table(name).filter("id = 2").first().v == f"b{round_}"
        assert spark.table(name).count() == 5
    back = spark.createDataFrame([(6, "f", 2000)], SALES)
    tables.create_or_merge_partitions(back, name, ["id", "year"], "year")
    assert rows(spark.table(name).filter("year = 2000")) == [(6, "f", 2000)]


def test_partition_merge_skips_rows_it_holds(spark, layer):
    name = f"{layer}.f"
    data = [(1, "a", 2000), (2, None, 2001), (3, "c", None)]
    source = spark.createDataFrame(data, SALES)
    for unique in (True, False):
        tables.create_or_merge_partitions(source, name, ["id"], "year", unique=unique)
    files = set(spark.table(name).inputFiles())
    assert tables.create_or_merge_partitions(source, name, ["id"], "year") == []
    assert set(spark.table(name).inputFiles()) == files
    # one row of many differs: its partition alone is written
    changed = spark.createDataFrame([*data[:1], (2, "b", 2001), data[2]], SALES)
    assert tables.create_or_merge_partitions(changed, name, ["id"], "year") == [2001]
    assert rows(spark.table(name), "id", "v") == [(1, "a"), (2, "b"), (3, "c")]


def test_partition_merge_refuses_duplicates_and_odd_partitions(spark, layer):
    twice = spark.createDataFrame([(1, "a", 2000), (1, "b", 2000)], SALES)
    with pytest.raises(DuplicateKeys):
        tables.create_or_merge_partitions(twice, f"{layer}.f", ["id"], "year")
    assert not tables.table_exists(spark, f"{layer}.f")
    with pytest.raises(ValueError, match="integer or a date"):
        tables.create_or_merge_partitions(twice, f"{layer}.f", ["id"], "v")
    tables.create_or_merge_partitions(
        twice, f"{layer}.f", ["id"], "year", latest=[("v", "desc")]
    )
    assert rows(spark.table(f"{layer}.f"), "v") == [("b",)]


def test_table_exists_and_missing_table(spark, layer):
    assert not tables.table_exists(spark, f"{layer}.absent")
    with pytest.raises(AnalysisException):
        spark.table(f"{layer}.absent").count()


def test_table_scans(spark, layer):
    tables.publish(spark.range(3), f"{layer}.t")
    assert tables.query_table(spark, f"{layer}.t", ["id + 1 AS n"]).columns == ["n"]
    assert tables.empty_like(spark, "a int, b string").isEmpty()
    none = tables.no_rows(spark.table(f"{layer}.t"))
    assert none.columns == ["id"] and none.isEmpty()
    assert "FileScan" not in none._jdf.queryExecution().executedPlan().toString()


def test_csv_export_has_a_header(spark, tmp_path):
    tables.export_csv(spark.createDataFrame([(1, "x,y")], "a int, b string"), f"{tmp_path}/c")
    back = spark.read.option("header", True).csv(f"{tmp_path}/c")
    assert rows(back) == [("1", "x,y")] and back.columns == ["a", "b"]


# --- ingest -------------------------------------------------------------------


def test_ingest_takes_each_file_once(spark, layer, tmp_path):
    folder, name = f"{tmp_path}/in", f"{layer}.orders"
    put(spark, folder, "orders_first", [(1,), (2,)], "id int")
    put(spark, folder, "orders_archive", [(99,)], "id int")
    others = ["orders", "orders_archive"]
    assert rows(ingest(spark, folder, "orders", name, others=others), "id") == [(1,), (2,)]
    assert ingest(spark, folder, "orders", name, others=others).count() == 2
    put(spark, folder, "orders_2024_01", [(2,), (3,)], "id int")
    got = ingest(spark, folder, "orders", name, max_files_per_batch=1, others=others)
    assert rows(got, "id") == [(1,), (2,), (2,), (3,)]
    assert got.columns == ["id", RESCUED, ARRIVED, BATCH]


def test_full_refresh_replaces_and_then_continues(spark, layer, tmp_path):
    folder, name = f"{tmp_path}/in", f"{layer}.orders"
    put(spark, folder, "orders", [(1,)], "id int")
    ingest(spark, folder, "orders", name)
    assert rows(ingest(spark, folder, "orders", name, full_refresh=True), "id") == [(1,)]
    put(spark, folder, "orders_second", [(2,)], "id int")
    assert rows(ingest(spark, folder, "orders", name), "id") == [(1,), (2,)]


def test_undeclared_columns_are_rescued(spark, layer, tmp_path):
    folder, name = f"{tmp_path}/in", f"{layer}.products"
    put(spark, folder, "products_first", [(1, "a")], "id int, v string")
    ingest(spark, folder, "products", name)
    put(
        spark, folder, "products_second",
        [(2, "b", "x", 1.5), (3, "c", None, None)],
        "id int, v string, extra string, more double",
    )
    got = rows(ingest(spark, folder, "products", name), "id", "v", RESCUED)
    assert got == [
        (1, "a", None), (2, "b", '{"extra":"x","more":1.5}'), (3, "c", None),
    ]
    declared = files.stored_schema(spark, f"{tables.table_root(spark, name)}/gen=0/schema")
    assert declared.names == ["id", "v"]
    batch_read = files.read_dataset(spark, folder, "products", declared)
    assert rows(batch_read, "id", "v", RESCUED) == got


def test_changed_types_fit_or_are_rescued(spark, layer, tmp_path):
    folder, name = f"{tmp_path}/in", f"{layer}.t"
    day = dt.date(2024, 1, 5)
    put(spark, folder, "t_1", [(1, 5, "x", day, [1])], "id int, n int, s string, d date, a array<int>")
    noon, midnight = dt.datetime(2024, 1, 6, 12), dt.datetime(2024, 1, 6)
    put(
        spark, folder, "t_2",
        [(2, "7", 8, noon, "no"), (3, "seven", None, midnight, None), (4, None, 1, None, None)],
        "ID int, n string, s int, d timestamp, a string",
    )
    put(spark, folder, "t_3", [(5, 2.0, True, b"z"), (6, 2.5, None, None)], "id int, n double, s boolean, d binary")
    put(spark, folder, "t_4", [(7, (1, 2), 2**40)], "id int, n struct<x:int,y:int>, s bigint")
    ingest(spark, folder, "t", name)  # all at once
    got = rows(spark.table(name), "id", "n", "s", "d", RESCUED)
    assert got == [
        (1, 5, "x", day, None),
        (2, 7, "8", None, '{"d":"2024-01-06T12:00:00.000Z","a":"no"}'),
        (3, None, None, dt.date(2024, 1, 6), '{"n":"seven"}'),
        (4, None, "1", None, None),
        (5, 2, "true", None, '{"d":"eg=="}'),
        (6, None, None, None, '{"n":2.5}'),
        (7, None, str(2**40), None, '{"n":{"x":1,"y":2}}'),
    ]
    stepwise, apart = f"{layer}.u", f"{tmp_path}/apart"
    for number in range(1, 5):
        Path(apart).mkdir(exist_ok=True)
        os.symlink(f"{folder}/t_{number}.parquet", f"{apart}/u_{number}.parquet")
        ingest(spark, apart, "u", stepwise)
    assert rows(spark.table(stepwise), "id", "n", "s", "d", RESCUED) == got


def test_each_footer_is_read_once(spark, layer, tmp_path, monkeypatch):
    folder, name = f"{tmp_path}/in", f"{layer}.orders"
    real, read = files.merged_schema, []
    monkeypatch.setattr(files, "merged_schema", lambda s, p: read.extend(p) or real(s, p))
    for number in range(10):
        data = spark.range(3).select("id", F.lit("x" if number % 2 else 1.5).alias("v"))
        data.coalesce(1).write.parquet(f"{folder}/orders_{number}.parquet")
        assert ingest(spark, folder, "orders", name).count() == 3 * (number + 1)
    assert len(read) == len(set(read)) == 10
    again = ingest(spark, folder, "orders", name, full_refresh=True, max_files_per_batch=4)
    assert again.count() == 30 and len(read) == 10
    assert files.Ledger(spark, f"{tables.table_root(spark, name)}/ledger").columns().names == ["id", "v"]


def test_a_stopped_batch_is_taken_once(spark, layer, tmp_path, monkeypatch):
    folder, name = f"{tmp_path}/in", f"{layer}.orders"
    put(spark, folder, "orders_a", [(1,)], "id int")
    ingest(spark, folder, "orders", name)
    put(spark, folder, "orders_b", [(2,)], "id int")
    real = Ingest._take

    def stopped(self, batch, batch_id):
        real(self, batch, batch_id)
        raise RuntimeError("stopped")

    with monkeypatch.context() as patched:
        patched.setattr(Ingest, "_take", stopped)
        with pytest.raises(Exception, match="stopped"):
            ingest(spark, folder, "orders", name)
    assert rows(spark.table(name), "id") == [(1,)]  # what is not whole is not shown
    assert rows(ingest(spark, folder, "orders", name), "id") == [(1,), (2,)]
    # whole, but stopped before it was shown
    put(spark, folder, "orders_c", [(3,)], "id int")
    Ingest(spark, folder, "orders", name).start().awaitTermination()
    assert rows(ingest(spark, folder, "orders", name), "id") == [(1,), (2,), (3,)]


def test_nothing_to_ingest(spark, layer, tmp_path):
    with pytest.raises(FileNotFoundError, match="no file"):
        ingest(spark, str(tmp_path), "orders", f"{layer}.orders")


def test_late_file_with_an_old_date_is_taken(spark, layer, tmp_path):
    folder, name = f"{tmp_path}/in", f"{layer}.orders"
    put(spark, folder, "orders_first", [(1,)], "id int")
    ingest(spark, folder, "orders", name)
    put(spark, folder, "orders_second", [(2,)], "id int")
    month_ago = time.time() - 30 * 24 * 3600
    for file in Path(f"{folder}/orders_second.parquet").iterdir():
        os.utime(file, (month_ago, month_ago))
    assert rows(ingest(spark, folder, "orders", name), "id") == [(1,), (2,)]


def test_ingest_of_several_datasets(spark, layer, tmp_path):
    folder = f"{tmp_path}/in"
    put(spark, folder, "orders", [(1,)], "id int")
    put(spark, folder, "regions", [("x",), ("y",)], "r string")
    got = ingest_all(spark, folder, layer, ["orders", "regions"])
    assert {n: df.count() for n, df in got.items()} == {"orders": 1, "regions": 2}


def test_stream_of_increments_equals_batch(spark, layer, tmp_path):
    folder, name = f"{tmp_path}/in", f"{layer}.orders"
    orders = spark.read.parquet(f"{DATA}/orders.parquet")
    years = {"orders": (0, 1997), "orders_first": (1997, 1999), "orders_second": (1999, 9999)}
    for file, (low, high) in years.items():
        year = F.year("o_orderdate")
        orders.filter((year >= low) & (year < high)).write.parquet(f"{folder}/{file}.parquet")
        ingest(spark, folder, "orders", name)
    got = spark.table(name).drop(RESCUED, ARRIVED, BATCH)
    assert got.exceptAll(orders).isEmpty() and orders.exceptAll(got).isEmpty()


# --- shared folder ------------------------------------------------------------


def test_scratch_is_under_the_configured_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    df = materialise(spark.range(4).withColumn("p", F.col("id") % 2), "t", ["p"])
    assert df.columns == ["id", "p"] and df.count() == 4
    assert all(shared_dir(spark) in f for f in df.inputFiles())


def test_side_by_side_runs_all_and_raises(spark):
    ended = []
    jobs = {"bad": lambda: 1 / 0, "good": lambda: ended.append(spark.range(3).count())}
    with pytest.raises(ZeroDivisionError):
        side_by_side(spark, jobs)
    assert ended == [3]
    assert side_by_side(spark, {"n": lambda: spark.range(2).count()}) == {"n": 2}


def test_clear_scratch_deletes_this_application_only(spark):
    kept = Path(shared_dir(spark)) / "another-application"
    kept.mkdir(parents=True)
    materialise(spark.range(1), "t")
    assert clear_scratch(spark) and not clear_scratch(spark)
    assert kept.exists()


def test_shuffle_partitions_follow_the_data():
    assert shuffle_partitions(0) == 8
    assert shuffle_partitions(10**12) == 3726
    assert shuffle_partitions(100 * 10**12) == 30_000
    assert scan_split_bytes(10**9) == 128 * 2**20
    assert scan_split_bytes(100 * 10**12) == 10**9


# --- whole loads --------------------------------------------------------------


def test_second_warehouse_load_changes_only_update_dates(spark, tmp_path):
    source, root, prefix = f"{tmp_path}/in", f"{tmp_path}/wh", "twice_"
    stand_ins.write_dataset_files(spark, DATA, source)

    def load():
        names = layers.load_warehouse(spark, source, root, "product_id", prefix)
        gold = names["gold"]
        frames = {
            "dim_customers": spark.table(f"{gold}.dim_customers").drop("update_date"),
            "dimproducts": spark.table(f"{gold}.dimproducts"),
            "fact_orders": spark.table(f"{gold}.fact_orders"),
        }
        return {n: sorted(map(repr, df.collect())) for n, df in frames.items()}

    first = load()
    assert all(first.values())
    assert load() == first


def test_batch_load_writes_and_exports_four_reports(spark, tmp_path):
    source, bronze, silver, gold, exports = (
        f"{tmp_path}/{n}" for n in ("in", "bronze", "silver", "gold", "exports")
    )
    orders = "order_id int, customer_id int, product_id int, order_date timestamp, amount double"
    when = dt.datetime(2024, 1, 5, 10)
    put(spark, source, "orders_first", [(1, 1, 1, when, 10.0), (2, 1, 2, when, -1.0)], orders)
    put(spark, source, "orders_second", [(1, 1, 1, when, 10.0), (3, 9, 2, when, 5.5)], orders)
    people = "customer_id int, customer_name string, region_id int"
    put(spark, source, "customer_first", [(1, " Ann ", 1)], people)
    put(spark, source, "customer_second", [(2, "Bob", 1), (None, "x", 1)], people)
    goods = "product_id int, product_name string, category string, price double"
    put(spark, source, "products_first", [(1, "pen", "office", 1.0)], goods)
    put(spark, source, "products_second", [(2, "cup", None, 2.0)], goods)
    put(spark, source, "regions", [(1, "North", "NO")], "region_id int, region_name string, country string")

    assert batch.copy_files(spark, source, bronze)["orders_first"] == 2
    assert batch.load_silver(spark, bronze, silver)["orders_enriched"] == 2
    assert batch.load_gold(spark, silver, gold) == {
        "monthly_revenue": 1, "category_revenue": 2, "region_revenue": 2, "top_customers": 2,
    }
    batch.export_reports(spark, gold, exports)

    def exported(name):
        return rows(spark.read.option("header", True).csv(f"{exports}/{name}"))

    assert exported("monthly_revenue") == [("2024", "1", "15.5", "2", "7.75")]
    assert exported("category_revenue") == [("Uncategorized", "5.5", "1"), ("office", "10.0", "1")]
    assert ("North", "NO", "10.0", "1", "10.0") in exported("region_revenue")
    assert ("1", "Ann", "North", "10.0", "1") in exported("top_customers")
