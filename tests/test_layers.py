"""The layered load over several runs, on a few hand-made rows."""

from __future__ import annotations

import datetime as dt
import os
import time
from pathlib import Path

from tidemark.plans import layers
from tidemark.plans.layers import load_warehouse

CUSTOMER = "customer_id string, email string, first_name string, last_name string"
ORDERS = (
    "order_id int, customer_id string, product_id int, order_date string, "
    "total_amount double"
)
PRODUCTS = (
    "product_id int, product_name string, brand string, price double, valid_from int"
)
REGIONS = "region_id int, region_name string, country string"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_three_loads(spark, tmp_path):
    folder, root = f"{tmp_path}/in", f"{tmp_path}/wh"

    def arrive(file, data, schema):
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{file}.parquet")

    def load(day, **options):
        names = load_warehouse(
            spark, folder, root, "valid_from", "three_",
            dt.datetime(2024, 1, day), **options,
        )
        gold = names["gold"]
        return (
            rows(
                spark.table(f"{gold}.dim_customers"),
                "customer_id", "domains", "full_name", "DimCustomerKey", "create_date",
                "update_date",
            ),
            rows(
                spark.table(f"{gold}.dimproducts"),
                "product_id", "price", "discounted_price", "__START_AT", "__END_AT",
            ),
            rows(
                spark.table(f"{gold}.fact_orders"),
                "order_id", "total_amount", "year", "DimCustomerKey", "DimProductKey",
            ),
        )

    first, second, third = (dt.datetime(2024, 1, d) for d in (1, 2, 3))
    arrive(
        "customer_first",
        [("c2", "a@x.com", "Ann", "Lee"), ("c4", "noat", "Bo", None), (None, None, None, None)],
        CUSTOMER,
    )
    arrive(
        "orders_first",
        [
            (1, "c2", 7, "2023-05-01", 10.0),
            (1, "c2", 7, "2023-05-01", 12.0),
            (2, "c9", 7, "2024-02-01", 5.0),
            (3, "c4", 8, "not a date", 1.0),
        ],
        ORDERS,
    )
    arrive("products_first", [(7, "pen", "b", 10.0, 1), (8, None, "b", 1.0, 1)], PRODUCTS)
    arrive("regions", [(1, "North", "NO")], REGIONS)
    customers, products, facts = load(1)
    assert customers == [
        ("c2", "x.com", "Ann Lee", 1, first, first),
        ("c4", None, None, 2, first, first),
    ]
    # product 8 has no name and fails a rule, so its order gets the unknown key
    assert products == [(7, 10.0, 9.0, 1, None)]
    assert facts == sorted(
        [(1, 12.0, 2023, 1, 7), (2, 5.0, 2024, -1, 7), (3, 1.0, None, 2, -1)], key=repr
    )

    arrive(
        "customer_second",
        [("c1", "b@y.com", "Cy", "Fox"), ("c9", "d@y.com", "Di", "Oak")],
        CUSTOMER,
    )
    arrive("products_second", [(7, "pen", "b", 20.0, 3), (7, "pen", "b", 15.0, 2)], PRODUCTS)
    arrive("orders_second", [(4, "c1", 7, "2023-07-01", 8.0)], ORDERS)
    customers, products, facts = load(2)
    assert [(c[0], c[3], c[4], c[5]) for c in customers] == [
        ("c1", 3, second, second), ("c2", 1, first, second),
        ("c4", 2, first, second), ("c9", 4, second, second),
    ]
    assert products == sorted(
        [(7, 10.0, 9.0, 1, 2), (7, 15.0, 13.5, 2, 3), (7, 20.0, 18.0, 3, None)], key=repr
    )
    # three versions of product 7 do not multiply its orders; the order of c9,
    # first loaded as unknown, takes its real key
    assert facts == sorted(
        [
            (1, 12.0, 2023, 1, 7), (2, 5.0, 2024, 4, 7),
            (3, 1.0, None, 2, -1), (4, 8.0, 2023, 3, 7),
        ],
        key=repr,
    )

    replayed = load(3, full_refresh=True)
    assert [c[:5] for c in replayed[0]] == [c[:5] for c in customers]
    assert {c[5] for c in replayed[0]} == {third}
    assert replayed[1:] == (products, facts)


def loader(spark, tmp_path, prefix, **options):
    folder, root = f"{tmp_path}/in", f"{tmp_path}/{prefix}"

    def arrive(file, data, schema):
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{file}.parquet")

    def load(**more):
        run = dt.datetime(2024, 1, 1)
        return load_warehouse(spark, folder, root, "valid_from", prefix, run, **options, **more)

    return arrive, load


def gold(spark, names):
    customers = rows(spark.table(f"{names['gold']}.dim_customers"), "customer_id", "email")
    products = rows(spark.table(f"{names['gold']}.dimproducts"), "product_id", "price", "__START_AT", "__END_AT")
    facts = rows(spark.table(f"{names['gold']}.fact_orders"), "order_id", "total_amount", "DimProductKey")
    return customers, products, facts


def first_deliveries(arrive):
    arrive("customer_1", [("c1", "a@x.com", "A", "B")], CUSTOMER)
    arrive("orders_1", [(1, "c1", 7, "2023-05-01", 12.0), (2, "c1", 7, "2024-05-01", 1.0)], ORDERS)
    arrive("products_1", [(7, "pen", "b", 1.0, 1), (7, "pen", "b", 3.0, 2)], PRODUCTS)
    arrive("regions", [(1, "North", "NO")], REGIONS)


def corrections(arrive):
    arrive("customer_2", [("c1", "z@x.com", "A", "B")], CUSTOMER)
    arrive("orders_2", [(1, "c1", 7, "2023-05-01", 9.0)], ORDERS)
    arrive("products_2", [(7, "pen", "b", 2.0, 1)], PRODUCTS)


CORRECTED = (
    [("c1", "z@x.com")],
    [(7, 2.0, 1, 2), (7, 3.0, 2, None)],
    [(1, 9.0, 7), (2, 1.0, 7)],
)


def test_corrections_win_in_one_load_in_two_and_in_a_replay(spark, tmp_path):
    arrive, load = loader(spark, tmp_path, "steps_")
    first_deliveries(arrive)
    load()
    corrections(arrive)
    assert gold(spark, load()) == CORRECTED
    assert gold(spark, load(full_refresh=True)) == CORRECTED
    _, at_once = loader(spark, tmp_path, "at_once_")
    assert gold(spark, at_once()) == CORRECTED


def test_a_late_file_with_an_old_date_does_not_win(spark, tmp_path):
    arrive, load = loader(spark, tmp_path, "late_")
    first_deliveries(arrive)
    load()
    corrections(arrive)
    year_ago = time.time() - 365 * 24 * 3600
    for folder in Path(f"{tmp_path}/in").glob("*_2.parquet"):
        for file in folder.iterdir():
            os.utime(file, (year_ago, year_ago))
    kept = (
        [("c1", "a@x.com")],
        [(7, 1.0, 1, 2), (7, 3.0, 2, None)],
        [(1, 12.0, 7), (2, 1.0, 7)],
    )
    assert gold(spark, load()) == kept
    assert gold(spark, load(full_refresh=True)) == kept


def test_a_second_load_reads_what_is_new_and_writes_what_it_touches(spark, tmp_path, monkeypatch):
    arrive, load = loader(spark, tmp_path, "new_")
    first_deliveries(arrive)
    arrive("orders_unknown", [(3, "c9", 7, "2022-01-01", 5.0), (4, "c8", 7, "2021-01-01", 6.0)], ORDERS)
    seen, real = [], layers.build_order_facts

    def watched(orders, *rest):
        seen.append(rows(orders, "order_id"))
        return real(orders, *rest)

    monkeypatch.setattr(layers, "build_order_facts", watched)
    name = f"{load()['gold']}.fact_orders"
    before = set(spark.table(name).inputFiles())
    arrive("orders_2", [(1, "c1", 7, "2023-05-01", 9.0)], ORDERS)
    arrive("customer_2", [("c9", "n@x.com", "N", "N")], CUSTOMER)
    load()
    # the new order, and those with an unknown key, of which one is known now
    assert seen[1:] == [[(1,), (3,), (4,)]]
    after = set(spark.table(name).inputFiles())
    assert {f.split("year=")[1][:4] for f in before & after} == {"2024", "2021"}
    assert {f.split("year=")[1][:4] for f in after - before} == {"2023", "2022"}
    assert rows(spark.table(name), "order_id", "total_amount", "DimCustomerKey") == [
        (1, 9.0, 1), (2, 1.0, 1), (3, 5.0, 2), (4, 6.0, -1),
    ]
    load()
    assert set(spark.table(name).inputFiles()) == after


def test_facts_take_the_version_of_their_date(spark, tmp_path):
    arrive, load = loader(spark, tmp_path, "dated_", point_in_time=True)
    arrive("customer_1", [("c1", "a@x.com", "A", "B")], CUSTOMER)
    arrive("regions", [(1, "North", "NO")], REGIONS)
    days = {n: dt.datetime(2023, n, 1) for n in range(1, 8)}
    dated = PRODUCTS.replace("valid_from int", "valid_from timestamp")
    arrive("products_1", [(7, "pen", "b", 1.0, days[2]), (7, "pen", "b", 2.0, days[4])], dated)
    orders = [(n, "c1", 7, str(days[n]), 1.0) for n in range(1, 8)] + [(9, "c1", 8, str(days[5]), 1.0)]
    arrive("orders_1", orders, ORDERS)
    name = f"{load()['gold']}.fact_orders"

    def found():
        return rows(spark.table(name), "order_id", "DimProductKey", "product_valid_from")

    second, fourth = (7, days[2]), (7, days[4])
    assert found() == [
        (1, -1, None), (2, *second), (3, *second), (4, *fourth), (5, *fourth), (6, *fourth),
        (7, *fourth), (9, -1, None),
    ]
    arrive("products_2", [(7, "pen", "b", 3.0, days[6])], dated)  # a version that came late
    load()
    assert [r[2] for r in found()[4:7]] == [days[4], days[6], days[6]]


def test_one_changed_customer_rewrites_one_bucket(spark, layer):
    name, schema = f"{layer}.dim", "customer_id int, email string, tags map<string,int>"
    first = [(k, f"{k}@x.com", {"t": k}) for k in range(100)]
    days = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]

    def load(data, day):
        source = spark.createDataFrame(data, schema)
        return layers.load_customer_dimension(spark, source, name, day, only_changed=True, buckets=8)

    assert load(first, days[0]) == list(range(8))
    before = set(spark.table(name).inputFiles())
    changed = [(k, "new@x.com" if k == 42 else v, t) for k, v, t in first]
    (touched,) = load(changed + [(None, "x", None)], days[1])
    after = set(spark.table(name).inputFiles())
    assert before - after == {f for f in before if f"_bucket={touched}/" in f}
    assert all(f"_bucket={touched}/" in f for f in after - before)
    assert rows(spark.table(name).filter("update_date > create_date"), "customer_id", "email") == [(42, "new@x.com")]
    assert load(changed, days[2]) == [] and set(spark.table(name).inputFiles()) == after
    # a new customer takes the next key, and its bucket is the only one written
    assert len(load([(1000, "n@x.com", None)], days[2])) == 1
    dim = spark.table(name)
    assert dim.count() == 101 and rows(dim.filter("customer_id = 1000"), "DimCustomerKey") == [(101,)]
    assert dim.select("DimCustomerKey").distinct().count() == 101
