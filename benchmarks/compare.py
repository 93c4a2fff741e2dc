"""Time each custom operator against its naive form; prints a Markdown table.

The tables of ``BENCH_SF_DIR`` (default sf0.1) are repeated ``BENCH_COPIES``
times (default 20) with fresh keys, so that the data outweighs job overhead.
Words given as arguments select the cases whose label contains one of them.
Shuffled and written megabytes come from Spark's event log.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.registry import register_upper
from tidemark.operators.dimensions import apply_type1, first_type1_load
from tidemark.operators.history import build_versions
from tidemark.operators.keys import dense_keys
from tidemark.operators.ranking import ranked
from tidemark.operators.upsert import upsert
from tidemark.session import session
from tidemark.sources.tables import ensure_layers
from tidemark.streaming.ingest import ingest

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
COPIES = int(os.environ.get("BENCH_COPIES", "20"))
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HOME = tempfile.mkdtemp(prefix="tidemark-compare-")


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def shuffled_mb(log: Path, group: str) -> float:
    """Shuffle megabytes written by the jobs of one job group."""
    stages, total = set(), 0
    for line in log.open():
        event = json.loads(line)
        if event["Event"] == "SparkListenerJobStart":
            if event["Properties"].get("spark.jobGroup.id") == group:
                stages.update(event["Stage IDs"])
        elif event["Event"] == "SparkListenerTaskEnd" and event["Stage ID"] in stages:
            metrics = event.get("Task Metrics") or {}
            total += metrics.get("Shuffle Write Metrics", {}).get(
                "Shuffle Bytes Written", 0
            )
    return total / 1e6


def main() -> None:
    os.makedirs(f"{HOME}/events")
    spark = session(
        "compare",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": str(4 * CPUS),
            "spark.driver.memory": "20g",
            "spark.checkpoint.dir": f"{HOME}/shared",
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": f"file:{HOME}/events",
            "spark.eventLog.rolling.enabled": "false",
            "spark.eventLog.compress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    copies = spark.range(COPIES).withColumnRenamed("id", "copy")

    def repeated(name: str, key: str) -> DataFrame:
        rows = spark.read.parquet(f"{SF}/{name}.parquet")
        path = f"{HOME}/data/{name}"
        fresh = rows.join(F.broadcast(copies)).withColumn(
            key, F.col(key) * COPIES + F.col("copy")
        )
        fresh.drop("copy").repartition(4 * CPUS).write.parquet(path)
        return spark.read.parquet(path)

    orders, customer = repeated("orders", "o_orderkey"), repeated("customer", "c_custkey")
    lines, part = repeated("lineitem", "l_orderkey"), repeated("part", "p_partkey")
    events = repeated("events", "event_id")
    times, wanted = [], sys.argv[1:]

    def case(label: str, run) -> None:
        if wanted and not any(word in label for word in wanted):
            return
        seconds = []
        for i in range(RUNS + 1):
            spark.sparkContext.setJobGroup(f"{label}-{i}", label)
            started = time.perf_counter()
            run()
            seconds.append(time.perf_counter() - started)
        times.append((label, statistics.median(seconds[1:])))

    # keys
    keys = orders.select("o_orderkey", "o_custkey", "o_totalprice")
    case("surrogate_key: spans", lambda: drain(dense_keys(keys, ["o_orderkey"], "k")))
    one = W.orderBy("o_orderkey")
    case(
        "surrogate_key: row_number in one partition",
        lambda: drain(keys.withColumn("k", F.row_number().over(one))),
    )

    # ranks
    dated = lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
        F.year("l_shipdate").alias("year"),
    )
    outputs = {"dense_rank": "d", "rank": "r", "row_number": "n"}
    order, tie = [("l_quantity", "desc")], ["l_orderkey", "l_linenumber", "l_partkey"]

    def ranks():
        return drain(ranked(dated, outputs, ["year"], order, tie))

    case("rank_family: years cut into spans", ranks)

    def separate():
        df = dated
        for fn, out in ((F.dense_rank, "d"), (F.rank, "r"), (F.row_number, "n")):
            window = W.partitionBy("year").orderBy(F.desc("l_quantity"))
            df = df.withColumn(out, fn().over(window))
        drain(df)

    case("rank_family: three windows, row_number without a total order", separate)

    # versions of a change feed in which one user makes half of the changes
    feed = events.select(
        F.when(F.col("event_id") % 2 == 0, 1).otherwise(F.col("user_id")).alias("user_id"),
        "event_type",
        F.col("event_id").alias("seq"),
    )

    def versions():
        return drain(build_versions(feed, ["user_id"], "seq"))

    case("scd2, hot key: keys cut into spans", versions)

    # dimension
    people = customer.select("c_custkey", "c_mktsegment", "c_nationkey")
    known = people.filter(F.col("c_mktsegment") != "BUILDING")
    drain_to = f"{HOME}/data/dim"
    first_type1_load(known, "c_custkey", "k").write.parquet(drain_to)
    dim = spark.read.parquet(drain_to)
    case("scd1: one join", lambda: drain(apply_type1(dim, people, "c_custkey", "k")))

    def split_and_union():
        source = people.dropDuplicates(["c_custkey"])
        old = dim.select(
            F.col("c_custkey").alias("old"), "k", "create_date", "update_date"
        )
        joined = source.join(old, F.col("c_custkey") == F.col("old"), "left")
        now = F.current_timestamp()
        top = dim.agg(F.max("k")).first()[0]
        numbered = F.row_number().over(W.orderBy("c_custkey")) + top
        new = joined.filter("k IS NULL").withColumns(
            {"k": numbered, "create_date": now, "update_date": now}
        )
        kept = joined.filter("k IS NOT NULL").withColumn("update_date", now)
        merged = kept.unionByName(new).drop("old")
        untouched = dim.join(merged, "c_custkey", "left_anti")
        drain(untouched.unionByName(merged))

    case("scd1: split, re-key, union", split_and_union)

    # upsert
    target = keys.filter("o_totalprice > 100000")
    source = keys.filter("o_totalprice < 200000")
    case(
        "fact_upsert: anti-join and union",
        lambda: drain(upsert(target, source, ["o_orderkey"])),
    )

    def full_join():
        s = source.select(*[F.col(c).alias(f"s_{c}") for c in source.columns])
        both = target.join(s, F.col("o_orderkey") == F.col("s_o_orderkey"), "full")
        drain(
            both.select(
                *[F.coalesce(f"s_{c}", c).alias(c) for c in target.columns]
            )
        )

    case(
        "fact_upsert: anti-join and union, no duplicate check",
        lambda: drain(upsert(target, source, ["o_orderkey"], unique=True)),
    )
    case("fact_upsert: full join and coalesce, no duplicate check", full_join)

    # functions
    upper = register_upper(spark)
    row_udf = F.udf(lambda s: None if s is None else s.upper(), T.StringType(), useArrow=False)
    case("upper: Arrow UDF", lambda: drain(part.select(F.expr(f"{upper}(p_brand)"))))
    case("upper: row-at-a-time UDF", lambda: drain(part.select(row_udf("p_brand"))))
    case("upper: built-in", lambda: drain(part.select(F.upper("p_brand"))))

    # ingest
    folder = f"{HOME}/files"
    halves = orders.randomSplit([0.5, 0.5], seed=1)
    for name, half in zip(("orders_first", "orders_second"), halves):
        half.write.parquet(f"{folder}/{name}.parquet")
    runs = iter(range(1000))

    def load(**options):
        n = next(runs)
        bronze = ensure_layers(spark, f"{HOME}/t{n}", ["bronze"], f"t{n}_")["bronze"]
        ingest(spark, folder, "orders", f"{bronze}.orders", **options)

    case("bronze_ingest: one batch", load)
    case("bronze_ingest: 8 files a batch", lambda: load(max_files_per_batch=8))

    spark.stop()
    (log,) = Path(f"{HOME}/events").iterdir()
    print(f"Copies: {COPIES}, cores: {CPUS}, median of {RUNS} warm runs.\n")
    print("| form | seconds | shuffled MB |\n|---|---:|---:|")
    for label, seconds in times:
        print(f"| {label} | {seconds:.2f} | {shuffled_mb(log, f'{label}-{RUNS}'):.0f} |")


if __name__ == "__main__":
    main()
