"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.scratch import materialise

MAX_ROUNDS = 60


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select("a", F.least("a", "least").alias("least"))
    least = materialise(least, "least")
    return (
        both.where("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
    )


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    least = materialise(least, "least")
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node that has a link; the root is its least node.

    ``links`` has long columns ``a`` and ``b``; loops, repeats and nulls are
    ignored. Alternates large and small stars until the links no longer change:
    each round is two aggregations and two joins over at most as many rows as
    there are links, and each is written to the shared folder. Least neighbours
    are aggregated before the shuffle and written, as are the stars, so both sides
    of a join come straight from a shuffle of files, and Spark can split the
    partition of a node that has a large share of the links.
    """
    links = links.select("a", "b").where("a <> b").distinct()
    links = materialise(links, "links")
    seen = _fingerprint(links)
    for _ in range(MAX_ROUNDS):
        if seen[0] == 0:
            break
        stars = materialise(_large_star(links).distinct(), "stars")
        stars = _small_star(stars).where("a <> b").distinct()
        links = materialise(stars, "links")
        before, seen = seen, _fingerprint(links)
        if seen == before:
            break
    else:
        raise RuntimeError(f"links still change after {MAX_ROUNDS} rounds")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots
    )


def _fingerprint(links: DataFrame) -> tuple:
    """Row count and a sum over row hashes, which tell whether a round changed links."""
    row_hash = F.xxhash64("a", "b").cast("decimal(20,0)")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(row_hash)).first())
