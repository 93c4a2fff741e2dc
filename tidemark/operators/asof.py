"""Point-in-time lookup: the version of a key that was valid at a fact's time.

Versions and facts are put into one frame, ordered by key and time and cut into
spans; the last version before a fact is carried forward to it. There is no range
join, and a key with any number of facts or versions covers as many spans as it
needs, each of which receives the version its predecessors ended with.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.spans import SPAN, join_edges, split_into_spans
from tidemark.scratch import materialise

_AT, _IS_FACT, _FACT, _VERSION = "_at", "_is_fact", "_fact", "_version"


def look_up_as_of(
    facts: DataFrame,
    versions: DataFrame,
    on: Mapping[str, str],
    at: str,
    start: str,
    columns: Sequence[str],
    end: str | None = None,
) -> DataFrame:
    """Attach ``columns`` of the version valid at ``facts[at]``.

    ``on`` maps fact to version keys. A version holds from ``start``, inclusive, to
    the start of the key's next one, and with ``end`` only to that, exclusive; a null
    end is open. Starts are unique per key and of the type of ``at``. A fact before
    the first version, in a gap, or with a null key or time gets nulls; every fact
    is answered, repeated ones too.
    """
    keys = [f"_key_{f}" for f in on]
    held = [*columns, *([end] if end else [])]
    told = facts.select(
        *[F.col(f).alias(k) for f, k in zip(on, keys)],
        F.col(at).alias(_AT),
        F.lit(True).alias(_IS_FACT),
        F.struct(*facts.columns).alias(_FACT),
    )
    known = versions.dropna(subset=[*on.values(), start]).select(
        *[F.col(v).alias(k) for v, k in zip(on.values(), keys)],
        F.col(start).alias(_AT),
        F.lit(False).alias(_IS_FACT),
        F.struct(*held).alias(_VERSION),
    )
    both = told.unionByName(known, allowMissingColumns=True)
    order = [(_AT, "asc"), (_IS_FACT, "asc")]
    spread = split_into_spans(both, keys, order, unique=False)
    so_far = W.partitionBy(SPAN, *keys).orderBy(_AT, _IS_FACT)
    so_far = so_far.rowsBetween(W.unboundedPreceding, W.currentRow)
    stored = materialise(
        spread.withColumn("_local", F.last(_VERSION, ignorenulls=True).over(so_far)), "as-of"
    )

    is_version = ~F.col(_IS_FACT)
    per_span = stored.groupBy(SPAN, *keys).agg(
        F.max_by(F.when(is_version, F.col(_VERSION)), F.when(is_version, F.col(_AT))).alias("_end")
    )
    whole = W.partitionBy(*keys)
    earlier = whole.orderBy(SPAN).rowsBetween(W.unboundedPreceding, -1)
    edges = (
        per_span.withColumn("_spans", F.count(F.lit(1)).over(whole))
        .filter("_spans > 1")
        .withColumn("_carried", F.last("_end", ignorenulls=True).over(earlier))
        .filter(F.col("_carried").isNotNull())
    )
    found = join_edges(stored.filter(_IS_FACT), edges, keys, ["_carried"])
    found = found.withColumn("_found", F.coalesce("_local", "_carried"))
    if end:
        open_ = F.col(f"_found.{end}").isNull() | (F.col(_AT) < F.col(f"_found.{end}"))
        found = found.withColumn("_found", F.when(open_, F.col("_found")))
    return found.select(f"{_FACT}.*", *[F.col(f"_found.{c}").alias(c) for c in columns])
