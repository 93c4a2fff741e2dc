"""Taking rejected documents out of a table, row by row."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.scratch import materialise

# a row's place, and its id with that place: what decisions about rows name them by
ROW = "_tidemark_row"
RANKED = "_tidemark_ranked_row"


def _place(docs: DataFrame) -> Column:
    """The digest of the path of a row's file, and the row's number there: 24 bytes."""
    found = docs.metadataColumn("_metadata")
    path = F.unhex(F.md5(found["file_path"].cast("binary")))
    return F.concat(path, F.unhex(F.lpad(F.hex(found["row_index"]), 16, "0")))


def numbered(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Parquet rows with ``ROW``, their place, and ``RANKED``, their id and place.

    No other row has either, so repeated rows and null ids are told apart. ``RANKED``
    is in the order of the ids, nulls last. ``docs`` is a scan of Parquet files with no
    more than filters and projections on it, and nothing is written; a frame without
    files behind it is stored first. Columns of these names in ``docs`` are replaced.
    """
    try:
        placed = docs.withColumn(ROW, _place(docs))
    except AnalysisException:  # rows that lie in no Parquet file have no place yet
        docs = materialise(docs, "numbered")
        placed = docs.withColumn(ROW, _place(docs))
    ranked = F.struct(
        F.col(id_col).isNull().alias("unnamed"), F.col(id_col).alias("id"), F.col(ROW).alias("place")
    )
    return placed.withColumn(RANKED, ranked)


def without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """The rows of ``numbered`` documents that are not in ``rejected``, as they were.

    ``rejected`` names rows by ``ROW`` or ``RANKED``. Decisions are written first: few
    are broadcast, many are joined by shuffle.
    """
    name = F.col(ROW) if ROW in rejected.columns else F.col(RANKED)["place"]
    places = materialise(rejected.select(name.alias("place")), "rejected")
    return docs.join(places, docs[ROW] == places["place"], "left_anti").drop(ROW, RANKED)
