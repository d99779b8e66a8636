"""Row numbers for tables whose ids do not tell rows apart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import Staged
from .sharding import slots


def unique_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """rows (doc_id, text) itself if its ids are unique, else with doc_id replaced by the row's number.

    Numbers follow id, null first, and then text. With them comes a table (_n, doc_id) of the ids they stand for.
    """
    n, distinct = rows.agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
    if n == distinct:
        return rows, None
    numbered = slots(rows.withColumn("_all", F.lit(0)), "_all", ["doc_id", "text"], "_n").select("_n", "doc_id", "text")
    numbered = Staged(numbered, "numbered").df
    return numbered.select(F.col("_n").alias("doc_id"), "text"), numbered.select("_n", "doc_id")
