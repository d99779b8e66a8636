"""Connected components by alternating large and small stars, in rounds of Spark aggregations and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import Staged, with_unique

_MOST_ROUNDS = 60


def _star(edges: DataFrame, large: bool, total: int) -> DataFrame:
    """Links each node's larger neighbours (large), or smaller ones and itself (small), to the least of them all."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = F.least(F.min("b"), F.first("a")) if large else F.min("b")  # in small stars, a > b in every edge
    least = Staged(both.groupBy("a").agg(least.alias("m"), F.count(F.lit(1)).alias("held")), "least")
    joined = with_unique(both, least, ["a"], "held", total)  # a hub's links do not meet in one task
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.df.select("a", F.col("m").alias("b")))
    return out.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """Of links (a, b) of longs: (node, root) of every linked node but the roots, the least nodes of their components."""
    now = Staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    digest = _digest(now.df)
    for _ in range(_MOST_ROUNDS):
        if not digest[0]:
            break
        after = Staged(_star(_star(now.df, True, 2 * digest[0]), False, digest[0]), "links")
        now.drop()
        now, before, digest = after, digest, _digest(after.df)
        if digest == before:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.df.select(F.col("a").alias("node"), F.col("b").alias("root"))
