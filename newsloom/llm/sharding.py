"""Shards by a hierarchical weighted hash tree.

A key descends from region to rack to shard. At each level every child draws -ln(u) / weight, where u comes from a
hash of the child's name and the key, and the least draw wins; a child's weight is that of its subtree. A change of
weights moves keys only into or out of the subtrees whose weights change. A shard beyond the base topology stands in
a region of its own, so that growth by one, from the base's number on, takes keys only into the new shard. Below the base,
growth also moves keys within the region whose weight grows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import Staged, documents, fresh

REGIONS, RACKS = 4, 2
SHARDS = 40
#: Rows in one range of ids, which one task numbers.
RANGE_ROWS = 100_000


@dataclass(frozen=True)
class Tree:
    """regions[g][r]: the (shard, weight) pairs of rack r in region g."""

    regions: tuple[tuple[tuple[tuple[int, float], ...], ...], ...]

    @staticmethod
    def of(shards: int, base: int = SHARDS) -> "Tree":
        """`base` shards dealt evenly to the racks, and a region for each further shard."""
        racks = REGIONS * RACKS
        dealt = [tuple((s, 1.0) for s in range(min(shards, base)) if s % racks == k) for k in range(racks)]
        regions = [tuple(x for x in dealt[g * RACKS : (g + 1) * RACKS] if x) for g in range(REGIONS)]
        return Tree((*(x for x in regions if x), *((((s, 1.0),),) for s in range(base, shards))))


def _draw(name: Column, key: Column, weight: Column) -> Column:
    u = (F.conv(F.substring(F.md5(F.concat(name, F.lit(":"), key)), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))
    return -F.log(u) / weight


def _least(key: Column, children: list[tuple[Column, Column, Column]]) -> Column:
    """The value of the child with the least draw; children: name, weight (null: absent) and value."""
    return F.array_min(F.filter(F.array(*(F.struct(_draw(n, key, w).alias("d"), v.alias("v")) for n, w, v in children)), lambda x: x["d"].isNotNull()))["v"]


def assign(df: DataFrame, key: str, tree: Tree, out: str) -> DataFrame:
    """df, with all its columns, and the shard of each row in column `out`; a null key goes the way of the empty string.

    Only the key and the tree decide, so repeated keys meet in one shard; an empty table stays empty.
    """
    at_region, at_rack, at_shards = fresh([*df.columns, out], "_g", "_r", "_s")
    k = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))
    weights = [[sum(w for _, w in rack) for rack in region] for region in tree.regions]
    region = _least(k, [(F.lit(f"g{g}"), F.lit(sum(w)), F.lit(g)) for g, w in enumerate(weights)])
    rows, g = df.withColumn(at_region, region), F.col(at_region)
    table = F.array(*(F.array(*(F.lit(w) for w in own)) for own in weights))
    widest = max(map(len, weights))
    rack = _least(k, [(F.concat(F.lit("g"), g, F.lit(f"r{r}")), F.get(F.get(table, g), F.lit(r)), F.lit(r)) for r in range(widest)])
    rows = rows.withColumn(at_rack, rack)
    racks = [rack for region in tree.regions for rack in region]
    first = [sum(len(x) for x in tree.regions[:g]) for g in range(len(tree.regions))]
    at = F.get(F.array(*map(F.lit, first)), g) + F.col(at_rack)
    shards = F.get(F.array(*(F.array(*(F.struct(F.lit(s).alias("s"), F.lit(w).alias("w")) for s, w in rack)) for rack in racks)), at)
    rows = rows.withColumn(at_shards, shards)
    most = max(map(len, racks))
    own = lambda j: F.get(at_shards, F.lit(j))
    leaf = _least(k, [(F.concat(F.lit("s"), own(j)["s"]), own(j)["w"], own(j)["s"]) for j in range(most)])
    return rows.withColumn(out, leaf).drop(at_region, at_rack, at_shards)


def slots(df: DataFrame, shard: str, order: list[str], out: str) -> DataFrame:
    """df, with all its columns, and each row's place in its shard, from 0 without gaps, by `order`; nulls come first.

    Rows are dealt by range of `order` with a row number last, so that a repeated key splits too, and rows alike in `order` stand
    in any order. Places are counted within a range and shard; a small table of counts has what the ranges before hold. An
    empty table stays empty.
    """
    row, part, n, base, k = fresh([*df.columns, out], "_row", "_part", "_n", "_base", "_k")
    dealt = df.withColumn(row, F.monotonically_increasing_id())
    ranges = max(1, -(-dealt.count() // RANGE_ROWS))
    by = [F.col(f"`{c}`") for c in (*order, row)]
    staged = Staged(dealt.repartitionByRange(ranges, *by).withColumn(part, F.spark_partition_id()), "shard-ranges").df
    counts = staged.groupBy(part, shard).agg(F.count(F.lit(1)).alias(n))
    before = Window.partitionBy(shard).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    bases = Staged(counts.select(part, shard, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(base)), "shard-bases").side()
    within = F.row_number().over(Window.partitionBy(part, shard).orderBy(*by))
    found = staged.withColumn(k, within).join(bases, [part, shard])
    return found.select(*(F.col(f"`{c}`") for c in df.columns if c != out), (F.col(base) + F.col(k) - 1).alias(out))


def op5_shard_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    rows = documents(spark, sf_dir).select("doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), F.lit("key").alias("law"))
    rows = assign(assign(rows, "doc_id", Tree.of(SHARDS), "shard"), "doc_id", Tree.of(SHARDS + 1), "grown_shard")
    rows = Staged(rows, "shards").df
    return slots(rows, "shard", ["doc_id", "text_crc32"], "slot").select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
