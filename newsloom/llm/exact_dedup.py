"""Exact duplicates by two passes over Bloom filters.

The first pass deals the 64-bit hashes of the normalised texts by segment of a filter that spans the cluster: a task holds
its own segments only, so the filter grows with the table and is never in one place. A hash whose bits are all set when it
comes, or that comes twice at once, is possibly repeated. These hashes, and no others, make the second filter, which is
broadcast. The second pass tests every row against it: rows that miss are unique and pass straight through, and only the
others shuffle. What a filter lets through too much is told apart by the SHA-256 of the texts, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import SEPARATORS, Staged, documents, fresh, prepare, task, with_unique

BITS_PER_ROW = 16
#: The second filter takes no more bits than this (32 MB), as it is broadcast. A fuller filter lets more rows through to
#: the shuffle; the result stays exact.
MAX_BITS = 1 << 28
_SEG_BITS = 4096
_SEG_WORDS = _SEG_BITS // 64
_PROBES = (20, 32, 44)  # shifts of the hash that give a place in a segment
#: Hashes that a task of the first pass holds before it sends the distinct ones on; segments that make a part.
_HELD, _PART_SEGMENTS = 1 << 20, 8192


def normalised(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for c in SEPARATORS:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def _segments(rows: int) -> int:
    """A power of two."""
    n = 16
    while n * _SEG_BITS < rows * BITS_PER_ROW:
        n *= 2
    return n


def _masks(h: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Word index and bit mask of each probe: (n, probes)."""
    seg = (h & np.uint64(segments - 1)).astype(np.int64)
    at = np.stack([(h >> np.uint64(s)) & np.uint64(_SEG_BITS - 1) for s in _PROBES], axis=1)
    return seg[:, None] * _SEG_WORDS + (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes, once each of what is held at a time, and whether they were there twice."""
    held: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        h, n = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(h), pa.array(n > 1)], names=["h", "again"])

    for batch in batches:
        held.append(batch.column(0).to_numpy())
        if sum(map(len, held)) >= _HELD:
            yield flush()
    if held:
        yield flush()


def _possibly_repeated(batches: Iterator[pa.RecordBatch], segments: int, own: int) -> Iterator[pa.RecordBatch]:
    """Of hashes dealt by part (`own` segments each), those that came before, as far as the part's bits can tell."""
    planes: dict[int, np.ndarray] = {}
    for batch in batches:
        hashes, back, n = np.unique(batch.column(0).to_numpy().view(np.uint64), return_inverse=True, return_counts=True)
        again = n > 1
        np.logical_or.at(again, back, batch.column(1).to_numpy(zero_copy_only=False))
        word, mask = _masks(hashes, segments)
        parts = word[:, 0] // (own * _SEG_WORDS)
        for part in np.unique(parts).tolist():
            at = np.flatnonzero(parts == part)
            bits = planes.setdefault(part, np.zeros(own * _SEG_WORDS, np.uint64))
            local = word[at] - part * own * _SEG_WORDS
            again[at] |= ((bits[local] & mask[at]) == mask[at]).all(axis=1)
            np.bitwise_or.at(bits, local, mask[at])
        yield pa.RecordBatch.from_arrays([pa.array(hashes[again].view(np.int64))], names=["h"])


def repeated_hashes(hashes: DataFrame, rows: int) -> Staged:
    """Of `rows` 64-bit hashes (column h): each that occurs twice or more, once, and by chance a few others."""
    spark, segments = hashes.sparkSession, _segments(rows)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = 1
    while own < _PART_SEGMENTS and segments // own > 2 * width:
        own *= 2
    part = F.col("h").bitwiseAND(F.lit(segments - 1)) / F.lit(own)
    dealt = hashes.mapInArrow(task("exact", _distinct), "h long, again boolean").repartition(width, F.floor(part))
    found = dealt.mapInArrow(task("exact", lambda x: _possibly_repeated(x, segments, own)), "h long")
    return Staged(found.distinct(), "repeated-hashes")


def _filled(batches: Iterator[pa.RecordBatch], segments: int) -> Iterator[pa.RecordBatch]:
    """The bits of the segments whose hashes these are."""
    planes: dict[int, np.ndarray] = {}
    for batch in batches:
        h = batch.column(0).to_numpy().view(np.uint64)
        word, mask = _masks(h, segments)
        for seg in np.unique(word[:, 0] // _SEG_WORDS).tolist():
            at = word[:, 0] // _SEG_WORDS == seg
            np.bitwise_or.at(planes.setdefault(seg, np.zeros(_SEG_WORDS, np.uint64)), word[at] - seg * _SEG_WORDS, mask[at])
    if planes:
        yield pa.RecordBatch.from_arrays([pa.array(list(planes), pa.int64()), pa.array([p.view(np.int64) for p in planes.values()], pa.list_(pa.int64()))], names=["seg", "bits"])


class Bloom:
    """A filter of the hashes in a staged table (column h), of MAX_BITS at most, to be broadcast."""

    def __init__(self, hashes: Staged):
        n = hashes.df.count()
        self.segments = min(_segments(n), MAX_BITS // _SEG_BITS)
        width = int(hashes.spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = hashes.df.repartition(width, F.col("h").bitwiseAND(F.lit(self.segments - 1)))
        segments = self.segments
        self.table = Staged(dealt.mapInArrow(task("exact", lambda x: _filled(x, segments)), "seg long, bits array<long>"), "filter")

    def test(self, rows: DataFrame, h: Column, out: str) -> DataFrame:
        """rows with whether the filter may hold h, in column `out`."""
        hash_, seg, bits = fresh([*rows.columns, out], "_h", "_seg", "_bits")
        table = F.broadcast(self.table.df.select(F.col("seg").alias(seg), F.col("bits").alias(bits)))
        tested = rows.withColumn(hash_, h)
        tested = tested.join(table, F.col(hash_).bitwiseAND(F.lit(self.segments - 1)) == F.col(seg), "left")
        hit = F.lit(True)
        for s in _PROBES:
            at = F.shiftrightunsigned(hash_, s).bitwiseAND(F.lit(_SEG_BITS - 1)).cast("int")
            hit &= F.getbit(F.element_at(bits, F.shiftright(at, 6) + 1), at.bitwiseAND(F.lit(63))) == 1
        return tested.withColumn(out, F.coalesce(hit, F.lit(False))).drop(hash_, seg, bits)


def with_lists(docs: DataFrame, lists: Staged, key: str, how: str = "inner", broadcast: bool = True) -> DataFrame:
    """docs, inner or left joined with a table of unique keys, by a broadcast if that may be; else only rows that may have an entry shuffle."""
    if broadcast and lists.small:
        return docs.join(F.broadcast(lists.df), key, how)
    names = Staged(lists.df.select(F.xxhash64(key).alias("h")), "listed")
    hit = fresh([*docs.columns, *lists.schema.names], "_listed")[0]
    tested = Bloom(names).test(docs, F.xxhash64(key), hit)
    met = tested.where(hit).drop(hit).join(lists.df, key, how)
    if how == "inner":
        return met
    return met.unionByName(tested.where(~F.col(hit)).drop(hit).withColumns({f.name: F.lit(None).cast(f.dataType) for f in lists.schema if f.name != key}))


def without(rows: DataFrame, key: str, gone: Staged) -> DataFrame:
    """rows but those whose key is in the only column of `gone`. Beyond a broadcast, only rows that may be there shuffle."""
    out = gone.schema.names[0]
    same = F.col(f"`{key}`") == F.col(out)
    if gone.small:
        return rows.join(F.broadcast(gone.df), same, "left_anti")
    hit = fresh([*rows.columns, out], "_hit")[0]
    hashed = Staged(gone.df.select(F.xxhash64(out).alias("h")), "removed-hashes")
    tested = Bloom(hashed).test(rows, F.xxhash64(f"`{key}`"), hit)
    return tested.where(~F.col(hit)).unionByName(tested.where(hit).join(gone.df, same, "left_anti")).drop(hit)


def _hash(sha: str) -> Column:
    return F.conv(F.hex(F.substring(sha, 1, 8)), 16, -10).cast("long")


def _decided(df: DataFrame, id_col: str, text_col: str) -> Staged:
    """Staged, without texts: i (the id), r (a row number), keep_i, keep_r (those of the row that stays), size and sha."""
    prepare(df.sparkSession)
    text = F.col(f"`{text_col}`").cast("string")
    rows = df.select(F.col(f"`{id_col}`").alias("i"), F.coalesce(F.length(text), F.lit(0)).alias("n"), F.unhex(F.sha2(normalised(text), 256)).alias("sha"))
    rows = Staged(rows.withColumn("r", F.monotonically_increasing_id()), "hashed")  # from here on r is a stored number
    n = rows.df.count()
    repeated = repeated_hashes(rows.df.select(_hash("sha").alias("h")), n)
    tested = Bloom(repeated).test(rows.df, _hash("sha"), "maybe")
    maybe = tested.where("maybe").drop("maybe")
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("i").isNull().alias("none"), "i", "r"))
    groups = Staged(maybe.groupBy("sha").agg(best.alias("best"), F.count(F.lit(1)).alias("size")).where("size > 1"), "copies")
    alone = tested.where("NOT maybe").drop("maybe").withColumns({"best": F.lit(None).cast(groups.schema["best"].dataType), "size": F.lit(None).cast("long")})
    joined = alone.unionByName(with_unique(maybe, groups, ["sha"], "size", n, "left"))
    lone = F.col("size").isNull()
    done = joined.select("i", "r", F.when(lone, F.col("i")).otherwise(F.col("best.i")).alias("keep_i"), F.when(lone, F.col("r")).otherwise(F.col("best.r")).alias("keep_r"), F.coalesce("size", F.lit(1).cast("long")).alias("size"), F.lower(F.hex("sha")).alias("sha"))
    out = Staged(done, "decided")
    for table in (rows, repeated, groups):
        table.drop()
    return out


def annotate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row of df its id, _keep_id, _size, _kept and _sha: the row of equal texts that stays, their number, whether this is it.

    Texts are equal if they are so without the six separators; null counts as empty. The longest original text stays,
    then the smallest id (a null id last); of rows alike in both, one. Other columns do not count, whatever their names;
    texts may have any length; an empty table stays empty.
    """
    return _decided(df, id_col, text_col).df.select(F.col("i").alias(id_col), F.col("keep_i").alias("_keep_id"), F.col("size").alias("_size"), (F.col("r") == F.col("keep_r")).alias("_kept"), F.col("sha").alias("_sha"))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay by annotate's rules, with df's own columns, whatever their names.

    Where ids are null or repeated, rows are numbered first. Rows whose id the list of removed ones may hold, by a filter
    that is broadcast, shuffle if that list is large; the others never do.
    """
    number, out = fresh(df.columns, "_row", "_gone")
    decided = _decided(df, id_col, text_col)
    n, distinct = decided.df.agg(F.count(F.lit(1)), F.count_distinct("i")).first()
    rows, key = df, id_col
    if n != distinct:
        decided.drop()
        rows = Staged(df.withColumn(number, F.monotonically_increasing_id()), "numbered").df
        # Numbers rank as ids do, as far as ids tell rows apart.
        by_id = Staged(_decided(rows.withColumn(number, F.struct(F.col(f"`{id_col}`").isNull().alias("none"), F.col(f"`{id_col}`").alias("i"), F.col(number).alias("r"))), number, text_col).df.select("i.r", (F.col("r") == F.col("keep_r")).alias("kept")), "decided")
        gone, key = Staged(by_id.df.where("NOT kept").select(F.col("r").alias(out)), "removed"), number
    else:
        gone = Staged(decided.df.where("r <> keep_r").select(F.col("i").alias(out)), "removed")
        decided.drop()
    return without(rows, key, gone).select(*(F.col(f"`{c}`") for c in df.columns))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = annotate(documents(spark, sf_dir))
    return found.select("doc_id", F.col("_keep_id").alias("keep_id"), F.col("_size").alias("group_size"), F.col("_kept").alias("kept"), F.col("_sha").alias("text_sha256"))


OP9_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), r AS (
  SELECT doc_id, text_sha256,
         count(*) OVER (PARTITION BY text_sha256) AS group_size,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id
  FROM t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM r
"""
