"""Incremental behaviour: seen keys, freshness, caches, an archive that grows by micro-batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import micros
from ..operators.archive import backfill_bodies, backfill_dates, keep_first, last_seen, merge_scan
from ..operators.aggregates import keep_newest
from ..sources.writers import recover, staged_path, swap


def first_seen(stream: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """Each key once within the watermark; the state forgets keys older than `delay`."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def stale_sources(sources: DataFrame, now: Column, ttl_seconds: int) -> DataFrame:
    """Sources to scan anew: those never scanned, not ok, or scanned `ttl_seconds` ago or longer."""
    fresh = F.coalesce(F.col("ok") & (micros(now) - micros(F.col("scanned_at")) < ttl_seconds * 1_000_000), F.lit(False))
    return sources.where(~fresh)


def update_cache(cache: DataFrame, fetched: DataFrame, now: Column, key: str = "url", at: str = "fetched_at", ttl_seconds: int = 172_800, n: int = 500) -> DataFrame:
    """The cache with newer entries in, stale ones out, and no more than the newest n."""
    both = cache.unionByName(fetched).where(micros(now) - micros(F.col(at)) < ttl_seconds * 1_000_000)
    latest = both.groupBy(key).agg(F.max_by(F.struct(*both.columns), at).alias("r")).select("r.*")
    return keep_newest(latest, [F.desc(at), F.col(key).asc()], n)


def update_seen(seen: DataFrame, new: DataFrame, n: int = 5000) -> DataFrame:
    """(key, seq): the last n of the distinct keys in order of first occurrence."""
    offset = seen.agg(F.coalesce(F.max("seq") + 1, F.lit(0)).alias("o"))  # one row
    both = seen.select("key", "seq").unionByName(new.crossJoin(F.broadcast(offset)).select("key", (F.col("seq") + F.col("o")).alias("seq")))
    return both.groupBy("key").agg(F.min("seq").alias("seq")).orderBy(F.desc("seq"), "key").limit(n)


def enrich(archive: DataFrame, batch: DataFrame, key: str = "key", seq: str = "seq") -> DataFrame:
    """The archive with the batch's new keys appended, and longer bodies and missing dates taken from it."""
    grown = merge_scan(archive, batch, key, seq)
    return backfill_dates(backfill_bodies(grown, batch, key, seq), batch, key, seq)


#: Parts of an archive by hash of the key; a batch rewrites those that it touches.
BUCKETS = 256


def run_archive(stream: DataFrame, path: str, checkpoint: str, key: str = "key", seq: str = "seq", buckets: int = BUCKETS):
    """A query that merges each micro-batch into the Parquet archive at `path`; a batch run twice changes nothing more.

    The archive is partitioned by bucket, a hash of the key. A batch reads and rewrites only the buckets of its keys. They are staged
    beside the archive and then moved; a run that broke off in between is ended before the next batch.
    """

    def merge(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        recover(spark, path)
        names = [c for c in batch.columns if c != seq]
        bucket = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")
        touched = [r[0] for r in batch.select(bucket).distinct().collect()]  # `buckets` numbers at most
        if not touched:
            return
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            before = spark.read.schema(f"{batch.select(*names).schema.toDDL()}, bucket int").parquet(path).where(F.col("bucket").isin(touched)).select(*names)
        else:
            before = keep_first(batch, key, seq).select(*names)
        enrich(before, batch, key, seq).withColumn("bucket", bucket).write.partitionBy("bucket").mode("overwrite").parquet(staged_path(path))
        swap(spark, path)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


__all__ = ["enrich", "first_seen", "last_seen", "run_archive", "stale_sources", "update_cache", "update_seen"]
