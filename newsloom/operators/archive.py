"""Keyed merges: dedup, anti joins, an append-only archive that is enriched but never rewritten, last-seen state.

Order is always a column (`seq`), as rows of a DataFrame have none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BODY_CHARS = 8000


def keep_first(df: DataFrame, key: str, seq: str) -> DataFrame:
    """The first row of each key; rows without a key go. Ties in seq are settled by the row's hash."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(seq, F.xxhash64(*df.columns)))
    return df.where(F.coalesce(F.col(key), F.lit("")) != "").withColumn("_k", rank).where("_k = 1").drop("_k")


def keep_last(df: DataFrame, key: str, seq: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(seq), F.xxhash64(*df.columns)))
    return df.where(F.coalesce(F.col(key), F.lit("")) != "").withColumn("_k", rank).where("_k = 1").drop("_k")


def unseen(df: DataFrame, seen: DataFrame, key: str, cached: Column | None = None) -> DataFrame:
    """Rows whose key is not in `seen`, and cached rows in any case."""
    if cached is None:
        return df.join(seen.select(key).distinct(), key, "left_anti")
    always = F.coalesce(cached, F.lit(False))
    return df.where(~always).join(seen.select(key).distinct(), key, "left_anti").unionByName(df.where(always))


def merge_scan(archive: DataFrame, scanned: DataFrame, key: str, seq: str) -> DataFrame:
    """The archive as it is, and the first of each scanned key that it lacks."""
    new = keep_first(scanned, key, seq).join(archive.select(key), key, "left_anti")
    return archive.unionByName(new.select(*archive.columns))


def last_seen(keys: DataFrame, scanned: DataFrame, exceptions: DataFrame, previous_scan: Column, key: str) -> DataFrame:
    """The new exceptions (key, seen): archived keys that this scan lacks, stamped once with the scan before."""
    missing = keys.select(key).distinct().join(scanned.select(key).distinct(), key, "left_anti")
    return missing.join(exceptions.select(key, "seen"), key, "left").select(key, F.coalesce("seen", previous_scan).alias("seen"))


def seen_at(keys: DataFrame, exceptions: DataFrame, last_scan: Column, key: str) -> DataFrame:
    return keys.join(exceptions.select(key, "seen"), key, "left").withColumn("seen", F.coalesce("seen", last_scan))


def backfill_bodies(archive: DataFrame, updates: DataFrame, key: str, seq: str, levels: list[str] | None = None) -> DataFrame:
    """Bodies that are strictly longer come in, cut to BODY_CHARS; of several updates the longest, then the first."""
    own = updates.where(F.col("level").isin(levels)) if levels else updates
    best = own.groupBy(key).agg(F.max(F.struct(F.length(F.left(F.col("body"), F.lit(BODY_CHARS))).alias("n"), (-F.col(seq)).alias("s"), F.left(F.col("body"), F.lit(BODY_CHARS)).alias("b"))).alias("_u"))
    longer = F.col("_u.n") > F.length(F.coalesce("body", F.lit("")))
    return archive.join(best, key, "left").withColumn("body", F.when(longer, F.col("_u.b")).otherwise(F.col("body"))).drop("_u").select(*archive.columns)


def backfill_dates(archive: DataFrame, updates: DataFrame, key: str, seq: str, date: str = "date") -> DataFrame:
    """A missing date comes from the first update that has one."""
    first = updates.where(F.col(date).isNotNull()).groupBy(key).agg(F.min_by(date, seq).alias("_d"))
    return archive.join(first, key, "left").withColumn(date, F.coalesce(date, "_d")).drop("_d").select(*archive.columns)


def merge_archives(base: DataFrame, incoming: DataFrame, key: str, body: str = "body", date: str = "date") -> DataFrame:
    """All keys of both; base's facts stand, but for a longer body and a missing date. `change` says what happened."""
    a, b = base.alias("a"), incoming.alias("b")
    joined = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer")
    new, kept = F.col(f"a.{key}").isNull(), F.col(f"b.{key}").isNull()
    longer = F.length(F.coalesce(F.col(f"b.{body}"), F.lit(""))) > F.length(F.coalesce(F.col(f"a.{body}"), F.lit("")))
    dated = F.col(f"a.{date}").isNull() & F.col(f"b.{date}").isNotNull()
    cols = [
        (F.when(new | longer, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")) if c == body else F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")) if c == date else F.when(new, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}"))).alias(c)
        for c in base.columns
    ]
    change = F.when(new, "added").when(kept, "kept").when(longer & dated, "body and date").when(longer, "body").when(dated, "date").otherwise("kept")
    return joined.select(*cols, change.alias("change"))


def with_archive(scanned: DataFrame, archive: DataFrame, key: str) -> DataFrame:
    """The scanned rows, and the archived ones that the scan lacks."""
    return scanned.unionByName(archive.join(scanned.select(key), key, "left_anti"), allowMissingColumns=True)


def body_from_archive(df: DataFrame, archive: DataFrame, key: str) -> DataFrame:
    own = archive.select(key, F.col("body").alias("_old")).where(F.coalesce("_old", F.lit("")) != "")
    return df.join(own, key, "left").withColumn("body", F.coalesce("_old", "body")).drop("_old")


def clean_column(df: DataFrame, name: str, cleaned: Column) -> DataFrame:
    """df with the cleaned column and whether that changed it, in `changed`."""
    return df.withColumn("_c", cleaned).withColumn("changed", ~F.col(name).eqNullSafe(F.col("_c"))).withColumn(name, F.col("_c")).drop("_c")


def look_up(df: DataFrame, dim: DataFrame, key: str, value: str, default: str) -> DataFrame:
    """A dimension's value for each row; AQE broadcasts the dimension if it is small."""
    return df.join(dim.select(key, value), key, "left").withColumn(value, F.coalesce(value, F.lit(default)))


def priority_union(first: DataFrame, rest: DataFrame, key: str) -> DataFrame:
    """Rows of `first`, then those of `rest` whose key is new."""
    return first.unionByName(rest.join(first.select(key), key, "left_anti"))
