"""The page cache as a data source: whole inserts, what is read and what is not, failed tasks, expiry."""

import json
import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from newsloom.sources import page_cache as C

NOW = datetime(2024, 3, 1, 12, tzinfo=timezone.utc)
KINDS = "url string, content string, age int, other int"


def land(spark, path, rows):
    df = spark.createDataFrame(rows, KINDS)
    C.insert(df.withColumn("fetched_at", F.lit(NOW) - F.make_dt_interval(secs=F.col("age"))), path)


def read(spark, path, ttl):
    return {r.url: r.content for r in C.fresh(spark, path, NOW, ttl).collect()}


def test_newest_fresh_entries(spark, tmp_path):
    path = f"file://{tmp_path}/cache"
    assert read(spark, path, 60) == {}
    land(spark, path, [("a", "old", 100, 1), ("b", "old", 61, 1), ("c", "edge", 60, 1), ("d", "", 10, 1)])
    land(spark, path, [("a", "new", 50, 2), ("a", "mid", 70, 2), (None, "x", 1, 2), ("e", None, 1, 2), ("f", "x", None, 2), ("d", "tie", 10, 2)])
    assert read(spark, path, 60) == {"a": "new", "c": "edge", "d": "tie"}
    assert read(spark, path, 59) == {"a": "new", "d": "tie"}
    assert read(spark, path, None) == {"a": "new", "b": "old", "c": "edge", "d": "tie"}
    land(spark, path, [])
    assert len(os.listdir(f"{tmp_path}/cache/commits")) == 2


def test_expired_files_are_not_opened(spark, tmp_path):
    path = f"file://{tmp_path}/cache"
    land(spark, path, [("a", "old", 5000, 1)])
    old = C.parts(path)
    land(spark, path, [("b", "new", 5, 1)])
    for p in old:  # whoever opens it fails
        with open(f"{tmp_path}/cache/{p.name}", "wb") as f:
            f.write(b"torn")
    assert read(spark, path, 60) == {"b": "new"}
    with pytest.raises(Exception, match="arquet"):
        read(spark, path, None)
    assert C.expire(path, NOW - timedelta(seconds=60)) == len(old) == 1
    assert read(spark, path, None) == {"b": "new"} and C.expire(path, NOW - timedelta(seconds=60)) == 0
    assert len(os.listdir(f"{tmp_path}/cache/commits")) == 1 and len(os.listdir(f"{tmp_path}/cache/parts")) == 1


def test_filters_reach_the_reader(spark, tmp_path):
    path = f"file://{tmp_path}/cache"
    land(spark, path, [("a", "x", 1, 1), ("b", "y", 2, 1), ("c", "z", 3, 1)])
    df = spark.read.format("page_cache").load(path)
    one = df.where(F.col("url").isin("a", "c") & (F.col("fetched_at") < F.lit(NOW - timedelta(seconds=1))) & (F.length("content") == 1))
    assert [r.content for r in one.collect()] == ["z"]
    assert [r.content for r in df.where(F.col("url") == "b").collect()] == ["y"]
    bounds = C.Bounds()
    assert bounds.take(C.GreaterThan(("fetched_at",), NOW)) and bounds.take(C.LessThanOrEqual(("fetched_at",), NOW + timedelta(seconds=1)))
    assert bounds.greatest - bounds.least == 999_999 and not bounds.take(C.EqualTo(("content",), "x"))
    assert not bounds.may_have(C.Part("p", 1, bounds.least - 9, bounds.least - 1)) and bounds.may_have(C.Part("p", 1, 0, bounds.least))


def test_failed_inserts_leave_nothing_to_read(spark, tmp_path):
    path = f"file://{tmp_path}/cache"
    land(spark, path, [("a", "x", 1, 1)])
    torn = spark.range(8, numPartitions=4).select(F.concat(F.lit("u"), "id").alias("url"), F.when(F.col("id") == 7, F.raise_error(F.lit("torn"))).otherwise("y").alias("content"), F.lit(NOW).alias("fetched_at"))
    with pytest.raises(Exception, match="torn"):
        C.insert(torn, path)
    assert read(spark, path, None) == {"a": "x"}


def test_a_merge_of_commits_that_broke_off(spark, tmp_path):
    """The new commit is there and the old ones not yet gone: entries count once."""
    path = f"file://{tmp_path}/cache"
    land(spark, path, [("a", "x", 1, 1)])
    land(spark, path, [("b", "y", 1, 1)])
    before = C.parts(path)
    C._put_commit(path, before, C._commits(path))
    assert C.parts(path) == before and spark.read.format("page_cache").load(path).count() == 2
    assert sum(len(json.load(open(f"{tmp_path}/cache/commits/{n}"))["replaces"]) for n in os.listdir(f"{tmp_path}/cache/commits")) == 2


def test_long_texts_and_many_rows(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/cache"
    rows = spark.range(20_000, numPartitions=3).select(F.col("id").cast("string").alias("url"), F.when(F.col("id") == 5, F.repeat(F.lit("é"), 3_000_000)).otherwise("x").alias("content"), F.timestamp_seconds(F.col("id") * 7 % 20_000).alias("fetched_at"))
    C.insert(rows, path)
    got = C.fresh(spark, path, datetime(1970, 1, 1, 5, 33, 19, tzinfo=timezone.utc), 9_999)
    assert got.count() == 10_000 and got.where("url = '5'").count() == 0
    assert spark.read.format("page_cache").load(path).where("url = '5'").select(F.length("content")).first()[0] == 3_000_000
