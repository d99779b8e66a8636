import json

from pyspark.sql import functions as F

from newsloom.sources import readers as R
from newsloom.sources import writers as W
from newsloom.streaming import incremental as I


def entry(key, body="", date=None, url="http://a.org/x/y", title="A good long title"):
    return {"key": key, "url": url, "title": title, "summary": "", "source": "s", "source_label": "S", "language": "en", "date": date, "premiere_vue": "2024-01-01", "body": body}


def test_archive(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text("\n".join([json.dumps(entry("a", "1")), "{broken", "", json.dumps(entry("a", "2")), json.dumps(entry("")), json.dumps(entry("b", "x", "2024-05-01"))]) + "\n")
    rows, counts = R.archive(spark, str(path))
    assert sorted((r.key, r.body) for r in rows.collect()) == [("a", "2"), ("b", "x")]
    assert tuple(counts.first()) == (1, 1)
    assert [r.key for r in R.pending(rows).collect()] == ["a"]
    seen = spark.createDataFrame([("a", "t")], "key string, seen string")
    assert {(r.archive_key, r.derniere_vue) for r in R.articles_of(rows, seen).collect()} == {("a", "t"), ("b", None)}


def test_state_memory_labels(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"dernier_scan": "t2", "vus_avant": {"k": "t1"}}))
    last, seen = R.state(spark, str(tmp_path / "s.json"))
    assert last.first()[0] == "t2" and tuple(seen.first()) == ("k", "t1")
    (tmp_path / "m.json").write_text(json.dumps({"seen_article_keys": ["a", "b"], "sources": {"s": {"last_scanned_at": "2024-05-01T00:00:00Z", "ok": True, "articles": [{"title": "t"}]}}, "body_cache": {"u": {"body": "b", "date": None, "fetched_at": "2024-05-01T00:00:00Z"}}, "last_collected_size": 7}))
    m = R.memory(spark, str(tmp_path / "m.json"))
    assert m["seen"].count() == 2 and m["articles"].first().title == "t" and m["bodies"].first().url == "u" and m["size"].first()[0] == 7
    now = F.lit("2024-05-01 03:00:00").cast("timestamp")
    assert I.stale_sources(m["sources"], now, 7200).count() == 1 and I.stale_sources(m["sources"], now, 14400).count() == 0
    (tmp_path / "l.json").write_text(json.dumps({"a": True, "b": {"pertinent": False}, "c": {"pertinent": None}, "d": None, "e": "yes", "f": {"pertinent": "true"}, "g": 1}))
    assert sorted(map(tuple, R.labels(spark, str(tmp_path / "l.json")).collect())) == [("a", True), ("b", False)]


def test_collect_prefers_feeds(spark):
    attempts = spark.createDataFrame([("s", "f1", 0, True, True), ("s", "f2", 1, True, False), ("s", "h", 2, False, True), ("t", "f", 0, True, False), ("t", "h1", 1, False, False), ("t", "h2", 2, False, True), ("t", "h3", 3, False, True)], "source_name string, attempt string, rank int, is_feed boolean, ok boolean")
    items = attempts.select("source_name", "attempt")
    assert sorted(map(tuple, R.collect(attempts, items).collect())) == [("s", "f1"), ("t", "h2")]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("a", ["x", "y"], 'q "1", 2')], "key string, l array<string>, t string")
    W.export_csv(df, str(tmp_path / "csv"), {"l": "; "})
    assert tuple(R.csv_rows(spark, str(tmp_path / "csv")).first()) == ("a", "x; y", 'q "1", 2')
    path = str(tmp_path / "lines")
    assert W.append_lines(df.limit(0), path) == 0 and W.append_lines(df, path) == 1 and W.append_lines(df, path) == 1
    old = spark.read.json(path)
    W.rewrite(old.limit(1), path)
    assert spark.read.json(path).count() == 1
    W.review_file(df, str(tmp_path / "r"))
    assert "pertinent" in spark.read.json(str(tmp_path / "r")).columns


def test_caches(spark):
    at = lambda s: F.lit(s).cast("timestamp")
    one = lambda u, b, t: spark.range(1).select(F.lit(u).alias("url"), F.lit(b).alias("body"), at(t).alias("fetched_at"))
    cache = one("a", "1", "2024-05-01").unionByName(one("b", "2", "2024-05-02 12:00:00"))
    got = I.update_cache(cache, one("b", "3", "2024-05-02 18:00:00").unionByName(one("c", "4", "2024-05-02 20:00:00")), at("2024-05-03 06:00:00"), n=2)
    assert sorted((r.url, r.body) for r in got.collect()) == [("b", "3"), ("c", "4")]
    seen = spark.createDataFrame([("a", 0), ("b", 1)], "key string, seq int")
    assert sorted((r.key) for r in I.update_seen(seen, spark.createDataFrame([("a", 0), ("c", 1)], "key string, seq int"), 2).collect()) == ["b", "c"]


def test_stream_into_archive(spark, tmp_path):
    schema = "key string, url string, title string, body string, date string, seq int"
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    batches = [[("a", "u", "t", "x", None, 1), ("b", "u", "t", "", None, 2)], [("a", "u", "other", "longer", "2024", 3), ("c", "u", "t", "y", None, 4)]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(source)
        I.run_archive(spark.readStream.schema(schema).json(source), path, str(tmp_path / "cp")).awaitTermination()
    got = {r.key: r for r in spark.read.parquet(path).collect()}
    assert set(got) == {"a", "b", "c"} and got["a"].body == "longer" and got["a"].title == "t" and got["a"].date == "2024"


def test_a_crash_while_swapping_loses_nothing(spark, tmp_path, monkeypatch):
    """Kills between any two moves; the next run ends the swap, and a batch that comes again changes nothing more."""
    import pytest
    from newsloom.sources import writers

    schema = "key string, url string, title string, body string, date string, seq int"
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    run = lambda: I.run_archive(spark.readStream.schema(schema).json(source), path, str(tmp_path / "cp"), buckets=4)
    put = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(source)
    put([(k, "u", "t", k, None, i) for i, k in enumerate("abcdefgh")])
    run().awaitTermination()
    move, left = writers._move, [0]

    def killed(fs, staged, target):
        if left[0] == 0:
            fs.delete(target, True)  # the worst moment: the old part is gone and the new one not there yet
            raise RuntimeError("killed")
        left[0] -= 1
        move(fs, staged, target)

    for n in range(3):
        put([(k, "u", "t", k * 3, None, 100 + n) for k in "abcdefgh"] + [(f"new{n}", "u", "t", "n", None, 200 + n)])
        left[0] = n
        monkeypatch.setattr(writers, "_move", killed)
        with pytest.raises(Exception):
            run().awaitTermination()
        monkeypatch.setattr(writers, "_move", move)
        run().awaitTermination()
        got = {r.key: r.body for r in spark.read.parquet(path).collect()}
        assert got == {k: k * 3 for k in "abcdefgh"} | {f"new{m}": "n" for m in range(n + 1)}
    writers.recover(spark, path)
    assert spark.read.parquet(path).count() == 11


def test_a_broken_write_changes_nothing(spark, tmp_path):
    from newsloom.sources import writers

    path = str(tmp_path / "lines")
    spark.createDataFrame([("a",)], "k string").write.json(path)
    spark.createDataFrame([("b",)], "k string").write.json(path + ".next")
    (tmp_path / "lines.next" / "_SUCCESS").unlink()
    writers.recover(spark, path)
    assert [r.k for r in spark.read.json(path).collect()] == ["a"] and not (tmp_path / "lines.next").exists()
    spark.createDataFrame([("b",)], "k string").write.json(path + ".next")
    writers.recover(spark, path)
    assert [r.k for r in spark.read.json(path).collect()] == ["b"]


def test_first_seen(spark, tmp_path):
    spark.createDataFrame([("a", "2024-05-01 00:00:00"), ("a", "2024-05-01 00:01:00"), ("b", "2024-05-01 00:02:00")], "key string, t string").coalesce(1).write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema("key string, t timestamp").json(str(tmp_path / "in"))
    q = I.first_seen(stream, "key", "t", "1 hour").writeStream.format("memory").queryName("firsts").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.key for r in spark.table("firsts").collect()) == ["a", "b"]
