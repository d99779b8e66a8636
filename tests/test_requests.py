"""Requests: positions over files and splits, refused articles, results in one pass, batches."""

import json

import pytest
from pyspark.sql import functions as F

from newsloom.operators import scoring as S
from newsloom.plans import demo
from newsloom.sources import requests as Q

LINES = [
    '{"title": "the arrest", "body": "from this", "url": "u0", "source": "src7", "extra": {"a": 1}}', "", '["the"]', '{"title": "", "url": "u3"}', '{"body": "b"}', '{"title": 7, "url": 5}', "{torn", '"text"', "3",
    "null", "true", '{"title": "les", "body": null, "date": "2024-05-01", "language": "fr"}', '{"title": "les", "body": null, "date": "2024-05-01", "language": "fr"}', '{"title": " "}',
]
ERRORS = [None, "empty line", "not a JSON object (type=array)", *["title missing or empty"] * 3, "not JSON", "not a JSON object (type=string)", "not a JSON object (type=bigint)", "not a JSON object (type=void)", "not a JSON object (type=boolean)", None, None, None]


def lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(0, len(LINES), 5):
        (tmp_path / f"in/{k:03d}.jsonl").write_text("\n".join(LINES[k : k + 5]) + "\n")
    return Q.request_lines(spark, f"{tmp_path}/in", f"{tmp_path}/staged")


def test_positions_and_refusals(spark, tmp_path):
    got = sorted(lines(spark, tmp_path).collect())
    assert [tuple(r) for r in got] == list(enumerate(LINES))
    found = {r["index"]: r for r in Q.outcomes(spark.createDataFrame(got), demo.LEXICON).collect()}
    assert [found[k].error for k in range(len(LINES))] == ERRORS
    assert [found[k].url for k in (0, 2, 3, 4, 5, 11)] == ["u0", None, "u3", None, "5", ""]
    assert found[3].score is None and found[3].sub_scores is None and found[3].keywords is None
    assert found[11][2:] == found[12][2:]  # repeated rows


def test_results_are_those_of_the_score(spark, tmp_path):
    rows = spark.createDataFrame([(0, LINES[0]), (1, LINES[11])], "index long, value string")
    got = {r["index"]: r for r in Q.outcomes(rows, demo.LEXICON).collect()}
    plain = spark.createDataFrame([(k, *(json.loads(LINES[n]).get(f) or "" for f in ("title", "summary", "body", "source", "url", "language"))) for k, n in ((0, 0), (1, 11))], "index long, title string, summary string, body string, source string, url string, language string")
    for r in S.score(plain, demo.LEXICON).collect():
        o = got[r["index"]]
        assert (o.score, o.level, o.priority, o.relevant, o.theme, o.reasons, o.language) == (r.score, r.level, r.priority, r.relevant, r.theme, r.reasons, r.language)
        assert o.sub_scores.repression_score == r.signals.repression_score and set(o.keywords) >= set(r.signals.region_1)


def test_one_job_writes_both_and_batches_count(spark, tmp_path):
    found = Q.outcomes(lines(spark, tmp_path), demo.LEXICON)
    assert Q.write_outcomes(found, f"{tmp_path}/out") == {"count": 14, "scored": 4, "failed": 10}
    kept = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(r["index"] for r in kept.where("NOT failed").collect()) == [0, 11, 12, 13]
    for size in (1, 5, 200):
        got = sorted(tuple(r) for r in Q.progress(kept, size).collect())
        want = [(a, min(a + size, 14) - 1, sum(e is None for e in ERRORS[a : a + size]), sum(e is not None for e in ERRORS[a : a + size])) for a in range(0, 14, size)]
        assert got == want
    for bad in (0, -1, "5", True):
        with pytest.raises(ValueError):
            Q.progress(kept, bad)


def test_documents(spark, tmp_path):
    def of(value):
        path = tmp_path / f"{abs(hash(value))}.json"
        path.write_text(value)
        return Q.request_document(spark, str(path))

    got = sorted(of('{"articles": [{"title": "a\\nb"}, 3, null]}').collect())
    assert [(r["index"], json.loads(r.value) if r.value else None) for r in got] == [(0, {"title": "a\nb"}), (1, 3), (2, None)]
    assert of('{"articles": []}').count() == 0
    for bad in ("{}", '{"articles": {"a": 1}}', "[1]", "torn"):
        with pytest.raises(ValueError):
            of(bad)


def test_splits_and_skew_keep_the_order(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a").write_text("".join(f"{k}\n" for k in range(5000)))
    (tmp_path / "in/b").write_text("\n" * 100 + "x" * 100_000 + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        got = Q.request_lines(spark, f"{tmp_path}/in", f"{tmp_path}/staged").withColumn("value", F.left("value", F.lit(9))).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = [str(k) for k in range(5000)] + [""] * 100 + ["x" * 9]
    assert [r.value for r in sorted(got)] == want and [r["index"] for r in sorted(got)] == list(range(len(want)))
    assert Q.in_order(spark.createDataFrame([], "a int"), ["a"], f"{tmp_path}/none").count() == 0
