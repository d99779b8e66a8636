import hashlib
import random
import re

import duckdb
import pytest

from newsloom.llm import exact_dedup as ed


def brute(rows):
    groups = {}
    for k, (i, text) in enumerate(rows):
        sha = hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", text or "").encode()).hexdigest()
        groups.setdefault(sha, []).append((-len(text or ""), i is None, i or 0, k, i))
    out = []
    for sha, own in groups.items():
        keep = min(own)
        out += [(i, keep[4], len(own), k == keep[3], sha) for *_, k, i in own]
    return sorted(out, key=str)


def read(df):
    return sorted((tuple(r) for r in df.selectExpr("doc_id", "_keep_id", "_size", "_kept", "_sha").collect()), key=str)


def test_query_equals_brute_force_and_sql(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in ed.op9_exact_dedup(spark, sf).collect()), key=str)
    assert got == brute(rows)
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert sorted((r[0], r[1], r[2], bool(r[3]), r[4]) for r in db.sql(f"SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM ({ed.OP9_SQL})").fetchall()) == sorted(got)


@pytest.mark.parametrize("small_groups", [True, False])
def test_random_rows(spark, small, monkeypatch, small_groups):
    if not small_groups:
        monkeypatch.setattr("newsloom.llm._common.BROADCAST_BYTES", -1)
    rng = random.Random(1)
    rows = [(i, "".join(rng.choice("ab \n\t") for _ in range(rng.randint(0, 6)))) for i in rng.sample(range(5000), 900)]
    assert read(ed.annotate(small(rows))) == brute(rows)


@pytest.mark.parametrize("small_lists", [True, False])
def test_whole_rows_stay(spark, small, monkeypatch, small_lists):
    """Also beyond a broadcast, where groups are hot or not and the list of removed rows is tested by a filter first."""
    if not small_lists:
        monkeypatch.setattr("newsloom.llm._common.BROADCAST_BYTES", -1)
    rows = [(i, "hot" if i % 3 == 0 else f"t{i % 2500}") for i in range(6000)]
    assert read(ed.annotate(small(rows))) == brute(rows)
    want = sorted(r[0] for r in brute(rows) if r[3])
    assert sorted(r.doc_id for r in ed.exact_dedup(small(rows)).collect()) == want


def test_names_that_clash_and_the_least_id(spark, small):
    rows = [(-(2**63), "a b"), (2**63 - 1, "ab"), (-(2**63), "b"), (None, "b ")]
    names = ["_n", "_sha", "_size", "_row", "_h", "_gone", "sha", "r", "best", "i", "maybe", "size"]
    docs = small(rows).selectExpr("*", *(f"{k} AS `{n}`" for k, n in enumerate(names)))
    assert read(ed.annotate(docs)) == brute(rows)
    kept = ed.exact_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.text, r._row, r.maybe) for r in kept.collect()) == [(False, "a b", 3, 10), (True, "b ", 3, 10)]
    unique = docs.where("text <> 'b ' AND text <> 'b'")
    assert [(r.text, r._gone) for r in ed.exact_dedup(unique).collect()] == [("a b", 5)]


def test_ten_megabytes(spark, small):
    long = "word " * 2_000_000
    rows = [(1, long), (2, long.replace(" ", "  ")), (3, "x")]
    assert read(ed.annotate(small(rows))) == brute(rows)


def test_full_filter_stays_exact(spark, small, monkeypatch):
    monkeypatch.setattr(ed, "_segments", lambda n: 16)
    rows = [(i, str(i % 31_000)) for i in range(40_000)]
    assert read(ed.annotate(small(rows))) == brute(rows)


def test_odd_null_repeated_none(spark, small, odd_texts):
    rows = [(i, t) for i, t in enumerate(odd_texts)] + [(None, "a"), (900, "a "), (901, "a ")]
    assert read(ed.annotate(small(rows))) == brute(rows)
    kept = ed.exact_dedup(small([(1, "x"), (1, "x"), (2, "y")]))
    assert kept.columns[:2] == ["doc_id", "text"] and sorted(r.doc_id for r in kept.collect()) == [1, 2]
    assert ed.annotate(small([])).count() == 0
