import random

import pytest
from pyspark.sql import functions as F

from newsloom.operators import matching as P
from newsloom.operators import vocabulary_tables as V
from newsloom.operators.vocabulary import TermSet

PARTS = ["ab", "abc", "a", "b c", "été", "c++", "#tag", "x-y", "о", "об", "l'eau", "ab cd", "b"]


def words(rng, n):
    return [rng.choice(PARTS) if rng.random() < 0.4 else "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 3))) for _ in range(n)]


@pytest.mark.parametrize("seed, broadcast", [(1, True), (2, False)])
def test_equals_find_terms_for_every_list(spark, monkeypatch, seed, broadcast):
    """Nested, repeated and overlapping terms, terms with signs at their ends, letters beyond ASCII."""
    if not broadcast:
        monkeypatch.setattr(V, "BROADCAST_TERMS", -1)
    rng = random.Random(seed)
    lists = {f"l{k}": [" ".join(words(rng, rng.randint(1, 3))) for _ in range(rng.randint(1, 30))] for k in range(9)}
    texts = [(k, rng.choice(["", " ", "  "]).join(rng.choice([" ", " ", "-", ", "]).join(words(rng, 3)) for _ in range(rng.randint(0, 12))).strip()) for k in range(120)] + [(900, None), (901, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("text", F.lower(F.trim(F.regexp_replace("text", r"(?U)\s+", " "))))
    vocabulary = spark.createDataFrame([(name, j, t) for name, own in lists.items() for j, t in enumerate(own)] + [(None, 1, "ab"), ("l0", 99, " ")], "list_id string, ord long, term string")
    got = {(r.doc_id, r.list_id): r.terms for r in V.match_vocabulary(docs, vocabulary).collect()}
    want = {}
    for r in docs.select("doc_id", *(P.find_terms(F.col("text"), TermSet.of(name, own)).alias(name) for name, own in lists.items())).collect():
        want |= {(r.doc_id, name): r[name] for name in lists if r[name]}
    assert got == want and len(got) > 200


def test_five_thousand_terms_in_fifty_sets(spark):
    rng = random.Random(5)
    vocabulary = spark.createDataFrame([(f"s{k % 50}", k // 50, f"w{rng.randrange(9000)}" + (f" w{rng.randrange(9000)}" if k % 3 == 0 else "")) for k in range(5000)], "list_id string, ord long, term string")
    docs = spark.createDataFrame([(k, " ".join(f"w{rng.randrange(9000)}" for _ in range(300))) for k in range(40)], "doc_id long, text string")
    got = {(r.doc_id, r.list_id): r.terms for r in V.match_vocabulary(docs, vocabulary).collect()}
    sets: dict = {}
    for r in vocabulary.orderBy("list_id", "ord").collect():
        sets.setdefault(r.list_id, []).append(r.term)
    picked = sorted(sets)[::10]
    for r in docs.select("doc_id", *(P.find_terms(F.col("text"), TermSet.of(n, sets[n])).alias(n) for n in picked)).collect():
        assert all(got.get((r.doc_id, n), []) == r[n] for n in picked)


def test_files(spark, tmp_path):
    rows = [("a", 1, "One  Two"), ("a", 2, "x"), ("b", 1, None), (None, 1, "y")]
    df = spark.createDataFrame(rows, "list_id string, ord long, term string")
    for kind in ("json", "csv", "parquet"):
        path = str(tmp_path / kind)
        (df.write.option("header", True).csv(path) if kind == "csv" else df.write.format(kind).save(path))
        assert sorted(map(tuple, V.read_vocabulary(spark, path, kind).collect())) == [("a", 1, "one two"), ("a", 2, "x")]
    assert V.match_vocabulary(spark.createDataFrame([(1, "x")], "doc_id long, text string"), df.limit(0)).collect() == []


def test_single_words_take_one_join_of_a_texts_distinct_words(spark, monkeypatch):
    """Words of all texts that share an id are found, and a word that a text repeats is looked up once."""
    monkeypatch.setattr(V, "BROADCAST_TERMS", -1)
    terms = spark.createDataFrame([("l", 2, "été"), ("l", 1, "ab"), ("l", 3, "ab"), ("m", 1, "#")], "list_id string, ord long, term string")
    docs = spark.createDataFrame([(1, "ab ab été-ab"), (1, "# cd"), (2, "abc # été"), (None, "ab")], "doc_id long, text string")
    found = V.match_vocabulary(docs, terms)
    assert sorted((r.doc_id or 0, r.list_id, r.terms) for r in found.collect()) == [(0, "l", ["ab", "ab"]), (1, "l", ["ab", "été", "ab"]), (1, "m", ["#"]), (2, "l", ["été"]), (2, "m", ["#"])]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join Inner") == 1
