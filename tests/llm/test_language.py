import itertools
import zlib

import numpy as np
from pyspark.sql.functions import lit

from newsloom.llm import language as lg


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = lg.op4_language_crf(spark, sf).collect()
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in rows if r.held_out]) > 0.98


def toy():
    rng = np.random.default_rng(1)
    kinds = {"aa": "bcd", "ee": "fgh"}
    word = lambda k: "".join(rng.choice(list(kinds[k] + "xyz"), 5))
    return [(k, " ".join(word(k) for _ in range(60))) for k in kinds for _ in range(40)]


def test_switches_are_found():
    texts = toy()
    model = lg.fit(texts)
    a, b = texts[0][1].split()[:10], texts[-1][1].split()[:10]
    p = next(iter(model.label([" ".join(a + b + a)])))
    best = [model.labels[k] for k in p.argmax(axis=1)]
    want = ["aa"] * 10 + ["ee"] * 10 + ["aa"] * 10
    assert np.mean([x == y for x, y in zip(best, want)]) > 0.9


def test_forward_backward_equals_enumeration(monkeypatch):
    monkeypatch.setattr(lg, "BLOCK", 3)
    rng = np.random.default_rng(2)
    model = lg.Crf(["a", "b", "c"], np.zeros((1, 3)), {}, rng.normal(size=(3, 3)), rng.normal(size=3))
    table = rng.normal(size=(20, 3)).astype(np.float32)
    texts = [rng.integers(0, 20, n) for n in (1, 2, 3, 4, 7)]
    got = model.posteriors(texts, table)
    at = 0
    for own in texts:
        want = np.zeros((len(own), 3))
        for path in itertools.product(range(3), repeat=len(own)):
            w = model.start[path[0]] + sum(table[r][k] for r, k in zip(own, path)) + sum(model.transition[x, y] for x, y in zip(path, path[1:]))
            want[np.arange(len(own)), path] += np.exp(w)
        want /= want.sum(axis=1, keepdims=True)
        assert np.allclose(got[at : at + len(own)], want, atol=1e-6)
        at += len(own)


def test_odd_rows(spark, small, odd_texts):
    rows = [(i, t) for i, t in enumerate(odd_texts)] + [(None, "bcd"), (3, "bcd"), (3, "bcd"), (70, "12 34 !!")]
    model = lg.fit(toy())
    got = {(r.doc_id, r.lang_pred, r.score > 0) for r in lg.identify(small(rows), model).collect()}
    assert (0, "und", False) in got and (1, "und", False) in got and (70, "und", False) in got and (None, "aa", True) in got
    assert lg.identify(small([]), model).count() == 0
    assert {r.lang_pred for r in lg.identify(small(rows), lg.learn(small(rows))).collect()} == {"und"}
    assert {r.lang_pred for r in lg.identify(small([(1, "x y")]), lg.learn(small([(1, "x y"), (2, None)], lang="qq"))).collect()} == {"qq"}
    kept = lg.accept(small(rows), model, 0.4)
    assert kept.columns == small(rows).columns and {0, 1, 3, 70}.isdisjoint({r.doc_id for r in kept.where("doc_id <> 3").collect()})


def test_stretches_and_batches_change_nothing(monkeypatch):
    model = lg.fit(toy())
    texts = [t for _, t in toy()[::7]]
    whole = list(model.label(texts))
    monkeypatch.setattr(lg, "STRETCH", 100)
    assert all(np.allclose(a, b) for a, b in zip(whole, model.label(texts)))
    for size in (1, 7, 31, 32, 33):  # stretches hand their messages on
        monkeypatch.setattr(lg, "STRETCH", size)
        assert all(np.allclose(a, b, atol=1e-9) for a, b in zip(whole, model.label(texts), strict=True))


def test_long_texts_are_learned_from(spark, small):
    """Texts of 90 KB only, in two languages; a label that is not among the most frequent is not learned."""
    texts = [(k, lang, " ".join([t] * 300)) for k, (lang, t) in enumerate(toy()[::6])]
    assert min(len(t) for *_, t in texts) > lg.SAMPLE_BYTES
    docs = small([(i, t) for i, _, t in texts]).drop("lang").join(spark.createDataFrame([(i, lang) for i, lang, _ in texts], "doc_id long, lang string"), "doc_id")
    model = lg.learn(docs)
    assert model.labels == ["aa", "ee"]
    assert {(r.doc_id, r.lang_pred) for r in lg.identify(docs, model).collect()} == {(i, lang) for i, lang, _ in texts}


def test_the_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(lg, "LANGUAGES", 3)
    monkeypatch.setattr(lg, "SAMPLE_TOTAL", 3000)
    seen = []
    monkeypatch.setattr(lg, "fit", seen.append)
    rows = [(f"l{k % 9}" if k % 9 > 2 else f"l{k % 3}", f"text {k} " + "word " * (k % 70)) for k in range(900)]
    lg.learn(spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "1 AS doc_id"))
    assert {x for x, _ in seen[0]} == {"l0", "l1", "l2"} and sum(len(t) for _, t in seen[0]) <= 3000


def test_gradient_of_a_fitted_model():
    """Training ends where labels' likelihood stands above that of any other constant labelling."""
    model = lg.fit(toy())
    for lang, text in toy()[::10]:
        p = next(iter(model.label([text])))
        assert p.mean(axis=0).argmax() == model.labels.index(lang) and p.mean(axis=0).max() > 0.9


def test_names_that_clash_and_ten_megabytes(spark, small):
    model = lg.fit(toy())
    rows = [(1, "bcdb " * 2_000_000), (2, "fghf fgh"), (-(2**63), None)]
    docs = small(rows).selectExpr("*", "1 AS t", "2 AS label", "3 AS _h", "4 AS score")
    assert sorted((r.doc_id, r.lang_pred) for r in lg.identify(docs, model).collect()) == [(-(2**63), "und"), (1, "aa"), (2, "ee")]
    kept = lg.accept(docs, model, 0.4)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]
    assert lg.learn(docs.withColumn("lang", lit("qq"))).labels == ["qq"]
