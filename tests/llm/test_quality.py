import zlib

import numpy as np

from newsloom.llm import quality as q


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = q.op2_quality_nbsvm(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [(labels[r.doc_id], r.score, r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for y, s, _ in held if y], [s for y, s, _ in held if not y]
    assert np.mean([[g > b for g in good] for b in bad]) > 0.95
    assert np.mean([y == p for y, _, p in held]) > 0.93


def by_subgradient(x, y, bound, steps=60_000):
    """Another solver of the same problem: w.w / 2 + sum(bound * hinge), by averaged subgradient steps."""
    w = np.zeros(x.shape[1])
    best = np.inf
    for t in range(1, steps):
        margin = y * (x @ w)
        value = w @ w / 2 + (bound * np.maximum(0, 1 - margin)).sum()
        best = min(best, value)
        w -= (w - ((bound * y * (margin < 1)) @ x)) / (t + 10)
    return best


def test_descent_reaches_the_optimum(monkeypatch):
    """The log-count ratios are as told, and the primal value of the model is that of an independent solver."""
    monkeypatch.setattr(q, "EPOCHS", 400)
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 60, 12)).astype(np.int32) for _ in range(80)]
    labels = np.array([int((r < 25).mean() > 0.4) for r in rows])
    labels[:6] = 1 - labels[:6]
    model = q.fit(rows, labels)
    order = np.random.default_rng(1).permutation(80)
    used = order[16:]
    dense = np.zeros((80, 60))
    for i, r in enumerate(rows):
        dense[i, r] = 1
    n = [(labels[used] == c).sum() + 2 * q.SMOOTHING for c in (0, 1)]
    ratio = np.log((dense[used][labels[used] == 1].sum(axis=0) + q.SMOOTHING) / n[1]) - np.log((dense[used][labels[used] == 0].sum(axis=0) + q.SMOOTHING) / n[0])
    x = np.column_stack([dense * ratio / np.sqrt(dense.sum(axis=1))[:, None], np.ones(80)])[used]
    y = np.where(labels[used] == 1, 1.0, -1.0)
    bound = q.COST * 0.5 / np.array([(labels[used] == c).mean() for c in (0, 1)])[labels[used]]
    weights = np.append(np.divide(model.weights[:60], ratio, out=np.zeros(60), where=ratio != 0), model.bias)
    margin = y * (x @ weights)
    assert np.allclose(margin, y * np.array([model.margin(rows[i]) for i in used]), atol=1e-4)
    primal = weights @ weights / 2 + (bound * np.maximum(0, 1 - margin)).sum()
    assert abs(primal - by_subgradient(x, y, bound)) < 0.01 * primal


def test_features_do_not_depend_on_pieces(monkeypatch):
    import pyarrow as pa

    texts = ["Some words, and 12 signs! " * 40, "", "x" * 500 + " y y"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"])
    whole = list(q.features(batch, 0))
    monkeypatch.setattr(q, "CHUNK_BYTES", 7)
    assert all(np.array_equal(a, b) for a, b in zip(whole, q.features(batch, 0)))


def test_odd_rows(spark, small, odd_texts):
    rows = [(i, t) for i, t in enumerate(odd_texts)] + [(None, "x"), (3, "x"), (3, "x")]
    docs = small(rows)
    labels = spark.createDataFrame([(0, 1), (1, 0), (4, 1), (5, 0), (5, 0), (6, None), (77, 1), (None, 1)], "doc_id long, quality int")
    model = q.learn(docs, labels)
    got = q.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in got if r.doc_id in (0, 1)} and q.score(small([]), model).count() == 0
    none = q.learn(docs, labels.limit(0))
    assert {r.score for r in q.score(docs, none).collect()} == {0.5}
    assert all(r.score > 0.9 for r in q.score(docs, q.learn(docs, labels.where("quality = 1"))).collect())


def test_many_copies_and_names_that_clash(spark, small):
    """A third of the rows share an id and a text: they count once, and nothing gathers on the driver."""
    rows = [(k, f"good words number {k} here") for k in range(30)] + [(100 + k, f"BAD!!! {k} $$$") for k in range(30)] + [(7, "good words number 7 here")] * 30 + [(None, "x")] * 5
    docs = small(rows).selectExpr("*", "1 AS label", "2 AS id", "3 AS _h", "4 AS _held", "5 AS f", "6 AS score")
    labels = spark.createDataFrame([(k, 1) for k in range(30)] + [(7, 1)] * 40 + [(100 + k, 0) for k in range(30)], "doc_id long, quality int")
    got = q.score(docs, q.learn(docs, labels)).collect()
    assert len(got) == len(rows) and all((r.score > 0.5) == (r.doc_id < 100) for r in got if r.doc_id is not None)


def test_long_texts_are_learned_from(spark, small, monkeypatch):
    """Texts of 100 KB only; and a sample bounded by bytes keeps some of each class."""
    rng = np.random.default_rng(3)
    text = lambda kind: " ".join(f"{kind}{x}" for x in rng.integers(0, 5000, 17_000))
    rows = [(k, text("good") if k % 2 else text("BAD!")) for k in range(24)]
    docs, labels = small(rows), spark.createDataFrame([(k, k % 2) for k in range(24)], "doc_id long, quality int")
    for most in (q.SAMPLE_BYTES, 400_000):
        monkeypatch.setattr(q, "SAMPLE_BYTES", most)
        got = q.score(docs, q.learn(docs, labels)).collect()
        assert all((r.score > 0.5) == bool(r.doc_id % 2) for r in got)


def test_features_by_brute_force():
    """The numbers of a text's n-grams, one by one."""
    import pyarrow as pa
    from newsloom.llm._words import raw, spans, word_hashes

    def kind(c):
        signs = (".,;:", "!?", "'\"-", "|", "#", "$%", "&*", "<>", "/\\")
        found = [7 + k for k, own in enumerate(signs) if c in own.encode()]
        return found[0] if found else 0 if c in b" \t" else 1 if c in b"\n\x0b\x0c\r" else 5 if c > 127 else 2 if chr(c).islower() else 3 if chr(c).isupper() else 4 if chr(c).isdigit() else 6

    for text in ("Hello, World 42!", "a a b", "", "x", "é|é #1 \n<b>"):
        batch = pa.RecordBatch.from_arrays([pa.array([text])], names=["t"])
        kinds = [kind(c) for c in text.encode()]
        want = set()
        for n in range(1, 5):
            for b in range(len(kinds) - n + 1):
                code = 0
                for x in kinds[b : b + n]:
                    code = code * 16 + x
                want.add(code + sum(16**m for m in range(1, n)))
        data, bounds = raw(batch.column(0))
        starts, ends, _ = spans(data, bounds)
        w = [int(x) for x in word_hashes(data, starts, ends)[0]]
        if any(x == y for x, y in zip(w, w[1:])):
            want.add(q.SHAPES)
        pairs = [int(q.mix(np.array([(x * 0x9E3779B97F4A7C15 + y) % 2**64], np.uint64))[0]) for x, y in zip(w, w[1:])]
        want |= {q.SHAPES + 1 + (x >> (64 - q.WORD_BITS)) for x in [*w, *pairs]}
        assert sorted(next(iter(q.features(batch, 0))).tolist()) == sorted(want)
