import random
import re

import numpy as np
import pytest
from newsloom.llm import bottom_k as bk

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + 4]) for i in range(len(words) - 3)) if len(words) >= 4 else frozenset([tuple(words)] if words else [])


def brute(rows):
    """rows: (id, text), ids unique."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    inverted = {}
    for i in ids:
        for s in sets[i]:
            inverted.setdefault(s, []).append(i)
    for a in ids:
        shared = {}
        for s in sets[a]:
            for b in inverted[s]:
                if b > a:
                    shared[b] = shared.get(b, 0) + 1
        for b, n in shared.items():
            if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i in sets)


def read(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect())


def families(seed, n, size, words=(20, 120), edits=4):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklmnoABC") for _ in range(4))
    rows = []
    for _ in range(n):
        texts = [[word() for _ in range(rng.randint(*words))]]
        for _ in range(rng.randint(0, size)):
            t = list(rng.choice(texts))
            for _ in range(rng.randint(0, edits)):
                t[rng.randrange(len(t))] = word()
            texts.append(t)
        rows += [" ".join(t) for t in texts]
    rng.shuffle(rows)
    return [(5 * i + 3, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("broadcast", [True, False])
def test_random_families(spark, small, monkeypatch, broadcast):
    """Chains of edits on either side of the threshold; also beyond broadcasts."""
    if not broadcast:
        monkeypatch.setattr("newsloom.llm._common.BROADCAST_BYTES", -1)
    rows = families(7, 40, 14)
    got, want = read(bk.near_components(small(rows))), brute(rows)
    assert got == want and len({r[2] for r in want}) < len(want) - 100


def test_one_large_family_in_many_blocks(spark, small, monkeypatch):
    """Blocks of a few classes: the largest component does not meet itself again, all others meet all."""
    monkeypatch.setattr(bk, "LIST_BLOCK", 16)
    monkeypatch.setattr(bk, "SET_BLOCK", 8)
    rows = families(11, 3, 150, (30, 45), 3)
    assert read(bk.near_components(small(rows))) == brute(rows)


def test_common_passages_link_nothing(spark, small):
    rng = random.Random(3)
    passage = [f"p{k}" for k in range(60)]
    rows = [(k, " ".join([f"w{rng.randrange(10**6)}" for _ in range(40)] + passage)) for k in range(300)]
    assert all(r[3] for r in read(bk.near_components(small(rows))))


def test_odd_texts_repeated_rows_and_names(spark, small, odd_texts):
    rows = [(k, t) for k, t in enumerate(odd_texts * 2)] + [(100, "One two THREE"), (101, "one Two three"), (102, "one two three four"), (103, "É a b c"), (104, "é a b c")]
    docs = small(rows).selectExpr("*", "1 AS id", "2 AS n", "3 AS comp", "4 AS value", "5 AS family")
    assert read(bk.near_components(docs)) == brute(rows)
    twice = [(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d E"), (2, "x"), (2, None)]
    got = sorted((tuple(r) for r in bk.near_components(small(twice)).collect()), key=repr)
    assert got == sorted([(None, 2, None, True), (1, 2, None, False), (1, 2, None, False), (2, 0, 2, True), (2, 1, 2, True)], key=repr)
    assert bk.near_components(small([])).collect() == []


def test_query_equals_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = bk.op12_bottom_k(spark, sf)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert read(got) == brute(rows)


def test_estimates_follow_the_union(monkeypatch):
    rng = np.random.default_rng(1)
    for size in (3, 40, 63, 64, 65, 500):
        values = np.unique(rng.integers(0, 2**63, 2 * size, np.uint64))
        a, b = np.sort(rng.choice(values, size, replace=False)), np.sort(rng.choice(values, size, replace=False))
        least = np.union1d(a, b)[: bk.SKETCH]
        want = (np.isin(least, a) & np.isin(least, b)).sum() / len(least)
        assert np.isclose(bk.estimates([a[: bk.SKETCH]], [b[: bk.SKETCH]])[0], want)


def test_recall_at_the_threshold():
    """Of pairs just over 0.8, all share one of the least values and two fifths of those indexed."""
    rng = np.random.default_rng(2)
    for _ in range(5000):
        n = int(rng.integers(5, 400))
        shared = rng.integers(0, 2**63, n, np.uint64)
        extra = rng.integers(0, 2**63, n // 4, np.uint64)
        cut = int(rng.integers(0, len(extra) + 1))
        a, b = (np.sort(np.concatenate((shared, x))) for x in (extra[:cut], extra[cut:]))
        assert len(np.intersect1d(a[: bk.KEYS], b[: bk.KEYS])) > 0
        both = len(np.intersect1d(a[: bk.INDEX], b[: bk.INDEX]))
        assert both >= max(bk.needed(np.array([len(a), len(b)])))
