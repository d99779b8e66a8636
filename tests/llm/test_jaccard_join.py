import random
import re

import numpy as np
import pytest

from newsloom.llm import _components, jaccard_join as jj


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def brute(rows):
    """rows: (id, text), ids unique."""
    sets = {}
    for i, text in rows:
        if s := shingles(text):
            sets.setdefault(s, []).append(i)
    kinds = [(min(ids), len(ids), s, ids) for s, ids in sets.items()]
    root = {k[0]: k[0] for k in kinds}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = {k[0]: [0, 0] for k in kinds}
    for a in kinds:
        for b in kinds:
            if a[0] < b[0] and 10 * len(a[2] & b[2]) >= 8 * len(a[2] | b[2]):
                for x, y in ((a, b), (b, a)):
                    links[x[0]][0] += 1
                    links[x[0]][1] += y[1]
                lo, hi = sorted((find(a[0]), find(b[0])))
                root[hi] = lo
    of = {i: k for k in kinds for i in k[3]}
    return sorted((i, of[i][0], of[i][1], find(of[i][0]), *links[of[i][0]]) if i in of else (i, i, 1, i, 0, 0) for i, _ in rows)


def read(df):
    return sorted(tuple(r) for r in df.select("doc_id", "copy_of", "copies", "class_id", "n_links", "n_near").collect())


def families(seed, n, size):
    """Texts of several families, whose members differ by a few words from others of the family."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklmno") for _ in range(4))
    rows = []
    for _ in range(n):
        texts = [[word() for _ in range(rng.randint(30, 120))]]
        for _ in range(rng.randint(0, size)):
            t = list(rng.choice(texts))
            for _ in range(rng.randint(0, 3)):
                t[rng.randrange(len(t))] = word()
            texts.append(t)
        rows += [" ".join(t) for t in texts]
    rng.shuffle(rows)
    return [(5 * i + 3, t) for i, t in enumerate(rows)]


def test_prefixes_shorten_to_the_recall_and_leave_crowds_alone():
    missed = lambda depth: np.prod(1 - 0.8 ** depth.astype(float), axis=1)
    alone = np.ones((1, jj.TREES, 4), int)
    depth = jj.chosen_depths(alone)
    assert set(depth[0]) == {4, 5} and missed(depth)[0] <= 1e-4 < missed(depth + (np.arange(jj.TREES) == 0))[0] * 1.5
    assert jj.chosen_depths(alone, recall=0.5).min() == 6 and jj.chosen_depths(alone, recall=0.999999).min() == 3
    crowded = alone.copy()
    crowded[0, :5] = [10_000, 9_000, 8_000, 100]
    depth = jj.chosen_depths(crowded)
    assert (depth[0, :5] == 6).all() and (depth[0, 5:] <= 5).all() and (depth[0, 5:] <= 4).any() and missed(depth)[0] <= 1e-4
    crowded[:] = [10_000, 9_000, 8_000, 7_000]
    assert missed(jj.chosen_depths(crowded))[0] <= 1e-4
    # Whether a few partners are there changes nothing.
    few = alone.copy()
    few[0, ::2] = [5, 4, 3, 2]
    assert np.array_equal(jj.chosen_depths(few), jj.chosen_depths(alone))


@pytest.mark.parametrize("rows_in_a_range", [400_000, 50])
def test_sorted_tries_have_the_nodes_of_all_prefixes(spark, monkeypatch, rows_in_a_range):
    monkeypatch.setattr(jj, "_TRIE_ROWS", rows_in_a_range)
    rng = np.random.default_rng(5)
    data = [(k, rng.integers(0, 3, jj.TREES * jj.DEPTH).astype("<u4").tobytes()) for k in range(120)]
    trie, nodes = jj.forest_nodes(spark.createDataFrame(data, "id long, signature binary"), len(data))
    counts, labels = {}, {}
    for k, s in data:
        for t in range(jj.TREES):
            labels[k, t] = s[24 * t : 24 * t + 24]
            for d in range(jj.LEAST, jj.DEPTH + 1):
                counts[t, labels[k, t][: 4 * d]] = counts.get((t, labels[k, t][: 4 * d]), 0) + 1
    got = {(r.id, r.tree): (bytes(r.label), r.s3, r.s4, r.s5, r.s6) for r in trie.df.collect()}
    want = {(k, t): (x, *(counts[t, x[: 4 * d]] for d in range(3, 7))) for (k, t), x in labels.items() if counts[t, x[:12]] > 1}
    assert got == want
    assert nodes.df.count() > 0


def test_query_equals_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert read(jj.op3_jaccard_join(spark, sf)) == brute(rows)


@pytest.mark.parametrize("blocks", [(4096, 512), (3, 4)])
def test_families(spark, small, monkeypatch, blocks):
    monkeypatch.setattr(jj, "NODE_BLOCK", blocks[0])
    monkeypatch.setattr(jj, "FAMILY_BLOCK", blocks[1])
    if blocks[0] == 3:
        monkeypatch.setattr("newsloom.llm._common.BROADCAST_BYTES", -1)
    rows = families(8, 12, 14)
    want = brute(rows)
    assert read(jj.near_classes(small(rows))) == want
    assert sum(r[4] for r in want) > 60


def test_leaders_tear_nothing_apart():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 256, 120).astype(np.uint8)
    rows = [base]
    for _ in range(60):  # a chain: each is near the one before, and far from the first
        new = rows[-1].copy()
        new[rng.choice(120, 20, replace=False)] = rng.integers(0, 256, 20)
        rows.append(new)
    other = rng.integers(0, 256, (40, 120)).astype(np.uint8)
    sketches = np.concatenate([np.array(rows), other])
    a, b = jj.node_links(np.arange(len(sketches)), sketches, None)
    assert len(a) == 60 and {*a, *b} == set(range(61))


def test_odd_repeated_null(spark, small, odd_texts):
    rows = [(i, t) for i, t in enumerate(odd_texts)]
    assert read(jj.near_classes(small(rows))) == brute(rows)
    text = " ".join(map(str, range(40)))
    got = jj.near_classes(small([(None, text), (1, text), (1, text + " x"), (2, None), (2, None)])).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.copies, r.n_links, r.n_near) for r in got) == [(False, 1, 1, 1, 2), (False, 1, 2, 1, 1), (False, 2, 1, 0, 0), (False, 2, 1, 0, 0), (True, None, 2, 1, 1)]
    assert jj.near_classes(small([])).count() == 0


def test_components(spark):
    rng = random.Random(3)
    links = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 130)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(7, 7)]
    got = {r.node: r.root for r in _components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        lo, hi = sorted((find(a), find(b)))
        root[hi] = lo
    want = {x: find(x) for x in root if find(x) != x}
    assert got == want


def test_bands_lose_no_pair(spark, small, monkeypatch):
    """A large family of sets of many sizes, of which only some bands meet."""
    monkeypatch.setattr(jj, "FAMILY_BLOCK", 6)
    monkeypatch.setattr("newsloom.llm._common.BROADCAST_BYTES", -1)
    words = [f"w{k}" for k in range(400)]
    rows = [(k, " ".join(words[: 40 + 9 * k])) for k in range(40)]
    want = brute(rows)
    assert read(jj.near_classes(small(rows))) == want and len({r[3] for r in want}) == 1


def test_names_that_clash_and_long_texts(spark, small):
    text = " ".join(f"w{k}" for k in range(1_400_000))  # over 10 MB
    rows = [(1, text), (2, text + " more"), (3, "other"), (-(2**63), None)]
    docs = small(rows).selectExpr("*", *(f"{k} AS `{n}`" for k, n in enumerate(("_gone", "_number", "_all", "id", "_n", "_hit", "held"))))
    assert read(jj.near_classes(docs)) == brute(rows)
    got = jj.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id, r._gone, r.held) for r in got.collect()) == [(-(2**63), 0, 6), (1, 0, 6), (3, 0, 6)]
