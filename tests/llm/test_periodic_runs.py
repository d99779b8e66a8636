import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from newsloom.llm import periodic_runs as pr

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(seq, least=24, times=3):
    """Every stretch that keeps a period, by trying all periods."""
    out = {}
    for p in range(1, len(seq) // times + 1):
        i = 0
        while i + p < len(seq):
            if seq[i] != seq[i + p]:
                i += 1
                continue
            j = i
            while j + p < len(seq) and seq[j] == seq[j + p]:
                j += 1
            if j + p - i >= max(least, times * p):
                out.setdefault((i, j + p), p)
            i = j + 1
    return sorted((s, e - s, p) for (s, e), p in out.items())


def brute(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute_runs(words)
    gone = {k for s, m, p in found for k in range(s + p, s + m)}
    best = (None,) * 4
    for s, m, p in found:
        if best[0] is None or m * best[2] > best[1] * p:
            best = (s, m, p, 1000 * m // p)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(found), *best, sha("".join(f"{s},{m},{p}\n" for s, m, p in found)), sha(" ".join(w for k, w in enumerate(words) if k not in gone)))


def sequence(rng, n, kinds):
    seq = []
    while len(seq) < n:
        if seq and rng.random() < 0.5:
            b = rng.randrange(len(seq))
            seq += seq[b : b + rng.randint(1, 12)] * rng.randint(1, 4)
        else:
            seq.append(rng.randrange(kinds))
    return seq


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_random_sequences(seed):
    rng = random.Random(seed)
    for _ in range(700):
        seq = sequence(rng, rng.randint(0, 90), rng.choice([1, 2, 2, 3, 4]))
        times, least = rng.choice([2, 3, 3, 4]), rng.choice([1, 4, 6, 24])
        want = brute_runs(seq, least, times)
        assert pr.runs(seq, least, times) == want
        if pr.gram_size(least, times) > 1:
            hashed = np.array(seq, np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(7)
            assert sorted((b + s, m, p) for b, e in pr.repetitive(hashed, least, times) for s, m, p in pr.runs(seq[b:e], least, times)) == want


def test_factors_are_the_longest_that_begin_earlier():
    rng = random.Random(9)
    for _ in range(200):
        seq = sequence(rng, rng.randint(1, 40), 3)
        at = 0
        for start, end, earlier in pr.factorise(seq):
            sizes = [next(k for k in range(len(seq) - at + 1) if at + k == len(seq) or seq[b + k] != seq[at + k]) for b in range(at)]
            assert start == at and end - start == max([1, *sizes])
            assert earlier == -1 if not any(sizes) else 0 <= earlier < start and seq[earlier : earlier + end - start] == seq[start:end]
            at = end
        assert at == len(seq)


def test_query_equals_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = pr.op13_periodic_runs(spark, sf)
    assert got.columns == "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    got = sorted(tuple(r) for r in got.collect())
    assert got == sorted(brute(i, t) for i, t in rows)
    assert sum(r[1] > 0 for r in got) > 5


def test_odd_texts_and_repeated_rows(spark, small, odd_texts):
    rng = random.Random(3)
    rows = [(k % 11, t) for k, t in enumerate(odd_texts * 2)] + [(100 + k, " \n".join(f"w{x}" for x in sequence(rng, 200, 3))) for k in range(60)] + [(None, "x y " * 40), (7, None)]
    docs = small(rows).selectExpr("*", "1 AS id", "2 AS runs", "3 AS collapsed", "4 AS _h", "5 AS _words")
    read = lambda df: sorted(((r[0], r[1], [tuple(x) for x in r[2]], r[3]) for r in df.collect()), key=repr)
    want = []
    for i, t in rows:
        words = WORD.findall(t or "")
        found = brute_runs(words)
        gone = {k for s, m, p in found for k in range(s + p, s + m)}
        want.append((i, len(words), found, " ".join(w for k, w in enumerate(words) if k not in gone)))
    assert read(pr.collapse_runs(docs)) == sorted(want, key=repr)
    changed = pr.with_periods(docs)
    assert changed.columns == docs.columns
    assert pr.collapse_runs(small([])).collect() == []


def test_long_periodic_text(spark, small):
    """A passage of 20,000 words, three and a half times over; one word 300,000 times."""
    rng = random.Random(5)
    passage = [f"w{rng.randrange(4000)}" for _ in range(20_000)]
    rows = [(1, " ".join(passage * 3 + passage[:10_000])), (2, "word " * 300_000)]
    got = {r.doc_id: r for r in pr.collapse_runs(small(rows)).collect()}
    assert [tuple(x) for x in got[1].runs] == [(0, 70_000, 20_000)] and got[1].collapsed == " ".join(passage)
    assert [tuple(x) for x in got[2].runs] == [(0, 300_000, 1)] and got[2].collapsed == "word"
