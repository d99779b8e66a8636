import corpus_pipeline as cp

from test_exact_dedup import brute as exact_brute
from test_jaccard_join import brute as near_brute
from test_packing import holds
from test_substrings import brute as span_brute

import re


def cut(rows):
    """Brute force of the substring stage: (id, text) of what stays."""
    from newsloom.llm.substrings import WINDOW

    seen, out = set(), []
    for i, text in sorted(rows):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(words)
        for s in range(len(words) - WINDOW + 1):
            w = tuple(words[s : s + WINDOW])
            if w in seen:
                gone[s : s + WINDOW] = [True] * WINDOW
            seen.add(w)
        if not any(gone):
            out.append((i, text))
        elif not all(gone):
            out.append((i, " ".join(w for w, g in zip(words, gone) if not g)))
    return out


def test_stages_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    read = lambda df: [(r.doc_id, r.text) for r in df.collect()]
    rows = read(docs)
    for name, stage in cp.STAGES:
        after = stage(spark, docs, sf)
        if name == "best_fit_packing":
            assert holds(after.collect(), rows) > 0
            break
        assert after.columns == columns
        path = cp.Staged(after, "t").df
        got = sorted(read(path))
        if name == "language_id":
            assert set(got) <= set(rows) and len(got) == len(rows)
        elif name == "exact_dedup":
            assert [i for i, _ in got] == sorted(r[0] for r in exact_brute(rows) if r[3])
        elif name == "jaccard_join":
            assert [i for i, _ in got] == sorted(r[0] for r in near_brute(rows) if r[3] == r[0])
        else:
            assert got == sorted(cut(rows))
            assert all(r.n_chars == len(r.text) for r in path.collect())
            assert span_brute(sorted(rows))
        docs, rows = path, got


def test_odd_rows(spark, small, odd_texts, sf):
    """Nulls, ties, repeated rows and ids, and extra columns with names that the operators use themselves."""
    long = " ".join(f"word{k}" for k in range(60))
    rows = [(i, t) for i, t in enumerate(odd_texts)] + [(None, "some more words here"), (3, "a"), (3, "a"), (50, long), (51, long + " end"), (52, "start " + long), (None, None)]
    names = ("_row", "_gone", "_n", "_number", "_hit", "own", "id", "label", "ranges", "_h")
    docs = small(rows, lang="en").selectExpr("*", *(f"{k} AS `{n}`" for k, n in enumerate(names)))
    columns = docs.columns
    lettered = [(i, t) for i, t in rows if t and any(c.isalpha() for c in t)]
    for name, stage in cp.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        after = stage(spark, docs, sf)
        if name == "best_fit_packing":
            pieces = after.collect()
            assert sorted((r.doc_id for r in pieces if r.piece == 0), key=str) == sorted((i for i, _ in before), key=str)
            break
        assert after.columns == columns, name
        docs = cp.Staged(after, "t").df
        got = sorted(((r.doc_id, r.text) for r in docs.collect()), key=str)
        assert all(tuple(r[n] for n in names) == tuple(range(len(names))) for r in docs.collect()), name
        if name == "language_id":
            assert got == sorted(lettered, key=str)
        elif name == "exact_dedup":
            assert got == sorted(((k, dict(enumerate(t for _, t in before)).get(n)) for n, (k, *_) in enumerate(before) if (n, k) in kept(before)), key=str)
        elif name == "jaccard_join":
            assert {i for i, _ in before} - {i for i, _ in got} == {51, 52}
        else:
            assert sorted(((i, t) for i, t in got), key=str) == got and len(got) <= len(before)


def kept(rows):
    """(place, id) of the rows that exact dedup keeps."""
    best = {}
    for n, (i, t) in enumerate(rows):
        key = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        rank = (-len(t or ""), i is None, i or 0, n)
        if key not in best or rank < best[key][0]:
            best[key] = rank, (n, i)
    return {x for _, x in best.values()}


def test_no_rows(spark, small, sf):
    docs = small([])
    for name, stage in cp.STAGES:
        docs = cp.Staged(stage(spark, docs, sf), "t").df
        assert docs.count() == 0, name
