import hashlib
import random
import re

import duckdb
import pytest

from newsloom.llm import substrings as sub


def brute(rows):
    """rows: (id, text) in order of coordinates."""
    seen, out = set(), []
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(words)
        for s in range(len(words) - sub.WINDOW + 1):
            w = tuple(words[s : s + sub.WINDOW])
            if w in seen:
                gone[s : s + sub.WINDOW] = [True] * sub.WINDOW
            seen.add(w)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((i, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def read(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark, sf):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    got = sorted((tuple(r) for r in sub.op10_substring_dedup(spark, sf).collect()), key=str)
    assert got == brute(rows)
    assert sum(r[2] for r in got) > 1000
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert sorted(db.sql(f"SELECT doc_id, n_words, n_removed, kept_sha256 FROM ({sub.OP10_SQL})").fetchall()) == sorted(got)


@pytest.mark.parametrize("broadcast, bits", [(True, 64), (False, 64), (True, 3)])
def test_random_passages(spark, small, monkeypatch, broadcast, bits):
    """Also without broadcasts, and where most names of edges collide."""
    if not broadcast:
        monkeypatch.setattr("newsloom.llm._common.BROADCAST_BYTES", -1)
    monkeypatch.setattr(sub, "NAME_BITS", bits)
    if bits < 64:
        monkeypatch.setattr(sub, "LONG", 0)
    rng = random.Random(4)
    word = lambda: rng.choice("abcdefgh")
    passages = [[word() for _ in range(rng.randint(15, 60))] for _ in range(12)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randint(0, 6)):
            p = rng.choice(passages)
            b = rng.randint(0, 10)
            words += p[b:] if rng.random() < 0.5 else [word() for _ in range(rng.randint(1, 30))]
            if rng.random() < 0.2:
                words += [word()] * rng.randint(10, 50)
        rows.append((1000 - i * 7, rng.choice([" ", "\n", "\t "]).join(words)))
    assert read(sub.cut_repeats(small(rows))) == brute(sorted(rows))


def test_odd_rows(spark, small, odd_texts):
    rows = [(i, t) for i, t in enumerate(odd_texts)] + [(100, "word " * 25), (101, "é " * 40), (102, " ".join(map(str, range(30)))), (103, "\n".join(map(str, range(5, 40))))]
    assert read(sub.cut_repeats(small(rows))) == brute(rows)


def test_repeated_and_null_ids_and_no_rows(spark, small):
    text = " ".join(map(str, range(30)))
    rows = [(None, text), (1, None), (1, "x " + text), (1, text), (1, text), (2, text + " y")]
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert read(sub.cut_repeats(small(rows))) == brute(order)
    assert sub.cut_repeats(small([])).count() == 0


def test_paths_compact(spark, small, monkeypatch):
    """A long passage that always stands whole is one path, however many edges it has."""
    from newsloom.llm import _common

    held = {}
    staged = _common.Staged.__init__

    def spy(self, df, name, by=()):
        staged(self, df, name, by)
        if name in ("paths", "members"):
            held[name] = self.df.count()
            held["longest"] = self.df.agg({"windows": "max"}).first()[0] if name == "paths" else None

    monkeypatch.setattr(_common.Staged, "__init__", spy)
    passage = " ".join(f"w{k}" for k in range(700))
    rows = [(i, f"a{i} " + passage + f" b{i}") for i in range(5)]
    assert read(sub.cut_repeats(small(rows))) == brute(rows)
    assert held["members"] > 50 and held["paths"] <= 3 and held["longest"] > 600  # edges at its ends depend on what is beside it


def test_long_texts_and_words(spark, small):
    long = " ".join(f"w{k % 400_000}" for k in range(1_300_000))  # over 10 MB
    word = "x" * 3_000_000
    rows = [(1, long), (2, f"{word} a " + " ".join(map(str, range(30)))), (3, f"{word} a " + " ".join(map(str, range(25)))), (4, "y" + word)]
    assert read(sub.cut_repeats(small(rows))) == brute(rows)


def test_names_that_clash(spark, small):
    text = " ".join(map(str, range(30)))
    rows = [(1, text), (2, text + " y"), (3, None), (-(2**63), "a")]
    for more in ([], [(1, text)]):
        docs = small(rows + more).selectExpr("*", *(f"{k} AS `{n}`" for k, n in enumerate(("_n", "_text", "_ranges", "text_", "ranges", "own", "_all", "asked", "_listed"))))
        got = sub.cut_documents(docs)
        assert got.columns == docs.columns
        assert all((r._n, r._listed) == (0, 8) for r in got.collect())
        stays = sorted((r.doc_id, r.text) for r in got.collect() if r.text)
        assert stays == [(-(2**63), "a"), (1, text), (2, "y")]
        assert read(sub.cut_repeats(docs)) == brute(sorted(rows + more, key=lambda r: r[0]))
