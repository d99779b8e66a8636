import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from newsloom.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tool():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def mine():
    return bpe.WordCodec(PATH)


def same(tool, mine, texts):
    for text, (n, ids, decoded) in zip(texts, mine.code(texts)):
        want = tool.encode(text, add_special_tokens=False).ids
        assert ids == " ".join(map(str, want)), text
        assert n == len(want)
        assert decoded == tool.decode(want, skip_special_tokens=False), text


def test_odd_texts(tool, mine, odd_texts):
    same(tool, mine, [t or "" for t in odd_texts] + ["a<|endoftext|>b <|startoftext|> c", "it's they'll DON'T", "é ä", "x" * 300, "ab" * 500])


def test_random_words(tool, mine):
    rng = random.Random(5)
    letters = "etaoinshrdlu" * 3 + "cmfwypvbgkjqxzéèüßñ.,'!-0123"
    before = mine.failed
    same(tool, mine, [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 14))) for _ in range(60)) for _ in range(60)])
    assert mine.failed > before  # speculation fails at times, and the exact way takes over


def test_vocabulary_words_need_no_merging(mine):
    words = [t.removesuffix("</w>") for t in list(mine.ids)[1000:4000] if t.endswith("</w>") and t.removesuffix("</w>").isalpha() and t.isascii()]
    before = mine.failed
    mine.learn(words)
    assert mine.failed - before < len(words) / 20


def test_compatibility_is_exact(mine):
    rng = np.random.default_rng(3)
    whole = np.flatnonzero(mine.whole & np.array([bool(t) and not t.endswith("</w>") and t not in mine.special for t in mine.text]))
    a, b = rng.choice(whole, 3000), rng.choice(whole, 3000)
    for x, y, ok in zip(a.tolist(), b.tolist(), mine.compatible(a, b).tolist()):
        assert ok == (mine.merge(mine.text[x] + mine.text[y], "") == [x, y])


def test_query_equals_library(spark, sf, tool):
    got = {r.doc_id: r for r in bpe.op6_bpe_codec(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = tool.encode(r.text, add_special_tokens=False).ids
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(tool.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_null_empty_repeated(spark, small):
    got = sorted((r.doc_id is None, r.doc_id, r.n_tokens) for r in bpe.code_digests(small([(1, None), (1, ""), (2, "a"), (None, "a"), (2, "a")]), PATH).collect())
    assert got == [(False, 1, 0), (False, 1, 0), (False, 2, 1), (False, 2, 1), (True, None, 1)]
    assert bpe.code_digests(small([]), PATH).count() == 0


def test_few_symbols_merge_as_many_do(monkeypatch):
    """Short chains are merged without a heap; equal pairs in a row show the order."""
    import random

    import public_tokenizers

    own, rng = bpe.codec(public_tokenizers.path("word_bpe_49k.json")), random.Random(5)
    chains = ["".join(rng.choice("aabeilnrst") for _ in range(rng.randint(1, 24))) for _ in range(400)] + ["a" * n for n in range(1, 25)]
    short = [own.merge(c) for c in chains]
    monkeypatch.setattr(bpe, "SHORT", 0)
    assert short == [own.merge(c) for c in chains] and any(len(s) > 3 for s in short)
