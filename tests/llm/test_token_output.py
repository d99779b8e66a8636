import struct
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from newsloom.llm import _tokens
from newsloom.llm.token_output import BLOCK, op1_token_files, pack_blocks, read_digests, unpack_blocks, write_tokens
from newsloom.llm._common import new_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


def brute(rows):
    tool, start, out = Tokenizer.from_file(PATH), 0, []
    for i, text in sorted(rows, key=lambda r: r[0]):
        ids = [*tool.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def read(df):
    return sorted(tuple(r) for r in df.collect())


def test_units_encode_as_whole_texts(odd_texts):
    tool, mine = Tokenizer.from_file(PATH), _tokens.UnitEncoder(PATH)
    for text in [*odd_texts, "one two\nthree  four\n", " lead", "\nlead", "trail ", "trail\n", "a \nb", "a\n b"]:
        assert np.frombuffer(mine.encode(text or ""), "<u4").tolist() == tool.encode(text or "", add_special_tokens=False).ids, text


def test_small_cache(monkeypatch):
    monkeypatch.setattr(_tokens, "CACHE_UNITS", 2)
    monkeypatch.setattr(_tokens, "CACHE_CHARS", 3)
    tool, mine = Tokenizer.from_file(PATH), _tokens.UnitEncoder(PATH)
    for text in ("a few words here", "here words few a", "longer words longer words", "few a few a"):
        assert np.frombuffer(mine.encode(text), "<u4").tolist() == tool.encode(text, add_special_tokens=False).ids


def test_blocks_round_trip():
    rng = np.random.default_rng(1)
    for n in (1, 63, 64, 65, BLOCK, BLOCK + 1, 5 * BLOCK + 77):
        for ids in (rng.integers(0, 50257, n), rng.integers(7, 8, n), np.where(rng.random(n) < 0.02, 2**32 - 1, rng.integers(5, 9, n))):
            blocks = pack_blocks(ids.astype(np.uint32))
            buf = np.frombuffer(b"".join(blocks), np.uint8)
            starts = np.cumsum([0, *map(len, blocks)])[:-1]
            assert np.array_equal(unpack_blocks(buf, starts), ids.astype(np.uint32))
            assert np.array_equal(unpack_blocks(buf, starts[-1:]), ids[(len(blocks) - 1) * BLOCK :].astype(np.uint32))


def test_query_equals_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert read(op1_token_files(spark, sf)) == brute(rows)


def test_odd_rows_and_many_files(spark, small, odd_texts, monkeypatch):
    monkeypatch.setattr("newsloom.llm.token_output.parts_for", lambda *a: 3)
    rows = [(7 * i % 101, t) for i, t in enumerate(odd_texts)]
    path = new_path(spark, "t")
    write_tokens(small(rows), path, PATH)
    assert read(read_digests(spark, path)) == brute(rows)


def test_null_and_repeated_ids_and_no_rows(spark, small):
    path = new_path(spark, "t")
    write_tokens(small([(None, "x"), (3, "x"), (3, "x")]), path, PATH)
    got = [(r.doc_id, r.start, r.n_tokens) for r in read_digests(spark, path).orderBy("start").collect()]
    assert got == [(None, 0, 2), (3, 2, 2), (3, 4, 2)]
    path = new_path(spark, "t")
    write_tokens(small([]), path, PATH)
    assert read_digests(spark, path).count() == 0
