import hashlib
import random

import numpy as np
import xxhash

from newsloom.llm import fingerprints as fp


M64 = 2**64 - 1


def mixed(h):
    for _ in range(2):
        h = (h ^ (h >> 32)) * 0xD6E8FEB86659FD93 & M64
    return h ^ (h >> 32)


def brute_print(text):
    """Order MinHash as the paper tells it, one k-mer and one order at a time, in plain Python."""
    codes = [ord(c) for c in text]
    k = min(fp.K, len(codes))
    seen, kmers = {}, []
    for i in range(len(codes) - k + 1 if k else 0):
        kmer = tuple(codes[i : i + k])
        h = 0
        for c in kmer:
            h = (h * int(fp._BASE) + c + 1) & M64
        kmers.append(mixed((mixed(h) + seen.get(kmer, 0) * int(fp._STEP)) & M64))
        seen[kmer] = seen.get(kmer, 0) + 1
    out = b""
    for seed, odd in zip(fp._SEEDS[:, 0].tolist(), fp._ODD[:, 0].tolist()):
        chosen = sorted(range(len(kmers)), key=lambda i: (kmers[i] ^ seed) * odd & M64)[: fp.LENGTH]
        own = [kmers[i] for i in sorted(chosen)]
        own = [0] * (fp.LENGTH - len(own)) + own  # a text of fewer k-mers has none in the places before
        h = 0
        for x in own:
            h = mixed((h * int(fp._TUPLE) + x) & M64)
        out += (h >> 32).to_bytes(4, "big")
    return out


def places(text):
    own = brute_print(text)
    return [own[4 * k : 4 * k + 4] for k in range(fp.HASHES)]


def brute(rows):
    name = lambda t: 42 if t is None else xxhash.xxh64_intdigest(t.encode(), 42)
    signed = lambda h: h - 2**64 if h >= 2**63 else h
    order = sorted(rows, key=lambda r: (-(fp._LOW if r[0] is None else r[0]), signed(name(r[1]))))
    out = []
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        third = len(text) // 3
        other = text[: len(text) - third] + after[:third]
        a, b, c = map(places, (text, other, after))
        like = lambda x, y: sum(p == q for p, q in zip(x, y)) / fp.HASHES
        out.append((i, len(text), hashlib.sha256(other.encode()).hexdigest(), b"".join(a).hex(), b"".join(b).hex(), like(a, b), like(a, c)))
    return sorted(out, key=str)


def test_numbers_follow_the_text():
    text = "abcabcabcabcabcabc" * 3 + "xyz"
    codes = fp._codes(text)
    found = fp.numbered(codes)
    again = fp.numbered(codes[:40])
    assert len(set(found.tolist())) == len(found)
    assert np.array_equal(found[: len(again)], again)
    assert fp.fingerprint(text).tobytes() == brute_print(text)


def test_smallest_equals_sorting(monkeypatch):
    monkeypatch.setattr(fp, "_CHUNK", 7)
    h = np.random.default_rng(1).integers(0, 2**63, 50, np.uint64)
    values, places, hashes = fp.smallest(h)
    v = (h[None, :] ^ fp._SEEDS) * fp._ODD
    assert np.array_equal(places, np.argsort(v, axis=1)[:, : fp.LENGTH])
    assert np.array_equal(hashes, h[places])


def test_order_matters_and_edits_show():
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(300)]
    text = " ".join(words)
    near = lambda a, b: float((fp.fingerprint(a) == fp.fingerprint(b)).mean())
    assert near(text, text) == 1
    small = " ".join(words[:150] + ["zzz"] + words[151:])
    turned = " ".join(words[150:] + words[:150])
    assert near(text, small) > 0.85
    assert near(text, turned) < near(text, small) - 0.2
    assert near(text, " ".join("".join(rng.choice("klmnopq") for _ in range(6)) for _ in range(300))) == 0
    assert near("", "") == 1 and near("ab", "ab") == 1 and near("ab", "ba") == 0


def read(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark, sf):
    """The order of all rows, and every fingerprint of texts that plain Python gets through."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    short = [(i, t[:400]) for i, t in rows]
    docs = spark.createDataFrame(short, "doc_id long, text string")
    assert read(fp.fingerprint_chain(docs)) == brute(short)
    got = {r.doc_id: r for r in fp.op8_order_minhash(spark, sf).collect()}
    order = sorted(rows, reverse=True)
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        a, b, c = fp.fingerprint(text), fp.fingerprint(fp.edited(text, after)), fp.fingerprint(after)
        r = got[i]
        assert (r.n_chars, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) == (len(text), a.tobytes().hex(), b.tobytes().hex(), float((a == b).mean()), float((a == c).mean()))
        assert r.edited_sha256 == hashlib.sha256(fp.edited(text, after).encode()).hexdigest()


def test_many_parts_and_odd_rows(spark, small, odd_texts, monkeypatch):
    monkeypatch.setattr(fp, "parts_for", lambda *a: 5)
    rows = [(3 * i, t if t is None else t[:2000]) for i, t in enumerate(odd_texts)] + [(6, "tie"), (None, "none"), (48, "top tie"), (9, "same"), (9, "same"), (9, "same")]
    assert read(fp.fingerprint_chain(small(rows))) == brute(rows)


def test_one_row_and_none(spark, small):
    rows = [(4, "an only document here")]
    assert read(fp.fingerprint_chain(small(rows))) == brute(rows)
    assert fp.fingerprint_chain(small([])).count() == 0


def test_one_id_in_many_ranges_and_names_that_clash(spark, small, monkeypatch):
    monkeypatch.setattr(fp, "parts_for", lambda *a: 6)
    rows = [(7, f"text number {k} of many") for k in range(60)] + [(1, "one"), (-(2**63), "least")]
    docs = small(rows).selectExpr("*", *(f"{k} AS `{n}`" for k, n in enumerate(("i", "t", "h", "row", "part", "kind", "own_id"))))
    assert read(fp.fingerprint_chain(docs)) == brute(rows)
