"""Word-level BPE by speculation and verification.

Greedy longest match proposes the tokens of each new word. A chain of tokens is what the merges would give exactly if
each token merges to itself and each adjacent pair is compatible: undoing the two tokens' merges from the last one
back, no pair that ever stood at their border had a merge that would have come first. That test runs over all new
pairs of a batch at once, in numpy; only words with a pair or a token that fails are merged exactly.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import documents, keep, prepare, task

#: Distinct words a worker remembers in each of two generations; longer ones are not remembered.
CACHE_WORDS, CACHE_CHARS = 400_000, 64
NONE = np.int64(1) << 40
#: The rank of a pair without a merge, and the most symbols that are merged without a heap.
_NEVER, SHORT = 1 << 40, 24

# Fixed value: white space as the vocabulary's own pattern means it.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPLIT = regex.compile(f"[{SPACE}]+")
_PRINTED = regex.compile("[!-~]+")  # bytes that stand for themselves
_CONTROLS = "\x1c\x1d\x1e\x1f"


def byte_letters() -> list[str]:
    """A visible letter for each byte: itself where it prints in Latin-1, else the next from U+0100 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(rest)) for b in range(256)]


class WordCodec:
    """The words' codes of a vocabulary file with word ends, after its own normalisation."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*self.ids.values(), *self.special.values()]) + 1
        self.text = [""] * size
        for t, i in [*self.ids.items(), *self.special.items()]:
            self.text[i] = t
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"[^\s", f"[^{SPACE}")
        self._pieces = regex.compile(pattern)
        self._marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self._letters = byte_letters()
        self.left, self.right, self.rank = (np.full(size, -1, np.int64) for _ in range(3))
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        twofold = set()
        for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            x, y, z = self.ids[a], self.ids[b], self.ids[a + b]
            self.merges[x, y] = rank, z
            if self.rank[z] >= 0:
                twofold.add(z)
            else:
                self.left[z], self.right[z], self.rank[z] = x, y, rank
        keys = np.array([(x << 32) | y for x, y in self.merges], np.int64)
        order = np.argsort(keys)
        self._keys = np.append(keys[order], np.iinfo(np.int64).max)
        self._ranks = np.append(np.array([r for r, _ in self.merges.values()], np.int64)[order], NONE)
        self.longest = max(map(len, self.ids))
        # Whether a token's text merges to the token: its halves must, and nothing may cross their border before.
        self.whole = np.ones(size, bool)
        made = np.flatnonzero(self.rank >= 0)
        self.whole[made] = self.compatible(self.left[made], self.right[made], self.rank[made])
        self.whole[list(twofold)] = False
        for z in made[np.argsort(self.rank[made])].tolist():
            self.whole[z] &= self.whole[self.left[z]] and self.whole[self.right[z]]
        self._young: dict[str, tuple[int, str, str]] = {}
        self._old: dict[str, tuple[int, str, str]] = {}
        self.failed = 0

    def _pair_ranks(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        key = (x << 32) | y
        at = np.searchsorted(self._keys, key)
        return np.where(self._keys[at] == key, self._ranks[at], NONE)

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether the border between each a and b stands, up to merges of rank `limit` (default: all)."""
        ok = np.ones(len(a), bool)
        at, x, y = np.arange(len(a)), a.copy(), b.copy()
        limit = np.full(len(a), NONE) if limit is None else limit.copy()
        while len(at):
            bad = self._pair_ranks(x, y) < limit
            ok[at[bad]] = False
            later_x, later_y = self.rank[x], self.rank[y]
            go = ~bad & ((later_x >= 0) | (later_y >= 0))
            at, x, y, later_x, later_y = (v[go] for v in (at, x, y, later_x, later_y))
            # The half that was made last is undone; of one merge, the right-hand use comes later.
            undo_x = later_x > later_y
            limit = np.where(undo_x, later_x, later_y + 1)
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
        return ok

    def propose(self, chain: str) -> list[int] | None:
        """The longest vocabulary entry at each place in turn; the word end goes with the last letter."""
        get, end, out, i, n, most = self.ids.get, self.end, [], 0, len(chain), self.longest
        while i < n:
            e = i + most
            if e >= n:
                if (found := get(chain[i:] + end)) is not None:
                    out.append(found)
                    break
                e = n - 1
            while e > i:
                if (found := get(chain[i:e])) is not None:
                    out.append(found)
                    i = e
                    break
                e -= 1
            else:
                return None
        return out

    def merge(self, chain: str, end: str | None = None) -> list[int]:
        """The merges one by one, lowest rank first and leftmost of equals; n log n."""
        symbols = [*chain[:-1], chain[-1] + (self.end if end is None else end)]
        ids = [self.ids[s] for s in symbols if s in self.ids]
        if len(ids) <= SHORT:
            return self._merge_short(ids)
        n, merges = len(ids), self.merges
        after, before, gone = list(range(1, n + 1)), list(range(-1, n - 1)), [False] * n
        heap = [(found[0], i, ids[i], ids[i + 1], found[1]) for i in range(n - 1) if (found := merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, z = heapq.heappop(heap)
            j = after[i]
            if gone[i] or ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], gone[j], after[i] = z, True, after[j]
            if after[i] < n:
                before[after[i]] = i
                if found := merges.get((z, ids[after[i]])):
                    heapq.heappush(heap, (found[0], i, z, ids[after[i]], found[1]))
            if before[i] >= 0 and (found := merges.get((ids[before[i]], z))):
                heapq.heappush(heap, (found[0], before[i], ids[before[i]], z, found[1]))
        return [x for x, out in zip(ids, gone) if not out]

    def _merge_short(self, ids: list[int]) -> list[int]:
        """The same for few symbols, where looking over all ranks costs less than a heap; changes ids."""
        get, none = self.merges.get, (_NEVER, 0)
        found = [get(pair, none) for pair in zip(ids, ids[1:])]
        while found:
            best = min(found)  # equal ranks are equal pairs: the first is the leftmost
            if best is none:
                break
            i = found.index(best)
            ids[i] = best[1]
            del ids[i + 1], found[i]
            if i < len(found):
                found[i] = get((ids[i], ids[i + 1]), none)
            if i:
                found[i - 1] = get((ids[i - 1], ids[i]), none)
        return ids

    def chains(self, word: str) -> Iterator[str | int]:
        """The pieces of a word as byte letters; special tokens as their ids."""
        if word.isascii() and word.isalpha():
            yield word.lower()
            return
        for part in self._marks.split(word) if "<|" in word else (word,):
            if part in self.special:
                yield self.special[part]
                continue
            part = unicodedata.normalize("NFC", part)
            part = "".join(c.lower() for c in part) if "Σ" in part else part.lower()
            for piece in self._pieces.findall(part):
                yield piece if _PRINTED.fullmatch(piece) else "".join([self._letters[b] for b in piece.encode()])

    def learn(self, words: list[str]) -> dict[str, tuple[int, str, str]]:
        """Each word's number of tokens, ids and tokens as text."""
        chains = [(k, chain) for k, word in enumerate(words) for chain in self.chains(word)]
        tokens = [[c] if isinstance(c, int) else self.propose(c) for _, c in chains]
        size = np.array([len(t or ()) for t in tokens], np.int64)
        flat = np.array([x for t in tokens for x in t or ()], np.int64)
        own = np.repeat(np.arange(len(tokens)), size)
        good = np.array([t is not None for t in tokens], bool)
        good[own[~self.whole[flat]]] = False
        border = np.flatnonzero(own[1:] == own[:-1])
        pairs, back = np.unique((flat[border] << 32) | flat[border + 1], return_inverse=True)
        fits = self.compatible(pairs >> 32, pairs & 0xFFFFFFFF)
        good[own[border[~fits[back]]]] = False
        for c in np.flatnonzero(~good).tolist():
            self.failed += 1
            tokens[c] = self.merge(chains[c][1])
        by_word: list[list[int]] = [[] for _ in words]
        for (k, _), t in zip(chains, tokens):
            by_word[k] += t
        text = self.text
        return {w: (len(t), " ".join(map(str, t)), " ".join([text[x] for x in t])) for w, t in zip(words, by_word)}

    def code(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """Of each text: the number of tokens, the ids and the decoded tokens, each joined by one space."""
        split = [(_SPLIT.split(t) if any(c in t for c in _CONTROLS) else t.split()) for t in texts]
        young, found = self._young, {}
        new = set().union(*split).difference(young)
        for word in [w for w in new if w in self._old]:
            young[word] = self._old[word]
            new.discard(word)
        for word, value in self.learn(list(new)).items():
            (young if len(word) <= CACHE_CHARS else found)[word] = value
        for words in split:
            got = list(map(young.get, words))
            if None in got:
                got = [g or found[w] for g, w in zip(got, words)]
            n, ids, tokens = zip(*got) if got else ((), (), ())
            if 0 in n:  # words of which nothing is left
                n, ids, tokens = zip(*kept) if (kept := [g for g in got if g[0]]) else ((), (), ())
            if n:
                yield sum(n), " ".join(ids), " ".join(tokens)
            else:
                yield 0, "", ""
        if len(young) > CACHE_WORDS:
            self._old, self._young = young, {}


def codec(path: str) -> WordCodec:
    """The worker's codec for a vocabulary file; it outlives a task, but not the operator's turn."""
    return keep(f"words {path}", lambda: WordCodec(path))


_CODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _code(batches: Iterator[pa.RecordBatch], tokenizer: str) -> Iterator[pa.RecordBatch]:
    tool = codec(tokenizer)
    for batch in batches:
        for b in range(0, batch.num_rows, 100):
            part = batch.slice(b, 100)
            out = [(n, hashlib.sha256(i.encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for n, i, t in tool.code([t or "" for t in part.column(1).to_pylist()])]
            n, ids, decoded = zip(*out)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(decoded)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def code_digests(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and decodes every whole text: its number of tokens and digests of ids and decoded text.

    A null text counts as empty and has no tokens. Null and repeated ids keep a row each; other columns are ignored,
    whatever their names; texts may have any length; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("i"), F.col(f"`{text_col}`").cast("string").alias("t"))
    return rows.mapInArrow(task("codec", lambda x: _code(x, tokenizer)), _CODED)


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return code_digests(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
