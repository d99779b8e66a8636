"""Byte-level BPE by the tokenizers library, which encodes each distinct unit of text once while a worker remembers it."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ._common import keep

#: Distinct units a worker remembers in each of two generations, of about 200 bytes each.
CACHE_UNITS = 250_000
#: Longer units are encoded but not remembered.
CACHE_CHARS = 64
#: UTF-8 bytes of the texts that are split and looked up together, as columns; a longer text stands alone.
SLICE_BYTES = 4 << 20
#: Units of a slice that are looked up, or whose ids are put in their places, at a time.
STEP_UNITS = 1 << 15
#: New units that go to the library in one call.
CALL_UNITS = 2000

#: Characters of which every version of Unicode says that they are letters, and marks that are neither letter, digit nor space.
_LETTERS, _MARKS = "A-Za-zÀ-ÖØ-öø-ſЀ-ҁ", ".,;:!?#$%&*"
_PLAIN = re.compile(rf"\n?[{_LETTERS}]+")
#: Marks that are parted from a word at once.
TAIL = 3
_ODD_SPACE = re.compile(r"[^\S \n]|[\x1c-\x1f\x85]")


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Puts small batches together, as a unit is looked up once in each slice."""
    held = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= SLICE_BYTES // 2:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def encoder(path: str) -> "UnitEncoder":
    """The worker's encoder for a tokenizer file; it outlives a task, but not the operator's turn."""
    return keep(f"units {path}", lambda: UnitEncoder(path))


class UnitEncoder:
    """Encodes texts exactly as the library encodes them whole.

    The vocabulary's split pattern never joins a word to what stands after the next single space or line feed,
    so a text is the chain of its units: a word with the one space before it, or a line feed with the word after it.
    The library encodes each distinct unit; texts with runs of white space or other white space are encoded whole.
    The pattern parts a letter from a mark, so a unit's last marks are encoded and remembered apart from its word. A word
    of nothing but letters can't be parted further and goes straight to the library's model.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        vocabulary = self._tokenizer.get_vocab()
        #: Of each id, whether its token begins with the space or line feed that begins a unit.
        self._begins = np.zeros(max(vocabulary.values()) + 1, bool)
        self._begins[[i for t, i in vocabulary.items() if t[0] in "\u0120\u010a"]] = True
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._tails: dict[str, bytes] = {"": b""}
        #: Letters from which marks are parted, and how the model spells those beyond ASCII.
        self._letters: frozenset[str] = frozenset()
        self._spelling: dict[int, str] = {}
        self._learn_letters()
        self._line = self._library("\n").tobytes()

    def _learn_letters(self) -> None:
        """Takes letters apart from marks, and spells them, if the tokenizer does so, tried on all letters and marks."""
        tool = self._tokenizer
        added = "".join(t.content for t in tool.get_added_tokens_decoder().values() if re.fullmatch(rf"[\n{_LETTERS}{_MARKS}]*", t.content))
        if added or tool.normalizer is not None or tool.pre_tokenizer is None:
            return
        parts = lambda text: [p for p, _ in tool.pre_tokenizer.pre_tokenize_str(text)]
        letters = "".join(c for c in map(chr, range(0x482)) if re.match(f"[{_LETTERS}]", c))
        spelling = {ord(c): "".join(parts(c)) for c in letters if not c.isascii()}
        word = letters.translate(spelling)
        if all(parts(f"{letters}{m} {letters}{m}{_MARKS}\n{letters}") == [word, m, "\u0120" + word, m + _MARKS, "\u010a", word] for m in _MARKS):
            self._letters, self._spelling = frozenset(letters), spelling

    def _library(self, text: str) -> np.ndarray:
        return np.array(self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _units(self, units: list[str]) -> list[bytes | None]:
        """The ids of each unit, by one library call on the chain of them; None where its bounds can't be told."""
        ids = self._library("".join([u if u[0] == "\n" else " " + u for u in units]))
        starts = np.flatnonzero(self._begins[ids])
        if len(starts) != len(units):
            half = len(units) // 2
            return self._units(units[:half]) + self._units(units[half:]) if half else [None]
        raw, bounds = ids.tobytes(), [*(4 * starts).tolist(), 4 * len(ids)]
        return [raw[b:e] for b, e in zip(bounds, bounds[1:])]

    def _words(self, words: list[str]) -> list[bytes]:
        """The ids of words of letters, by the library's model."""
        tokenize = self._tokenizer.model.tokenize
        out = []
        for b in range(0, len(words), CALL_UNITS):
            some = words[b : b + CALL_UNITS]
            spelled = ["\u0120" + w if w.isascii() else "\u0120" + w.translate(self._spelling) for w in some]
            found = [[t.id for t in tokenize(w if w[1] != "\n" else w[2:])] for w in spelled]
            ends = np.cumsum([4 * len(ids) for ids in found]).tolist()
            raw = np.array([i for ids in found for i in ids], "<u4").tobytes()
            out += [raw[x:y] if w[0] != "\n" else self._line + raw[x:y] for w, x, y in zip(some, [0, *ends], ends)]
        return out

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        [(ids, _)] = self.encode_column(pa.array([text]), 0)
        return ids[:-1].tobytes()

    def encode_column(self, texts: pa.Array, end_id: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each slice of the column the ids of its texts, each with the end id behind it, and their bounds; null counts as empty."""
        texts = texts.fill_null("").cast(pa.large_string())
        upto = np.cumsum(pc.binary_length(texts).to_numpy())
        b = 0
        while b < len(texts):
            e = max(b + 1, int(np.searchsorted(upto, (upto[b - 1] if b else 0) + SLICE_BYTES, "right")))
            yield self._encode_slice(texts[b:e], end_id)
            b = e

    def _encode_slice(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        # A line feed before the first word makes it a unit like others; the id of that line feed gives its place to an end id below.
        line, nothing = pa.scalar("\n", texts.type), pa.scalar("", texts.type)
        split = pc.split_pattern(pc.binary_join_element_wise(line, pc.replace_substring(texts, "\n", " \n"), nothing), " ")
        coded, firsts = split.flatten().dictionary_encode(), split.offsets.to_numpy().astype(np.int64)
        del split
        which, units = coded.indices.to_numpy(), coded.dictionary
        del coded
        found = []
        for b in range(0, len(units), STEP_UNITS):
            found += self._look_up(units[b : b + STEP_UNITS].to_numpy(zero_copy_only=False).tolist())
        del units
        odd = np.array([ids is None for ids in found], bool)
        whole = np.flatnonzero(np.add.reduceat(odd[which], firsts[:-1])) if odd.any() else ()
        for k in whole:  # the library's ids stand in for all units of such a text
            found.append(b"\0\0\0\0" + self._library(texts[int(k)].as_py()).tobytes())
        sizes = np.array([len(ids) // 4 if ids else 0 for ids in found], np.int64)
        starts = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join([ids or b"" for ids in found]), "<u4")
        del found
        size, start = sizes[which], starts[which]
        for at, k in enumerate(whole, len(odd)):
            size[firsts[k] : firsts[k + 1]] = 0
            size[firsts[k]], start[firsts[k]] = sizes[at], starts[at]
        ends = np.append(0, np.cumsum(size))
        start -= ends[:-1]
        ids = np.empty(ends[-1] + 1, "<u4")
        for b in range(0, len(which), STEP_UNITS):
            e = min(b + STEP_UNITS, len(which))
            places = np.repeat(start[b:e], size[b:e])
            places += np.arange(ends[b], ends[e])
            ids[ends[b] : ends[e]] = flat[places]
        bounds = ends[firsts]
        ids[bounds] = end_id
        return ids[1:], bounds

    def _look_up(self, units: list[str]) -> list[bytes | None]:
        """The ids of distinct units; None for those whose texts must be encoded whole."""
        young, old, letters, tails = self._young, self._old, self._letters, self._tails
        found = list(map(young.get, units))
        parted, new = [], {}
        for k in [k for k, ids in enumerate(found) if ids is None]:
            unit = units[k]
            if (ids := old.get(unit)) is not None:
                found[k] = young[unit] = ids
                continue
            if not unit or unit == "\n":  # white space in a row is odd; a text's own start also reads so
                continue
            word = unit.rstrip(_MARKS)
            if len(unit) - len(word) > TAIL or word[-1:] not in letters:
                word = unit
            if word not in young:
                if (ids := old.get(word)) is not None:
                    young[word] = ids
                else:
                    new[word] = None
            parted.append((k, word, unit[len(word) :]))
        plain = list(filter(_PLAIN.fullmatch, new)) if letters else []
        new.update(zip(plain, self._words(plain)))
        others = [word for word, ids in new.items() if ids is None]
        for b in range(0, len(others), CALL_UNITS):
            some = others[b : b + CALL_UNITS]
            if sum(map(len, "".join(some).split())) != sum(map(len, some)) - sum(w[0] == "\n" for w in some):
                some = [w for w in some if not _ODD_SPACE.search(w)]
            new.update(zip(some, self._units(some) if some else ()))
        for k, word, tail in parted:
            ids = new[word] if word in new else young[word]
            if tail and ids is not None:
                if tail not in tails:
                    tails[tail] = self._library(tail).tobytes()
                ids += tails[tail]
            found[k] = ids
        if len(young) + len(new) > CACHE_UNITS:
            self._old, self._young = young, {}
        self._young.update((word, ids) for word, ids in new.items() if ids is not None and len(word) <= CACHE_CHARS)
        return found
