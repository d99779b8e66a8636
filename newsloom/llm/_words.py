"""Words of Arrow string columns as numpy hashes, without a Python object for any word.

A word is a run of other bytes than the six separators; in UTF-8 that splits texts as it splits code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from ._common import SEPARATORS

_rng = np.random.default_rng(7_401)
_LETTERS = _rng.integers(1, 2**63, (2, 256), np.uint64) * np.uint64(2) + np.uint64(1)
_LETTERS[:, [ord(c) for c in SEPARATORS]] = 0
_STEPS = _rng.integers(1, 2**63, 2, np.uint64) * np.uint64(2) + np.uint64(1)
_GRAM = _rng.integers(1, 2**63, 2, np.uint64) * np.uint64(2) + np.uint64(1)
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[ord(c) for c in SEPARATORS]] = True
#: Bytes of text hashed at once; a longer text is hashed alone.
CHUNK_BYTES = 1 << 20
_powers = np.ones((2, 1), np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _power(which: int, n: int) -> np.ndarray:
    global _powers
    if _powers.shape[1] < n:
        size = max(n, 64)
        _powers = np.ones((2, size), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(2):
                _powers[k, 1:] = np.cumprod(np.full(size - 1, _STEPS[k]))
    return _powers[which]


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the bounds of its texts; a null is empty."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8))[bounds[0] : bounds[-1]], bounds - bounds[0]


def spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the first word's number of each text with the total last."""
    word = ~_SEPARATOR[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before = np.concatenate(([False], word[:-1])) if len(word) else word
    after = np.concatenate((word[1:], [False])) if len(word) else word
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def _some_hashes(own: np.ndarray, base: np.ndarray, size: np.ndarray, k: int) -> np.ndarray:
    """Of words that start at `base` in the bytes `own`; separators after a word count as nothing."""
    length = np.diff(np.append(base, len(own)))
    place = np.arange(len(own)) - np.repeat(base, length)
    np.minimum(place, np.repeat(size, length), out=place)
    return np.add.reduceat(_LETTERS[k][own] * _power(k, int(size.max()) + 1)[place], base)


def _long_hash(own: np.ndarray, k: int) -> np.uint64:
    """Of a word of any length, piece by piece."""
    total, power, step = np.uint64(0), np.uint64(1), np.uint64(pow(int(_STEPS[k]), CHUNK_BYTES, 1 << 64))
    with np.errstate(over="ignore"):
        for b in range(0, len(own), CHUNK_BYTES):
            piece = own[b : b + CHUNK_BYTES]
            total += power * (_LETTERS[k][piece] * _power(k, CHUNK_BYTES)[: len(piece)]).sum(dtype=np.uint64)
            power *= step
    return total


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, both: bool = False) -> list[np.ndarray]:
    """A 64-bit hash of each word, or two independent ones; about CHUNK_BYTES of text at a time, however long it is."""
    kinds = 2 if both else 1
    out = [np.zeros(len(starts), np.uint64) for _ in range(kinds)]
    size = ends - starts
    b = 0
    while b < len(starts):
        e = max(b + 1, int(np.searchsorted(ends, starts[b] + CHUNK_BYTES, "right")))
        for k in range(kinds):
            if e == b + 1 and size[b] > CHUNK_BYTES:
                out[k][b] = _long_hash(data[starts[b] : ends[b]], k)
            else:
                out[k][b:e] = _some_hashes(data[starts[b] : ends[e - 1]], starts[b:e] - starts[b], size[b:e], k)
        b = e
    return [mix(h + size.astype(np.uint64)) for h in out]


def grams(words: np.ndarray, n: int, which: int = 0) -> np.ndarray:
    """A hash of each n words in a row, regardless of where texts end; empty if there are fewer."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    step = _GRAM[which]
    block, size, power = words, 1, step  # the polynomial of `size` words from each place; power = step ** size
    out, done = None, 0
    with np.errstate(over="ignore"):
        while True:
            if n & size:
                if out is None:
                    out, done = block, size
                else:
                    m = len(words) - done - size + 1
                    out = out[:m] * power + block[done : done + m]
                    done += size
            if size * 2 > n:
                return mix(out[: len(words) - n + 1])
            m = len(words) - 2 * size + 1
            block = block[:m] * power + block[size : size + m]
            power = power * power
            size *= 2


def chunks(batches: Iterator[pa.RecordBatch], size: int = CHUNK_BYTES, text: int = 1) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of one take about `size` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, bounds = raw(batch.column(text))
        b = 0
        while b < batch.num_rows:
            e = max(b + 1, int(np.searchsorted(bounds, bounds[b] + size, "right")) - 1)
            yield batch.slice(b, e - b)
            b = e
