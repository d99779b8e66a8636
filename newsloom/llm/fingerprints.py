"""Order MinHash fingerprints, and what an edit does to them.

A text's k-mers of code points are numbered by occurrence. Each of HASHES orders picks its LENGTH smallest numbered
k-mers; they are put back in text order, and the hash of that tuple is one place of the fingerprint. Two texts agree in a
place if they share the chosen k-mers and their order, which falls with edit distance and not with set overlap alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import Staged, documents, parts_for, prepare, task

K, HASHES, LENGTH = 8, 32, 2
PART_INPUT_BYTES = 16 << 20
#: Numbered k-mers hashed under all orders at once.
_CHUNK = 16_384
_LOW = np.iinfo(np.int64).min

_rng = np.random.default_rng(20_260_101)
_SEEDS = _rng.integers(1, 2**63, HASHES, np.uint64)[:, None]
_ODD = _rng.integers(1, 2**63, HASHES, np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
_BASE, _STEP, _TUPLE = (_rng.integers(1, 2**63, 3, np.uint64) * np.uint64(2) + np.uint64(1)).tolist()
_BASE, _STEP, _TUPLE = np.uint64(_BASE), np.uint64(_STEP), np.uint64(_TUPLE)
_MOST = np.uint64(2**64 - 1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def numbered(codes: np.ndarray) -> np.ndarray:
    """The hashes of a text's k-mers, each mixed with its occurrence number; a shorter text is one k-mer."""
    k = min(K, len(codes))
    if not k:
        return np.zeros(0, np.uint64)
    c = codes.astype(np.uint64) + np.uint64(1)
    n = len(c) - k + 1
    h = c[:n].copy()
    for j in range(1, k):
        h *= _BASE
        h += c[j : j + n]
    h = _mix(h)
    bits = np.uint64(max(1, int(n - 1).bit_length()))
    keyed = np.sort(h >> bits << bits | np.arange(n, dtype=np.uint64))
    place = (keyed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    kind = keyed >> bits
    first = np.flatnonzero(np.concatenate(([True], kind[1:] != kind[:-1])))
    run = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
    number = np.empty(n, np.uint64)
    number[place] = run.astype(np.uint64)
    return _mix(h + number * _STEP)


def smallest(h: np.ndarray, base: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Under each order, the LENGTH smallest values, their places and hashes, in ascending order: (HASHES, LENGTH) each."""
    values = np.full((HASHES, LENGTH), _MOST)
    places = np.full((HASHES, LENGTH), -1)
    hashes = np.zeros((HASHES, LENGTH), np.uint64)
    rows = np.arange(HASHES)
    for b in range(0, len(h), _CHUNK):
        own = h[b : b + _CHUNK]
        v = (own[None, :] ^ _SEEDS) * _ODD
        got = []
        for _ in range(min(LENGTH, len(own))):
            at = v.argmin(axis=1)
            got.append((v[rows, at].copy(), at + b + base, own[at]))
            v[rows, at] = _MOST
        values, places, hashes = merged((values, places, hashes), tuple(np.stack(x, axis=1) for x in zip(*got)))
    return values, places, hashes


def merged(a: tuple, b: tuple) -> tuple:
    values, places, hashes = (np.concatenate(x, axis=1) for x in zip(a, b))
    order = np.lexsort((places, values, places < 0), axis=1)[:, :LENGTH]
    return tuple(np.take_along_axis(x, order, axis=1) for x in (values, places, hashes))


def sketch(found: tuple) -> np.ndarray:
    """The tuples in text order, hashed to 32 bits each."""
    _, places, hashes = found
    hashes = np.take_along_axis(hashes, np.argsort(places, axis=1, kind="stable"), axis=1)
    out = np.zeros(HASHES, np.uint64)
    for j in range(LENGTH):
        out = _mix(out * _TUPLE + hashes[:, j])
    return (out >> np.uint64(32)).astype(">u4")


def fingerprint(text: str) -> np.ndarray:
    return sketch(smallest(numbered(_codes(text))))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def edited(text: str, after: str) -> str:
    """The last third of the code points replaced by the first as many of the next text."""
    third = len(text) // 3
    return text[: len(text) - third] + after[:third]


def _pair(text: str, after: str) -> tuple[np.ndarray, np.ndarray, str]:
    """The fingerprints of a text and its edited text, which share the k-mers before the edit."""
    other = edited(text, after)
    a, b = numbered(_codes(text)), numbered(_codes(other))
    kept = max(0, len(text) - len(text) // 3 - K + 1) if len(text) >= K and len(other) >= K else 0
    shared = smallest(a[:kept])
    return sketch(merged(shared, smallest(a[kept:], kept))), sketch(merged(shared, smallest(b[kept:], kept))), other


_PRINTED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


_RESULT = [c.split()[0] for c in _PRINTED.split(", ")]
_KINDS = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
#: What a task knows of its range: finished rows (kind 0), and its first (1) and last (2) row with their texts, for the ranges beside it.
_RANGE = f"kind int, part int, {_PRINTED}, text string"
FIRST, LAST = 1, 2


def _row(doc_id: int | None, text: str, after: str) -> tuple[tuple, np.ndarray]:
    """All but near_next of a text's row, and its fingerprint."""
    own, changed, other = _pair(text, after)
    sha = hashlib.sha256(other.encode("utf-8", "surrogatepass")).hexdigest()
    return (doc_id, len(text), sha, own.tobytes().hex(), changed.tobytes().hex(), float((own == changed).mean())), own


def _print_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text) in order: finishes all but the last, as the row after that is in the next range."""
    part, rows = TaskContext.get().partitionId(), []

    def border(kind: int, doc_id: int | None, text: str) -> tuple:
        return (kind, part, doc_id, *[None] * (len(_RESULT) - 1), text)

    def emit() -> pa.RecordBatch:
        kinds = (pa.int32(), pa.int32(), *_KINDS, pa.string())
        out = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], names=["kind", "part", *_RESULT, "text"])
        rows.clear()
        return out

    last = pending = None  # the row before, and the one before that with its fingerprint, which waits for near_next
    for batch in batches:
        for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            text = text or ""
            if last is None:
                rows.append(border(FIRST, doc_id, text))
            else:
                done, own = _row(*last, text)
                if pending:
                    rows.append((0, part, *pending[0], float((pending[1] == own).mean()), None))
                pending = done, own
            last = doc_id, text
            if len(rows) >= 500:
                yield emit()
    if last is not None:
        if pending:
            rows.append((0, part, *pending[0], float((pending[1] == fingerprint(last[1])).mean()), None))
        rows.append(border(LAST, *last))
        yield emit()


def _print_borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, next text) in any order."""
    for batch in batches:
        rows = []
        for doc_id, text, after in zip(*(c.to_pylist() for c in batch.columns)):
            done, own = _row(doc_id, text, after)
            rows.append((*done, float((own == fingerprint(after)).mean())))
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), _KINDS)], names=_RESULT)


def fingerprint_chain(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and how near both that and the next document's are.

    The next document is the one with the next smaller id, after the smallest the largest; rows of one id follow each
    other by xxhash64 of the text, equal texts in any order, and a null id counts as the smallest. A null text counts as empty; a
    text of fewer than K code points is one k-mer, and empty texts equal each other. An only document is its own next.
    Other columns are ignored, whatever their names; texts may have any length, and take some 100 bytes of memory for each code
    point; an empty table gives no rows.

    Rows are sorted by range of id, hash and row number, so that no id gathers in one task. A task hands its first and last
    row on, and those are joined with the ranges beside it.
    """
    spark = docs.sparkSession
    prepare(spark)
    text = F.col(f"`{text_col}`").cast("string")
    own_id = F.col(f"`{id_col}`").cast("long")
    rows = docs.select(F.coalesce(own_id, F.lit(_LOW)).alias("i"), own_id.alias("own_id"), text.alias("t"), F.xxhash64(text).alias("h"))
    order = [F.desc("i"), F.asc("h"), F.asc("row")]
    dealt = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(parts_for(rows, PART_INPUT_BYTES), *order).sortWithinPartitions(*order)
    ranges = Staged(dealt.select("own_id", "t").mapInArrow(task("prints", _print_range), _RANGE), "prints").df
    firsts = Staged(ranges.where(F.col("kind") == FIRST).select("part", F.col("text").alias("after")), "first-rows").df
    # A row of two numbers for each range; after the last comes the first.
    numbers = firsts.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy(F.lit(0)))).alias("next"))
    lasts = ranges.where(F.col("kind") == LAST).select("part", "doc_id", "text").join(numbers, "part")
    borders = lasts.join(firsts.withColumnRenamed("part", "next"), "next").select("doc_id", "text", "after").mapInArrow(task("prints", _print_borders), _PRINTED)
    return ranges.where("kind = 0").select(_RESULT).unionByName(borders)


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_chain(documents(spark, sf_dir))
