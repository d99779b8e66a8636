"""Best-fit packing whose bin counts carry a certificate.

Documents of more than `capacity` tokens are cut into full pieces after a shorter first one. A full piece fills a
sequence. The others are dealt to partitions of bounded size and packed by best-fit decreasing; dual-feasible
functions give each partition a lower bound. A partition that meets its bound is certified, and all its sequences but the
emptiest are settled. One with a gap settles its full sequences only. The sequences that are not settled are dealt anew, to
as few partitions of the same size as hold them, so that partitions exchange their documents, which are packed again; of the
old and the new packing the one with fewer sequences stays. That goes on until one partition is left, or for ROUNDS rounds.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import Staged, documents, prepare, task
from ._tokens import encoder, grouped

CAPACITY = 1024
#: Pieces in a partition of any round.
PART_PIECES = 8192
ROUNDS = 4

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = f"{_PIECE}, part long, sequence_id long, offset long, part_bins long, part_bound long, loose boolean"


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """The largest bound on the bins of `sizes` that a family of dual-feasible functions gives."""
    if not len(sizes):
        return 0
    count = np.bincount(sizes, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((count * size).sum()) // capacity)
    # Threshold functions: above capacity - e counts as a whole bin, below e as nothing.
    number, total = np.cumsum(count), np.cumsum(count * size)
    e = np.arange(1, capacity // 2 + 1)
    whole = number[-1] - number[capacity - e]
    middle = total[capacity - e] - total[e - 1]
    best = max(best, int((whole + -(-middle // capacity)).max()))
    # Rounding functions: x if (k + 1) x is whole, else floor((k + 1) x) / k, for x a share of the capacity.
    for k in range(1, 21):
        grown = (k + 1) * size
        value = np.where(grown % capacity == 0, size * k, grown // capacity * capacity)  # times k * capacity
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Each piece's bin and offset, and the number of bins."""
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    open_by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, used = 0, 0  # bit r of rooms: a bin with room r is open
    order = np.argsort(-sizes, kind="stable")
    for i, size in zip(order.tolist(), sizes[order].tolist()):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            own = open_by_room[room]
            b = own.pop()
            if not own:
                rooms ^= 1 << room
        else:
            b, room = used, capacity
            used += 1
        bins[i], offsets[i] = b, capacity - room
        if left := room - size:
            if not open_by_room[left]:
                rooms |= 1 << left
            open_by_room[left].append(b)
    return bins, offsets, used


def _pieces(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int, capacity: int) -> Iterator[pa.RecordBatch]:
    tool = encoder(tokenizer)
    for batch in grouped(batches):
        rows, doc_ids = [], iter(batch.column(0).to_pylist())
        for ids, bounds in tool.encode_column(batch.column(1), end_id):
            for at, end, doc_id in zip(bounds[:-1].tolist(), bounds[1:].tolist(), doc_ids):
                n = end - at
                first = n % capacity or capacity
                for piece, e in enumerate(range(first, n + 1, capacity)):
                    b = max(0, e - capacity) if piece else 0
                    rows.append((doc_id, piece, b, e - b, zlib.crc32(ids[at + b : at + e])))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], names=["doc_id", "piece", "start", "length", "ids_crc32"])


def _pack_part(table: pa.Table, step: int, capacity: int) -> pa.Table:
    """Packs a partition; after the first round, only if that takes fewer bins than what exchanged into it had."""
    sizes = table["length"].to_numpy()
    part = table["part"][0].as_py()
    bins, offsets, used = best_fit_decreasing(sizes, capacity)
    bound = lower_bound(sizes, capacity)
    before = len(np.unique(table["sequence_id"].to_numpy())) if step else used + 1
    if used < before:
        sequence = (step << 58) + (part << 28) + bins
    else:
        used, sequence, offsets = before, table["sequence_id"].to_numpy(), table["offset"].to_numpy()
    n = len(sizes)
    own = np.unique(sequence, return_inverse=True)[1]
    room = capacity - np.bincount(own, sizes).astype(np.int64)
    loose = (room > 0)[own] if used > bound else (room > 0)[own] & (own == room.argmax())
    keep = {c: table[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32", "part")}
    return pa.table(keep | {"sequence_id": pa.array(sequence), "offset": pa.array(offsets), "part_bins": pa.array(np.full(n, used)), "part_bound": pa.array(np.full(n, bound)), "loose": pa.array(loose)})


def _packer(step: int, capacity: int):
    def run(table: pa.Table) -> pa.Table:
        return _pack_part(table, step, capacity)

    return run


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, capacity: int = CAPACITY, part_pieces: int = PART_PIECES, rounds: int = ROUNDS) -> DataFrame:
    """One row for each piece: its document, place there, sequence and offset, and the bins and bound of the partition that it was
    packed in last.

    A null text counts as empty and is packed as its end id. Null or repeated ids are packed row by row, equal lengths in any
    order. Other columns are ignored, whatever their names; texts may have any length; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("i"), F.col(f"`{text_col}`").cast("string").alias("t"))
    pieces = Staged(rows.mapInArrow(task("units", lambda x: _pieces(x, tokenizer, end_id, capacity)), _PIECE), "pieces").df
    row = F.monotonically_increasing_id()
    one, result = F.lit(1).cast("long"), [c.split()[0] for c in _PACKED.split(", ")][:-1]
    out = pieces.where(F.col("length") == capacity).select("*", F.lit(None).cast("long").alias("part"), (-1 - row).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), one.alias("part_bins"), one.alias("part_bound")).select(result)
    open_ = pieces.where(F.col("length") < capacity)
    parts = max(1, -(-open_.count() // part_pieces))
    open_ = open_.select("*", F.pmod(row, F.lit(parts)).alias("part"), F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    for step in range(rounds + 1):
        packed = Staged(open_.groupBy("part").applyInArrow(_packer(step, capacity), _PACKED), f"packed{step}").df
        loose = packed.where("loose").count() if step < rounds and parts > 1 else 0
        if not loose:
            return out.unionByName(packed.select(result))
        out = out.unionByName(packed.where("NOT loose").select(result))
        parts = -(-loose // part_pieces)
        # Whole sequences move, so that a partition can tell what its pieces took before.
        open_ = packed.where("loose").withColumn("part", F.pmod(F.xxhash64("sequence_id", F.lit(step)), F.lit(parts))).drop("part_bins", "part_bound", "loose")
    raise AssertionError


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json")).drop("part")
