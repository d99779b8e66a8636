"""Token-id files in patched frame-of-reference blocks.

A file holds the ids of one range of doc_id, in ascending order. All numbers are little-endian:

    header   b"NLPF" u16 version, u16 block size, u64 file number
    blocks   u32 minimum, u16 values, u16 exceptions, u8 width, 3 bytes of 0,
             values less the minimum packed at `width` bits in groups of 64 (the last one padded with 0),
             u16 places and u32 values of the exceptions
    index    u64 block starts; i64 doc_ids; u8 1 where a doc_id is null; u64 first id of each document; u64 ids in the file
    footer   u64 index start, u64 blocks, u64 documents, b"NLPF"

A guard byte 0x0A stands after the header, each run of blocks, the index and the footer. Spark's own text
writer puts the pieces down, so its commit protocol decides what a lost executor or a second attempt leaves, and
any store that Spark reaches will do. Block starts in the index give access to any document without the ones before.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import Staged, documents, new_path, parts_for, prepare, task, with_unique
from ._tokens import encoder, grouped

MAGIC, VERSION = b"NLPF", 1
BLOCK = 1024
PERCENTILE = 90
#: Ids that are packed together, a multiple of BLOCK.
RUN = 1 << 18
FILE_INPUT_BYTES = 8 << 20
END_ID = 2
#: Files whose sums one task adds up.
GROUP_FILES = 4096


def _bit_length(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, np.floor(np.log2(np.maximum(x, 1).astype(np.float64))).astype(np.int64) + 1, 0)


def _pack(groups: np.ndarray, width: int) -> np.ndarray:
    """(n, 64) values under 2**width as (n, width) 64-bit words."""
    out = np.zeros((len(groups), width), np.uint64)
    for j in range(64 if width else 0):
        word, shift = divmod(j * width, 64)
        out[:, word] |= groups[:, j] << np.uint64(shift)
        if shift + width > 64:
            out[:, word + 1] |= groups[:, j] >> np.uint64(64 - shift)
    return out


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(words), 64), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for j in range(64 if width else 0):
        word, shift = divmod(j * width, 64)
        got = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            got = got | (words[:, word + 1] << np.uint64(64 - shift))
        out[:, j] = got & mask
    return out


def pack_blocks(ids: np.ndarray, percentile: int = PERCENTILE) -> list[bytes]:
    """Blocks of BLOCK ids; the last may hold fewer."""
    out: list[bytes] = []
    whole = len(ids) // BLOCK * BLOCK
    for part in (ids[:whole].reshape(-1, BLOCK), ids[whole:].reshape(1, -1)):
        if not part.size:
            continue
        n = part.shape[1]
        low = part.min(axis=1)
        rest = (part - low[:, None]).astype(np.uint64)
        rank = min(n - 1, -(-n * percentile // 100) - 1)
        widths = _bit_length(np.sort(rest, axis=1)[:, rank])
        beyond = rest >> widths.astype(np.uint64)[:, None] > 0
        counts = beyond.sum(axis=1)
        rows, places = np.nonzero(beyond)
        values = rest[rows, places].astype("<u4").tobytes()
        places = places.astype("<u2").tobytes()
        ends = np.cumsum(counts)
        rest[beyond] = 0
        padded = np.zeros((len(rest), -(-n // 64) * 64), np.uint64)
        padded[:, :n] = rest
        packed: list[bytes] = [b""] * len(rest)
        for width in np.unique(widths):
            at = np.flatnonzero(widths == width)
            body = _pack(padded[at].reshape(-1, 64), int(width)).astype("<u8")
            size = body.nbytes // len(at)
            raw = body.tobytes()
            for k, i in enumerate(at):
                packed[i] = raw[k * size : (k + 1) * size]
        for i in range(len(rest)):
            b, e = int(ends[i] - counts[i]), int(ends[i])
            out.append(struct.pack("<IHHBxxx", int(low[i]), n, e - b, int(widths[i])) + packed[i] + places[2 * b : 2 * e] + values[4 * b : 4 * e])
    return out


def unpack_blocks(buf: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that begin at `starts`, in that order."""
    if not len(starts):
        return np.zeros(0, np.uint32)
    head = buf[starts[:, None] + np.arange(9)]
    low = head[:, 0:4].copy().view("<u4")[:, 0]
    n = head[:, 4:6].copy().view("<u2")[:, 0].astype(np.int64)
    odd = head[:, 6:8].copy().view("<u2")[:, 0].astype(np.int64)
    width = head[:, 8].astype(np.int64)
    ends = np.cumsum(n)
    out = np.empty(int(ends[-1]), np.uint32)
    body = starts + 12
    tail = body + 8 * width * -(-n // 64)
    for w, size in {*zip(width.tolist(), n.tolist())}:
        at = np.flatnonzero((width == w) & (n == size))
        nbytes = 8 * w * -(-size // 64)
        words = buf[body[at][:, None] + np.arange(nbytes)].view("<u8").reshape(-1, w) if w else np.zeros((len(at) * -(-size // 64), 0), "<u8")
        values = _unpack(words, w).reshape(len(at), -1)[:, :size].astype(np.uint32)
        out[(ends[at] - size)[:, None] + np.arange(size)] = values
    for i in np.flatnonzero(odd):
        k, t = int(odd[i]), int(tail[i])
        places = buf[t : t + 2 * k].copy().view("<u2").astype(np.int64)
        out[ends[i] - n[i] + places] = buf[t + 2 * k : t + 6 * k].copy().view("<u4")
    out += np.repeat(low, n)
    return out


def _write_pieces(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int) -> Iterator[pa.RecordBatch]:
    tool = encoder(tokenizer)
    ids, starts, nulls, firsts = [], [], [], []
    waiting, held, total, at = [], 0, 0, 0

    def row(piece: bytes) -> pa.RecordBatch:
        nonlocal at
        at += len(piece) + 1
        return pa.RecordBatch.from_arrays([pa.array([piece], pa.binary())], names=["piece"])

    def flush(last: bool) -> Iterator[pa.RecordBatch]:
        nonlocal waiting, held
        tokens = np.concatenate(waiting)
        upto = len(tokens) if last else len(tokens) // BLOCK * BLOCK
        for b in range(0, upto, RUN):
            blocks = pack_blocks(tokens[b : min(b + RUN, upto)])
            place = at
            for block in blocks:
                starts.append(place)
                place += len(block)
            yield row(b"".join(blocks))
        waiting, held = [tokens[upto:]], len(tokens) - upto

    for batch in grouped(batches):
        if not at and len(batch):
            yield row(MAGIC + struct.pack("<HHQ", VERSION, BLOCK, TaskContext.get().partitionId()))
        ids.append(batch.column(0).fill_null(0).to_numpy())
        nulls.append(batch.column(0).is_null().to_numpy(zero_copy_only=False))
        for got, bounds in tool.encode_column(batch.column(1), end_id):
            firsts.append(total + bounds[:-1])
            total += len(got)
            waiting.append(got)
            held += len(got)
            if held >= RUN:
                yield from flush(False)
    if at:
        yield from flush(True)
        ids, nulls, firsts = map(np.concatenate, (ids, nulls, firsts))
        index = at
        yield row(np.array(starts, "<u8").tobytes() + ids.astype("<i8").tobytes() + nulls.astype("u1").tobytes() + firsts.astype("<u8").tobytes() + struct.pack("<Q", total))
        yield row(struct.pack("<QQQ", index, len(starts), len(ids)) + MAGIC)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> None:
    """Encodes every whole text and writes token files in ascending id order under `path`.

    A null text counts as empty: such a document has the end id alone. A null id sorts first; repeated ids keep
    one entry each, in any order among themselves, and may go on in the next file. Other columns are ignored, whatever their
    names; texts may have any length; an empty table leaves no ids.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("i"), F.col(f"`{text_col}`").cast("string").alias("t"))
    # A row number splits the rows of one id; files stay in order of id.
    dealt = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(parts_for(rows, FILE_INPUT_BYTES), "i", "row").sortWithinPartitions("i", "row")
    pieces = dealt.select("i", "t").mapInArrow(task("units", lambda x: _write_pieces(x, tokenizer, end_id)), "piece binary")
    pieces.select(F.col("piece").cast("string").alias("value")).write.text(path, lineSep="\n")


def read_file(content: bytes) -> tuple[int, list, np.ndarray, np.ndarray]:
    """File number, doc_ids, the documents' bounds within the file and its ids."""
    if content[:4] != MAGIC or content[-5:-1] != MAGIC:
        raise ValueError("not a token file, or a torn one")
    number = struct.unpack_from("<Q", content, 8)[0]
    index, blocks, docs = struct.unpack_from("<QQQ", content, len(content) - 29)
    buf = np.frombuffer(content, np.uint8)
    starts = np.frombuffer(content, "<u8", blocks, index).astype(np.int64)
    index += 8 * blocks
    ids = np.frombuffer(content, "<i8", docs, index).tolist()
    nulls = np.frombuffer(content, "u1", docs, index + 8 * docs)
    bounds = np.frombuffer(content, "<u8", docs + 1, index + 9 * docs).astype(np.int64)
    tokens = np.empty(int(bounds[-1]), np.uint32)
    for b in range(0, blocks, 256):  # all blocks but the last are full
        part = unpack_blocks(buf, starts[b : b + 256])
        tokens[b * BLOCK : b * BLOCK + len(part)] = part
    return number, [None if z else i for i, z in zip(ids, nulls)], bounds, tokens


_DIGEST = "file_no long, file_tokens long, doc_id long, local_start long, n_tokens long, ids_crc32 long"


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(0):
            raw = content.as_py()
            if not raw:
                continue
            number, ids, bounds, tokens = read_file(raw)
            tokens = tokens.astype("<u4")
            n = len(ids)
            sums = [zlib.crc32(tokens[b:e]) for b, e in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, number)), pa.array(np.full(n, bounds[-1])), pa.array(ids, pa.int64()), pa.array(bounds[:-1]), pa.array(np.diff(bounds)), pa.array(sums, pa.int64())], names=["file_no", "file_tokens", "doc_id", "local_start", "n_tokens", "ids_crc32"])


def _before(totals: DataFrame) -> DataFrame:
    """file_no and base: the tokens of all files before it. Sums run within groups of files, and over groups."""
    group = F.floor(F.col("file_no") / GROUP_FILES)
    upto = lambda *by: Window.partitionBy(*by).orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    groups = totals.groupBy(group.alias("g")).agg(F.sum("tokens").alias("n"))
    over = Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1)  # a row for each group of files
    groups = groups.select("g", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("start"))
    within = totals.withColumn("g", group).withColumn("own", F.coalesce(F.sum("tokens").over(upto("g")), F.lit(0)))
    return within.join(groups, "g").select("file_no", (F.col("start") + F.col("own")).alias("base"), "docs")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Reads token files back: doc_id, start, n_tokens, ids_crc32 of every document."""
    files = spark.read.format("binaryFile").load(path).select("content")
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "1")  # a row is a whole file
    try:
        rows = Staged(files.mapInArrow(task("files", _digest), _DIGEST), "token-digests").df
    finally:
        spark.conf.set(key, before)
    totals = rows.groupBy("file_no").agg(F.max("file_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    bases = Staged(_before(Staged(totals, "file-totals").df), "file-bases")
    found = with_unique(rows, bases, ["file_no"], "docs", rows.count())
    return found.select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = new_path(spark, "token-files")
    write_tokens(documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_digests(spark, path)
