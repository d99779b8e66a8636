"""Repeated substrings by a compacted de Bruijn graph of word k-mers.

The graph's k-mers are windows of 20 words; two that follow each other share 19. They are kept as runs: windows in a row
whose least 6-gram by hash (their anchor) stands at one place form an edge, so that equal k-mers meet by their anchor.

1. Edges are counted by anchor. An anchor that stands once has no repeated window and goes.
2. What is left is grouped to the graph's distinct edges, with their first source coordinate (doc_id, start), how often
   they stand, and what follows them. A join of edges with their successors finds where the path does not branch: an
   edge is always followed by one other, which stands as often. The edges of such a path stand in a row wherever they do, in
   the first document too, so that sums over its coordinates give each edge the head of its path and the path's length.
3. A later occurrence of a path that stands twice or more lies wholly in a repeated span. Of long paths the source words at all
   coordinates are read again and compared by SHA-256; edges of a path whose words differ are opened as below.
4. An anchor with several kinds of edges branches, and these may share windows. The first edge of each kind is opened into its
   windows, named by 128 bits, and source coordinates decide window by window.

Spans of both kinds are cut from the texts; overlapping spans merge. No join here turns to a broadcast where tables are small, so that
plans, and what they shuffle, are alike at every size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import Staged, documents, fresh, prepare, release, task, with_unique
from ._rows import unique_rows
from .exact_dedup import with_lists
from .sharding import slots
from ._words import chunks, grams, mix, raw, spans, word_hashes

WINDOW, K = 20, 6
#: Bits of each of an edge's two names. What is found does not depend on them; tests take fewer.
NAME_BITS = 64
#: Windows of a path that is long: of more than 50 words.
LONG = 32
#: What stands after a text's last edge.
_BOUND = 0
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _texts(batches: Iterator[pa.RecordBatch]):
    """Of each chunk: the batch, bytes, word starts and ends, the first word of each text and the words' two hashes."""
    for batch in chunks(batches):
        data, bounds = raw(batch.column(1))
        starts, ends, first = spans(data, bounds)
        yield batch, data, starts, ends, first, word_hashes(data, starts, ends, True)


def _windows(first: np.ndarray) -> np.ndarray:
    """The words where a window of one text starts."""
    n = np.diff(first)
    ok = np.zeros(first[-1] + 1, np.int64)
    own = n >= WINDOW
    np.add.at(ok, first[:-1][own], 1)
    np.add.at(ok, first[1:][own] - WINDOW + 1, -1)
    return np.flatnonzero(np.cumsum(ok)[:-1] > 0)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the least of each `width` values in a row, the first of equals."""
    low, place, size = values, np.arange(len(values)), 1

    def joined(low: np.ndarray, place: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(low) - shift
        later = low[shift:] < low[:n]
        return np.where(later, low[shift:], low[:n]), np.where(later, place[shift:], place[:n])

    while size * 2 <= width:
        low, place = joined(low, place, size)
        size *= 2
    return joined(low, place, width - size)[1] if width > size else place


def _edges(words: list[np.ndarray], first: np.ndarray, bits: int) -> tuple[np.ndarray, ...]:
    """Anchor, two content hashes, first window (as a word number) and number of windows of each edge."""
    at = _windows(first)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    kmer = grams(words[0], K)
    place = _least(kmer, WINDOW - K + 1)[at]
    begins = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1))))
    n = np.diff(np.append(begins, len(at)))
    s, e = at[begins], at[begins] + n - 1
    seg = []
    for k in range(2):
        whole = grams(words[k], WINDOW, k)
        seg.append((mix(whole[s] * _A + whole[e] * _B + n.astype(np.uint64)) >> np.uint64(64 - bits)).view(np.int64))
    return kmer[place[begins]].view(np.int64), seg[0], seg[1], s, n


_COUNTED = "anchor long, seg long"
_EDGE = "anchor long, seg long, seg2 long, after long, doc_id long, at int, n int"


def _counted(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for _, _, _, _, first, words in _texts(batches):
        anchor, seg, _, _, _ = _edges(words, first, bits)
        yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(seg)], names=["anchor", "seg"])


def _owners(batch: pa.RecordBatch, first: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The doc_id and place in its text of each word number."""
    own = np.searchsorted(first, at, "right") - 1
    return batch.column(0).to_numpy()[own], (at - first[own]).astype(np.int32)


def _placed(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch, _, _, _, first, words in _texts(batches):
        anchor, seg, seg2, s, n = _edges(words, first, bits)
        own = np.searchsorted(first, s, "right") - 1
        same = own[1:] == own[:-1]  # the edges of a text follow each other without a gap
        after = np.full(len(seg), _BOUND, np.int64)
        after[:-1][same] = seg[1:][same]
        doc_id, at = batch.column(0).to_numpy()[own], (s - first[own]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (anchor, seg, seg2, after, doc_id, at, n.astype(np.int32))], names=["anchor", "seg", "seg2", "after", "doc_id", "at", "n"])


_RANGE_BITS = 32


def _packed(at: Column, n: Column) -> Column:
    return F.shiftleft(at.cast("long"), _RANGE_BITS) + n


def _ranges(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The starts and numbers of windows of packed ranges."""
    return packed >> _RANGE_BITS, packed & ((1 << _RANGE_BITS) - 1)


def _list(column: pa.Array, own: int, *fields: str) -> list[np.ndarray]:
    """One row's list as arrays: of numbers, or of the fields of structs; a null inside is 0."""
    if not column[own].is_valid:
        return [np.zeros(0, np.int64)] * max(1, len(fields))
    values = column[own].values
    parts = [values.field(f) for f in fields] if fields else [values]
    return [pc.fill_null(x, 0).to_numpy(zero_copy_only=False).astype(np.int64) for x in parts]


#: Of an opened window (kind 0): its two names, doc_id and place. Of a path at one of its places (kind 1): its name, and the first 16
#: bytes of the SHA-256 of the words there.
_FOUND = "kind int, h long, h2 long, x long, at int"


def _sources(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, asked): asked has ranges to be opened (p is null) and ranges of the path p to be read."""
    for batch, data, starts, ends, first, words in _texts(batches):
        held, places, read = data.tobytes(), [], []
        for k in range(batch.num_rows):
            values = batch.column(2)[k].values
            if values is None or not len(values):
                continue
            r, p = _list(batch.column(2), k, "r", "p")
            opened = np.asarray(values.field("p").is_null())
            s, n = _ranges(r)
            if opened.any():
                size = n[opened]
                places.append(first[k] + np.repeat(s[opened] - np.cumsum(size) + size, size) + np.arange(size.sum()))
            for b, size, path in zip((first[k] + s[~opened]).tolist(), n[~opened].tolist(), p[~opened].tolist()):
                e = min(b + size + WINDOW - 1, int(first[k + 1]))
                digest = hashlib.sha256(b" ".join([held[x:y] for x, y in zip(starts[b:e].tolist(), ends[b:e].tolist())])).digest()
                read.append((path, int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:16], "little", signed=True)))
        if places:
            at = np.concatenate(places)
            doc_id, place = _owners(batch, first, at)
            h = [grams(words[k], WINDOW, k)[at].view(np.int64) for k in range(2)]
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(at), np.int32)), pa.array(h[0]), pa.array(h[1]), pa.array(doc_id), pa.array(place)], names=["kind", "h", "h2", "x", "at"])
        if read:
            p, a, b = (pa.array(c, pa.int64()) for c in zip(*read))
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(read), np.int32)), p, a, b, pa.array(np.zeros(len(read), np.int32))], names=["kind", "h", "h2", "x", "at"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, ranges): the words that stay."""
    for batch in chunks(batches):
        data, bounds = raw(batch.column(1))
        starts, ends, first = spans(data, bounds)
        held, kept = data.tobytes(), []
        gone_counts = np.zeros(batch.num_rows, np.int64)
        for k in range(batch.num_rows):
            b, e = int(first[k]), int(first[k + 1])
            s, n = _ranges(_list(batch.column(2), k)[0])
            stays = np.ones(e - b, bool)
            if len(s):
                edge = np.zeros(e - b + 1, np.int64)
                np.add.at(edge, s, 1)
                np.add.at(edge, s + n + WINDOW - 1, -1)
                stays = np.cumsum(edge)[:-1] == 0
            gone_counts[k] = (~stays).sum()
            own = np.flatnonzero(stays) + b
            kept.append(b" ".join([held[x:y] for x, y in zip(starts[own].tolist(), ends[own].tolist())]).decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(first)), pa.array(gone_counts), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])


def _heads(kinds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of the distinct edges that stand twice or more: the paths by their first edge (seg, seg2, first, c, windows), and of each edge
    the head of its path (seg, seg2, head, head2)."""
    left = kinds.where(f"after0 = after1 AND after0 <> {_BOUND}").select(F.col("after0").alias("seg"), "c", F.col("first.doc_id").alias("doc_id"), (F.col("first.at") + F.col("n")).alias("at"))
    right = kinds.select("seg", "c", "seg2", F.col("first.doc_id").alias("doc_id"), F.col("first.at").alias("at"))
    # Both stand equally often, and in a row where they stand first: then each follows the other wherever they stand.
    follows = right.join(left, ["seg", "c", "doc_id", "at"]).select("seg", "seg2").distinct().withColumn("follows", F.lit(True))
    own = kinds.join(follows, ["seg", "seg2"], "left").select("seg", "seg2", "first", "c", "n", F.col("first.doc_id").alias("doc_id"), F.col("first.at").alias("at"), F.coalesce("follows", F.lit(False)).alias("follows"))
    in_order = Window.partitionBy("doc_id").orderBy("at", "n", "seg", "seg2")
    own = own.withColumn("path", F.sum(F.when(F.col("follows"), 0).otherwise(1)).over(in_order))
    path = Window.partitionBy("doc_id", "path").orderBy("at", "n", "seg", "seg2")
    whole = path.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    own = own.withColumns({"lead": F.first(F.struct("seg", "seg2", "at")).over(path), "windows": (F.max(F.col("at") + F.col("n")).over(whole))})
    members = Staged(own.select("seg", "seg2", "first", "c", F.col("lead.seg").alias("head"), F.col("lead.seg2").alias("head2"), (F.col("windows") - F.col("lead.at")).alias("windows")), "members").df
    return members.where("seg = head AND seg2 = head2").select("seg", "seg2", "first", "c", "windows"), members.select("seg", "seg2", "head", "head2")


def repeated_ranges(docs: DataFrame) -> Staged:
    """Of docs (doc_id, text) with unique ids: doc_id and the packed ranges (start and windows) of repeated windows."""
    spark, bits = docs.sparkSession, NAME_BITS
    counted = docs.mapInArrow(task("spans", lambda x: _counted(x, bits)), _COUNTED).groupBy("anchor").agg(F.count(F.lit(1)).alias("stands"), F.min("seg").alias("a"), F.max("seg").alias("b"))
    anchors = Staged(counted.where("stands > 1").select("anchor", "stands", (F.col("a") != F.col("b")).alias("branching")), "anchors")
    release(spark)
    total = anchors.df.agg(F.coalesce(F.sum("stands"), F.lit(0))).first()[0]
    found = with_unique(docs.mapInArrow(task("spans", lambda x: _placed(x, bits)), _EDGE), anchors, ["anchor"], "stands", total, broadcast=False)
    edges = Staged(found.drop("anchor", "stands"), "edges")
    anchors.drop()
    release(spark)
    place = F.struct("doc_id", "at")
    kinds = edges.df.groupBy("seg", "seg2").agg(F.min(F.struct("doc_id", "at", "n")).alias("first"), F.count(F.lit(1)).alias("c"), F.max("branching").alias("branching"), F.min("after").alias("after0"), F.max("after").alias("after1"))
    kinds = Staged(kinds.where("c > 1 OR branching").withColumn("n", F.col("first.n")).withColumn("first", F.struct("first.doc_id", "first.at")), "kinds")
    release(spark)
    paths, members = _heads(kinds.df.where("c > 1"))
    paths = Staged(paths.withColumn("p", F.xxhash64("seg", "seg2")), "paths")
    late = with_unique(edges.df.select("seg", "seg2", "doc_id", "at"), paths, ["seg", "seg2"], "c", total, broadcast=False).where(F.col("first") < place)
    late = Staged(late.select("doc_id", "at", "windows", "p"), "late")
    release(spark)

    asked = lambda df, p: df.select("doc_id", F.struct(F.col("r"), p.alias("p")).alias("q"))
    first = lambda df, n: df.select("first.doc_id", _packed(F.col("first.at"), F.col(n)).alias("r"), *(["p"] if "p" in df.columns else []))
    nothing = F.lit(None).cast("long")
    long = F.col("windows") >= LONG
    to_read = late.df.where(long).select("doc_id", _packed(F.col("at"), F.col("windows")).alias("r"), "p").unionByName(first(paths.df.where(long & (F.col("c") > 1)), "windows"))
    requests = asked(to_read, F.col("p")).unionByName(asked(first(kinds.df.where("branching"), "n"), nothing))
    source = _read_sources(docs, requests)
    different = source.df.where("kind = 1").groupBy("h").agg(*(f(c).alias(f"{c}{k}") for c in ("h2", "x") for k, f in enumerate((F.min, F.max)))).where("h20 <> h21 OR x0 <> x1")
    different = Staged(different.select(F.col("h").alias("p")), "different")
    windows, good = source.df.where("kind = 0"), late.df
    if different.df.limit(1).count():  # names that collide: every edge of such a path is opened
        odd = different.df.withColumn("odd", F.lit(True))
        bad = members.withColumn("p", F.xxhash64("head", "head2")).join(odd, "p").select("seg", "seg2").distinct()
        again = _read_sources(docs, asked(edges.df.join(bad, ["seg", "seg2"]).select("doc_id", _packed(F.col("at"), F.col("n")).alias("r")), nothing))
        windows, good = windows.unionByName(again.df.where("kind = 0")).distinct(), late.df.join(odd.select("p"), "p", "left_anti")
    edges.drop()
    release(spark)
    # A window's first place is in the first edge of some kind, and all of those at branching anchors are open here.
    windows = windows.select("h", "h2", F.col("x").alias("doc_id"), "at")
    firsts = Staged(windows.groupBy("h", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1"), "window-firsts")
    opened = firsts.df.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    more = with_unique(windows, firsts, ["h", "h2"], "c", opened, broadcast=False).where(F.col("first") < place).select("doc_id", _packed(F.col("at"), F.lit(1)).alias("r"))
    ranges = good.select("doc_id", _packed(F.col("at"), F.col("windows")).alias("r")).unionByName(more)
    out = Staged(ranges.groupBy("doc_id").agg(F.collect_list("r").alias("ranges")), "ranges")
    for table in (kinds, paths, late, source, different, firsts):
        table.drop()
    release(spark)
    return out


def _read_sources(docs: DataFrame, requests: DataFrame) -> Staged:
    """What _sources finds for requests (doc_id, q), of which a document has no more than its windows are."""
    lists = Staged(requests.groupBy("doc_id").agg(F.collect_list("q").alias("asked")), "asked")
    release(docs.sparkSession)
    out = Staged(with_lists(docs, lists, "doc_id", broadcast=False).select("doc_id", "text", "asked").mapInArrow(task("spans", _sources), _FOUND), "sources")
    lists.drop()
    return out


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Row by row: doc_id, n_words, n_removed and `kept`, the words that stay, joined by one space.

    A word goes if a window over it has the words of one that starts earlier: in a smaller id, or before in the same
    text. Null and empty texts, and those of fewer than 20 words, lose nothing. Null ids come first and rows that share
    an id follow each other by text, equal texts in any order. Other columns are ignored, whatever their names; texts may have any
    length; an empty table gives no rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    rows, own = unique_rows(rows)
    done = with_lists(rows, repeated_ranges(rows), "doc_id", "left", broadcast=False).select("doc_id", "text", "ranges").mapInArrow(task("spans", _cut), _CUT)
    return done if own is None else done.withColumnRenamed("doc_id", "_n").join(own, "_n").select("doc_id", "n_words", "n_removed", "kept")


_CUT = "doc_id long, n_words long, n_removed long, kept string"


def cut_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The rows of docs without the words that cut_repeats removes, and without texts that lose all their words.

    A text that loses words becomes the rest joined by one space, and its length column, if docs has one, follows; others
    stay as they are, null ones too. Order, ties, lengths and empty tables are as in cut_repeats; all other columns stay, whatever
    their names.
    """
    prepare(docs.sparkSession)
    names = docs.columns
    number, all_rows = fresh(names, "_n", "_all")
    n, distinct = docs.agg(F.count(F.lit(1)), F.count_distinct(F.col(f"`{id_col}`"))).first()
    rows = docs.withColumn(number, F.col(f"`{id_col}`").cast("long"))
    if n != distinct:
        rows = Staged(slots(docs.withColumn(all_rows, F.lit(0)), all_rows, [id_col, text_col], number).drop(all_rows), "numbered").df
    own = F.struct(*(F.col(f"`{c}`") for c in names)).alias("own")
    rows = rows.select(F.col(number).alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"), own)
    joined = with_lists(rows, repeated_ranges(rows.select("doc_id", "text")), "doc_id", "left", broadcast=False).select("doc_id", "text", "ranges", *(F.col("own").getField(c).alias(f"own{k}") for k, c in enumerate(names)))
    text_at, length_at = names.index(text_col), names.index(length_col) if length_col in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            done = next(_cut(iter([batch])))
            gone = np.asarray(done.column(2))
            cut = pa.array(gone > 0)
            columns = batch.columns[3:]
            columns[text_at] = pc.if_else(cut, done.column(3).cast(columns[text_at].type), columns[text_at])
            if length_at is not None:
                columns[length_at] = pc.if_else(cut, pc.utf8_length(done.column(3)).cast(columns[length_at].type), columns[length_at])
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array((gone == 0) | (gone < np.asarray(done.column(1)))))

    return joined.mapInArrow(task("spans", run), docs.schema)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cut_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), x AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d
), g AS (
  SELECT doc_id, pos, word,
         string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS win,
         count(*) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS n
  FROM x
), r AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) AS k FROM g WHERE n = 20
), c AS (
  SELECT g.doc_id, g.pos, g.word,
         max(CASE WHEN r.k > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY g.doc_id ORDER BY g.pos ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
  FROM g LEFT JOIN r ON g.doc_id = r.doc_id AND g.pos = r.pos
), k AS (
  SELECT doc_id, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (WHERE gone = 0) AS kept FROM c GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""
