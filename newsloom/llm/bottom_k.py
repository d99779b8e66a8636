"""Near duplicates by bottom-k sketches: one hash function, whose SKETCH least values of a text's shingles are its sketch.

1. Rows with one set of shingles are a class. The INDEX least values of each class go into inverted lists. A class of which too
   few of these stand in any other class's list has no partner and goes; the others are looked up by their KEYS least values.
   For sets at the threshold 0.8, each value of a sketch is the other's too with that chance: none of the KEYS least is shared
   in 0.2 ** 10 of all cases, and less than two fifths of INDEX in 3e-7.
2. Each class is verified against one leader, the class that comes first in most of its lists, and against those that are dealt
   to the same block, by exact counts. So a crowded family becomes one component while each of its sets moves once.
3. Lists that hold one component only are settled. In others, the largest component's classes need not meet each other: all
   other classes of the list meet all of it. Overlaps of the lists' values, then the estimate from the union of two sketches
   (the share of common values among the least of both) propose links between components, a spanning forest for each task.
4. Components that links lead to are verified exactly: all but the largest component's classes against all, in pairs of
   blocks, of sizes that the threshold allows. Pairs are never emitted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import Staged, documents, prepare, release, task, with_unique
from ._components import components
from ._rows import unique_rows
from ._words import chunks, grams, mix, raw, spans, word_hashes
from .exact_dedup import with_lists
from .jaccard_join import _grouped, _verify, common

SHINGLE, THRESHOLD = 4, 0.8
SKETCH, INDEX, KEYS = 64, 32, 10
#: The part of a sketch that two sets at the threshold share; also the least estimate of their likeness.
OVERLAP, ESTIMATE = 0.4, 0.5
#: Classes in a block of a list; sets in a block that is verified, and their shingles.
LIST_BLOCK, SET_BLOCK, BLOCK_SHINGLES = 2048, 512, 1 << 20


def shingle_sets(batch: pa.RecordBatch, text: int) -> Iterator[np.ndarray]:
    """Of each text, A to Z in lower case, the sorted hashes of its shingles; fewer words than SHINGLE are one, none are none."""
    data, bounds = raw(batch.column(text))
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    starts, ends, first = spans(data, bounds)
    words = word_hashes(data, starts, ends)[0]
    whole = grams(words, SHINGLE)
    for b, e in zip(first[:-1].tolist(), first[1:].tolist()):
        if e - b >= SHINGLE:
            yield np.unique(whole[b : e - SHINGLE + 1])
        elif e > b:
            yield grams(words[b:e], e - b)[:1] + np.uint64(e - b)
        else:
            yield np.zeros(0, np.uint64)


_SIGNED = "id long, c1 long, c2 long, n long, sketch array<long>"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
    for batch in chunks(batches):
        rows = []
        for s in shingle_sets(batch, 1):
            name = [np.bitwise_xor.reduce(mix(s * k)) + np.uint64(len(s)) for k in (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))] if len(s) else None
            rows.append((int(name[0].view(np.int64)), int(name[1].view(np.int64)), len(s), s[:SKETCH].view(np.int64)) if name else (None, None, 0, None))
        yield pa.RecordBatch.from_arrays([batch.column(0)] + [pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], names=["id", "c1", "c2", "n", "sketch"])


def needed(size: np.ndarray) -> np.ndarray:
    """How many of the indexed values a set of this size shares with a similar one at least."""
    return np.ceil(OVERLAP * np.minimum(size, INDEX) - 1e-9).astype(np.int64)


def estimates(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Of pairs of sketches, the share of common values among the SKETCH least of their union."""
    none = np.iinfo(np.uint64).max
    both = np.full((len(a), 2 * SKETCH), none, np.uint64)
    for k, (x, y) in enumerate(zip(a, b)):
        both[k, : len(x)] = x
        both[k, len(x) : len(x) + len(y)] = y
    both.sort(axis=1)
    twice = (both[:, 1:] == both[:, :-1]) & (both[:, 1:] != none)
    distinct = np.cumsum(np.concatenate((both[:, :1] != none, (both[:, 1:] != both[:, :-1]) & (both[:, 1:] != none)), axis=1), axis=1)
    return (twice & (distinct[:, 1:] <= SKETCH)).sum(axis=1) / np.maximum(np.minimum(distinct[:, -1], SKETCH), 1)


def spanning_links(comps: np.ndarray, sketches: list[np.ndarray], sizes: np.ndarray, x: np.ndarray, y: np.ndarray) -> list[tuple[int, int]]:
    """Links between the components of the classes x and y that may be similar: a forest, the greatest overlaps first."""
    shared = common([sketches[k][:INDEX] for k in x], [sketches[k][:INDEX] for k in y])
    need = needed(sizes)
    like = (shared >= np.maximum(need[x][:, None], need[y][None, :])) & (comps[x][:, None] != comps[y][None, :])
    i, j = np.nonzero(like)
    order = np.argsort(-shared[i, j], kind="stable")
    a, b = x[i[order]], y[j[order]]
    names, part = np.unique(comps, return_inverse=True)
    root, out, at, step = np.arange(len(names)), [], 0, 256
    while at < len(a):
        now = slice(at, at + step)
        for k in np.flatnonzero(estimates([sketches[k] for k in a[now]], [sketches[k] for k in b[now]]) >= ESTIMATE):
            p, q = sorted((int(root[part[a[at + k]]]), int(root[part[b[at + k]]])))
            if p != q:
                out.append((int(names[part[a[at + k]]]), int(names[part[b[at + k]]])))
                root[root == q] = p
        a, b = a[at + step :], b[at + step :]
        apart = root[part[a]] != root[part[b]]
        a, b, at, step = a[apart], b[apart], 0, min(2 * step, 4096)
    return out


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted by value, i, j: the two blocks of a list in each run."""
    out = []

    def flush() -> pa.RecordBatch:
        columns = [pa.array(list(c), pa.int64()) for c in zip(*out)]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    for group in _grouped(batches, 3):
        if group.num_rows < 2:
            continue
        block, i, j = group["own"].to_numpy(), group["i"][0].as_py(), group["j"][0].as_py()
        x = np.flatnonzero(block == i)
        y = x if i == j else np.flatnonzero(block == j)
        if len(x) and len(y):
            sketches = [np.asarray(s, np.int64).view(np.uint64) for s in group["sketch"].combine_chunks().to_numpy(zero_copy_only=False)]
            out += spanning_links(group["comp"].to_numpy(), sketches, group["n"].to_numpy(), x, y)
        if len(out) >= 10_000:
            yield flush()
    if out:
        yield flush()


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        sets = pa.array([s.tobytes() for s in shingle_sets(batch, 1)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), sets], names=["id", "places", "shingles"])


_PLACES = "array<struct<family:long,i:long,j:long,block:long>>"


def _roots(rows: DataFrame, places: Staged) -> DataFrame:
    """(a, b) of classes that exact counts link within the groups (family, i, j) that `places` (id, places) puts them in."""
    texts = with_lists(rows, places, "id").select("id", "text", "places")
    sets = texts.mapInArrow(task("bottom-k", _shingled), f"id long, places {_PLACES}, shingles binary").withColumn("p", F.explode("places"))
    sets = sets.select("id", F.lit(1).cast("long").alias("size"), "p.family", "p.i", "p.j", "p.block", "shingles")
    found = sets.groupBy("family", "i", "j").applyInArrow(_verify, "id long, links long, near long, root long")
    return found.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b"))


def _fits(n: Column) -> Column:
    """Sets of up to n shingles in a block."""
    return F.greatest(F.lit(1), F.least(F.lit(SET_BLOCK), F.floor(F.lit(BLOCK_SHINGLES) / n)))


def inverted_lists(reps: Staged, count: int) -> Staged:
    """(value, id): the lists by which classes of `reps` (id, n, sketch) that may have a partner are looked up."""
    postings = reps.df.select("id", F.least("n", F.lit(INDEX)).cast("int").alias("s"), F.posexplode(F.slice("sketch", 1, INDEX)).alias("at", "value"))
    shared = Staged(postings.groupBy("value").agg(F.count(F.lit(1)).alias("held")).where("held > 1"), "shared-values")
    met = with_unique(postings, shared, ["value"], "held", count * INDEX).groupBy("id").agg(F.first("s").alias("s"), F.collect_list(F.struct("at", "value")).alias("own"))
    met = met.where(F.size("own") >= F.ceil(OVERLAP * F.col("s") - 1e-9))
    lists = met.select("id", F.explode(F.filter("own", lambda x: x["at"] < KEYS)).alias("x")).select(F.col("x.value").alias("value"), "id")
    return Staged(lists, "inverted-lists")


def _stars(lists: Staged, reps: Staged, total: int) -> Staged:
    """Places of classes beside their leaders: of all lists of a class, the first of most."""
    heads = Staged(lists.df.groupBy("value").agg(F.min("id").alias("leader"), F.count(F.lit(1)).alias("held")).where("held > 1"), "heads")
    led = with_unique(lists.df, heads, ["value"], "held", total).groupBy("id").agg(F.mode("leader", True).alias("leader")).where("id <> leader")
    led = Staged(led.join(reps.df.select("id", "n"), "id").select("id", "n", "leader"), "led")
    sizes = led.df.groupBy("leader").agg(F.count(F.lit(1)).alias("held"), F.max("n").alias("top"))
    sizes = Staged(sizes.withColumn("blocks", F.ceil(F.col("held") / _fits(F.col("top"))).cast("long")), "stars")
    place = lambda family, k: F.struct(family.alias("family"), k.alias("i"), k.alias("j"), k.alias("block"))
    members = with_unique(led.df, sizes, ["leader"], "held", total).select("id", F.array(place(F.col("leader"), F.pmod(F.xxhash64("id"), F.col("blocks")))).alias("places"))
    leaders = sizes.df.select(F.col("leader").alias("id"), F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda k: place(F.col("leader"), k)).alias("places"))
    places = Staged(members.unionByName(leaders).groupBy("id").agg(F.flatten(F.collect_list("places")).alias("places")), "star-places")
    for table in (heads, led, sizes):
        table.drop()
    return places


def _proposed(owned: Staged, reps: Staged, total: int) -> DataFrame:
    """(a, b) of components that estimates link, over `owned` (value, id, comp)."""
    counts = owned.df.groupBy("value", "comp").agg(F.count(F.lit(1)).alias("c"))
    contested = counts.groupBy("value").agg(F.sum("c").alias("held"), F.max_by("comp", F.struct("c", "comp")).alias("main"), F.max("c").alias("m"), F.count(F.lit(1)).alias("comps")).where("comps > 1").drop("comps")
    contested = Staged(contested, "contested-lists")
    met = with_unique(owned.df, contested, ["value"], "held", total)
    met = met.join(reps.df.select("id", "n", "sketch"), "id")
    rest, most = F.ceil((F.col("held") - F.col("m")) / LIST_BLOCK).cast("int"), F.ceil(F.col("m") / LIST_BLOCK).cast("int")
    main = F.col("comp") == F.col("main")
    met = met.withColumn("own", F.when(main, rest + F.pmod(F.xxhash64("id"), most)).otherwise(F.pmod(F.xxhash64("id"), rest)).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(main, rest).otherwise(rest + most) - 1)))
    met = met.select("value", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "comp", "n", "sketch")
    width = int(owned.spark.conf.get("spark.sql.shuffle.partitions"))
    return met.repartition(width, "value", "i", "j").sortWithinPartitions("value", "i", "j").mapInArrow(task("bottom-k", _links), "a long, b long")


def _contests(families: DataFrame, comps: DataFrame, reps: Staged, total: int) -> Staged:
    """Places of the classes of components (comp, family) that were linked: all but a family's largest component meet all."""
    families = Staged(families, "contests")
    sizes = comps.groupBy("comp").agg(F.count(F.lit(1)).alias("c"))
    sized = Staged(families.df.join(sizes, "comp"), "contest-sizes")
    members = Staged(with_unique(comps, sized, ["comp"], "c", total).join(reps.df.select("id", "n"), "id").select("id", "n", "comp", "family"), "contest-members")
    mains = sized.df.groupBy("family").agg(F.max_by("comp", F.struct("c", "comp")).alias("main"), F.sum("c").alias("held"))
    band = F.floor(F.log(F.col("n")) / -np.log(THRESHOLD) + 1e-9).cast("long")
    members = with_unique(members.df, Staged(mains, "mains"), ["family"], "held", total).withColumn("band", band).withColumn("rest", (F.col("comp") != F.col("main")).cast("long"))
    members = Staged(members.select("id", "n", "family", "band", "rest"), "contest-members")
    parts = members.df.groupBy("family", "band", "rest").agg(F.count(F.lit(1)).alias("c"), F.max("n").alias("top")).withColumn("b", F.ceil(F.col("c") / _fits(F.col("top"))).cast("long"))
    parts = parts.groupBy("family").agg(F.sum("c").alias("held"), F.collect_list(F.struct("band", "rest", "b")).alias("parts"))  # a family has some eighty bands at most
    found = with_unique(members.df, Staged(parts, "contest-parts"), ["family"], "held", total)
    name = lambda band, rest, k: F.shiftleft(F.shiftleft(band, 1) + rest, 24) + k
    mine = F.element_at(F.filter("parts", lambda x: (x["band"] == F.col("band")) & (x["rest"] == F.col("rest"))), 1)["b"]
    found = found.withColumn("own", name(F.col("band"), F.col("rest"), F.pmod(F.xxhash64("id"), mine)))
    near = F.filter("parts", lambda x: (F.abs(x["band"] - F.col("band")) <= 1) & ((x["rest"] + F.col("rest")) > 0))
    others = F.flatten(F.transform(near, lambda x: F.transform(F.sequence(F.lit(0).cast("long"), x["b"] - 1), lambda k: name(x["band"], x["rest"], k))))
    places = F.transform(others, lambda o: F.struct(F.col("family").alias("family"), F.least("own", o).alias("i"), F.greatest("own", o).alias("j"), F.col("own").alias("block")))
    return Staged(found.select("id", places.alias("places")).where(F.size("places") > 0), "contest-places")


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Row by row: doc_id, n_shingles, component_id (the least id that similar texts lead to, itself included) and kept.

    A null or wordless text has no shingles and is alone in its component. One row of each component is kept, that of its least
    id. Rows that share an id, or have none, are told apart by their order. Other columns are ignored, whatever their names;
    texts may have any length; an empty table gives no rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows, own = unique_rows(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")))
    rows = rows.select(F.col("doc_id").alias("id"), "text")
    signed = Staged(rows.mapInArrow(task("bottom-k", _sign), _SIGNED), "sketches")
    worded = signed.df.where("c1 IS NOT NULL")
    total = signed.df.count()
    several = Staged(worded.groupBy("c1", "c2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("size")).where("size > 1"), "classes-of-several")
    reps = with_unique(worded, several, ["c1", "c2"], "size", total, "left").where("rep IS NULL OR rep = id")
    reps = Staged(reps.select("id", "n", "sketch"), "reps")
    lists = inverted_lists(reps, total)
    release(spark)
    places = _stars(lists, reps, KEYS * total)
    edges = Staged(_roots(rows, places), "star-links")
    stars = Staged(components(edges.df), "star-components")
    comp = F.coalesce("root", "id").alias("comp")
    owned = Staged(lists.df.join(stars.df, F.col("id") == F.col("node"), "left").select("value", "id", comp), "owned-lists")
    linked = Staged(components(_proposed(owned, reps, KEYS * total)), "contest-links")
    release(spark)
    if linked.df.limit(1).count():
        families = linked.df.select(F.col("node").alias("comp"), F.col("root").alias("family")).unionByName(linked.df.select(F.col("root").alias("comp"), F.col("root").alias("family")).distinct())
        comps = owned.df.select("id", "comp").distinct()
        more = Staged(_roots(rows, _contests(families, comps, reps, total)), "contest-edges")
        stars = Staged(components(edges.df.unionByName(more.df)), "all-components")
    for table in (lists, reps, places, owned, linked, edges):
        table.drop()
    release(spark)
    named = with_unique(signed.df.select("id", "c1", "c2", "n"), several, ["c1", "c2"], "size", total, "left").withColumn("copy_of", F.coalesce("rep", "id"))
    sized = stars.df.join(several.df.select(F.col("rep").alias("node"), F.col("size").alias("rows")), "node", "left").select(F.col("node").alias("copy_of"), "root", F.coalesce("rows", F.lit(1).cast("long")).alias("rows"))
    found = with_unique(named, Staged(sized, "component-rows"), ["copy_of"], "rows", total, "left")
    found = found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("root", "copy_of").alias("component_id")).withColumn("kept", F.col("doc_id") == F.col("component_id"))
    if own is not None:
        found = Staged(found, "components-by-number").df
        for c in ("doc_id", "component_id"):
            found = found.withColumnRenamed(c, "_n")
            counts = found.groupBy("_n").agg(F.count(F.lit(1)).alias("_held"))  # the rows of a large component share one number
            found = with_unique(found, Staged(counts.join(own.withColumnRenamed("doc_id", c), "_n"), "named-rows"), ["_n"], "_held", total).drop("_n", "_held")
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op12_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(documents(spark, sf_dir))
