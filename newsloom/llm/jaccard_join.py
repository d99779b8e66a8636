"""Near duplicates by n-gram Jaccard: a MinHash LSH forest proposes, exact sets verify.

1. Each text's set of word shingles gives a 128-bit name of the set and a signature. Rows of one set are a class, and
   only its least id goes on.
2. The forest has TREES tries. A class's label in a trie is DEPTH of its hashes; labels are sorted over the cluster by range,
   so that a node (a prefix) is a run of neighbours, which may go on in the next range. A node's size is its run's.
3. Every class begins with its whole labels as prefixes, and shortens one after another by a level, until the chance to meet
   a class at the threshold in some tree reaches the target recall. The next prefix to shorten is the one whose shorter node
   holds the least for what it adds to the recall; so crowded nodes are left alone as long as others can make up for them.
   Sizes under CROWD count alike: a choice that saw single partners come and go would spoil the recall it aims at.
   All classes under a chosen prefix are members of its node; a large node is dealt out as pairs of blocks.
4. Within a node, in trie order, classes join leaders by the signatures' estimate. Every class meets every leader, and
   they link from an estimate of LINK on: by the triangle inequality of Jaccard distance no pair at the threshold is
   torn apart. A node emits at most a link for each class, and linked classes form families.
5. Families are verified exactly, all pairs at once as products of set matrices, in pairs of blocks; in large families only
   sets of sizes that the threshold allows meet. A task emits one row for each class: its number of links, of linked rows,
   and the root of its component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import Staged, documents, fresh, prepare, release, task, with_unique
from ._components import components
from ._rows import unique_rows
from ._words import chunks, grams, mix, raw, spans, word_hashes
from .exact_dedup import with_lists, without
from .sharding import slots

SHINGLE, THRESHOLD = 5, 0.8
#: Prefixes have LEAST levels or more, which suffices for the target.
TREES, DEPTH, LEAST, RECALL = 20, 6, 3, 0.9999
CROWD = 64
#: Bytes of a level in a label, and rows of the sorted tries in a task.
_LEVEL, _TRIE_ROWS = 4, 400_000
#: A class is a leader unless an earlier leader is estimated this near; classes link to leaders from LINK on. At the
#: threshold t a class is at least 1 - (1 - NEAR) - (1 - t) = 0.65 near a leader of its partner's; the rest is allowed
#: for the estimate's error, four standard deviations.
NEAR, LINK = 0.85, 0.45
NODE_BLOCK, FAMILY_BLOCK = 4096, 512
#: Shingles in a block of sets: long sets make smaller blocks.
BLOCK_SHINGLES = 1 << 21

_rng = np.random.default_rng(31_337)
_XOR = _rng.integers(1, 2**63, TREES * DEPTH, np.uint64)[:, None]
_ODD = _rng.integers(1, 2**63, TREES * DEPTH, np.uint64)[:, None] * np.uint64(2) + np.uint64(1)


def chosen_depths(sizes: np.ndarray, recall: float = RECALL, threshold: float = THRESHOLD, crowd: int = CROWD) -> np.ndarray:
    """Of (classes, trees, levels) node sizes at LEAST to DEPTH levels: each class's prefix length in each tree."""
    levels = np.arange(LEAST, DEPTH + 1)
    gain = -np.log1p(-(threshold**levels))  # -log of the chance not to meet in a tree, which add up over trees
    cost = np.maximum(sizes, crowd).astype(float)
    at = np.full(sizes.shape[:2], DEPTH - LEAST)
    need = -math.log(1 - recall) - gain[at].sum(axis=1)
    rows = np.arange(len(sizes))
    while True:
        short = np.flatnonzero((need > 0) & (at > 0).any(axis=1))
        if not len(short):
            return at + LEAST
        own = at[short]
        after = np.maximum(own - 1, 0)
        more = np.take_along_axis(cost[short], after[:, :, None], 2)[:, :, 0] - np.take_along_axis(cost[short], own[:, :, None], 2)[:, :, 0]
        # Of prefixes that cost nothing more, the longest shortens first, so that they go down together.
        price = np.where(own > 0, more / np.maximum(gain[after] - gain[own], 1e-12) + len(levels) - own, np.inf)
        tree = price.argmin(axis=1)
        need[short] -= gain[after[rows[: len(short)], tree]] - gain[own[rows[: len(short)], tree]]
        at[short, tree] -= 1


def shingle_sets(batch: pa.RecordBatch, text: int) -> Iterator[np.ndarray]:
    """Of each text, the sorted hashes of its word shingles; fewer words than SHINGLE are one shingle, none are none."""
    data, bounds = raw(batch.column(text))
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


def signature(s: np.ndarray) -> np.ndarray:
    """The least value under each order, as 64-bit hashes of the shingles."""
    low = np.full(TREES * DEPTH, np.iinfo(np.uint64).max, np.uint64)
    for b in range(0, len(s), 4096):
        low = np.minimum(low, ((s[None, b : b + 4096] ^ _XOR) * _ODD).min(axis=1))
    return mix(low)


_SIGNED = "id long, c1 long, c2 long, n long, signature binary"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        rows = []
        for s in shingle_sets(batch, 1):
            if not len(s):
                rows.append((None, None, 0, None))
                continue
            name = [np.bitwise_xor.reduce(mix(s * k)) + np.uint64(len(s)) for k in (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))]
            rows.append((int(name[0].view(np.int64)), int(name[1].view(np.int64)), len(s), signature(s).astype("<u4").tobytes()))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0)] + [pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], names=["id", "c1", "c2", "n", "signature"])


_SIZES = [f"s{d}" for d in range(LEAST, DEPTH + 1)]
_TRIE = f"tree int, label binary, id long, edge int, {', '.join(f'{c} long' for c in _SIZES)}"


def _trie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a range of sorted labels: the sizes of each label's nodes, as far as the range goes, and `edge`, the most levels at
    which its node touches the range's first or last label. Labels alone in all nodes of LEAST levels go."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held).combine_chunks()
    tree = table["tree"].to_numpy()
    labels = np.frombuffer(b"".join(table["label"].to_pylist()), "<u4").reshape(len(tree), DEPTH)
    common = np.zeros(len(tree), np.int64)  # levels in common with the label before
    like = tree[1:] == tree[:-1]
    for d in range(DEPTH):
        like = like & (labels[1:, d] == labels[:-1, d])
        common[1:] += like
    with_first = np.minimum.accumulate(np.concatenate(([DEPTH], common[1:])))
    with_last = np.minimum.accumulate(np.concatenate(([DEPTH], common[:0:-1])))[::-1]
    edge = np.maximum(with_first, with_last)
    sizes = []
    for d in range(LEAST, DEPTH + 1):
        node = np.cumsum(common < d) - 1
        sizes.append(np.bincount(node)[node])
    stays = pa.array((sizes[0] > 1) | (edge >= LEAST))
    out = pa.table([table["tree"], table["label"], table["id"], pa.array(edge.astype(np.int32)), *map(pa.array, sizes)], names=["tree", "label", "id", "edge", *_SIZES]).filter(stays)
    yield from out.to_batches(max_chunksize=50_000)


_ASKED = "tree int, depth int, prefix binary, held long"


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (own), lists of tree, label and sizes by class: the nodes of the prefixes that it chooses, but where it is alone."""
    for batch in batches:
        entries = batch.column(0)
        flat, size = entries.flatten(), np.diff(entries.offsets.to_numpy())
        own, tree = np.repeat(np.arange(len(size)), size), flat.field("tree").to_numpy()
        sizes = np.ones((len(size), TREES, len(_SIZES)), np.int64)
        for j, c in enumerate(_SIZES):
            sizes[own, tree, j] = flat.field(c).to_numpy()
        depth = chosen_depths(sizes)[own, tree]
        held = sizes[own, tree, depth - LEAST]
        at = np.flatnonzero(held > 1)
        prefixes = [x[: _LEVEL * d] for x, d in zip(flat.field("label").take(pa.array(at)).to_pylist(), depth[at].tolist())]
        yield pa.RecordBatch.from_arrays([pa.array(tree[at], pa.int32()), pa.array(depth[at].astype(np.int32)), pa.array(prefixes, pa.binary()), pa.array(held[at])], names=["tree", "depth", "prefix", "held"])


def node_links(ids: np.ndarray, sketches: np.ndarray, sizes: np.ndarray) -> tuple[list[int], list[int]]:
    """Links between the classes of a node that join what may be similar; at most one for each class but the first."""
    g = len(ids)
    part, open_ = np.arange(g), np.ones(g, bool)
    a, b = [], []
    for k in range(g):
        if not open_[k]:
            continue
        like = (sketches == sketches[k]).mean(axis=1)
        open_[like >= NEAR] = False
        open_[k] = False
        hit = np.flatnonzero((like >= LINK) & (part != part[k]))
        if len(hit):
            joined, at = np.unique(part[hit], return_index=True)
            a += [int(ids[k])] * len(joined)
            b += ids[hit[at]].tolist()
            part[np.isin(part, joined)] = part[k]
    return a, b


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Rows of each run of equal key columns (the first `keys`), over the bounds of batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy() for k in range(keys)]
        cuts = [0, *(np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1).tolist(), batch.num_rows]
        for b, e in zip(cuts, cuts[1:]):
            key = tuple(c[b] for c in cols)
            if held and key != last:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(b, e - b))
            last = key
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = [], []
    for node in _grouped(batches, 3):
        if node.num_rows > 1:
            sketches = np.frombuffer(b"".join(node["sketch"].to_pylist()), np.uint8).reshape(node.num_rows, -1)[:, ::_LEVEL]
            x, y = node_links(node["id"].to_numpy(), sketches, node["n"].to_numpy())
            a += x
            b += y
        if len(a) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
            a, b = [], []
    if a:
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many values each left and right set share."""
    flat = np.concatenate([*left, *right])
    _, name = np.unique(flat, return_inverse=True)
    size = np.array([len(s) for s in left + right])
    own = np.repeat(np.arange(len(size)), size)
    counts = np.bincount(name)
    shared = counts[name] > 1
    name, own = name[shared], own[shared]
    kinds, name = np.unique(name, return_inverse=True)
    order = np.argsort(name, kind="stable")
    name, own = name[order], own[order]
    counted = np.zeros((len(left), len(right)), np.float32)
    step = 4096
    for k in range(0, len(kinds), step):
        b, e = np.searchsorted(name, [k, k + step])
        m = np.zeros((len(size), min(step, len(kinds) - k)), np.float32)
        m[own[b:e], name[b:e] - k] = 1
        counted += m[: len(left)] @ m[len(left) :].T
    return counted.astype(np.int64)


def similar(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Whether each left and right set are at least THRESHOLD alike, by exact counts."""
    shared = common(left, right)
    both = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])[None, :] - shared
    return shared * 10 >= both * round(THRESHOLD * 10)


_VERIFIED = "id long, links long, near long, root long"


def _verify(table: pa.Table) -> pa.Table:
    ids, size, block = table["id"].to_numpy(), table["size"].to_numpy(), table["block"].to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in table["shingles"].to_pylist()]
    x, y = np.flatnonzero(block == table["i"][0].as_py()), np.flatnonzero(block == table["j"][0].as_py())
    like = similar([sets[k] for k in x], [sets[k] for k in y])
    alone = np.array_equal(x, y)
    links, near = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
    if alone:
        np.fill_diagonal(like, False)
    links[x] += like.sum(axis=1)
    near[x] += like @ size[y]
    if not alone:
        links[y] += like.sum(axis=0)
        near[y] += size[x] @ like
    root = np.arange(len(ids))
    order = np.argsort(ids)
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids))
    low = rank.copy()  # the least rank of each class's component, spread until nothing changes
    while True:
        after = low.copy()
        np.minimum.at(after, x, np.where(like, low[y][None, :], len(ids)).min(axis=1, initial=len(ids)))
        np.minimum.at(after, y, np.where(like, low[x][:, None], len(ids)).min(axis=0, initial=len(ids)))
        after = np.minimum(after, after[order[after]])
        if np.array_equal(after, low):
            break
        low = after
    root = ids[order[low]]
    return pa.table({"id": ids, "links": links, "near": near, "root": root})


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Row by row: doc_id, copy_of (the least id with the same set), copies, class_id, n_links and n_near.

    class_id is the least id that similar texts lead to, over any number of links; n_links counts the classes of
    other sets at THRESHOLD or more, n_near their rows. A null or wordless text is alone in its class and has no links.
    Rows that share an id, or have none, are told apart all the same, by their order. Other columns are ignored, whatever
    their names; texts may have any length; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows, own = unique_rows(rows)
    found = _near_classes(rows.select(F.col("doc_id").alias("id"), "text"))
    if own is not None:
        found = Staged(found, "classes-by-number").df
    if own is None:
        return found
    total = found.count()
    for c in ("doc_id", "copy_of", "class_id"):
        found = found.withColumnRenamed(c, "_n")
        counts = found.groupBy("_n").agg(F.count(F.lit(1)).alias("_held"))  # the rows of a large class share one number
        names = Staged(counts.join(own.withColumnRenamed("doc_id", c), "_n"), "named-rows")
        found = with_unique(found, names, ["_n"], "_held", total).drop("_n", "_held")
    return found.select("doc_id", "copy_of", "copies", "class_id", "n_links", "n_near")


def forest_nodes(reps: DataFrame, count: int) -> tuple[Staged, Staged]:
    """Of classes (id, signature): their labels that share a node of LEAST levels, with all node sizes, and the chosen nodes.

    trie: tree, label, id, s3 to s6; nodes: key (a hash of tree, depth and prefix) and held, its number of classes.
    """
    width = int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bytes_ = _LEVEL * DEPTH
    labels = reps.select("id", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"), "signature").select("tree", F.expr(f"substring(signature, tree * {bytes_} + 1, {bytes_})").alias("label"), "id")
    ranges = max(width, -(-count * TREES // _TRIE_ROWS))
    local = labels.repartitionByRange(ranges, "tree", "label", "id").sortWithinPartitions("tree", "label", "id").mapInArrow(task("forest", _trie), _TRIE)
    local = Staged(local, "trie-ranges")
    # Nodes that touch the end of a range may go on in the next: their sizes are added up, two at most for each range and level.
    border = local.df.where(f"edge >= {LEAST}")
    prefix = lambda d: F.expr(f"substring(label, 1, {_LEVEL * d})")
    total = count * TREES
    for d, c in zip(range(LEAST, DEPTH + 1), _SIZES):
        sums = Staged(local.df.where(f"edge >= {d}").groupBy("tree", prefix(d).alias("p")).agg(F.count(F.lit(1)).alias("t")), "border")
        border = with_unique(border.withColumn("p", F.when(F.col("edge") >= d, prefix(d))), sums, ["tree", "p"], "t", total, "left").withColumn(c, F.coalesce("t", c)).drop("p", "t")
    columns = ["tree", "label", "id", *_SIZES]
    trie = Staged(local.df.where(f"edge < {LEAST}").select(columns).unionByName(border.select(columns)).where(f"s{LEAST} > 1"), "trie")
    local.drop()
    release(reps.sparkSession)
    own = trie.df.groupBy("id").agg(F.collect_list(F.struct("tree", "label", *_SIZES)).alias("own")).select("own")
    asked = own.mapInArrow(task("forest", _choose), _ASKED).select(F.xxhash64("tree", "depth", "prefix").alias("key"), "held")
    return trie, Staged(asked.groupBy("key").agg(F.max("held").alias("held")), "nodes")


def _blocks(members: DataFrame, total: int) -> DataFrame:
    """members (id, family, held, n, size) with their block and the pairs of blocks of the family that they have to go to.

    A family of one block is one group. In larger ones, sets go by band: sizes of neighbouring bands differ by the
    threshold or more, so that a set meets its own band and the next on either side, and no similar pair is lost.
    """
    band = F.when((F.col("held") <= FAMILY_BLOCK) & (F.col("shingles") <= BLOCK_SHINGLES), 0).otherwise(F.floor(F.log(F.col("n")) / -math.log(THRESHOLD) + 1e-9)).cast("long")
    members = Staged(members.withColumn("band", band), "banded")
    counts = members.df.groupBy("family", "band").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
    blocks = F.ceil(F.greatest(F.col("c") / FAMILY_BLOCK, F.col("s") / BLOCK_SHINGLES)).cast("int")
    blocks = Staged(counts.select("family", "band", blocks.alias("b"), "c"), "blocks")
    found = with_unique(members.df, blocks, ["family", "band"], "c", total)
    for k, name in ((-1, "above"), (1, "below")):  # the number of blocks of the next band up, and down
        shifted = blocks.df.select("family", (F.col("band") + k).alias("band"), F.col("b").alias(name), F.col("c").alias(f"c_{name}"))
        found = with_unique(found, Staged(shifted, "blocks"), ["family", "band"], f"c_{name}", total, "left")
    found = found.withColumn("mine", F.pmod(F.xxhash64("id"), F.col("b")).cast("int"))
    own, mine = F.col("band"), F.col("mine")
    name = lambda band, k: F.shiftleft(band, 24) + k
    pair = lambda i, j: F.struct(i.cast("long").alias("i"), j.cast("long").alias("j"))

    def pairs(upto, make):
        return F.transform(F.when(upto > 0, F.sequence(F.lit(0), upto - 1)).otherwise(F.array().cast("array<int>")), make)

    meets = F.concat(
        pairs(F.col("b"), lambda k: pair(name(own, F.least(mine, k)), name(own, F.greatest(mine, k)))),
        pairs(F.coalesce("above", F.lit(0)), lambda k: pair(name(own, mine), name(own + 1, k))),
        pairs(F.coalesce("below", F.lit(0)), lambda k: pair(name(own - 1, k), name(own, mine))),
    )
    return found.select("id", "size", "family", name(own, mine).cast("long").alias("block"), meets.alias("meets"))


_SETS = "id long, size long, family long, block long, meets array<struct<i:long,j:long>>, shingles binary"


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        sets = pa.array([s.tobytes() for s in shingle_sets(batch, 1)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], sets], names=["id", "size", "family", "block", "meets", "shingles"])


def _near_classes(rows: DataFrame) -> DataFrame:
    spark = rows.sparkSession
    signed = Staged(rows.mapInArrow(task("forest", _sign), _SIGNED), "signatures")
    worded = signed.df.where("c1 IS NOT NULL")
    classes = Staged(worded.groupBy("c1", "c2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("size")), "classes")
    count, total = classes.df.count(), signed.df.count()
    several = Staged(classes.df.where("size > 1"), "classes-of-several")
    classes.drop()
    one = F.lit(1).cast("long")
    reps = with_unique(worded, several, ["c1", "c2"], "size", total, "left").where("rep IS NULL OR rep = id")
    reps = Staged(reps.select("id", F.coalesce("size", one).alias("size"), "n", "signature"), "reps")

    trie, nodes = forest_nodes(reps.df.select("id", "signature"), count)
    held_at = F.array(*(F.struct(F.lit(d).alias("d"), F.col(c).alias("s")) for d, c in zip(range(LEAST, DEPTH + 1), _SIZES)))
    members = trie.df.select("tree", "label", "id", F.explode(F.filter(held_at, lambda x: x["s"] > 1)).alias("x"))
    members = members.select(F.xxhash64("tree", F.col("x.d"), F.expr(f"substring(label, 1, {_LEVEL} * x.d)")).alias("key"), "id")
    live = with_unique(members, nodes, ["key"], "held", count * TREES).groupBy("id").agg(F.collect_list(F.struct("key", "held")).alias("live"))
    # The estimate takes a byte of each hash, one of the label's four.
    sketched = reps.df.select("id", "n", F.col("signature").alias("sketch"))
    members = sketched.join(live, "id").select("id", "n", "sketch", F.explode("live").alias("k")).select("k.key", "k.held", "id", "n", "sketch")
    blocks = F.ceil(F.col("held") / NODE_BLOCK).cast("int")
    members = members.withColumn("own", F.pmod(F.xxhash64("id"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    members = members.select("key", F.least("own", "other").cast("int").alias("i"), F.greatest("own", "other").cast("int").alias("j"), "id", "n", "sketch")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    walked = members.repartition(width, "key", "i", "j").sortWithinPartitions("key", "i", "j", "sketch").mapInArrow(task("forest", _walk), "a long, b long")
    family = components(walked)
    release(spark)

    members_of = family.unionByName(family.select(F.col("root").alias("node"), "root").distinct())
    family = Staged(members_of, "families")
    held = Staged(family.df.withColumnRenamed("node", "id").join(reps.df.select("id", "size", "n"), "id"), "families-with-sizes")
    sized = Staged(held.df.groupBy("root").agg(F.count(F.lit(1)).alias("held"), F.sum("n").alias("shingles")), "family-sizes")
    held = with_unique(held.df, sized, ["root"], "held", count).withColumnRenamed("root", "family")
    held = Staged(_blocks(held, count), "family-members")
    texts = with_lists(rows, held, "id").select("id", "text", "size", "family", "block", "meets")
    sets = texts.mapInArrow(task("forest", _shingled), _SETS).withColumn("m", F.explode("meets"))
    sets = sets.select("id", "size", "family", "block", "shingles", "m.i", "m.j")
    verified = Staged(sets.groupBy("family", "i", "j").applyInArrow(_verify, _VERIFIED), "verified")
    sums = verified.df.groupBy("id").agg(F.sum("links").alias("links"), F.sum("near").alias("near"))
    roots = components(verified.df.select(F.col("id").alias("a"), F.col("root").alias("b")))
    found = sums.join(roots, sums.id == roots.node, "left").select(F.col("id").alias("rep"), "links", "near", "root").where("links > 0 OR root IS NOT NULL")
    found = Staged(found, "near-classes")
    for table in (reps, trie, nodes, family, sized, held, verified):
        table.drop()
    release(spark)
    named = with_unique(signed.df.select("id", "c1", "c2"), several, ["c1", "c2"], "size", total, "left").withColumn("copy_of", F.coalesce("rep", "id"))
    found = found.df.withColumnRenamed("rep", "copy_of").join(several.df.select(F.col("rep").alias("copy_of"), F.col("size").alias("_rows")), "copy_of", "left")
    found = Staged(found.withColumn("_rows", F.coalesce("_rows", one)), "near-classes")
    return with_unique(named, found, ["copy_of"], "_rows", total, "left").select(
        F.col("id").alias("doc_id"), "copy_of", F.coalesce("size", one).alias("copies"), F.coalesce("root", "copy_of").alias("class_id"), F.coalesce("links", one - 1).alias("n_links"), F.coalesce("near", one - 1).alias("n_near")
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of docs from each class, its least id's, with all its columns, whatever their names.

    Rows that share an id, or have none, count by their order. Null and wordless texts stay, each in a class of its own;
    texts may have any length; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    all_rows, number, gone_id = fresh(docs.columns, "_all", "_number", "_gone")
    n, distinct = docs.agg(F.count(F.lit(1)), F.count_distinct(F.col(f"`{id_col}`"))).first()
    rows, key = docs, id_col
    if n != distinct:
        rows, key = Staged(slots(docs.withColumn(all_rows, F.lit(0)), all_rows, [id_col, text_col], number), "numbered-docs").df, number
    found = _near_classes(rows.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")))
    gone = Staged(found.where("class_id <> doc_id").select(F.col("doc_id").alias(gone_id)), "near-copies")
    return without(rows, key, gone).select(*(F.col(f"`{c}`") for c in docs.columns))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(documents(spark, sf_dir))
