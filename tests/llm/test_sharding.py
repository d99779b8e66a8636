import hashlib
import math
import zlib
from collections import Counter, defaultdict

from newsloom.llm import sharding as sh


def test_query(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = sh.op5_shard_tree(spark, sf).collect()
    assert len(rows) == len(docs)
    slots = defaultdict(list)
    for r in rows:
        assert r.size == len(docs[r.doc_id].encode()) + 16 and r.text_crc32 == zlib.crc32(docs[r.doc_id].encode()) and r.law == "key"
        assert 0 <= r.shard < 40 and r.grown_shard in (r.shard, 40)
        slots[r.shard].append((r.slot, r.doc_id))
    for own in slots.values():
        assert [s for s, _ in sorted(own)] == list(range(len(own)))
        assert [i for _, i in sorted(own)] == sorted(i for _, i in own)


def placed(spark, tree, n=20_000):
    return [r.s for r in sh.assign(spark.range(n), "id", tree, "s").orderBy("id").collect()]


def test_even_and_growth_takes_only_into_the_new_shard(spark):
    before = placed(spark, sh.Tree.of(40))
    count = Counter(before)
    assert len(count) == 40 and max(count.values()) < 1.25 * 500 and min(count.values()) > 0.75 * 500
    for n in (41, 42, 43):
        after = placed(spark, sh.Tree.of(n))
        assert all(b in (a, n - 1) for a, b in zip(before, after))
        assert 0.6 / n < sum(b == n - 1 for b in after) / len(after) < 1.5 / n
        before = after


def test_weights_move_only_their_subtrees(spark):
    tree = sh.Tree.of(40)
    region = tree.regions[1]
    heavier = sh.Tree((tree.regions[0], (((region[0][0][0], 3.0), *region[0][1:]), region[1]), *tree.regions[2:]))
    inside = {s for rack in region for s, _ in rack}
    a, b = placed(spark, tree), placed(spark, heavier)
    moved = [(x, y) for x, y in zip(a, b) if x != y]
    assert moved and all(y in inside for _, y in moved)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(sh, "RANGE_ROWS", 3)
    df = spark.createDataFrame([(None,), (None,), *[(5,)] * 12, *[(k,) for k in range(10)]], "k long")
    rows = sh.slots(sh.assign(df, "k", sh.Tree.of(3, 3), "s"), "s", ["k"], "slot").collect()
    assert len({r.s for r in rows if r.k == 5}) == 1 and len({r.s for r in rows if r.k is None}) == 1
    by = defaultdict(list)
    for r in rows:
        by[r.s].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert sh.slots(sh.assign(df.limit(0), "k", sh.Tree.of(3), "s"), "s", ["k"], "slot").count() == 0


def by_hand(tree, key):
    """A key's way down the tree in plain Python."""

    def least(children):
        def draw(child):
            u = (int(hashlib.md5(f"{child[0]}:{key}".encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)
            return -math.log(u) / child[1]

        return min(children, key=draw)[2]

    weight = lambda rack: sum(w for _, w in rack)
    g = least([(f"g{g}", sum(map(weight, region)), g) for g, region in enumerate(tree.regions)])
    r = least([(f"g{g}r{r}", weight(rack), r) for r, rack in enumerate(tree.regions[g])])
    return least([(f"s{s}", w, s) for s, w in tree.regions[g][r]])


def test_placement_equals_plain_python(spark):
    heavy = sh.Tree((((((0, 2.5), (1, 1.0)), ((2, 0.5),))), (((3, 1.0),), ((4, 3.0), (5, 1.0), (6, 0.25)))))
    for tree in (sh.Tree.of(40), sh.Tree.of(41), sh.Tree.of(3, 3), heavy):
        assert placed(spark, tree, 3000) == [by_hand(tree, k) for k in range(3000)]


def test_names_that_clash(spark):
    names = ["_g", "_r", "_s", "_row", "_part", "_n", "_base", "_k"]
    df = spark.range(50).selectExpr("id", *(f"{k} AS {n}" for k, n in enumerate(names)))
    out = sh.slots(sh.assign(df, "id", sh.Tree.of(40), "shard"), "shard", ["id"], "slot")
    assert out.columns == ["id", *names, "shard", "slot"]
    rows = out.collect()
    assert len(rows) == 50 and all(tuple(r[1:9]) == tuple(range(8)) for r in rows)
    assert {r.id: r.shard for r in rows} == dict(enumerate(placed(spark, sh.Tree.of(40), 50)))
