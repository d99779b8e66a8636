"""Spans near others, by join: equal to a comparison of all pairs and to the expression on whole texts."""

import random

import pytest

from newsloom.operators import intervals as N
from newsloom.operators import matching as P
from newsloom.operators.vocabulary import TermSet

TARGETS, ACTIONS = TermSet.of("t", ["активист", "ngo", "a b"]), TermSet.of("a", ["арест", "jail", "b"])


def gap(x, y):
    return max(0, x[0] - y[1], y[0] - x[1])


def by_pairs(left, right, window):
    out = {}
    for k, s, e in set(left):
        own = [gap((s, e), (a, b)) for j, a, b in right if j == k and b >= a]
        if k is not None and e >= s and own and min(own) <= window:
            out[(k, s, e)] = min(own)
    return out


@pytest.mark.parametrize("window,width", [(0, 1), (0, None), (3, 5), (7, 1000), (25, None)])
def test_nearest_equals_all_pairs(spark, window, width):
    rng = random.Random(window)
    made = lambda n, longest: [(rng.choice([1, 2, None]), (s := rng.randint(-40, 400)), s + rng.randint(-1, longest)) for _ in range(n)]
    left, right = made(120, 90), made(40, 60)
    left += left[:5]  # repeats
    right += right[:5]
    df = lambda rows: spark.createDataFrame(rows, "k long, s long, e long").selectExpr("k AS `the.key`", "s", "e", "'x' AS _bucket", "1 AS gap")
    rows = N.nearest(df(left), df(right), "the.key", window, width).collect()
    got = {(r[0], r.s, r.e): r.gap for r in rows}
    assert len(rows) == len(got) and got == by_pairs(left, right, window)
    assert 0 < len(got) < 120


def test_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(1, None, 3), (1, 1, None), (None, 1, 2), (1, 5, 6)], "k long, s long, e long")
    assert [tuple(r) for r in N.nearest(df, df, "k", 2).collect()] == [(1, 5, 6, 0)]
    assert N.nearest(df.limit(0), df, "k").collect() == [] and N.nearest(df, df.limit(0), "k").collect() == []


@pytest.mark.parametrize("window", [0, 6, 140])
def test_whole_texts_equal_the_expression(spark, window):
    rng = random.Random(5)
    bits = ["арест", "арестован", "ngo", "congo", "a b", "активисты", "jail", "jailed", " ", " ", ", ", "-", "слово ", " ngo ", " активист ", "b"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.choice([0, 4, 14, 300, 6000]))) for _ in range(60)] + ["", None, "ngo" + " x" * 200 + " jail"]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    got = sorted(map(tuple, N.related_by_join(df, "k", "t", TARGETS, ACTIONS, window).collect()))
    assert got == sorted(map(tuple, P.related_rows(df, "k", "t", TARGETS, ACTIONS, window).collect())) and len(got) > 10


def test_one_long_text_goes_to_many_groups(spark):
    """Every other word a target or an action: rows grow with the spans, and no group holds more than a bucket."""
    n = 20_000
    df = spark.createDataFrame([(1, "ngo jail " * n)], "k long, t string")
    targets, actions = N.span_rows(df, "k", "t", TARGETS), N.span_rows(df, "k", "t", ACTIONS)
    near = N.nearest(targets, actions, "k", 140)
    assert near.count() == n and near.selectExpr("max(gap)").first()[0] == 1
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "_bucket" in plan
