"""Array and number columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(c: Column, use: Callable[[Column], Column]) -> Column:
    """use(c), with c evaluated once however often `use` reads it, also within lambdas."""
    return F.transform(F.array(c), use)[0]


def ordered_union(*arrays: Column) -> Column:
    """Elements in order of first occurrence."""
    return F.array_distinct(F.concat(*arrays))


def quoted(value: str) -> str:
    """A string literal of SQL."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def literal(values: list[str]) -> Column:
    return F.expr(f"cast(array({', '.join(map(quoted, values))}) as array<string>)")


def present(*pairs: tuple[Column, Column]) -> Column:
    """Of (condition, value) pairs the values whose condition holds, in order."""
    return F.filter(F.array(*(F.when(c, v) for c, v in pairs)), lambda x: x.isNotNull())


def lookup(a: Column, table: dict[str, str], default: str) -> Column:
    """Each element's entry, once each."""
    if not table:
        return F.array_distinct(F.transform(a, lambda _: F.lit(default)))
    own = F.create_map(*(F.lit(x) for kv in table.items() for x in kv))
    return F.array_distinct(F.transform(a, lambda t: F.coalesce(F.try_element_at(own, t), F.lit(default))))


def without_contained(a: Column, containers: dict[str, list[str]]) -> Column:
    """Without elements that stand as whole words within another element of the same array."""
    out = a
    for term, within in containers.items():
        if within:
            out = F.when(F.array_contains(a, term) & F.arrays_overlap(a, literal(within)), F.array_remove(out, term)).otherwise(out)
    return out


def capped_add(now: Column, more: Column | int, most: int) -> Column:
    return F.least(now + more, F.lit(most))


def weighted_sum(terms: Column, weights: dict[str, int], most: int, default: int = 2) -> Column:
    """The terms' weights, `default` for others, no more than `most`."""
    if weights:
        table = F.create_map(*(F.lit(x) for kv in weights.items() for x in kv))
        one = lambda t: F.coalesce(F.try_element_at(table, F.lower(t)), F.lit(default))
    else:
        one = lambda t: F.lit(default)
    return F.least(F.aggregate(terms, F.lit(0), lambda s, t: s + one(t)), F.lit(most))


def clamp(c: Column, low: int = 0, high: int = 100) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))
