"""Terms, stems and proximity in normalised text columns, as Catalyst expressions.

What a lambda captures is evaluated again for each element. Columns that are costly (scans of a text) are therefore bound
once, as the only element of an array, before a lambda reads them.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import bound, literal, quoted
from .vocabulary import Stem, TermSet, lowered, quote

#: Most characters between two spans that count as related.
WINDOW = 140
#: Lengths that are summed up in one go; the sums of such runs are then summed.
_RUN = 64


def phrase_present(c: Column, phrase: str) -> Column:
    return c.rlike(rf"(?U)(?<!\w){quote(lowered(phrase))}(?!\w)")


def head_words(c: Column, sets: list[TermSet]) -> Column:
    """The words of c that terms of the sets begin with, once each: one scan for all sets.

    The functions below take it as `words`, a column that is evaluated once: a set of single words needs no scan of its own then, and one with
    longer terms only in texts that have the first word of one.
    """
    own = TermSet("words", tuple(dict.fromkeys(w for s in sets for w in (*(s.heads or ()), *(s.stem_heads or ())))))
    return F.array_distinct(F.regexp_extract_all(c, F.lit(own.whole_words), F.lit(0))) if own.terms else literal([])


def _single(terms: TermSet) -> bool:
    return terms.heads is not None and set(terms.heads) == {t for t in terms.terms if t}


def any_term(c: Column, terms: TermSet, words: Column | None = None) -> Column:
    if words is None or not terms.heads:
        return c.rlike(terms.whole_words)
    near = F.arrays_overlap(words, literal(terms.heads))
    return near if _single(terms) else near & c.rlike(terms.whole_words)


def find_terms(c: Column, terms: TermSet, words: Column | None = None) -> Column:
    """The terms found by a leftmost scan without overlaps, in the set's order; a term within a longer match is not found."""
    if not any(terms.terms):
        return literal([])
    if words is not None and terms.heads is not None and not _single(terms):
        return F.when(F.arrays_overlap(words, literal(terms.heads)), find_terms(c, terms)).otherwise(literal([]))
    scanned = F.regexp_extract_all(c, F.lit(terms.whole_words), F.lit(0))
    found, own = words if words is not None and _single(terms) else scanned, literal(list(terms.terms))
    if len(set(terms.terms)) == len(terms.terms):
        return F.array_intersect(own, found)
    return bound(F.array_distinct(found), lambda f: F.filter(own, lambda t: F.array_contains(f, t)))  # keeps repeats


def any_pattern(c: Column, patterns: list[str]) -> Column:
    return c.rlike("(?isU)" + "|".join(f"(?:{p})" for p in patterns)) if patterns else F.lit(False)


def find_with_stems(c: Column, language: Column, terms: TermSet, stems: list[Stem], words: Column | None = None) -> Column:
    """find_terms, then the names of stems that match and are not there yet."""
    if not stems:
        return find_terms(c, terms, words)
    hits = [F.when((F.lit(True) if s.language is None else language == s.language) & c.rlike("(?iU)" + s.pattern), F.lit(s.name)) for s in stems]
    named = F.filter(F.array(*hits), lambda x: x.isNotNull())
    return bound(find_terms(c, terms, words), lambda found: F.concat(found, F.array_except(named, found)))


def stem_match(c: Column, pattern: str) -> Column:
    return F.regexp_extract(c, "(?iU)" + pattern, 0)


def contains_any(c: Column, parts: list[str]) -> Column:
    """Substrings without word bounds."""
    out = F.lit(False)
    for p in parts:
        out = out | F.contains(c, F.lit(p))
    return out


# Spans and gaps are SQL text, which the JVM parses at once: built by calls, each part is a trip from Python, and a relation takes seconds.


def _once(value: str, name: str, use: str) -> str:
    """SQL `use`, in which `name` stands for `value`, evaluated once."""
    return f"transform(array({value}), {name} -> {use})[0]"


def _sums(lengths: str) -> str:
    """The sum of all lengths up to each, itself included. Appending is quadratic, so runs of _RUN are summed apart."""
    added = "aggregate({0}, named_struct('at', {1}, 'out', cast(array() as array<bigint>)), (a, n) -> named_struct('at', a.at + n, 'out', array_append(a.out, a.at + n)), a -> a.out)"
    runs = f"transform(sequence(0, greatest(size(own) - 1, 0), {_RUN}), k -> slice(own, k + 1, {_RUN}))"
    totals = f"transform({runs}, r -> aggregate(r, 0L, (t, n) -> t + n))"
    all_runs = f"flatten(transform(both.runs, (r, k) -> {added.format('r', 'coalesce(get(both.ends, k - 1), 0L)')}))"
    ends = added.format(totals, "0L")
    return _once(f"cast({lengths} as array<bigint>)", "own", _once(f"named_struct('runs', {runs}, 'ends', {ends})", "both", all_runs))


def _spans(text: str, pattern: str) -> str:
    # Gap, match, gap, match, ...: a match ends where the sum of all lengths up to it ends.
    sizes = "flatten(zip_with(cut.gaps, cut.found, (g, f) -> array(length(g), coalesce(length(f), 0))))"
    of = _once(_sums(sizes), "at", "transform(sequence(0, size(cut.found) - 1), i -> named_struct('s', cast(at[2 * i] as int), 'e', cast(at[2 * i + 1] as int)))")
    cut = f"named_struct('found', regexp_extract_all({text}, {quoted(pattern)}, 0), 'gaps', split({text}, {quoted(pattern)}, -1))"
    return _once(cut, "cut", f"if(size(cut.found) > 0, {of}, cast(array() as array<struct<s:int,e:int>>))")


def _of_text(c: Column, sql: str) -> Column:
    """SQL over `text`, which stands for c."""
    return F.call_function("transform", F.array(c), F.expr(f"text -> {sql}"))[0]


def spans(c: Column, pattern: str) -> Column:
    """Start and end (from 0, end excluded) of each match, in order."""
    return _of_text(c, _spans("text", pattern))


def least_gap(c: Column, targets: TermSet, actions: TermSet) -> Column:
    """The least number of characters between a target and an action, 0 if they overlap; null if either is missing.

    Spans of one kind are in order and do not overlap, so that one pass over both kinds by start sees, for each, the
    nearest of the other kind before it.
    """
    tagged = [f"transform({_spans('text', own.stems)}, z -> named_struct('s', z.s, 'e', z.e, 'k', {k}))" for k, own in enumerate((targets, actions))]
    end = lambda k, name: f"if(x.k = {k}, greatest(cast(x.e as bigint), g.{name}), g.{name})"
    step = f"named_struct('target', {end(0, 'target')}, 'action', {end(1, 'action')}, 'best', least(g.best, greatest(0L, x.s - if(x.k = 0, g.action, g.target))))"
    far = 1 << 40
    best = f"aggregate(array_sort(concat({tagged[0]}, {tagged[1]})), named_struct('target', {-far}L, 'action', {-far}L, 'best', {far}L), (g, x) -> {step}, g -> g.best)"
    return _of_text(c, f"if(text rlike {quoted(targets.stems)} and text rlike {quoted(actions.stems)}, {best}, null)")


def _near(targets: TermSet, actions: TermSet, window: int) -> str:
    """A pattern for sets of single words, which cannot overlap but where they are equal: one, at most `window` characters, the other."""
    t, a = (own.whole_words.removeprefix("(?U)") for own in (targets, actions))
    both = TermSet("both", tuple(x for x in targets.terms if x in actions.terms))
    ways = [f"{t}.{{0,{window}}}?{a}", f"{a}.{{0,{window}}}?{t}", *([both.whole_words.removeprefix("(?U)")] if any(both.terms) else [])]
    return "(?sU)" + "|".join(f"(?:{w})" for w in ways)


def related(c: Column, targets: TermSet, actions: TermSet, window: int = WINDOW, words: Column | None = None) -> Column:
    """Whether some target and some action overlap or stand within `window` characters, in either order."""
    if not any(targets.terms) or not any(actions.terms):
        return F.lit(False)
    near = c.rlike(_near(targets, actions, window)) if all(_single(own) and own.stem_heads for own in (targets, actions)) else F.coalesce(least_gap(c, targets, actions) <= window, F.lit(False))
    heads = [own.stem_heads for own in (targets, actions)] if words is not None else []
    both = [F.arrays_overlap(words, literal(h)) for h in heads if h is not None]
    return F.when(reduce(and_, both), near).otherwise(False) if both else near


def related_rows(df: DataFrame, key: str, text: str, targets: TermSet, actions: TermSet, window: int = WINDOW) -> DataFrame:
    """key, gap of the rows that have a target within `window` characters of an action; 0 if they overlap."""
    gaps = df.where(F.col(text).rlike(targets.stems) & F.col(text).rlike(actions.stems)).select(key, least_gap(F.col(text), targets, actions).alias("gap"))
    return gaps.where(F.col("gap") <= window)
