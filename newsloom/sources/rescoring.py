"""Scores of an archive's whole history, kept beside it: only what new texts or new rules touch is scored again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.matching import any_term
from ..operators.scoring import Lexicon, score, zones
from ..operators.vocabulary import TermSet, lowered
from .configs import fingerprint, from_json, to_json
from .snapshots import Version, commit, read_text, table, version, write_parts, write_text

#: What is kept of a score.
SCORE = ("language", "score", "level", "priority", "theme", "relevant", "reasons")


def changed_terms(old: Lexicon, new: Lexicon) -> list[str] | None:
    """Terms such that a text without any of them has the same score under both; None if any text may change.

    Terms that came or went, those of a set whose order changed, and those whose weight did; a change of stems, patterns, regions or hints
    of sources may show anywhere.
    """
    if (old.stems, old.patterns, old.regions, old.sets.get("source_hints", ())) != (new.stems, new.patterns, new.regions, new.sets.get("source_hints", ())):
        return None
    out: set[str] = set()
    for name in {*old.sets, *new.sets}:
        a, b = old.terms(name).terms, new.terms(name).terms
        if a != b:
            out |= set(a) ^ set(b)
            kept = set(a) & set(b)
            if [t for t in a if t in kept] != [t for t in b if t in kept]:
                out |= kept
    for name in {*old.weights, *new.weights}:
        a, b = old.weights.get(name, {}), new.weights.get(name, {})
        out |= {lowered(t) for t in {*a, *b} if a.get(t) != b.get(t)}
    return sorted(out - {""})


def touched(df: DataFrame, terms: list[str]) -> Column:
    """Whether any zone of df's texts (of `zones`) has one of the terms."""
    own, found = TermSet.of("changed", terms), F.lit(False)
    for zone in ("_headline", "_primary", "_body", "_full"):
        found = found | any_term(F.col(zone), own)
    return found


def _scores(df: DataFrame, lexicon: Lexicon, key: str) -> DataFrame:
    return score(df, lexicon).select(F.col(key), *SCORE)


def rescore(spark: SparkSession, path: str, lexicon: Lexicon, key: str = "key") -> Version:
    """Brings the table `scores` of the snapshots at `path` up to date with their archive and the lexicon, in one commit.

    Buckets whose part of the archive is another than when they were scored are scored anew. Of the others, those with a text that has a
    changed term are written again, and in them only such texts are scored; the rest keep their part. Scores under the same
    rules of the same texts make no version. Readers keep the version that they have; a run that breaks off has changed nothing.
    """
    before = version(spark, path)
    if "archive" not in before.tables:
        return before
    parts, rules = before.tables["archive"][1], fingerprint(lexicon)
    done = before.facts.get("scored", {"rules": rules, "parts": {}})
    moved = {int(b) for b, p in parts.items() if done["parts"].get(b) != p}
    rest = sorted({int(b) for b in parts} - moved)
    buckets = before.facts["buckets"]
    hit: list[int] = []
    again = None
    if rest and done["rules"] != rules:
        terms = changed_terms(from_json(Lexicon, read_text(spark, f"{path}/rules/{done['rules']}.json")), lexicon)
        if terms is None:
            moved |= set(rest)
        elif terms:
            own = table(spark, path, "archive", before, rest)
            # As a row of its own the mark is made once, from zones made once: a filter that Spark moves below them would make each anew.
            near = zones(own).withColumn("_near", F.explode(F.array(touched(own, terms)))).where("_near").drop("_near")
            # Written before it is known which buckets they are in, so that texts are read and scored once.
            staged = write_parts(_scores(near, lexicon, key), path, "scores", key, before, buckets, [int(b) for b in before.tables["scores"][1]])
            hit = sorted(map(int, staged[1]))
            again = table(spark, path, "scores", Version(before.n, before.facts, {"scores": staged}))
    if not moved and done["rules"] == rules:
        return before
    write_text(spark, f"{path}/rules/{rules}.json", to_json(lexicon))
    found = {}
    if moved or hit:
        out = _scores(table(spark, path, "archive", before, sorted(moved)), lexicon, key)
        if hit:
            kept = table(spark, path, "scores", before, hit).join(again.select(key), key, "left_anti")
            out = out.unionByName(kept).unionByName(again)
        found = {"scores": write_parts(out, path, "scores", key, before, buckets, sorted(moved | set(hit)))}
    return commit(spark, path, before, found, {"scored": {"rules": rules, "parts": parts, "scored_anew": sorted(moved), "scored_in": hit}})


def scores(spark: SparkSession, path: str, at: Version | None = None) -> DataFrame:
    """The archive with its scores, both of one version; texts that came since they were scored have null scores."""
    at = at or version(spark, path)
    own, known = table(spark, path, "archive", at), table(spark, path, "scores", at)
    hidden = [c for c in own.columns if c in SCORE]
    (key,) = [c for c in known.columns if c not in SCORE]
    return own.drop(*hidden).join(known, key, "left")
