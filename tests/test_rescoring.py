"""Rules that change, texts that come: the history's scores are those of a whole run, and what is not touched stays where it is."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from newsloom.operators import facets
from newsloom.operators import scoring as S
from newsloom.operators.vocabulary import Stem
from newsloom.plans import demo
from newsloom.sources import configs as G
from newsloom.sources import rescoring as R
from newsloom.sources import snapshots as V

WORDS = ["from", "the", "this by", "was", "les zebra", "xx", "une", "", "qui", "für"]
OLD = demo.LEXICON


def land(spark, path, low, high, scan):
    rows = [(f"k{i}", WORDS[i % 10], f"{WORDS[i // 10 % 10]} {WORDS[i % 7]}" if i % 9 else None, "src7" if i % 11 == 0 else "s", None, i) for i in range(low, high)]
    return V.commit_scan(spark.createDataFrame(rows, "key string, title string, body string, source string, date string, seq int"), path, scan, buckets=8)


def check(spark, path, lexicon):
    got = {r.key: tuple(r[c] for c in R.SCORE) for r in R.scores(spark, path).collect()}
    want = {r.key: tuple(r[c] for c in R.SCORE) for r in S.score(V.table(spark, path, "archive", V.version(spark, path)), lexicon).collect()}
    assert got == want


def test_history_under_new_rules(spark, tmp_path):
    path = f"file://{tmp_path}/v"
    assert R.rescore(spark, path, OLD).n == 0
    land(spark, path, 0, 60, "s1")
    first = R.rescore(spark, path, OLD)
    assert first.n == 2 and R.rescore(spark, path, OLD).n == 2
    check(spark, path, OLD)
    new = replace(OLD, sets=OLD.sets | {"repression": ("from",), "noise": ("que", "zebra")}, weights={"repression": {"from": 3}, "rights": {"are": 4}})
    assert R.changed_terms(OLD, new) == ["from", "une", "zebra"]
    second = R.rescore(spark, path, new)
    assert second.facts["scored"]["scored_anew"] == [] and second.facts["scored"]["scored_in"]
    check(spark, path, new)
    # A term that no text has: other rules, the same parts.
    rare = replace(new, sets=new.sets | {"noise": ("que", "zebra", "nowhere")})
    third = R.rescore(spark, path, rare)
    assert third.n == 4 and third.tables["scores"] == second.tables["scores"]
    # New texts: only their buckets.
    land(spark, path, 60, 62, "s2")
    fourth = R.rescore(spark, path, rare)
    stale = set(fourth.facts["scored"]["scored_anew"])
    assert 0 < len(stale) <= 2 and all(fourth.tables["scores"][1][b] == p for b, p in third.tables["scores"][1].items() if int(b) not in stale)
    check(spark, path, rare)
    held = R.scores(spark, path, first)
    # Both at once, and rules that may show anywhere.
    land(spark, path, 62, 64, "s3")
    R.rescore(spark, path, OLD)
    check(spark, path, OLD)
    other = replace(OLD, patterns={"detention": (r"\bxx\b",)})
    assert len(R.rescore(spark, path, other).facts["scored"]["scored_anew"]) == 8
    check(spark, path, other)
    assert held.count() == 60


def test_a_run_that_breaks_off_changes_nothing(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/v"
    land(spark, path, 0, 20, "s1")
    before = R.rescore(spark, path, OLD)
    with monkeypatch.context() as m:
        m.setattr(R, "commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            R.rescore(spark, path, replace(OLD, sets=OLD.sets | {"noise": ("xx",)}))
    assert V.version(spark, path) == before
    check(spark, path, OLD)


def test_what_changes_between_lexicons():
    L = S.Lexicon
    assert R.changed_terms(L(), L()) == []
    assert R.changed_terms(L(sets={"a": ("B  c", "d")}), L(sets={"a": ("d", "b c")})) == ["b c", "d"]
    assert R.changed_terms(L(weights={"a": {"X": 1}}), L(weights={"a": {"X": 2}})) == ["x"]
    assert R.changed_terms(L(sets={"source_hints": ("a",)}), L()) is None
    assert R.changed_terms(L(stems={"region_1": (Stem("a", "b"),)}), L()) is None


def test_configurations_as_files(spark, tmp_path):
    full = replace(OLD, stems={"region_1": (Stem("a", r"\ba\w+", "ru"), Stem("b", "b"))}, patterns={"lgbt": ("é",)})
    for config in (full, demo.FACETS, demo.RULES, facets.Rules(), S.Lexicon()):
        path = tmp_path / f"{G.fingerprint(config)}.json"
        path.write_text(G.to_json(config))
        assert G.read_config(spark, str(path), type(config)) == config
    assert G.fingerprint(S.Lexicon(sets={"a": ("x",), "b": ()})) == G.fingerprint(S.Lexicon(sets={"b": (), "a": ("x",)})) != G.fingerprint(S.Lexicon(sets={"a": ("x",)}))
    for kind, told, where in (
        (S.Lexicon, '{"words": {}}', "words"), (S.Lexicon, '{"sets": {"a": "x"}}', r"sets\.a"), (S.Lexicon, '{"weights": {"a": {"x": true}}}', r"weights\.a\.x"), (S.Lexicon, '{"stems": {"a": [{"name": "n"}]}}', "pattern"),
        (S.Lexicon, '{"regions": [["a"]]}', r"regions\[0\]"), (facets.Rules, '{"need_relation": 1}', "need_relation"), (facets.Rules, "[]", "Rules"), (facets.Rules, "{torn", "not JSON"),
    ):
        with pytest.raises(G.ConfigError, match=where):
            G.from_json(kind, told)


def test_sets_from_a_table(spark):
    rows = spark.createDataFrame([("noise", 2, "B"), ("noise", 1, "z  Z"), ("new", 1, "a"), ("new", 2, " "), (None, 1, "c")], "list_id string, ord long, term string")
    got = G.with_table(OLD, rows)
    assert got.sets["noise"] == ("z z", "b") and got.sets["new"] == ("a",) and got.sets["press"] == OLD.sets["press"]
    with pytest.raises(G.ConfigError, match="more than 2"):
        G.with_table(OLD, rows, most=2)


def test_registry(spark, tmp_path):
    def of(told):
        path = tmp_path / f"{abs(hash(told))}.json"
        path.write_text(told)
        return G.registry(spark, str(path))

    lines = of('{"name": "a", "feeds": ["u"], "max_articles": 3, "odd": 1}\n{"name": "b"}\n')
    array = of('[\n {"name": "a", "feeds": ["u"], "max_articles": 3},\n {"name": "b"}\n]')
    assert sorted(lines.select("name", "feeds", "max_articles").collect()) == sorted(array.select("name", "feeds", "max_articles").collect()) and lines.count() == 2
    for bad in ('{"name": "a"}\n{"name": "a"}\n', '{"url": "a"}\n', '{"name": " "}\n', "[1]"):
        with pytest.raises(G.ConfigError):
            of(bad)
    assert lines.where(F.size("feeds") == 1).count() == 1


def test_texts_are_searched_once_for_changed_terms(spark, tmp_path, monkeypatch):
    """They were searched to find the buckets, to score them and to leave out their old scores."""
    path, seen = f"file://{tmp_path}/v", spark.sparkContext.accumulator(0)
    land(spark, path, 0, 30, "s1")
    R.rescore(spark, path, OLD)

    @F.udf("boolean")
    def near(text):
        seen.add(1)
        return "zebra" in text

    monkeypatch.setattr(R, "touched", lambda df, terms: near(F.col("_full")))
    new = replace(OLD, sets=OLD.sets | {"noise": ("que", "zebra")})
    assert R.rescore(spark, path, new).facts["scored"]["scored_in"]
    assert seen.value == 30
    check(spark, path, new)
