import random
import re

import pytest
from pyspark.sql import functions as F

from newsloom.operators import aggregates as A
from newsloom.operators import archive as J
from newsloom.operators import evaluation as E
from newsloom.operators import facets as C
from newsloom.operators import matching as P
from newsloom.operators import scoring as S
from newsloom.operators.vocabulary import Stem, TermSet
from newsloom.plans import demo

TERMS = TermSet.of("t", ["арест", "ngo", "new york", "york", "a+b", "x", "york"])
TARGETS, ACTIONS = TermSet.of("t", ["активист", "ngo"]), TermSet.of("a", ["арест", "jail"])


def by_python(text, terms):
    own = sorted(dict.fromkeys(terms.terms), key=len, reverse=True)
    found = set(re.findall(r"(?<!\w)(?:" + "|".join(map(re.escape, own)) + r")(?!\w)", text))
    return [t for t in terms.terms if t in found]


def spans_by_python(text, terms):
    one = [r"(?<!\w)" + re.escape(t) + (r"(?!\w)" if t[-1].isascii() and t[-1].isalpha() else "") for t in terms.terms]
    return [m.span() for m in re.finditer("|".join(sorted(one, key=len, reverse=True)), text)]


def test_terms_and_spans_equal_python(spark):
    rng = random.Random(1)
    bits = ["арест", "арестован", "ngo", "congo", "new", "york", "new york", "a+b", "x", "активисты", "jail", "jailed", " ", " ", ", ", "-", "слово", " ngo ", " активист "]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(400)] + [""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    c = F.col("t")
    rows = df.select("t", P.find_terms(c, TERMS).alias("f"), P.spans(c, TARGETS.stems).alias("s"), P.related(c, TARGETS, ACTIONS, 6).alias("r"), P.any_term(c, TERMS).alias("any")).collect()
    hits = 0
    for r in rows:
        assert r.f == by_python(r.t, TERMS) and r.any == bool(r.f)
        t, a = spans_by_python(r.t, TARGETS), spans_by_python(r.t, ACTIONS)
        assert [tuple(s) for s in r.s] == t
        near = any((x[0] < y[1] and y[0] < x[1]) or 0 <= y[0] - x[1] <= 6 or 0 <= x[0] - y[1] <= 6 for x in t for y in a)
        assert r.r == near
        hits += near
    assert 20 < hits < 380


def test_many_terms_and_long_texts(spark):
    """Two hundred terms, some of which begin others, and more matches than one run of sums holds."""
    rng = random.Random(3)
    bits = ["ab", "ba", "арест", "new", "york", "x1", "été", "c++"]
    terms = TermSet.of("t", sorted({" ".join(rng.choice(bits) + rng.choice(["", "s", "ing"]) for _ in range(rng.randint(1, 3))) for _ in range(260)})[:200])
    texts = [rng.choice([" ", ", "]).join(rng.choice(bits) + rng.choice(["", "s", "ing", "z"]) for _ in range(n)) for n in (0, 1, 50, 700, 3000)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", P.find_terms(F.col("t"), terms).alias("f"), P.spans(F.col("t"), TARGETS.stems).alias("s"), P.spans(F.col("t"), terms.stems).alias("all")).collect()
    for r in rows:
        assert r.f == by_python(r.t, terms)
        assert [tuple(s) for s in r.s] == spans_by_python(r.t, TARGETS) and [tuple(s) for s in r.all] == spans_by_python(r.t, terms)
    assert max(len(r.all) for r in rows) > 1000


def test_related_rows_give_the_gap(spark):
    df = spark.createDataFrame([(1, "ngo word jail"), (2, "jail" + " " * 200 + "ngo"), (3, "арест арест"), (4, "активист арестован")], "k int, t string")
    assert sorted(map(tuple, P.related_rows(df, "k", "t", TARGETS, ACTIONS).collect())) == [(1, 6), (4, 1)]


def test_stems_and_phrases(spark):
    df = spark.createDataFrame([("это арестованный москвич", "ru"), ("the ngo of congo", "en")], "t string, l string")
    got = df.select(P.find_with_stems(F.col("t"), F.col("l"), TERMS, [Stem("moscow", r"москв\w*", "ru"), Stem("ngo", "ngo")]).alias("f"), P.phrase_present(F.col("t"), "NGO").alias("p"), P.contains_any(F.col("t"), ["ngo"]).alias("c"), P.stem_match(F.col("t"), r"арест\w*").alias("s")).collect()
    assert [tuple(r) for r in got] == [(["moscow"], False, False, "арестованный"), (["ngo"], True, True, "")]


@pytest.mark.parametrize("score, flags, level", [
    (80, {"global_hr_signal"}, "D"), (80, set(), "E"), (95, {"regional_context"}, "B"), (95, {"regional_context", "confirmed_activist_pressure"}, "A"), (99, {"regional_context", "confirmed_repression", "noise"}, "E"),
    (99, {"regional_context", "confirmed_repression", "non_news"}, "E"), (55, {"regional_context"}, "B"), (54, {"regional_context"}, "C"), (35, {"regional_context"}, "C"), (34, {"regional_context"}, "E"), (90, {"section_page", "regional_context"}, "F"),
])
def test_levels(spark, score, flags, level):
    df = spark.range(1).select(F.lit(score).alias("score"), *(F.lit(True).alias(f) for f in flags))
    assert S.decide(df).first().level == level


def test_priorities_and_relevance(spark):
    df = spark.createDataFrame([(s,) for s in (100, 90, 89, 60, 40, 20, 19, 0)], "score int")
    assert [r.priority for r in S.decide(df).orderBy(F.desc("score")).collect()] == ["ABSOLUE", "ABSOLUE", "TRÈS HAUTE", "HAUTE", "MOYENNE", "FAIBLE", "BRUIT", "BRUIT"]
    rows = spark.createDataFrame([(0, True, False, False), (90, False, True, False), (90, False, False, True), (90, False, True, True)], "score int, confirmed_journalist_pressure boolean, regional_context boolean, has_activist boolean")
    assert sorted((r.score, r.has_activist, r.regional_context, r.relevant) for r in S.decide(rows).collect()) == [(0, False, False, True), (90, False, True, False), (90, True, False, False), (90, True, True, True)]


def article(spark, *rows):
    return spark.createDataFrame([(k, *r, "src1", "en") for k, r in enumerate(rows)], "doc_id int, title string, summary string, body string, source string, language string")


def test_score(spark):
    df = article(spark, ("nothing here", "", ""), ("the activists this", "was jailed from", "the the with from"), ("the que", "", ""), (None, None, None))
    got = {r.doc_id: r for r in S.score(df, demo.LEXICON).collect()}
    assert got[0].score == 0 and got[0].level == "E" and got[0].reasons == ["cap: no regional anchor"]
    assert got[1].signals.confirmed_activist_pressure and got[1].relevant and got[1].theme == "Activistes / dissidents sous pression"
    assert got[1].signals.geography_score == 15 and got[1].signals.target_score == 20
    assert got[2].level == "E" and "noise" in got[2].reasons
    assert got[3].score == 0 and all(0 <= r.score <= 100 for r in got.values())
    ok, errors = S.score_batch(df, demo.LEXICON)
    assert ok.count() == 3 and errors.first().error == "missing title"


def test_score_ignores_age_and_takes_no_more_than_the_regional_cap(spark):
    df = article(spark, ("this was from by", "", ""), ("dans une nicht", "", ""))
    assert all(r.score <= 20 for r in S.score(df, demo.LEXICON).collect())
    a = [r.score for r in S.score(df.withColumn("date", F.lit("2001-01-01").cast("timestamp")), demo.LEXICON).orderBy("doc_id").collect()]
    assert a == [r.score for r in S.score(df, demo.LEXICON).orderBy("doc_id").collect()]


def test_facets_and_rules(spark):
    df = article(spark, ("the this", "", "from this"), ("nothing", "", "der"), (None, None, None)).withColumn("url", F.lit("http://a.org/x")).withColumn("date", F.lit("2024-05-01").cast("timestamp"))
    got = {r.doc_id: r for r in C.apply_rules(C.describe(df, demo.FACETS, F.lit("2024-05-11").cast("timestamp")), demo.RULES).collect()}
    assert got[0].geo == ["nord"] and got[0].geo_role == C.SUBJECT and got[0].acteur == ["presse"] and got[0].traitement == ["arret"] and got[0].traitement_role == C.MENTION and got[0].relation_acteur_traitement
    assert got[0].pertinent and got[0].motif == "pertinent" and got[0].age_jours == 10 and got[0].preuves_acteur["presse"].head == ["this"]
    assert got[1].acteur == ["juges"] and got[1].acteur_role == C.MENTION and got[1].motif == "hors périmètre géographique retenu"
    assert got[2].geo == [] and got[2].acteur == ["aucun"] and got[2].geo_role == C.ABSENT and got[2].type == "navigation"
    none = C.apply_rules(C.describe(df, C.FacetConfig(), F.lit("2024-05-11").cast("timestamp")), C.Rules()).collect()
    assert all(r.pertinent for r in none)


def test_merges(spark):
    rows = lambda data, ddl="key string, body string, date string, seq int": spark.createDataFrame(data, ddl)
    df = rows([("a", "1", None, 2), ("a", "2", None, 1), ("", "3", None, 0), (None, "4", None, 0), ("b", "5", None, 3)])
    assert sorted((r.key, r.body) for r in J.keep_first(df, "key", "seq").collect()) == [("a", "2"), ("b", "5")]
    assert sorted((r.key, r.body) for r in J.keep_last(df, "key", "seq").collect()) == [("a", "1"), ("b", "5")]
    archive = rows([("a", "old", None), ("c", "", "2024")], "key string, body string, date string")
    grown = J.merge_scan(archive, df, "key", "seq")
    assert sorted((r.key, r.body) for r in grown.collect()) == [("a", "old"), ("b", "5"), ("c", "")]
    updates = rows([("a", "longer", "2020", 1), ("a", "longe2", "2021", 2), ("a", "x", "2022", 0), ("c", "", "2023", 1)])
    once = J.backfill_dates(J.backfill_bodies(archive, updates, "key", "seq"), updates, "key", "seq")
    assert sorted(map(tuple, once.collect())) == [("a", "longer", "2022"), ("c", "", "2024")]
    assert sorted(map(tuple, J.backfill_bodies(once, updates, "key", "seq").collect())) == sorted(map(tuple, once.collect()))
    merged = {r.key: r for r in J.merge_archives(archive, rows([("a", "longer", "x"), ("d", "n", None)], "key string, body string, date string"), "key").collect()}
    assert merged["a"].change == "body and date" and merged["c"].change == "kept" and merged["d"].change == "added" and merged["a"].date == "x"
    old = spark.createDataFrame([("a", "t0")], "key string, seen string")
    assert sorted(map(tuple, J.last_seen(grown, df.where("key = 'b'"), old, F.lit("t1"), "key").collect())) == [("a", "t0"), ("c", "t1")]
    assert J.priority_union(df.where("key = 'a'"), df, "key").count() == 5
    assert {r.body for r in J.body_from_archive(df.where("key = 'b'"), archive.withColumn("key", F.lit("b")).limit(1), "key").collect()} == {"old"}


def test_reports(spark):
    df = spark.createDataFrame([(["k"], None), (["k", "r"], "x"), ([], "aucun")], "geo array<string>, kind string")
    axes = {"geo": None, "kind": "aucun"}
    assert sorted(tuple(r) for r in A.facet_counts(df, axes).collect()) == [("geo", "k", 2), ("geo", "r", 1), ("kind", "x", 1)]
    assert sorted(tuple(r) for r in A.facet_coverage(df, axes).collect()) == [("geo", 2, 3, 66.7), ("kind", 1, 3, 33.3)]
    foot = " " + "word " * 30 + "end of page"
    rows = spark.createDataFrame([("s", f"text {k} {'x' * k}" + foot) for k in range(8)] + [("t", "no footer " * 40 + str(k)) for k in range(3)], "source string, body string")
    got = {r.source: r.suffix for r in A.shared_suffix(rows, "source", "body").collect()}
    assert list(got) == ["s"] and foot.strip().endswith(got["s"]) and len(got["s"]) >= 150
    with pytest.raises(A.CorpusCollapse):
        A.guard_size(4, 10)
    A.guard_size(5, 10)
    done = A.grouped_in_order(spark.createDataFrame([("b", 1), ("a", 2), ("b", 0)], "g string, seq int"), "g", F.when(F.col("g") == "b", 0).otherwise(1), ["seq"], "seq").collect()
    assert [(r.g, r.n) for r in done] == [("b", 2), ("a", 1)]


def test_evaluation(spark):
    df = spark.createDataFrame([(True, True), (False, False), (True, False), (False, True), (True, None)], "relevant boolean, verdict boolean").withColumn("k", F.monotonically_increasing_id().cast("string")).withColumn("seq", F.lit(0)).withColumn("score", F.lit(1))
    c = E.compare(df.drop("verdict"), df.select("k", "verdict"), "k", "seq")
    r = E.agreement(c).first()
    assert (r.both, r.neither, r.only_score, r.only_judge, r.no_verdict, r.agreement) == (1, 1, 1, 1, 1, 0.5)
    m = df.agg(*E.measure(F.col("relevant"), F.col("verdict"))).first()
    assert (m.tp, m.fp, m.fn, m.tn, m.precision, m.recall, m.f1) == (1, 1, 1, 1, 0.5, 0.5, 0.5)
    assert df.limit(0).agg(*E.measure(F.col("relevant"), F.col("verdict"))).first().f1 == 0
    words = lambda w: spark.createDataFrame([(x,) for x in w], "word string")
    assert [tuple(r) for r in E.over_represented(words(["a"] * 4 + ["b"] * 4), words(["b"] * 40)).collect()] == [("a", 4, 20.0)]
    assert [r.bucket for r in E.to_review(c, "k", 1, 2, 0).collect()] == ["only_judge", "only_score"]


def test_no_task_gets_all_bodies_of_a_group(spark, monkeypatch):
    """Bodies stay where they are, or those of one group are dealt to many tasks; suffixes are the same."""
    tail = " " + "all rights reserved " * 10
    rows = spark.createDataFrame([("a" if k % 8 else "b", f"{k} " * (k % 40 + 120) + (tail if k % 3 else "")) for k in range(200)], "g string, b string")
    state = rows.groupBy("g").agg(F.lit(1).alias("need"))
    assert "Exchange hashpartitioning" not in A._with_groups(rows, A._kept(state))._jdf.queryExecution().executedPlan().toString()
    few = {r.g: r.suffix for r in A.shared_suffix(rows, "g", "b").collect()}
    monkeypatch.setattr(A, "BROADCAST_GROUPS", -1)
    dealt = A._with_groups(rows, A._kept(state))
    assert {r.g: r.suffix for r in A.shared_suffix(rows, "g", "b").collect()} == few and set(few) == {"a", "b"} and dealt.count() == 200
    assert dealt.columns == ["g", "b", "need"] and "_part" in dealt._jdf.queryExecution().optimizedPlan().toString()


def test_words_scanned_once_give_what_each_scan_gives(spark):
    """Sets of single words, of longer terms, of terms that no word begins, and of letters of other scripts, by one scan and each by its own."""
    sets = [TermSet.of("s", t) for t in (["aa", "b", "c_1"], ["aa b", "b", "aa"], ["b-b", "é"], ["-b", "aa"], ["aa 漢", "b"], ["漢"], ["b", "aa", "b"], ["", "aa"], [], ["ée b"], ["b́", "aa"])]
    rng, parts = random.Random(9), ["aa", "b", "c_1", "é", "ée", "漢", "-", " ", " ", ".", "x", "b́", "c"]
    rows = [("".join(rng.choice(parts) for _ in range(rng.randint(0, 12))),) for _ in range(400)]
    c, words, out = F.col("t"), F.col("w"), {}
    for k, own in enumerate(sets):
        out |= {f"f{k}": (P.find_terms(c, own), P.find_terms(c, own, words)), f"a{k}": (P.any_term(c, own), P.any_term(c, own, words))}
        other = sets[(k + 1) % len(sets)]
        gap = F.coalesce(P.least_gap(c, own, other) <= 2, F.lit(False)) if any(own.terms) and any(other.terms) else F.lit(False)
        out |= {f"r{k}": (gap, P.related(c, own, other, 2, words)), f"q{k}": (gap, P.related(c, own, other, 2))}
    twice = TermSet.of("t", ["aa", "x"])
    out["both"] = (F.coalesce(P.least_gap(c, twice, sets[0]) <= 2, F.lit(False)), P.related(c, twice, sets[0], 2, words))
    df = spark.createDataFrame(rows, "t string").withColumn("w", P.head_words(c, [*sets, twice]))
    unlike = {n: F.count_if(~a.eqNullSafe(b)).alias(n) for n, (a, b) in out.items()}
    assert df.agg(*unlike.values()).first().asDict() == dict.fromkeys(out, 0)
    held = df.agg(*(F.count_if(out[n][1]).alias(n) for n in ("r0", "both", "a0", "a1"))).first()
    assert all(0 < n < 400 for n in held)


def test_a_score_scans_a_zone_once(spark):
    """Each set of terms had a scan of its own; with sets of single words there is one for each zone."""
    df = spark.createDataFrame([("a", "b")], "title string, body string")
    plan = S.signals(S.zones(df), demo.LEXICON)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("(?U)(?=[") <= 4 < plan.count("_words")
