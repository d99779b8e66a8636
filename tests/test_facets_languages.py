from pyspark.sql import functions as F

from newsloom.operators import facets as C
from newsloom.operators.vocabulary import Stem

CONFIG = C.FacetConfig(
    places={"узбекистан": "uz", "дағыстан": "ru", "xinjiang": "cn"},
    place_stems=(Stem("Узбекистан", r"\bузбекистан\w*\b", "ru"), Stem("дағыстан", r"\bдағыстан\w*\b")),
    actors={"presse": ("журналист",), "minorite": ("ouïghour",)},
    treatments={"arret": ("арест",)},
    inherits={"cn": "minorite"},
    relations_fa={"presse": (r"خبرنگار.{0,100}بازداشت",), "opposant": (r"فعال.{0,100}زندان",)},
    repression_ru=(r"\bзадерж\w*",),
    source_hints=("rfe", "asia"),
)


def described(spark, *rows):
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id int, title string, body string, language string, source string")
    return {r.doc_id: r for r in C.describe(df, CONFIG, F.lit("2024-05-11").cast("timestamp")).collect()}


def test_inflected_places(spark):
    long = "обычный русский текст без имён"
    got = described(spark, ("власти узбекистана", long, "ru", ""), (long, "в узбекистане", "multi", ""), ("узбекистана", "", "kk", ""), ("дағыстанда", "", "kk", ""))
    assert [got[k].geo for k in range(4)] == [["uz"], ["uz"], [], ["ru"]]
    assert [got[k].geo_role for k in range(4)] == [C.SUBJECT, C.MENTION, C.ABSENT, C.SUBJECT]
    assert got[1].preuves_geo.head == [] and got[1].preuves_geo.body == ["узбекистан"]


def test_farsi_patterns_give_actor_role_and_relation(spark):
    words = "خبرنگار در تهران بازداشت شد و دیگران آزاد شدند"
    got = described(spark, (words, "", "fa", ""), ("x", words + " فعال سیاسی در زندان", None, ""), (words, "", "ar", ""))
    assert got[0].acteur == ["presse"] and got[0].acteur_role == C.SUBJECT and got[0].relation_acteur_traitement and got[0].traitement == ["aucun"]
    assert got[1].acteur == ["presse", "opposant"] and got[1].acteur_role == C.MENTION and got[1].relation_acteur_traitement
    assert got[1].preuves_acteur["opposant"].by == [C.BY_PATTERN] and got[1].preuves_relation.via_motif_farsi
    assert got[2].acteur == ["aucun"] and not got[2].relation_acteur_traitement and got[2].preuves_relation is None


def test_source_hints_are_whole_words_and_evidence_is_there(spark):
    got = described(spark, ("x", "", "en", "Malaysiana"), ("xinjiang", "", "en", "RFE Asia"), ("журналист", "арест", "ru", ""), ("его задержали", "", "ru", ""))
    assert not got[0].source_specialisee and got[0].preuves_source == []
    assert got[1].source_specialisee and got[1].preuves_source == ["rfe", "asia"]
    assert got[1].acteur == ["minorite"] and got[1].preuves_acteur["minorite"].by == ["(déduit de geo=cn)"]
    assert got[2].preuves_relation.acteur == ["журналист"] and got[2].preuves_relation.traitement == ["арест"] and not got[2].preuves_relation.via_motif_farsi
    assert got[3].traitement == ["aucun"] and C.UNTYPED in got[3].preuves_traitement
