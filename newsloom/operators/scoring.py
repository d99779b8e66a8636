"""A deterministic score with its signals, level, priority, theme, relevance and reasons.

`score` is a chain of projections over normalised zones of an article: headline, primary (its first part), body, full.
Vocabularies come in a Lexicon; a set that it lacks is empty and matches nothing. Each chain link reads only the columns
of links before, so that no pattern runs twice. No column depends on the time of the run.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import capped_add, clamp, literal, ordered_union, present, weighted_sum
from ..functions.text import normalize, resolve_language, text
from .matching import any_pattern, any_term, contains_any, find_terms, find_with_stems, head_words, related
from .vocabulary import Stem, TermSet

# Zones in characters.
HEADLINE_SUMMARY, PRIMARY_SUMMARY, FULL_BODY = 3000, 1600, 12_000
# Bounds of levels and priorities.
LEVEL_A, LEVEL_B, LEVEL_C = 75, 55, 35
PRIORITIES = ((90, "ABSOLUE"), (75, "TRÈS HAUTE"), (60, "HAUTE"), (40, "MOYENNE"), (20, "FAIBLE"))
RELEVANT_FROM = 40
# Any of these raises a high score to level A.
CONFIRMATIONS = ("confirmed_activist_pressure", "confirmed_journalist_pressure", "severe_detected", "confirmed_repression", "primary_forced_labor", "primary_lgbt_pressure", "primary_press", "critical_hr_case")
# Themes by their first signal.
THEMES = (
    ("confirmed_activist_pressure", "Activistes / dissidents sous pression"),
    ("confirmed_journalist_pressure", "Journalistes sous pression"),
    ("primary_event_anchor", "Événement HR / répression régionale"),
    ("primary_transnational", "Répression transnationale"),
    ("primary_gender", "Droits des femmes / violences"),
    ("confirmed_repression", "Répression / droits humains"),
    ("has_specific_rights", "Droits spécifiques"),
    ("primary_political_context", "État de droit / espace civique"),
    ("primary_democracy", "État de droit / espace civique"),
    ("domestic", "Politique intérieure"),
    ("major_geo", "Géopolitique majeure"),
    ("historical", "Histoire / culture / contexte"),
    ("non_news", "Contenu institutionnel"),
    ("routine_geo", "Économie / géopolitique ordinaire"),
)
NO_THEME = "Faible priorité"
# A relevant article of the region has one of these.
RELEVANT_BY = ("has_activist", "has_journalist", "has_repression", "has_specific_rights", "has_human_rights", "major_geo", "primary_event_anchor", "primary_gender", "primary_political_context", "primary_democracy")

#: Sets that are looked for in the headline, and of these the ones also in the body.
HEADLINE_SETS = ("human_rights", "repression", "legal_repression", "specific_rights", "legal_context", "journalists", "activists", "defenders", "regional_hr", "domestic", "major_geo", "routine_geo", "actors", "historical", "non_news", "noise", "low_signal")
BODY_SETS = ("human_rights", "repression", "legal_repression", "specific_rights", "legal_context", "journalists", "activists")
#: Sets that are looked for in the primary zone as signals, and those that confirm in the body.
PRIMARY_SETS = {"primary_defender": "defenders", "primary_specific_right": "strong_rights", "primary_press": "press", "primary_gender": "gender", "primary_transnational": "transnational", "primary_political_prisoner": "prisoners", "primary_political_context": "strong_politics", "primary_democracy": "democracy"}
CONFIRM_SETS = ("hr_repression", "strong_rights", "press", "gender", "transnational", "strong_politics", "prisoners", "hr_actions")
#: All sets that are looked for in a zone, beside those of the regions in the headline and the body.
_LOOKED_FOR = {
    "_headline": HEADLINE_SETS,
    "_primary": (*PRIMARY_SETS.values(), "events", "hr_repression", "forced_labor", "journalists", "academics", "reform_topics", "other_topics", "soft_topics"),
    "_body": (*BODY_SETS, *CONFIRM_SETS, "events"),
    "_full": ("activists", "journalists", "targets", "hr_actions"),
}


@dataclass(frozen=True)
class Lexicon:
    """Term sets by name, stems and patterns by name, weights by name, and names of the three regions' sets."""

    sets: dict[str, tuple[str, ...]] = field(default_factory=dict)
    stems: dict[str, tuple[Stem, ...]] = field(default_factory=dict)
    patterns: dict[str, tuple[str, ...]] = field(default_factory=dict)
    weights: dict[str, dict[str, int]] = field(default_factory=dict)
    regions: tuple[tuple[str, str], ...] = (("region_1", "region 1"), ("region_2", "region 2"), ("region_3", "region 3"))

    def terms(self, name: str) -> TermSet:
        return TermSet.of(name, self.sets.get(name, ()))

    def pattern(self, name: str) -> list[str]:
        return list(self.patterns.get(name, ()))


def zones(df: DataFrame) -> DataFrame:
    """df with _title, _headline, _primary, _body and _full, normalised; missing columns count as empty. A df that has them stays as it is."""
    if "_full" in df.columns:
        return df
    own = lambda name: normalize(F.col(name)) if name in df.columns else F.lit("")
    df = df.withColumns({"_title": own("title"), "_summary": own("summary"), "_body": own("body")})
    df = df.withColumns({"_headline": F.trim(F.concat_ws(" ", "_title", F.substring("_summary", 1, HEADLINE_SUMMARY))), "_primary": F.trim(F.concat_ws(" ", "_title", F.substring("_summary", 1, PRIMARY_SUMMARY)))})
    return df.withColumn("_full", F.trim(F.concat_ws(" ", "_headline", F.substring("_body", 1, FULL_BODY)))).drop("_summary")


def _some(*names: str) -> Column:
    """Whether any of the boolean columns holds, or any of the array columns has elements ([name])."""
    return F.expr(" or ".join(["false", *(f"size(`{n[1:-1]}`) > 0" if n[0] == "[" else f"`{n}`" for n in names)]))


def signals(df: DataFrame, lexicon: Lexicon) -> DataFrame:
    """df of zones with a column for each signal."""
    t, p = lexicon.terms, lexicon.pattern
    head, prim, body, full = F.col("_headline"), F.col("_primary"), F.col("_body"), F.col("_full")
    body_start = F.substring("_body", 1, FULL_BODY)
    own = {zone: (*names, *(name for name, _ in lexicon.regions if zone in ("_headline", "_body"))) for zone, names in _LOOKED_FOR.items()}
    df = df.withColumns({f"{zone}_words": head_words(F.col(zone), [t(n) for n in names]) for zone, names in own.items()})
    in_head, in_prim, in_body, in_full = (F.col(f"{zone}_words") for zone in _LOOKED_FOR)
    source = normalize(F.concat_ws(" ", *(text(F.col(c)) for c in ("source", "source_label", "url") if c in df.columns)))
    declared = F.col("language") if "language" in df.columns else F.lit("")
    df = df.withColumn("language", resolve_language(declared, full))
    ru, fa = F.col("language") == "ru", F.col("language") == "fa"
    geo = {name: find_with_stems(head, F.col("language"), t(name), list(lexicon.stems.get(name, ())), in_head) for name, _ in lexicon.regions}
    body_geo = ordered_union(*(find_with_stems(body, F.col("language"), t(name), list(lexicon.stems.get(name, ())), in_body) for name, _ in lexicon.regions))
    df = df.withColumns(geo | {"body_geo": body_geo, "specialised_source": contains_any(source, list(t("source_hints").terms))})
    df = df.withColumns({name: find_terms(head, t(name), in_head) for name in HEADLINE_SETS} | {f"body_{name}": find_terms(body, t(name), in_body) for name in BODY_SETS})
    regions = [f"[{name}]" for name, _ in lexicon.regions]
    df = df.withColumn("body_geo_count", F.size("body_geo")).withColumn("has_geography", _some(*regions))
    df = df.withColumn("regional_context", F.col("has_geography") | F.col("specialised_source") | (F.col("body_geo_count") >= 2))
    flags = {f"has_{n}": any_pattern(full, p(n)) for n in ("detention", "imprisonment", "censorship", "government", "restriction")}
    df = df.withColumns(flags | {"events": find_terms(prim, t("events"), in_prim)})
    morphology = lambda c: ru & any_pattern(c, p("ru_repression"))
    first = {name: any_term(prim, t(which), in_prim) for name, which in PRIMARY_SETS.items()}
    first |= {
        "primary_event_anchor": F.size("events") > 0,
        "primary_repression": any_term(prim, t("hr_repression"), in_prim) | morphology(prim) | any_pattern(prim, p("primary_repression")),
        "primary_forced_labor": any_term(prim, t("forced_labor"), in_prim),
        "body_morphology": morphology(body_start),
    }
    first |= {f"confirm_{n}": any_term(body, t(n), in_body) for n in (*CONFIRM_SETS, "events")}
    first |= {"body_hr_repression": find_terms(body, t("hr_repression"), in_body), "body_strong_rights": find_terms(body, t("strong_rights"), in_body)}
    df = df.withColumns(first)
    custody = F.col("has_detention") | F.col("has_imprisonment")
    df = df.withColumns({
        "primary_journalist_pressure": any_term(prim, t("journalists"), in_prim) & _some("primary_repression", "primary_press", "has_censorship", "has_restriction"),
        "primary_academic_case": any_term(prim, t("academics"), in_prim) & (F.col("primary_repression") | custody),
        "primary_defender_case": F.col("primary_defender") & (F.col("primary_repression") | custody),
        "primary_lgbt_pressure": any_pattern(prim, p("lgbt")) & _some("primary_repression", "primary_specific_right", "primary_press"),
        "body_confirmation": _some(*(f"confirm_{n}" for n in CONFIRM_SETS), "body_morphology"),
    })
    df = df.withColumn("primary_hr_anchor", _some("primary_repression", "primary_defender_case", "primary_forced_labor", "primary_specific_right", "primary_press", "primary_gender", "primary_transnational", "primary_political_prisoner", "primary_journalist_pressure", "primary_academic_case", "primary_lgbt_pressure", "primary_event_anchor"))
    gap = lambda who: any_pattern(head, p(who)) | any_pattern(body_start, p(who)) | (ru & (any_pattern(head, p(f"{who}_ru")) | any_pattern(body_start, p(f"{who}_ru")))) | (fa & (any_pattern(head, p(f"{who}_fa")) | any_pattern(body_start, p(f"{who}_fa"))))
    df = df.withColumns({
        "activist_relation": gap("activist_pressure") | related(full, t("activists"), t("hr_actions"), words=in_full),
        "journalist_relation": gap("journalist_pressure") | related(full, t("journalists"), t("hr_actions"), words=in_full),
        "target_relation": related(full, t("targets"), t("hr_actions"), words=in_full),
    })
    df = df.withColumns({
        "has_activist": _some("[activists]", "[body_activists]", "primary_defender"),
        "has_journalist": _some("[journalists]", "[body_journalists]"),
        "has_hr_defender": _some("[defenders]", "primary_defender"),
        "has_specific_rights": _some("[specific_rights]", "[body_specific_rights]", "primary_specific_right"),
        "has_human_rights": _some("[human_rights]", "[body_human_rights]"),
        "has_repression": _some("[repression]", "[legal_repression]", "[body_repression]", "[body_legal_repression]", "primary_repression", "confirm_hr_repression"),
        "has_legal_context": _some("[legal_context]", "[body_legal_context]"),
        "severe_detected": any_pattern(full, p("severe")) | contains_any(full, list(t("severe").terms)),
        "prison_sentence": any_pattern(full, p("prison_sentence")),
    })
    regional = F.col("regional_context")
    df = df.withColumns({"confirmed_repression": regional & F.col("has_repression"), "confirmed_rights": regional & F.col("has_specific_rights"), "confirmed_activist_pressure": regional & F.col("activist_relation"), "confirmed_journalist_pressure": regional & F.col("journalist_relation")})
    case = _some("primary_repression", "primary_defender_case", "primary_forced_labor", "primary_journalist_pressure", "primary_academic_case")
    df = df.withColumn("critical_hr_case", regional & _some("has_activist", "has_hr_defender") & case & _some("confirmed_repression", "severe_detected") & _some("prison_sentence", "has_repression"))
    return df.withColumn("global_hr_signal", _some("has_activist", "has_journalist", "has_hr_defender", "severe_detected", "primary_defender_case", "primary_forced_labor", "primary_specific_right", "primary_press", "primary_gender", "primary_transnational", "primary_political_prisoner", "primary_journalist_pressure", "primary_academic_case", "primary_lgbt_pressure", "critical_hr_case"))


def _first_of(*pairs: tuple[Column, int], default: int = 0) -> Column:
    return F.coalesce(*(F.when(c, F.lit(v)) for c, v in pairs), F.lit(default))


def parts(df: DataFrame, lexicon: Lexicon) -> DataFrame:
    """df of signals with the six sub-scores, penalties, bonuses and the bounded sum."""
    has = F.col
    some = lambda n: F.size(n) > 0
    pressure = has("confirmed_activist_pressure") | has("confirmed_journalist_pressure")
    geography = _first_of((has("has_geography"), 12), (has("specialised_source"), 10))
    geography = F.when(has("has_geography") & (has("body_geo_count") > 0), capped_add(geography, 3, 15)).otherwise(geography)
    civil = contains_any(F.col("_headline"), ["civil society", "ngo"])
    target = _first_of((has("confirmed_activist_pressure"), 20), (has("confirmed_journalist_pressure"), 18), (has("has_activist"), 10), (has("has_journalist"), 7), (civil, 5))
    df = df.withColumns({
        "repression_terms": ordered_union("repression", "legal_repression", "body_repression", "body_legal_repression", "body_hr_repression"),
        "rights_terms": ordered_union("specific_rights", "body_specific_rights", "body_strong_rights"),
    })
    repression = weighted_sum(F.col("repression_terms"), lexicon.weights.get("repression", {}), 25)
    repression = F.when(some("legal_repression") & (repression < 10), F.lit(8)).otherwise(repression)
    context = F.least(F.lit(3), F.when(some("legal_context"), F.size("legal_context")).otherwise(F.size("body_legal_context")))
    repression = F.when(has("has_legal_context") & some("repression_terms"), capped_add(repression, context, 30)).otherwise(repression)
    repression = F.when(has("confirmed_repression"), capped_add(repression, 5, 30)).otherwise(repression)
    repression = F.when(pressure, capped_add(repression, 5, 30)).otherwise(repression)
    rights = weighted_sum(F.col("rights_terms"), lexicon.weights.get("rights", {}), 8)
    rights = F.when(has("has_human_rights") & (rights == 0), F.lit(4)).otherwise(rights)
    rights = F.when(has("confirmed_rights"), capped_add(rights, 2, 10)).otherwise(rights)
    issue = has("has_human_rights") | has("has_repression") | has("has_specific_rights")
    journalism = _first_of((pressure, 7), (has("journalist_relation") & has("regional_context"), 6), (has("confirmed_repression"), 6), (some("major_geo"), 5), (some("domestic") & issue, 4), (has("has_human_rights"), 3), (some("domestic"), 2))
    geopolitical = _first_of((some("major_geo"), 7), (some("routine_geo"), 2))
    summit = any_pattern(F.col("_full"), lexicon.pattern("summit"))
    geopolitical = F.when(summit & some("major_geo"), capped_add(geopolitical, 3, 10)).otherwise(geopolitical)
    df = df.withColumns({"geography_score": geography, "target_score": target, "repression_score": repression, "rights_score": rights, "journalism_score": journalism, "geopolitical_score": geopolitical})

    people = has("has_activist") | has("has_journalist")
    touched = people | issue
    fined = {
        "routine_penalty": F.when(some("routine_geo") & ~touched, 10).otherwise(0),
        "historical_penalty": F.when(some("historical") & ~(touched | has("primary_event_anchor")), 12).otherwise(0),
        "actor_penalty": F.when(some("actors") & ~(has("has_geography") & (people | has("has_repression") | has("has_specific_rights") | some("domestic") | some("major_geo"))), 5).otherwise(0),
    }
    df = df.withColumns(fined)
    total = sum((F.col(c) for c in ("target_score", "repression_score", "rights_score", "journalism_score", "geopolitical_score")), F.col("geography_score"))
    total = F.when(some("non_news"), F.least(total, F.lit(5))).otherwise(total)
    base = F.when(some("noise"), 0).otherwise(total - F.col("routine_penalty") - F.col("historical_penalty") - F.col("actor_penalty"))
    plus = lambda c, n: F.when(c, n).otherwise(0)
    event = has("regional_context") & has("primary_event_anchor")
    df = df.withColumn("event", event)
    regional = has("regional_context")
    bonuses = [
        (has("event"), 12), (has("event") & has("confirm_events") & has("body_confirmation"), 10),
        (has("event") & _some("primary_repression", "confirm_hr_repression", "body_morphology"), 18), (has("event") & _some("target_relation", "activist_relation", "journalist_relation"), 14),
        (has("activist_relation") & regional, 18), (has("journalist_relation") & regional, 20), (has("primary_political_prisoner"), 22), (has("primary_transnational"), 18),
        (has("primary_gender"), 12), (has("primary_gender") & has("confirm_gender"), 5), (has("primary_press"), 15), (has("primary_political_context"), 8),
        (has("primary_political_context") & has("confirm_strong_politics"), 5), (has("primary_democracy") & regional, 5), (has("primary_specific_right"), 8),
        (has("primary_hr_anchor") & has("body_confirmation"), 8), (has("severe_detected") & regional & has("has_repression"), 15),
        (has("prison_sentence") & regional & has("has_activist"), 8), (has("critical_hr_case"), 25),
    ]
    df = df.withColumn("_sum", base + sum((plus(c, n) for c, n in bonuses), F.lit(0)))

    at_most = lambda c, limit: F.when(c, F.least(F.col("_sum"), limit)).otherwise(F.col("_sum"))
    prim = F.col("_primary")
    df = df.withColumn("_sum", at_most(~regional, F.lit(20)))
    unanchored = regional & ~has("primary_event_anchor") & ~has("primary_hr_anchor")
    df = df.withColumn("unanchored_cap", F.when(unanchored, F.when(_some("target_relation", "body_confirmation"), LEVEL_B - 1).when(any_term(prim, lexicon.terms("reform_topics"), F.col("_primary_words")), LEVEL_C - 1).when(any_term(prim, lexicon.terms("other_topics"), F.col("_primary_words")), 28).otherwise(LEVEL_C - 1)))
    floor = F.when(has("event"), F.when(has("body_confirmation"), LEVEL_B).otherwise(42))
    df = df.withColumn("_sum", F.greatest(F.least("_sum", F.coalesce("unanchored_cap", F.lit(1000))), F.coalesce(floor, F.lit(-1000))))
    only_politics = regional & has("primary_political_context") & ~_some("primary_repression", "primary_event_anchor", "primary_specific_right", "primary_political_prisoner", "primary_press", "primary_gender", "primary_transnational")
    df = df.withColumn("_sum", at_most(only_politics, F.lit(48)))
    editorial = F.coalesce(
        F.when(has("primary_forced_labor"), F.when(has("has_government"), 82).otherwise(76)), F.when(has("primary_academic_case"), 82), F.when(_some("primary_journalist_pressure", "primary_press"), 85),
        F.when(_some("primary_defender_case", "critical_hr_case"), 100), F.when(has("primary_lgbt_pressure"), 85), F.when(has("primary_transnational"), 85), F.when(has("primary_repression"), 78),
        F.when(has("primary_event_anchor") & has("body_confirmation"), 72), F.when(_some("primary_specific_right", "primary_gender"), 65), F.lit(1000),
    )
    df = df.withColumn("_sum", at_most(regional, editorial))
    concrete = _some("primary_defender_case", "primary_forced_labor", "primary_journalist_pressure", "primary_press", "primary_academic_case", "primary_lgbt_pressure", "primary_repression", "primary_event_anchor", "primary_gender")
    df = df.withColumn("soft_topic", regional & ~concrete & any_term(prim, lexicon.terms("soft_topics"), F.col("_primary_words")))
    return df.withColumn("score", clamp(at_most(has("soft_topic"), F.lit(48))).cast("int")).drop("_sum")


def _flag(name: str, arrays: set[str]) -> Column:
    return F.expr(f"size(`{name}`) > 0" if name in arrays else f"coalesce(`{name}`, false)")


def decide(df: DataFrame) -> DataFrame:
    """df with score and signals, and level, priority, theme and relevant.

    A signal may be a boolean or an array, which holds if it has elements; a signal that df lacks does not hold.
    """
    arrays = {f.name for f in df.schema if f.dataType.typeName() == "array"}
    flag = lambda n: _flag(n, arrays) if n in df.columns else F.lit(False)
    score = F.col("score")
    any_of = lambda names: sum((flag(n).cast("int") for n in names), F.lit(0)) > 0
    level = (
        F.when(flag("section_page"), "F").when(~flag("regional_context"), F.when(flag("global_hr_signal"), "D").otherwise("E")).when(flag("non_news") | flag("noise"), "E")
        .when((score >= LEVEL_A) & any_of(CONFIRMATIONS), "A").when(score >= LEVEL_B, "B").when(score >= LEVEL_C, "C").otherwise("E")
    )
    priority = F.coalesce(*(F.when(score >= least, label) for least, label in PRIORITIES), F.lit("BRUIT"))
    theme = F.coalesce(*(F.when(flag(name), label) for name, label in THEMES), F.lit(NO_THEME))
    relevant = flag("confirmed_activist_pressure") | flag("confirmed_journalist_pressure") | (flag("regional_context") & (score >= RELEVANT_FROM) & ~flag("non_news") & ~flag("noise") & any_of(RELEVANT_BY))
    return df.withColumns({"level": level, "priority": priority, "theme": theme, "relevant": relevant})


def reasons(df: DataFrame, lexicon: Lexicon) -> Column:
    """What raised or lowered the score, in order."""
    has, regional = F.col, F.col("regional_context")
    some = lambda n: F.size(n) > 0
    first = lambda name, n: F.concat_ws(", ", F.slice(name, 1, n))
    out, before = [], F.lit(False)
    for name, label in lexicon.regions:
        out.append((some(name) & ~before, F.concat(F.lit(f"{label}: "), first(name, 6))))
        before = before | some(name)
    out.append((~has("has_geography") & has("specialised_source"), F.lit("specialised source")))
    out.append((has("has_geography") & (has("body_geo_count") > 0), F.lit("geography confirmed in the body")))
    out += [(c, F.lit(label)) for c, label in (
        (has("confirmed_activist_pressure"), "activist or defender targeted"), (has("confirmed_journalist_pressure") & ~has("confirmed_activist_pressure"), "journalist or medium targeted"),
        (has("routine_penalty") > 0, "ordinary geopolitics or economy"), (has("historical_penalty") > 0, "history or culture"), (some("non_news"), "no journalistic content"), (some("noise"), "noise"),
    )]
    out.append((has("event"), F.concat(F.lit("regional event: "), first("events", 4))))
    out += [(c, F.lit(label)) for c, label in (
        (has("event") & has("confirm_events") & has("body_confirmation"), "event confirmed in the body"), (has("event") & _some("primary_repression", "confirm_hr_repression", "body_morphology"), "regional event with repression"),
        (has("event") & _some("target_relation", "activist_relation", "journalist_relation"), "regional event with a target"), (has("activist_relation") & regional, "activist and repressive action"),
        (has("journalist_relation") & regional, "journalist and repressive action"), (has("primary_political_prisoner"), "political prisoner"), (has("primary_transnational"), "transnational repression"),
        (has("primary_gender"), "violence or rights of women"), (has("primary_press"), "press restriction"), (has("primary_political_context"), "rule of law"), (has("primary_democracy") & regional, "civic space"),
        (has("primary_specific_right"), "specific right"), (has("primary_hr_anchor") & has("body_confirmation"), "signal confirmed in the body"), (has("severe_detected") & regional & has("has_repression"), "severe repression"),
        (has("prison_sentence") & regional & has("has_activist"), "prison sentence of an activist"), (has("critical_hr_case"), "critical case"), (~regional, "cap: no regional anchor"),
        (has("unanchored_cap") == LEVEL_B - 1, "cap: confirmed in the body only"), (has("unanchored_cap") == LEVEL_C - 1, "cap: no main anchor"), (has("unanchored_cap") == 28, "cap: other topic"), (has("soft_topic"), "cap: no concrete event"),
    )]
    return present(*((F.coalesce(c, F.lit(False)), label) for c, label in out))


def score(df: DataFrame, lexicon: Lexicon, section_page: Column | None = None) -> DataFrame:
    """df's own columns with language, score, level, priority, theme, relevant, reasons and the struct `signals`."""
    own = [c for c in df.columns if c != "language"]
    out = parts(signals(zones(df), lexicon), lexicon).withColumn("section_page", F.coalesce(section_page, F.lit(False)) if section_page is not None else F.lit(False))
    out = decide(out).withColumn("reasons", reasons(out, lexicon))
    hidden = {*own, "language", "score", "level", "priority", "theme", "relevant", "reasons"}
    return out.select(*own, "language", "score", "level", "priority", "theme", "relevant", "reasons", F.struct(*(c for c in out.columns if c not in hidden and not c.startswith("_"))).alias("signals"))


def score_batch(df: DataFrame, lexicon: Lexicon) -> tuple[DataFrame, DataFrame]:
    """Scored rows, and rows without a title as errors with `error`."""
    ok = normalize(F.col("title")) != ""
    return score(df.where(ok), lexicon), df.where(~ok).withColumn("error", F.lit("missing title"))


def two_pass(df: DataFrame, lexicon: Lexicon, keep: DataFrame, key: str) -> DataFrame:
    """Scores without bodies, and with them the rows whose key is in `keep`."""
    flagged = df.join(keep.select(key).distinct().withColumn("_keep", F.lit(True)), key, "left")
    return score(flagged.withColumn("body", F.when(F.col("_keep"), F.col("body")).otherwise("")).drop("_keep"), lexicon)


def keywords_used(columns: list[str]) -> Column:
    """All matched terms of the signals' arrays, in the order of the columns, once each."""
    return ordered_union(*(F.coalesce(F.col(f"signals.{c}"), literal([])) for c in columns))
