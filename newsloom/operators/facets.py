"""Facets of an article with roles and evidence, and a declarative filter over them."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import literal, lookup, ordered_union, present, without_contained
from ..functions.dates import whole_days
from ..functions.text import normalize, resolve_language, text
from ..functions.urls import looks_like_article, looks_like_section
from .matching import any_pattern, find_terms, find_with_stems, related, stem_match
from .scoring import zones
from .vocabulary import Stem, TermSet, lowered

# What evidence says where no term was found.
BY_PLACE, BY_PATTERN, UNTYPED = "(déduit de geo={0})", "(motif farsi acteur+répression)", "_non_typé"
SUBJECT, MENTION, ABSENT = "sujet_principal", "mention_secondaire", "absent"
NONE = "aucun"
REPORT_CHARS = 3000


@dataclass(frozen=True)
class FacetConfig:
    """Places with their codes and stems; classes of actors and treatments with terms and stem patterns; patterns in
    Farsi, and in Russian, of repression; advocacy terms; hints."""

    places: dict[str, str] = field(default_factory=dict)
    place_stems: tuple[Stem, ...] = ()  # a stem's name is a place, which gives the code
    actors: dict[str, tuple[str, ...]] = field(default_factory=dict)
    treatments: dict[str, tuple[str, ...]] = field(default_factory=dict)
    treatment_stems: dict[str, str] = field(default_factory=dict)
    inherits: dict[str, str] = field(default_factory=dict)  # a place code gives an actor class
    relations_fa: dict[str, tuple[str, ...]] = field(default_factory=dict)  # an actor near repression gives its class
    repression_ru: tuple[str, ...] = ()  # shows in the evidence where no treatment is found
    advocacy: tuple[str, ...] = ()
    source_hints: tuple[str, ...] = ()


def role(head: Column, body: Column) -> Column:
    return F.when(head, SUBJECT).when(body, MENTION).otherwise(ABSENT)


def _rank(r: Column) -> Column:
    return F.when(r == SUBJECT, 2).when(r == MENTION, 1).otherwise(0)


def _of_rank(n: Column) -> Column:
    return F.when(n == 2, SUBJECT).when(n == 1, MENTION).otherwise(ABSENT)


def article_type(title: Column, url: Column, has_date: Column, body: Column, advocacy: TermSet) -> tuple[Column, Column]:
    """The kind of an article, and why."""
    found = find_terms(F.concat_ws(" ", normalize(title), body), advocacy)
    kind = F.when(~looks_like_article(url, title), "navigation").when(looks_like_section(url, title), "page_thematique").when(has_date, "evenement_date").when(F.length(body) >= REPORT_CHARS, "rapport_analyse").when(F.size(found) > 0, "plaidoyer_communique").otherwise("indetermine")
    why = F.when(kind == "navigation", "link").when(kind == "page_thematique", "title and path").when(kind == "evenement_date", "dated").when(kind == "rapport_analyse", f"body >= {REPORT_CHARS}").when(kind == "plaidoyer_communique", F.concat_ws(", ", F.slice(found, 1, 4))).when(body == "", "no date, no body").otherwise("no date, short body")
    return kind, why


def describe(df: DataFrame, config: FacetConfig, now: Column) -> DataFrame:
    """df with geo, acteur, traitement, their roles, relation, type, age_jours, source_specialisee and preuves (evidence).

    Stems and patterns of one language act on texts of that language, declared or else told by the script. Evidence of a
    class: terms in head and body, and in `by` what else gave it.
    """
    own = df.columns
    have = lambda c, kind="string": F.col(c) if c in own else F.lit(None).cast(kind)
    out = zones(df)
    head, body = F.col("_headline"), F.col("_body")
    out = out.withColumn("_language", resolve_language(F.lower(F.trim(text(have("language")))), F.col("_full")))
    ru, fa = F.col("_language") == "ru", F.col("_language") == "fa"
    places = TermSet.of("places", config.places)
    stems_of_places = [replace(s, name=lowered(s.name)) for s in config.place_stems]
    containers = places.containers()
    codes = {t: c for t, c in zip(places.terms, config.places.values())}
    found_places = lambda c: without_contained(find_with_stems(c, F.col("_language"), places, stems_of_places), containers)
    out = out.withColumns({"_geo_head": found_places(head), "_geo_body": found_places(body)})
    out = out.withColumns({"geo": lookup(ordered_union("_geo_head", "_geo_body"), codes, "autre"), "geo_role": role(F.size("_geo_head") > 0, F.size("_geo_body") > 0), "preuves_geo": F.struct(F.col("_geo_head").alias("head"), F.col("_geo_body").alias("body"))})
    out = out.withColumns({f"_fa_{n}_{zone}": fa & any_pattern(c, list(patterns)) for n, patterns in config.relations_fa.items() for zone, c in (("h", head), ("b", body))})
    near = {n: (F.col(f"_fa_{n}_h"), F.col(f"_fa_{n}_b")) for n in config.relations_fa}
    by_pattern = F.greatest(F.lit(False), F.lit(False), *(h | b for h, b in near.values()))
    for axis, classes, stems in (("acteur", config.actors, {}), ("traitement", config.treatments, config.treatment_stems)):
        cols, hits = {}, []
        for k, (name, terms) in enumerate(classes.items()):
            for zone, c in (("h", head), ("b", body)):
                found = find_terms(c, TermSet.of(name, terms))
                if name in stems:
                    stem = stem_match(c, stems[name])
                    found = F.concat(found, F.when(stem != "", F.array(stem)).otherwise(literal([])))
                cols[f"_{axis}{k}{zone}"] = found
            hits.append((name, F.size(f"_{axis}{k}h") > 0, F.size(f"_{axis}{k}b") > 0))
        out = out.withColumns(cols) if cols else out
        by: dict[str, list[tuple[Column, Column]]] = {n: [] for n in classes}
        for code, given in config.inherits.items() if axis == "acteur" else ():
            place = literal([t for t, c in codes.items() if c == code])
            in_head, in_body = F.arrays_overlap("_geo_head", place), F.arrays_overlap("_geo_body", place)
            by.get(given, []).extend((~(h | b) & (in_head | in_body), F.lit(BY_PLACE.format(code))) for n, h, b in hits if n == given)
            hits = [(n, h | in_head, b | in_body) if n == given else (n, h, b) for n, h, b in hits]
        if axis == "acteur":  # these come last, and the stronger role holds
            hits += [(n, h, b) for n, (h, b) in near.items()]
            for n, (h, b) in near.items():
                by.setdefault(n, []).append((h | b, F.lit(BY_PATTERN)))
        named = F.array_distinct(F.filter(F.array(*(F.when(h | b, F.lit(n)) for n, h, b in hits)).cast("array<string>"), lambda x: x.isNotNull())) if hits else literal([])
        best = F.greatest(F.lit(0), *(_rank(role(h, b)) for _, h, b in hits), F.lit(0))
        numbers = {n: k for k, n in enumerate(classes)}
        zone_of = lambda n, z: F.col(f"_{axis}{numbers[n]}{z}") if n in numbers else literal([])  # noqa: E731, B023
        entries = [(n, zone_of(n, "h"), zone_of(n, "b"), present(*pairs).cast("array<string>") if pairs else literal([])) for n, pairs in by.items()]
        if axis == "traitement" and config.repression_ru:
            untyped = (best == 0) & ru & any_pattern(F.col("_full"), list(config.repression_ru))
            entries.append((UNTYPED, literal([]), literal([]), F.when(untyped, literal(["ru"])).otherwise(literal([]))))
        evidence = F.map_from_entries(F.filter(F.array(*(F.struct(F.lit(n).alias("k"), F.struct(h.alias("head"), b.alias("body"), w.alias("by")).alias("v")) for n, h, b, w in entries)), lambda e: (F.size(e["v"]["head"]) > 0) | (F.size(e["v"]["body"]) > 0) | (F.size(e["v"]["by"]) > 0))) if entries else F.lit(None)
        out = out.withColumns({axis: F.when(F.size(named) > 0, named).otherwise(literal([NONE])), f"{axis}_role": _of_rank(best), f"preuves_{axis}": evidence})
    actors = TermSet.of("actors", [t for terms in config.actors.values() for t in terms])
    treatments = TermSet.of("treatments", [t for terms in config.treatments.values() for t in terms])
    both = (F.col("acteur_role") != ABSENT) & (F.col("traitement_role") != ABSENT)
    kind, why = article_type(text(have("title")), text(have("url")), have("date", "timestamp").isNotNull(), body, TermSet.of("advocacy", config.advocacy))
    hints = find_terms(normalize(F.concat_ws(" ", text(have("source")), text(have("url")))), TermSet.of("source_hints", config.source_hints))
    out = out.withColumns({
        "relation_acteur_traitement": F.when(by_pattern, True).when(both, related(F.col("_full"), actors, treatments)).otherwise(False), "type": kind, "preuve_type": why,
        "age_jours": whole_days(have("date", "timestamp"), now), "preuves_source": hints,
    })
    linked = F.struct(find_terms(F.col("_full"), actors).alias("acteur"), find_terms(F.col("_full"), treatments).alias("traitement"), by_pattern.alias("via_motif_farsi"))
    out = out.withColumns({"source_specialisee": F.size("preuves_source") > 0, "preuves_relation": F.when(F.col("relation_acteur_traitement"), linked)})
    made = ["geo", "geo_role", "acteur", "acteur_role", "traitement", "traitement_role", "relation_acteur_traitement", "type", "age_jours", "source_specialisee", "preuve_type", "preuves_geo", "preuves_acteur", "preuves_traitement", "preuves_relation", "preuves_source"]
    return out.select(*(c for c in own if c not in made), *made)


@dataclass(frozen=True)
class Rules:
    """None turns a rule off. All rules that are on must hold."""

    places: frozenset[str] | None = None
    place_role: str | None = None
    actor_role: str | None = None
    treatment_role: str | None = None
    actors: frozenset[str] | None = None
    treatments: frozenset[str] | None = None
    excluded_types: frozenset[str] | None = None
    max_age_days: int | None = None
    need_relation: bool = False


def apply_rules(df: DataFrame, rules: Rules) -> DataFrame:
    """df with pertinent and motif: the first rule in order that fails gives the reason. A missing age passes."""
    # The wording of the reasons.
    fails: list[Column] = []
    overlap = lambda c, s: F.arrays_overlap(F.col(c), literal(sorted(s)))
    if rules.places is not None:
        fails.append(F.when(~overlap("geo", rules.places), "hors périmètre géographique retenu"))
    for name, least in (("geo_role", rules.place_role), ("acteur_role", rules.actor_role), ("traitement_role", rules.treatment_role)):
        if least is not None:
            fails.append(F.when(_rank(F.col(name)) < _rank(F.lit(least)), F.concat(F.lit(f"{name} '"), F.col(name), F.lit("' sous le minimum requis"))))
    if rules.actors is not None:
        fails.append(F.when(~overlap("acteur", rules.actors), "aucun acteur retenu détecté"))
    if rules.treatments is not None:
        fails.append(F.when(~overlap("traitement", rules.treatments), "aucun traitement retenu détecté"))
    if rules.excluded_types is not None:
        fails.append(F.when(F.col("type").isin(*rules.excluded_types), F.concat(F.lit("type d'article exclu: "), F.col("type"))))
    if rules.max_age_days is not None:
        fails.append(F.when(F.col("age_jours") > rules.max_age_days, F.concat(F.lit("article trop ancien ("), F.col("age_jours").cast("string"), F.lit(f" j > {rules.max_age_days} j)"))))
    if rules.need_relation:
        fails.append(F.when(~F.col("relation_acteur_traitement"), "acteur et traitement ne co-occurrent pas dans le texte"))
    failed = F.coalesce(*fails) if fails else F.lit(None).cast("string")
    return df.withColumn("motif", F.coalesce(failed, F.lit("pertinent"))).withColumn("pertinent", F.col("motif") == "pertinent")
