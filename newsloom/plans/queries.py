"""The queries by name, and their SQL in DuckDB's dialect."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as X
from ..functions import pages as H
from ..functions import text as T
from ..functions import urls as U
from ..functions.arrays import weighted_sum
from ..operators import aggregates as A
from ..operators import archive as J
from ..operators import evaluation as E
from ..operators import facets as C
from ..operators import matching as P
from ..operators import scoring as S
from . import demo

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        _queries[f.__name__] = f
        if sql is not None:
            _sql[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


#: Bytes of files for each core below which a table may have fewer row groups than there are cores.
SPREAD_BYTES = 16 << 20


def spread(df: DataFrame) -> DataFrame:
    """df dealt to all cores if its files are small; larger tables have row groups enough and stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * SPREAD_BYTES else df


def articles(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as articles: the first line is the title."""
    return spread(read(spark, sf, "documents").select("doc_id", "text", "source", "lang")).select("doc_id", F.element_at(F.split("text", "\n", 2), 1).alias("title"), F.col("text").alias("body"), "source", F.col("lang").alias("language"))


#: Articles, and their title and body in normal form.
ART = "art AS (SELECT doc_id, split_part(text, chr(10), 1) AS title, text AS body, source, lang AS language, lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS norm, lower(trim(regexp_replace(split_part(text, chr(10), 1), '\\s+', ' ', 'g'))) AS head FROM documents)"
_B = r"[^\p{L}\p{N}_]"


def _has(c: str, *terms: str) -> str:
    return f"regexp_matches(' ' || {c} || ' ', '{_B}({'|'.join(terms)}){_B}')"


# Text


@query(f"WITH {ART} SELECT doc_id, norm FROM art")
def normalize_text(spark: SparkSession, sf: str) -> DataFrame:
    return articles(spark, sf).select("doc_id", T.normalize(F.col("body")).alias("norm"))


@query(f"WITH {ART} SELECT doc_id, trim(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM art")
def slugify_title(spark: SparkSession, sf: str) -> DataFrame:
    return articles(spark, sf).select("doc_id", T.slugify(F.col("title")).alias("slug"))


@query(f"WITH {ART}, m AS (SELECT doc_id, body, length(regexp_extract(body, '(?is)^(.*?)Follow us on', 1)) AS n, regexp_matches(body, '(?i)follow us on') AS found FROM art) SELECT doc_id, trim(regexp_replace(CASE WHEN found AND n >= 0.8 * length(body) THEN substr(body, 1, n) ELSE body END, '\\s+', ' ', 'g')) AS stripped FROM m")
def strip_tail_marker(spark: SparkSession, sf: str) -> DataFrame:
    return articles(spark, sf).select("doc_id", T.strip_related_blocks(F.col("body")).alias("stripped"))


@query(f"WITH {ART}, n AS (SELECT doc_id, length(regexp_replace(body, '[^а-яёА-ЯЁ]', '', 'g')) AS c, length(regexp_replace(body, '[^a-zA-Z]', '', 'g')) AS l FROM art) SELECT doc_id, CASE WHEN c + l < 20 THEN '' WHEN c > 0.3 * (c + l) THEN 'ru' ELSE 'en' END AS script FROM n")
def detect_script(spark: SparkSession, sf: str) -> DataFrame:
    return articles(spark, sf).select("doc_id", T.detect_script(F.col("body")).alias("script"))


_WORDS = r"unnest(regexp_extract_all(lower(title), '[\p{L}][\p{L}\p{N}_''-]{2,}'))"
_STOP = ", ".join(f"'{w}'" for w in demo.STOPWORDS)


@query(f"WITH {ART}, w AS (SELECT trim({_WORDS}, '''-') AS word FROM art) SELECT word, count(*) AS n FROM w WHERE length(word) > 0 AND word NOT IN ({_STOP}) GROUP BY word ORDER BY n DESC, word LIMIT 300")
def title_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return A.word_counts(articles(spark, sf), "title", demo.STOPWORDS)


_LONG = r"list_sort(list_distinct(regexp_extract_all(lower(title), '[\p{L}]{4,}')))"


@query(f"WITH {ART} SELECT doc_id, array_to_string({_LONG}, ' ') AS words FROM art")
def significant_words(spark: SparkSession, sf: str) -> DataFrame:
    return articles(spark, sf).select("doc_id", F.array_join(F.array_sort(T.significant_words(F.col("title"))), " ").alias("words"))


@query(f"WITH {ART}, w AS (SELECT doc_id, unnest({_LONG}) AS w FROM art), r AS (SELECT doc_id, w, row_number() OVER (PARTITION BY doc_id ORDER BY length(w) DESC, w) AS k FROM w) SELECT doc_id, string_agg(w, ' ' ORDER BY k) AS words FROM r WHERE k <= 2 GROUP BY doc_id")
def distinctive_words(spark: SparkSession, sf: str) -> DataFrame:
    found = articles(spark, sf).select("doc_id", T.distinctive_words(F.col("title")).alias("w"))
    return found.where(F.size("w") > 0).select("doc_id", F.array_join("w", " ").alias("words"))


@query()
def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    return articles(spark, sf).select("doc_id", T.clean_text(F.col("body")).alias("cleaned"))


@query()
def repair_mojibake(spark: SparkSession, sf: str) -> DataFrame:
    return articles(spark, sf).select("doc_id", T.repair_mojibake(F.col("body")).alias("repaired"))


@query(f"WITH {ART} SELECT doc_id, replace(replace(replace(replace(replace(title, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;') AS escaped FROM art")
def escape_title(spark: SparkSession, sf: str) -> DataFrame:
    return articles(spark, sf).select("doc_id", T.escape_html(F.col("title")).alias("escaped"))


_STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
_TITLE_S, _SOURCE_S, _BODY_S = (_STRIP.format(c) for c in ("title", "coalesce(source, '')", "coalesce(body, '')"))


@query(f"WITH {ART} SELECT doc_id, 'Titre : ' || coalesce({_TITLE_S}, '') || CASE WHEN {_SOURCE_S} <> '' THEN chr(10) || 'Source : ' || {_SOURCE_S} ELSE '' END || CASE WHEN {_BODY_S} <> '' THEN chr(10) || 'Texte : ' || substr({_BODY_S}, 1, {T.JUDGE_CHARS}) ELSE '' END AS prompt FROM art")
def judge_prompt_whole(spark: SparkSession, sf: str) -> DataFrame:
    """The judge's prompt of every article, with the bounds of the prompt only."""
    return articles(spark, sf).select("doc_id", T.judge_prompt(F.col("title"), F.col("source"), F.lit(None), F.col("body")).alias("prompt"))


# URLs and pages

_KEPT = "list_filter(string_split(split_part(bare, '?', 2), '&'), lambda p: p <> '' AND lower(split_part(p, '=', 1)) NOT IN (" + ", ".join(f"'{p}'" for p in U.TRACKING) + "))"
URLS = "bare AS (SELECT page_id, url, html, regexp_replace(url, '#.*$', '') AS bare FROM pages)"


@query(f"WITH {URLS} SELECT page_id, split_part(bare, '?', 1) || CASE WHEN len({_KEPT}) > 0 THEN '?' || array_to_string({_KEPT}, '&') ELSE '' END AS link FROM bare")
def normalize_url(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "pages").select("page_id", U.normalize_url(F.col("url")).alias("link"))


_KEY = r"lower(rtrim(regexp_extract(bare, '^[a-z]+://([^?]*)', 1), '/')) || CASE WHEN contains(bare, '?') AND split_part(bare, '?', 2) <> '' THEN '?' || split_part(bare, '?', 2) ELSE '' END"


@query(f"WITH {URLS} SELECT page_id, {_KEY} AS key FROM bare")
def canonical_key(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "pages").select("page_id", U.article_key(F.col("url"), F.lit("")).alias("key"))


_DOMAIN = r"regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)), '^www\.', '')"


@query(f"SELECT {_DOMAIN} AS domain, count(*) AS n FROM pages GROUP BY 1")
def domain_counts(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "pages").groupBy(U.domain(F.col("url")).alias("domain")).agg(F.count(F.lit(1)).alias("n"))


_TITLE = r"regexp_extract(html, '(?is)<title>(.*?)</title>', 1)"


def _titled(spark: SparkSession, sf: str) -> DataFrame:
    return spread(read(spark, sf, "pages")).withColumn("title", F.regexp_extract("html", "(?is)<title>(.*?)</title>", 1))


_SEGMENTS = r"list_filter(string_split(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'), lambda s: s <> '')"
_SHORT = "len(list_filter(regexp_split_to_array(trim({0}), '\\s+'), lambda w: w <> '')) BETWEEN 1 AND 5"
_SLUG = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', '-', 'g'), '-')"
_INDEX = "[" + ", ".join(f"'{s}'" for s in U.INDEX_SEGMENTS) + "]"


@query(
    f"""WITH t AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path, {_SEGMENTS} AS seg, regexp_replace(trim({_TITLE}), '[\\s\u203a\u00bb>]+$', '') AS own FROM pages),
    b AS (SELECT *, trim(regexp_replace(own, '\\s*[-\u2013\u2014|]\\s*[^-\u2013\u2014|]{{1,40}}$', '')) AS bare FROM t)
    SELECT page_id, own <> '' AND NOT regexp_matches(path, '/(19|20)[0-9][0-9]/[0-9]{{1,2}}(/|$)') AND len(seg) > 0 AND ({_SHORT.format('own')} OR {_SHORT.format('bare')})
      AND (({_SHORT.format('own')} AND {_SLUG.format('own')} = seg[len(seg)]) OR ({_SHORT.format('bare')} AND {_SLUG.format('bare')} = seg[len(seg)]) OR list_has_any(list_transform(seg, lambda s: lower(s)), {_INDEX})) AS section FROM b"""
)
def section_page(spark: SparkSession, sf: str) -> DataFrame:
    return _titled(spark, sf).select("page_id", U.looks_like_section(F.col("url"), F.col("title")).alias("section"))


@query()
def article_link_filter(spark: SparkSession, sf: str) -> DataFrame:
    return _titled(spark, sf).select("page_id", U.looks_like_article(F.col("url"), F.col("title")).alias("article"))


@query()
def page_links(spark: SparkSession, sf: str) -> DataFrame:
    return H.page_links(spread(read(spark, sf, "pages")))


@query()
def extract_body(spark: SparkSession, sf: str) -> DataFrame:
    return H.extract_body(spread(read(spark, sf, "pages"))).select("page_id", "body", "published")


@query()
def outbound_domains(spark: SparkSession, sf: str) -> DataFrame:
    return H.outbound_domains(read(spark, sf, "pages"), ["facebook.com", "twitter.com"])


@query()
def page_title_overlap(spark: SparkSession, sf: str) -> DataFrame:
    pages = H.parse_pages(_titled(spark, sf))
    return pages.select("page_id", H.matches_title(F.col("page.heads"), F.col("title")).alias("by_heads"), H.body_matches_title(F.col("page.body"), F.col("title")).alias("by_body"))


@query(r"SELECT page_id, strlen(html) AS bytes, length(html) AS chars, len(regexp_extract_all(html, '(?i)<a\s')) AS links, len(regexp_extract_all(html, '(?i)<article[\s>]')) AS articles, regexp_matches(html, '(?i)<(html|body|head|!doctype)') AS looks_like_html FROM pages")
def source_diagnostics(spark: SparkSession, sf: str) -> DataFrame:
    return H.diagnose(read(spark, sf, "pages"), "html").select("page_id", "bytes", "chars", "links", "articles", "looks_like_html")


# Matching


@query(f"WITH {ART} SELECT doc_id, {_has('norm', *demo.WORDS.terms)} AS found FROM art")
def any_term(spark: SparkSession, sf: str) -> DataFrame:
    return articles(spark, sf).select("doc_id", P.any_term(T.normalize(F.col("body")), demo.WORDS).alias("found"))


@query(f"WITH {ART} SELECT doc_id, concat_ws(', ', " + ", ".join(f"CASE WHEN {_has('norm', w)} THEN '{w}' END" for w in demo.WORDS.terms) + ") AS terms FROM art")
def find_terms(spark: SparkSession, sf: str) -> DataFrame:
    return articles(spark, sf).select("doc_id", F.array_join(P.find_terms(T.normalize(F.col("body")), demo.WORDS), ", ").alias("terms"))


@query(f"WITH {ART} SELECT doc_id, CAST(least(9, " + " + ".join(f"CASE WHEN {_has('norm', w)} THEN {demo.WEIGHTS.get(w, 2)} ELSE 0 END" for w in demo.WORDS.terms) + ") AS INTEGER) AS score FROM art")
def weighted_score(spark: SparkSession, sf: str) -> DataFrame:
    found = P.find_terms(T.normalize(F.col("body")), demo.WORDS)
    return articles(spark, sf).select("doc_id", weighted_sum(found, demo.WEIGHTS, 9).cast("int").alias("score"))


_T, _A = "|".join(demo.TARGETS.terms), "|".join(demo.ACTIONS.terms)
_GAP = f"(?:{_B}.{{0,138}}{_B}|{_B})"


@query(f"WITH {ART} SELECT doc_id, regexp_matches(' ' || norm || ' ', '(?s){_B}({_T}){_GAP}({_A}){_B}') OR regexp_matches(' ' || norm || ' ', '(?s){_B}({_A}){_GAP}({_T}){_B}') AS related FROM art")
def proximity_relation(spark: SparkSession, sf: str) -> DataFrame:
    return articles(spark, sf).select("doc_id", P.related(T.normalize(F.col("body")), demo.TARGETS, demo.ACTIONS).alias("related"))


@query(f"WITH {ART} SELECT doc_id FROM art WHERE regexp_matches(' ' || norm || ' ', '(?s){_B}({_T}){_GAP}({_A}){_B}') OR regexp_matches(' ' || norm || ' ', '(?s){_B}({_A}){_GAP}({_T}){_B}')")
def proximity_join(spark: SparkSession, sf: str) -> DataFrame:
    df = articles(spark, sf).withColumn("norm", T.normalize(F.col("body")))
    return P.related_rows(df, "doc_id", "norm", demo.TARGETS, demo.ACTIONS).select("doc_id")


# Scores

#: Signals and scores that follow from the id, to walk through the decision tables.
SIGNALS = "sig AS (SELECT doc_id, source, lang, CAST(doc_id * 37 % 101 AS INTEGER) AS score, doc_id % 4 <> 0 AS regional_context, doc_id % 3 = 0 AS global_hr_signal, doc_id % 17 = 0 AS non_news, doc_id % 5 = 0 AS severe_detected, doc_id % 11 = 0 AS section_page, doc_id % 13 = 0 AS confirmed_activist_pressure, doc_id % 7 = 0 AS has_activist, doc_id % 6 = 0 AS domestic FROM documents)"
LEVEL = f"CASE WHEN section_page THEN 'F' WHEN NOT regional_context THEN CASE WHEN global_hr_signal THEN 'D' ELSE 'E' END WHEN non_news THEN 'E' WHEN score >= {S.LEVEL_A} AND (severe_detected OR confirmed_activist_pressure) THEN 'A' WHEN score >= {S.LEVEL_B} THEN 'B' WHEN score >= {S.LEVEL_C} THEN 'C' ELSE 'E' END"
RELEVANT = f"(confirmed_activist_pressure OR (regional_context AND score >= {S.RELEVANT_FROM} AND NOT non_news AND has_activist))"
PRIORITY = "CASE " + " ".join(f"WHEN score >= {n} THEN '{label}'" for n, label in S.PRIORITIES) + " ELSE 'BRUIT' END"
DECIDED = f"{SIGNALS}, dec AS (SELECT *, {LEVEL} AS level, {RELEVANT} AS relevant FROM sig)"


def decided(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("doc_id")
    df = read(spark, sf, "documents").select("doc_id", "source", "lang", (i * 37 % 101).cast("int").alias("score"), (i % 4 != 0).alias("regional_context"), (i % 3 == 0).alias("global_hr_signal"), (i % 17 == 0).alias("non_news"), (i % 5 == 0).alias("severe_detected"), (i % 11 == 0).alias("section_page"), (i % 13 == 0).alias("confirmed_activist_pressure"), (i % 7 == 0).alias("has_activist"), (i % 6 == 0).alias("domestic"))
    return S.decide(df)


@query(f"WITH {SIGNALS} SELECT doc_id, score, {LEVEL} AS level FROM sig")
def score_levels(spark: SparkSession, sf: str) -> DataFrame:
    return decided(spark, sf).select("doc_id", "score", "level")


@query(f"WITH {SIGNALS} SELECT {PRIORITY} AS priority, count(*) AS n FROM sig GROUP BY 1")
def priority_bands(spark: SparkSession, sf: str) -> DataFrame:
    return decided(spark, sf).groupBy("priority").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {SIGNALS} SELECT doc_id, CASE WHEN confirmed_activist_pressure THEN 'Activistes / dissidents sous pression' WHEN domestic THEN 'Politique intérieure' WHEN non_news THEN 'Contenu institutionnel' ELSE 'Faible priorité' END AS theme FROM sig")
def theme_rules(spark: SparkSession, sf: str) -> DataFrame:
    return decided(spark, sf).select("doc_id", "theme")


@query(f"WITH {SIGNALS} SELECT doc_id, {RELEVANT} AS relevant FROM sig")
def relevance(spark: SparkSession, sf: str) -> DataFrame:
    return decided(spark, sf).select("doc_id", "relevant")


@query()
def full_score(spark: SparkSession, sf: str) -> DataFrame:
    df = S.score(articles(spark, sf), demo.LEXICON)
    return df.select("doc_id", "score", "level", "priority", "theme", "relevant", F.array_join("reasons", "; ").alias("reasons"), F.array_join(S.keywords_used(["region_1", "activists", "repression"]), ", ").alias("keywords"))


# Facets and rules

_SPOT = {name: f"({_has('head', *terms)})" for name, terms in demo.FACETS.actors.items()}


def _axis(classes: dict, extra: dict[str, str] | None = None) -> tuple[str, str]:
    """SQL for whether any class is in the head, and a list of the classes found."""
    cond = {n: (_has("head", *t), _has("norm", *t)) for n, t in classes.items()}
    for n, more in (extra or {}).items():
        cond[n] = (f"({cond[n][0]} OR {_has('head', more)})", f"({cond[n][1]} OR {_has('norm', more)})")
    role = f"CASE WHEN {' OR '.join(h for h, _ in cond.values())} THEN 2 WHEN {' OR '.join(b for _, b in cond.values())} THEN 1 ELSE 0 END"
    found = "list_filter([" + ", ".join(f"CASE WHEN {b} THEN '{n}' END" for n, (_, b) in cond.items()) + "], lambda x: x IS NOT NULL)"
    return role, found


_GEO = _axis({c: (t,) for t, c in demo.FACETS.places.items()})
_ACT = _axis(demo.FACETS.actors, {"juges": "der"})
_TRE = _axis(demo.FACETS.treatments)
_FT, _FA = ("|".join(t for ts in x.values() for t in ts) for x in (demo.FACETS.actors, demo.FACETS.treatments))
_FULL = "substr(head || ' ' || substr(norm, 1, 12000), 1)"
_REL = f"(regexp_matches(' ' || {_FULL} || ' ', '(?s){_B}({_FT}){_GAP}({_FA}){_B}') OR regexp_matches(' ' || {_FULL} || ' ', '(?s){_B}({_FA}){_GAP}({_FT}){_B}'))"
FACETED = f"{ART}, fac AS (SELECT doc_id, {_GEO[0]} AS geo_rank, {_GEO[1]} AS geo, {_ACT[0]} AS act_rank, {_ACT[1]} AS act, {_TRE[0]} AS tre_rank, {_TRE[1]} AS tre, {_REL} AS rel FROM art)"
_AXES = {"geo": None, "acteur": C.NONE, "traitement": C.NONE}


def faceted(spark: SparkSession, sf: str) -> DataFrame:
    return C.describe(articles(spark, sf), demo.FACETS, F.lit("2026-01-01").cast("timestamp"))


@query(f"WITH {FACETED}, e AS (SELECT 'geo' AS axis, unnest(geo) AS class FROM fac UNION ALL SELECT 'acteur', unnest(act) FROM fac UNION ALL SELECT 'traitement', unnest(tre) FROM fac) SELECT axis, class, count(*) AS n FROM e GROUP BY axis, class")
def facet_counts(spark: SparkSession, sf: str) -> DataFrame:
    return A.facet_counts(faceted(spark, sf), _AXES)


@query(f"WITH {FACETED}, e AS (SELECT 'geo' AS axis, len(geo) > 0 AS has FROM fac UNION ALL SELECT 'acteur', len(act) > 0 FROM fac UNION ALL SELECT 'traitement', len(tre) > 0 FROM fac) SELECT axis, count(*) FILTER (WHERE has) AS described, count(*) AS total, round_even(100.0 * count(*) FILTER (WHERE has) / count(*), 1) AS coverage FROM e GROUP BY axis")
def facet_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return A.facet_coverage(faceted(spark, sf), _AXES)


@query(f"WITH {FACETED} SELECT doc_id, CASE WHEN NOT list_has_any(geo, ['nord', 'ouest']) THEN 'hors périmètre géographique retenu' WHEN NOT list_has_any(act, ['presse']) THEN 'aucun acteur retenu détecté' WHEN NOT list_has_any(tre, ['arret']) THEN 'aucun traitement retenu détecté' WHEN NOT (act_rank > 0 AND tre_rank > 0 AND rel) THEN 'acteur et traitement ne co-occurrent pas dans le texte' ELSE 'pertinent' END AS motif FROM fac")
def rule_filter_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return C.apply_rules(faceted(spark, sf), demo.RULES).select("doc_id", "motif")


# Merges


@query("SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS k FROM documents WHERE text <> '') WHERE k = 1")
def dedup_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    return J.keep_first(read(spark, sf, "documents").select("doc_id", "source", "text"), "text", "doc_id").select("doc_id", "source")


@query("SELECT doc_id, source FROM documents WHERE doc_id % 10 = 0 OR source NOT IN (SELECT DISTINCT source FROM documents WHERE doc_id < 5)")
def seen_anti_join(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents").select("doc_id", "source")
    return J.unseen(docs, docs.where("doc_id < 5"), "source", F.col("doc_id") % 10 == 0)


_WHOLE_BASE = "SELECT doc_id AS key, CASE WHEN doc_id % 3 <> 0 THEN text END AS body, CASE WHEN doc_id % 7 <> 0 THEN '2024-01-01' END AS date FROM documents WHERE doc_id % 5 <> 4"
_WHOLE_MORE = "SELECT doc_id AS key, CASE WHEN doc_id % 4 = 0 THEN text || chr(10) || source ELSE text END AS body, '2025-01-01' AS date FROM documents WHERE doc_id % 5 = 4 OR doc_id % 2 = 0 OR doc_id % 3 = 0"


@query(
    f"""WITH a AS ({_WHOLE_BASE}), b AS ({_WHOLE_MORE}), m AS (SELECT a.key AS ak, b.key AS bk, a.body AS ab, b.body AS bb, a.date AS ad, b.date AS bd, length(coalesce(b.body, '')) > length(coalesce(a.body, '')) AS longer FROM a FULL OUTER JOIN b ON a.key = b.key)
    SELECT coalesce(ak, bk) AS key, CASE WHEN ak IS NULL OR longer THEN bb ELSE ab END AS body, coalesce(ad, bd) AS date,
    CASE WHEN ak IS NULL THEN 'added' WHEN bk IS NULL THEN 'kept' WHEN longer AND ad IS NULL THEN 'body and date' WHEN longer THEN 'body' WHEN ad IS NULL THEN 'date' ELSE 'kept' END AS change FROM m"""
)
def archive_merge_whole(spark: SparkSession, sf: str) -> DataFrame:
    """Merges whole texts, some with their source, some missing in the base; every document is on a side at least."""
    docs, i = read(spark, sf, "documents"), F.col("doc_id")
    base = docs.where(i % 5 != 4).select(i.alias("key"), F.when(i % 3 != 0, F.col("text")).alias("body"), F.when(i % 7 != 0, F.lit("2024-01-01")).alias("date"))
    more = docs.where((i % 5 == 4) | (i % 2 == 0) | (i % 3 == 0)).select(i.alias("key"), F.when(i % 4 == 0, F.concat("text", F.lit("\n"), "source")).otherwise(F.col("text")).alias("body"), F.lit("2025-01-01").alias("date"))
    return J.merge_archives(base, more, "key")


@query(
    f"""WITH u AS (SELECT doc_id, left(text, {J.BODY_CHARS}) AS one, left(source || chr(10) || text, {J.BODY_CHARS}) AS two FROM documents),
    b AS (SELECT doc_id, CASE WHEN length(two) > length(one) THEN two ELSE one END AS best FROM u)
    SELECT d.doc_id AS key, CASE WHEN length(coalesce(best, '')) > length(coalesce(old, '')) THEN best ELSE old END AS body FROM (SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN text END AS old FROM documents) d JOIN b ON d.doc_id = b.doc_id"""
)
def backfill_bodies_whole(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts and missing bodies, updated by the whole text and by that after its source: BODY_CHARS cuts what comes in."""
    docs, i = read(spark, sf, "documents"), F.col("doc_id")
    archive = docs.select(i.alias("key"), F.when(i % 3 != 0, F.col("text")).alias("body"))
    update = lambda body, s: docs.select(i.alias("key"), body.alias("body"), F.lit(s).alias("seq"))
    return J.backfill_bodies(archive, update(F.col("text"), 1).unionByName(update(F.concat("source", F.lit("\n"), "text"), 2)), "key", "seq")


for _short in ("archive_merge", "backfill_bodies", "judge_prompt"):  # earlier names of the queries over whole texts
    _name = _short + ("_enrich" if _short == "archive_merge" else "")
    _queries[_name], _sql[_name] = _queries[f"{_short}_whole"], _sql[f"{_short}_whole"]


@query("SELECT k.user_id AS key, coalesce(x.seen, 'before') AS seen FROM (SELECT DISTINCT user_id FROM events) k LEFT JOIN (SELECT DISTINCT user_id, 'old' AS seen FROM events WHERE user_id % 7 = 0) x ON k.user_id = x.user_id WHERE k.user_id NOT IN (SELECT user_id FROM events WHERE event_id % 50 = 0)")
def last_seen_state(spark: SparkSession, sf: str) -> DataFrame:
    events = read(spark, sf, "events").select(F.col("user_id").alias("key"), "event_id")
    old = events.where("key % 7 = 0").select("key", F.lit("old").alias("seen")).distinct()
    return J.last_seen(events, events.where("event_id % 50 = 0"), old, F.lit("before"), "key")


@query("SELECT s_suppkey, coalesce(n_name, 'Autres') AS n_name FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON s_nationkey = n_nationkey")
def dimension_lookup(spark: SparkSession, sf: str) -> DataFrame:
    nation = read(spark, sf, "nation").where("n_regionkey < 3").withColumnRenamed("n_nationkey", "s_nationkey")
    return J.look_up(read(spark, sf, "supplier"), nation, "s_nationkey", "n_name", "Autres").select("s_suppkey", "n_name")


# Reports


@query(f"WITH {DECIDED} SELECT doc_id, source, score FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY score DESC, doc_id) AS k FROM dec) WHERE k <= 15")
def per_source_topn(spark: SparkSession, sf: str) -> DataFrame:
    return A.top_by_group(decided(spark, sf), "source", [F.desc("score"), F.col("doc_id").asc()], 15).select("doc_id", "source", "score")


@query(f"WITH {DECIDED} SELECT doc_id, score FROM dec ORDER BY score DESC, doc_id LIMIT 600")
def global_topn(spark: SparkSession, sf: str) -> DataFrame:
    return A.top(decided(spark, sf), [F.desc("score"), F.col("doc_id").asc()], 600).select("doc_id", "score")


@query(f"WITH {DECIDED} SELECT doc_id, row_number() OVER (ORDER BY relevant DESC, CASE level WHEN 'A' THEN 5 WHEN 'B' THEN 4 WHEN 'C' THEN 3 WHEN 'D' THEN 2 WHEN 'E' THEN 1 ELSE 0 END DESC, doc_id % 30 DESC, doc_id) AS place FROM dec ORDER BY place LIMIT 500")
def final_order(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import Window

    order = A.final_order(F.col("relevant"), F.col("level"), F.col("doc_id") % 30, F.col("doc_id"))
    first = decided(spark, sf).orderBy(*order).limit(500)
    return first.select("doc_id", F.row_number().over(Window.orderBy(*order)).cast("long").alias("place"))


@query(f"WITH {DECIDED} SELECT count(*) AS total, count(*) FILTER (WHERE relevant) AS retained, round_even(avg(score), 1) AS avg_score, " + ", ".join(f"count(*) FILTER (WHERE level = '{k}') AS level_{k.lower()}" for k in A.LEVEL_RANK) + ", round_even(100.0 * count(*) FILTER (WHERE relevant) / count(*), 1) AS relevance_rate FROM dec")
def stats(spark: SparkSession, sf: str) -> DataFrame:
    return A.stats(decided(spark, sf))


@query(f"WITH {DECIDED}, g AS (SELECT lang, level, count(*) AS n FROM dec GROUP BY lang, level) SELECT lang, level, n, round_even(100.0 * n / sum(n) OVER (PARTITION BY lang), 1) AS share, round_even(100.0 * n / max(n) OVER (PARTITION BY lang), 1) AS bar FROM g")
def audit_by_group(spark: SparkSession, sf: str) -> DataFrame:
    counted = decided(spark, sf).groupBy("lang", "level").agg(F.count(F.lit(1)).alias("n"))
    return A.shares(counted, "lang", "level", "n")


@query(f"WITH {ART} SELECT doc_id FROM art WHERE contains(lower(title), 'the') AND language = 'en'")
def client_filter(spark: SparkSession, sf: str) -> DataFrame:
    df = articles(spark, sf).withColumn("level", F.col("language"))
    return A.select_rows(df, levels=["en"], words=" THE ", in_columns=("title",)).select("doc_id")


def compared(spark: SparkSession, sf: str) -> DataFrame:
    verdicts = read(spark, sf, "labels").select("doc_id", F.when(F.col("doc_id") % 19 != 0, F.col("quality") == 1).alias("verdict"))
    return E.compare(decided(spark, sf).withColumn("id", F.col("doc_id").cast("string")), verdicts.select(F.col("doc_id").cast("string").alias("id"), "verdict"), "id", "doc_id")


COMPARED = f"{DECIDED}, cmp AS (SELECT d.*, CASE WHEN v.doc_id % 19 = 0 THEN NULL ELSE v.quality = 1 END AS verdict FROM dec d JOIN labels v ON d.doc_id = v.doc_id), buc AS (SELECT *, CASE WHEN verdict IS NULL THEN 'no_verdict' WHEN relevant AND verdict THEN 'both' WHEN relevant THEN 'only_score' WHEN verdict THEN 'only_judge' ELSE 'neither' END AS bucket FROM cmp)"


@query(f"WITH {COMPARED} SELECT " + ", ".join(f"count(*) FILTER (WHERE bucket = '{b}') AS {b}" for b in ("both", "neither", "only_score", "only_judge", "no_verdict")) + ", round_even(1.0 * count(*) FILTER (WHERE bucket IN ('both', 'neither')) / count(*) FILTER (WHERE bucket <> 'no_verdict'), 4) AS agreement FROM buc")
def judge_contingency(spark: SparkSession, sf: str) -> DataFrame:
    return E.agreement(compared(spark, sf))


@query(f"WITH {COMPARED}, n AS (SELECT count(*) FILTER (WHERE relevant AND verdict) AS tp, count(*) FILTER (WHERE relevant AND NOT verdict) AS fp, count(*) FILTER (WHERE NOT relevant AND verdict) AS fn, count(*) FILTER (WHERE NOT relevant AND NOT verdict) AS tn FROM buc) SELECT tp, fp, fn, tn, round_even(1.0 * tp / (tp + fp), 4) AS precision, round_even(1.0 * tp / (tp + fn), 4) AS recall, round_even(2.0 * tp / (2 * tp + fp + fn), 4) AS f1 FROM n")
def precision_recall_f1(spark: SparkSession, sf: str) -> DataFrame:
    return compared(spark, sf).agg(*E.measure(F.col("relevant"), F.col("verdict")))


@query(f"WITH {COMPARED}, c AS (SELECT bucket, source AS value, count(*) AS n FROM buc GROUP BY 1, 2) SELECT bucket, value, n FROM (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY n DESC, value) AS k FROM c) WHERE k <= 3")
def disagreements_by_source(spark: SparkSession, sf: str) -> DataFrame:
    return E.disagreements_by(compared(spark, sf), "source", 3).select("bucket", "value", "n")


@query(rf"WITH {ART}, w AS (SELECT language, unnest({_LONG}) AS word FROM art), a AS (SELECT word, count(*) AS n FROM w WHERE language = 'fr' GROUP BY word), r AS (SELECT word, count(*) AS r FROM w WHERE language <> 'fr' GROUP BY word), t AS (SELECT count(*) FILTER (WHERE language = 'fr') AS total, count(*) FILTER (WHERE language <> 'fr') AS ref_total FROM w), l AS (SELECT a.word, n, (n * 1.0::DOUBLE / total) / (coalesce(r, 1) * 1.0::DOUBLE / ref_total) AS lift FROM a LEFT JOIN r ON a.word = r.word CROSS JOIN t WHERE n >= 3) SELECT word, n, round_even(lift, 1) AS lift FROM l WHERE lift > 1.5")
def overrepresented_words(spark: SparkSession, sf: str) -> DataFrame:
    words = articles(spark, sf).select("language", F.explode(T.significant_words(F.col("title"))).alias("word"))
    return E.over_represented(words.where("language = 'fr'"), words.where("language <> 'fr'"))


@query()
def stable_suffix(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents").where("length(text) > 400").withColumn("body", F.concat("text", F.lit(" "), F.repeat(F.concat("source", F.lit(" footer ")), 15)))
    return A.shared_suffix(docs, "source", "body")


# Time

_NOW = "2026-01-01 00:00:00"


@query(f"WITH a AS (SELECT event_id, (epoch_us(TIMESTAMP '{_NOW}') - epoch_us(ts)) / 86400e6 AS d FROM events) SELECT CASE WHEN d < 0 THEN 'future' WHEN d < 1 THEN 'today' WHEN d < 2 THEN 'yesterday' WHEN d < 30 THEN CAST(floor(d) AS BIGINT) || ' d' WHEN d < 365 THEN CAST(floor(d / 30) AS BIGINT) || ' mo' ELSE CAST(floor(d / 365) AS BIGINT) || ' y' END AS age, count(*) AS n FROM a GROUP BY 1")
def age_buckets(spark: SparkSession, sf: str) -> DataFrame:
    now = F.lit(_NOW).cast("timestamp")
    return read(spark, sf, "events").groupBy(X.relative_age(F.col("ts"), now).alias("age")).agg(F.count(F.lit(1)).alias("n"))


@query("WITH m AS (SELECT max(epoch_us(ts)) AS now FROM events), s AS (SELECT user_id, max(epoch_us(ts)) AS last FROM events GROUP BY user_id) SELECT user_id, (now - last) >= 7200000000 AS stale FROM s CROSS JOIN m")
def freshness_ttl(spark: SparkSession, sf: str) -> DataFrame:
    events = read(spark, sf, "events")
    now = events.agg(F.max("ts").alias("now"))  # one row
    last = events.groupBy("user_id").agg(F.max("ts").alias("last")).crossJoin(F.broadcast(now))
    return last.select("user_id", X.is_stale(F.col("last"), F.col("now"), 7200).alias("stale"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_id % 2 = 0 END AS pertinent, CASE WHEN event_id % 3 = 1 THEN 'no boolean' WHEN event_id % 3 = 2 THEN 'no object' END AS erreur FROM events")
def verdict_parse(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("event_id")
    answer = F.when(i % 3 == 0, F.concat(F.lit('Answer: {"pertinent": '), (i % 2 == 0).cast("string"), F.lit(', "raison": "x"} done'))).when(i % 3 == 1, F.lit('{"pertinent": "true"}')).otherwise("no answer")
    return read(spark, sf, "events").select("event_id", H.parse_verdict(answer).alias("v")).select("event_id", "v.pertinent", "v.erreur")


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


__all__ = ["Column", "oracle_sql", "queries"]
