"""Queries of the library's smaller operators, each over its whole table, with SQL that states what it returns."""

from __future__ import annotations

import dataclasses
import tempfile
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import arrays as R
from ..functions import dates as X
from ..functions import pages as H
from ..functions import text as T
from ..functions import urls as U
from ..operators import aggregates as A
from ..operators import archive as J
from ..operators import evaluation as E
from ..operators import facets as C
from ..operators import intervals as N
from ..operators import matching as P
from ..operators import scoring as S
from ..operators import vocabulary_tables as V
from ..operators.vocabulary import Stem, TermSet
from ..sources import configs, readers, rescoring, snapshots, writers
from ..sources import page_cache as G
from ..sources import requests as Q
from ..streaming import incremental as I
from ..streaming import stateful as K
from . import demo
from .queries import _DOMAIN, _SEGMENTS, _TITLE, ART, COMPARED, _has, _sql, articles, compared, oracle_sql, queries, query, read

__all__ = ["oracle_sql", "queries"]


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share, or a local one in a local session; a cluster without one is refused."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared and (not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir is unset: executors of a cluster need a folder that all of them share")
    return f"{shared or 'file://' + tempfile.mkdtemp(prefix='newsloom-')}/{name}-{uuid.uuid4().hex}"



# Titles and texts

_BY = r"^(.*?)\bBy [A-Z][a-zA-Z''-]+(?: [A-Z][a-zA-Z''-]+){1,3}\b\s+\S"


@query(f"WITH {ART}, x AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN title || ' By Jane Van Doe 12 May' ELSE title END AS t FROM art), h AS (SELECT doc_id, t, trim(regexp_extract(t, '{_BY}', 1)) AS head FROM x) SELECT doc_id, CASE WHEN head <> '' THEN head ELSE t END AS bare FROM h")
def strip_byline(spark: SparkSession, sf: str) -> DataFrame:
    t = F.when(F.col("doc_id") % 2 == 0, F.concat("title", F.lit(" By Jane Van Doe 12 May"))).otherwise(F.col("title"))
    return articles(spark, sf).select("doc_id", T.strip_byline(t).alias("bare"))


_CARD = "'Press release ' || title || ' ' || title || '  Date Date 3 May 2024'"


@query(
    rf"""WITH {ART}, x AS (SELECT doc_id, {_CARD} AS t FROM art), s AS (SELECT doc_id, t, trim(regexp_replace(regexp_replace(t, '\s*\bDate Date\b.*$', ''), '^(?:Press release|Media advisory|Project Update|News Item|Story)\s+', '')) AS s FROM x),
    o AS (SELECT doc_id, t, CASE WHEN length(s) % 2 = 1 AND length(s) > 2 AND substr(s, (length(s) + 1) // 2, 1) = ' ' AND substr(s, 1, (length(s) - 1) // 2) = substr(s, (length(s) + 3) // 2) THEN substr(s, 1, (length(s) - 1) // 2) ELSE s END AS o FROM s)
    SELECT doc_id, CASE WHEN o <> '' THEN o ELSE t END AS bare FROM o"""
)
def strip_card(spark: SparkSession, sf: str) -> DataFrame:
    return articles(spark, sf).select("doc_id", T.strip_card(F.concat(F.lit("Press release "), "title", F.lit(" "), "title", F.lit("  Date Date 3 May 2024"))).alias("bare"))


@query(rf"WITH {ART} SELECT doc_id, regexp_replace(title || ' - ' || source || ' News', '\s+-\s+[^-]{{2,60}}$', '') AS bare FROM art")
def strip_site_name(spark: SparkSession, sf: str) -> DataFrame:
    return articles(spark, sf).select("doc_id", T.strip_site_name(F.concat("title", F.lit(" - "), "source", F.lit(" News"))).alias("bare"))


@query(f"WITH {ART} SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN trim(body) ELSE body END AS bare FROM art")
def strip_suffix(spark: SparkSession, sf: str) -> DataFrame:
    """Half of the bodies end with their source's footer."""
    body = F.when(F.col("doc_id") % 2 == 0, F.concat("body", F.lit(" About "), "source")).otherwise(F.col("body"))
    return articles(spark, sf).select("doc_id", T.strip_suffix(body, F.concat(F.lit(" About "), "source")).alias("bare"))


@query("SELECT c_custkey, trim(regexp_replace(lower(strip_accents(c_name || ' Été à Óbidos')), '[^a-z0-9]+', '_', 'g'), '_') AS code FROM customer")
def place_codes(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "customer").select("c_custkey", T.place_code(F.concat("c_name", F.lit(" Été à Óbidos"))).alias("code"))


@query(f"WITH {ART}, n AS (SELECT doc_id, language, length(regexp_replace(body, '[^а-яёА-ЯЁ]', '', 'g')) AS c, length(regexp_replace(body, '[^a-zA-Z]', '', 'g')) AS l FROM art) SELECT doc_id, CASE WHEN doc_id % 3 = 2 THEN language WHEN c + l < 20 THEN '' WHEN c > 0.3 * (c + l) THEN 'ru' ELSE 'en' END AS language FROM n")
def resolve_language(spark: SparkSession, sf: str) -> DataFrame:
    declared = F.when(F.col("doc_id") % 3 == 0, "").when(F.col("doc_id") % 3 == 1, "multi").otherwise(F.col("language"))
    return articles(spark, sf).select("doc_id", T.resolve_language(declared, F.col("body")).alias("language"))


@query(f"WITH {ART} SELECT doc_id, CASE WHEN contains(body, ' ') THEN substr(body, instr(body, ' ') + 1) ELSE '' END AS cut FROM art")
def cut_to_word(spark: SparkSession, sf: str) -> DataFrame:
    return articles(spark, sf).select("doc_id", T.cut_to_word(F.col("body")).alias("cut"))


@query("SELECT doc_id, replace(format('{:,}', n_chars * 997), ',', ' ') AS shown FROM documents")
def thousands(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "documents").select("doc_id", T.thousands(F.col("n_chars") * 997).alias("shown"))


@query("SELECT conv_id, turn, contains(lower(text), 'the ') OR contains(lower(text), 'nicht') AS refused FROM conversations")
def refusals(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "conversations").select("conv_id", "turn", T.looks_like_refusal(F.col("text"), ["the ", "nicht"]).alias("refused"))


# URLs

_ORG = "CASE WHEN len(string_split({0}, '.')) > 1 THEN string_split({0}, '.')[len(string_split({0}, '.')) - 1] ELSE '' END"


@query(
    f"""WITH d AS (SELECT page_id, url, {_DOMAIN} AS domain, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS host FROM pages)
    SELECT page_id, domain, {_ORG.format('domain')} AS organisation, host = 'news.google.com' AS redirect, CASE WHEN regexp_matches(lower(url), '^https?://') THEN url ELSE '' END AS safe,
      domain = 'example.org' OR ends_with(domain, '.example.org') AS excluded, {_ORG.format('domain')} = 'example' AS same FROM d"""
)
def url_parts(spark: SparkSession, sf: str) -> DataFrame:
    url = F.col("url")
    own = U.domain(url)
    return read(spark, sf, "pages").select("page_id", own.alias("domain"), U.organisation(own).alias("organisation"), U.is_redirect(url).alias("redirect"), U.safe_url(url).alias("safe"), U.is_excluded(own, ["example.org"]).alias("excluded"), U.same_organisation(own, F.lit("www.example.com")).alias("same"))


@query(
    rf"""WITH p AS (SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || CASE WHEN page_id % 2 = 0 THEN path || path ELSE path || '/a/b/a' END AS url FROM (SELECT *, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages)),
    s AS (SELECT page_id, {_SEGMENTS} AS seg FROM p) SELECT page_id, len(list_filter(range(2, len(seg) // 2 + 1), lambda k: seg[1:k] = seg[k + 1:2 * k])) > 0 AS repeated FROM s"""
)
def repeated_prefixes(spark: SparkSession, sf: str) -> DataFrame:
    path = U.path(F.col("url"))
    made = F.concat(F.regexp_extract("url", "^([a-z]+://[^/?#]*)", 1), F.when(F.col("page_id") % 2 == 0, F.concat(path, path)).otherwise(F.concat(path, F.lit("/a/b/a"))))
    return read(spark, sf, "pages").select("page_id", U.repeated_prefix(made).alias("repeated"))


@query(f"SELECT DISTINCT domain FROM (SELECT {_DOMAIN} AS domain FROM pages UNION ALL SELECT 'feeds.' || {_DOMAIN} FROM pages WHERE page_id % 3 = 0) WHERE domain <> ''")
def known_domains(spark: SparkSession, sf: str) -> DataFrame:
    feed = F.concat(F.lit("http://feeds."), U.domain(F.col("url")), F.lit("/rss"))
    pages = read(spark, sf, "pages").select("url", F.when(F.col("page_id") % 3 == 0, F.array(feed)).alias("feeds"), F.lit(None).cast("array<string>").alias("fallbacks"))
    return readers.known_domains(pages)


@query(f"WITH d AS (SELECT page_id, {_DOMAIN} AS domain FROM pages) SELECT domain, count(*) AS n, min(page_id) AS example FROM d WHERE domain NOT IN (SELECT domain FROM d WHERE page_id % 4 = 0) GROUP BY domain")
def candidate_domains(spark: SparkSession, sf: str) -> DataFrame:
    cited = read(spark, sf, "pages").select("page_id", U.domain(F.col("url")).alias("domain"))
    return E.candidates(cited, cited.where("page_id % 4 = 0"))


_FEED_TITLE = "trim(regexp_replace(lower(title), '[^a-z]+', ' ', 'g'))"
_PASSES = "length({0}) >= 8 AND contains({0}, ' ') AND {0} NOT IN (" + ", ".join("'" + t.replace("'", "''") + "'" for t in U.GENERIC_TITLES) + ")"


@query(f"WITH {ART}, t AS (SELECT doc_id, source, {_FEED_TITLE} AS title FROM art), e AS (SELECT doc_id, title, 'https://' || source || '.org/news/' || doc_id || '/a' AS link, doc_id % 3 AS k FROM t) SELECT doc_id, title, link, CASE WHEN k = 0 THEN 'about ' || title ELSE '' END AS summary FROM e WHERE k < 2 AND {_PASSES.format('title')}")
def feed_items(spark: SparkSession, sf: str) -> DataFrame:
    """An RSS feed for a third of the documents, an Atom feed for another, and a torn one."""
    title = F.trim(F.regexp_replace(F.lower("title"), "[^a-z]+", " "))
    link = F.concat(F.lit("https://"), "source", F.lit(".org/news/"), F.col("doc_id").cast("string"), F.lit("/a?utm_source=x"))
    rss = F.concat(F.lit('<?xml version="1.0"?><rss><channel><item><title>'), title, F.lit("</title><link>"), link, F.lit("</link><description>about "), title, F.lit("</description></item><item><title>no link at all</title></item></channel></rss>"))
    atom = F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>'), title, F.lit('</title><link href="'), link, F.lit('"/></entry></feed>'))
    content = F.when(F.col("doc_id") % 3 == 0, rss).when(F.col("doc_id") % 3 == 1, atom).otherwise(F.concat(F.lit("<rss><channel><item><title>"), title))
    items = H.feed_items(articles(spark, sf).select("doc_id", content.alias("content")))
    return items.select("doc_id", "title", "link", "summary")


# Dates

_STAMPED = "SELECT event_id, ts, event_id % 5 AS k FROM events"


@query(f"SELECT event_id, CASE k WHEN 4 THEN 0 WHEN 3 THEN epoch(date_trunc('day', ts))::BIGINT ELSE epoch(date_trunc('second', ts))::BIGINT END AS seconds FROM ({_STAMPED})")
def parsed_dates(spark: SparkSession, sf: str) -> DataFrame:
    k, shown = F.col("event_id") % 5, lambda f: F.date_format("ts", f)
    written = F.when(k == 0, shown("yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k == 1, shown("EEE, dd MMM yyyy HH:mm:ss '+0000'")).when(k == 2, shown("d MMM yyyy HH:mm:ss 'GMT'")).when(k == 3, shown("yyyy-MM-dd")).otherwise("no date at all")
    return read(spark, sf, "events").select("event_id", X.epoch_seconds(X.parse_date(written)).alias("seconds"))


@query("WITH a AS (SELECT event_id, ts, (epoch_us(TIMESTAMP '2024-03-01') - epoch_us(ts)) / 86400e6 AS d FROM events) SELECT event_id, CAST(round_even(d, 0) AS INTEGER) AS days, d >= 60 AS archival, strftime(ts, '%d/%m/%Y à %H:%M UTC') AS shown FROM a")
def date_facts(spark: SparkSession, sf: str) -> DataFrame:
    now, ts = F.lit("2024-03-01").cast("timestamp"), F.col("ts")
    return read(spark, sf, "events").select("event_id", X.whole_days(ts, now).alias("days"), X.is_archival(ts, now).alias("archival"), X.format_date(ts).alias("shown"))


# Arrays, numbers, matching

_WORDS_OF = r"regexp_extract_all(lower({0}), '[\p{{L}}]{{4,}}')"


@query(f"WITH {ART}, w AS (SELECT doc_id, list_concat({_WORDS_OF.format('title')}, {_WORDS_OF.format('source || body')}) AS w FROM art), x AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w), f AS (SELECT doc_id, word, min(i) AS i FROM x GROUP BY doc_id, word), j AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS words FROM f GROUP BY doc_id) SELECT art.doc_id, coalesce(words, '') AS words FROM art LEFT JOIN j ON art.doc_id = j.doc_id")
def ordered_words(spark: SparkSession, sf: str) -> DataFrame:
    """Words of the title and then of the text, once each."""
    w = lambda c: F.regexp_extract_all(F.lower(c), F.lit(r"(?U)[^\W\d_]{4,}"), F.lit(0))
    return articles(spark, sf).select("doc_id", F.array_join(R.ordered_union(w(F.col("title")), w(F.concat("source", "body"))), " ").alias("words"))


@query(f"WITH {ART}, h AS (SELECT doc_id, {_has('norm', 'the')} AS a, {_has('norm', 'of the')} AS b, {_has('norm', 'with')} AS c FROM art) SELECT doc_id, concat_ws(',', CASE WHEN a AND NOT b THEN 'the' END, CASE WHEN b THEN 'of the' END, CASE WHEN c THEN 'with' END) AS found FROM h")
def without_inclusions(spark: SparkSession, sf: str) -> DataFrame:
    norm, terms = T.normalize(F.col("body")), TermSet.of("t", ["the", "of the", "with"])
    found = R.present(*((P.phrase_present(F.col("norm"), t), F.lit(t)) for t in terms.terms))
    return articles(spark, sf).select("doc_id", norm.alias("norm")).select("doc_id", F.array_join(R.without_contained(found, terms.containers()), ",").alias("found"))


@query("SELECT doc_id, CAST(least(n_chars % 50 + 7, 40) AS INTEGER) AS capped, CAST(greatest(0, least(100, n_chars - 500)) AS INTEGER) AS clamped FROM documents")
def bounded_numbers(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("n_chars").cast("int")
    return read(spark, sf, "documents").select("doc_id", R.capped_add(n % 50, 7, 40).alias("capped"), R.clamp(n - 500).alias("clamped"))


@query(f"WITH {ART} SELECT doc_id, {_has('norm', 'by the')} AS phrase, regexp_matches(norm, '(?is)wi(th|ll)|de[rs] ') AS pattern, regexp_extract(norm, 'ti[oa]n', 0) AS stem, contains(norm, 'ing') OR contains(norm, 'eau') AS parts FROM art")
def match_kinds(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("norm")
    df = articles(spark, sf).select("doc_id", T.normalize(F.col("body")).alias("norm"))
    return df.select("doc_id", P.phrase_present(c, "by  The").alias("phrase"), P.any_pattern(c, ["wi(th|ll)", "de[rs] "]).alias("pattern"), P.stem_match(c, "ti[oa]n").alias("stem"), P.contains_any(c, ["ing", "eau"]).alias("parts"))


@query(f"WITH {ART} SELECT doc_id, concat_ws(',', CASE WHEN {_has('norm', 'les')} THEN 'les' END, CASE WHEN language = 'fr' AND contains(norm, 'eau') THEN 'water' END, CASE WHEN contains(norm, 'ing') THEN 'form' END, CASE WHEN NOT {_has('norm', 'les')} AND contains(norm, 'les ') THEN 'les' END) AS found FROM art")
def terms_with_stems(spark: SparkSession, sf: str) -> DataFrame:
    found = P.find_with_stems(F.col("norm"), F.col("language"), TermSet.of("t", ["les"]), [Stem("water", "eau", "fr"), Stem("form", "ing"), Stem("les", "les ")])
    df = articles(spark, sf).select("doc_id", "language", T.normalize(F.col("body")).alias("norm"))
    return df.select("doc_id", F.array_join(found, ",").alias("found"))


# Archives

_ENTRY = "SELECT CAST(page_id AS VARCHAR) AS key, url, {title} AS title, CASE WHEN page_id % 3 <> 0 THEN html ELSE '' END AS body, CASE WHEN page_id % 2 = 0 THEN '2024-01-02' END AS date, page_id FROM pages"


def _entries(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("page_id")
    return read(spark, sf, "pages").select(i.cast("string").alias("key"), "url", F.regexp_extract("html", "(?is)<title>(.*?)</title>", 1).alias("title"), F.when(i % 3 != 0, F.col("html")).otherwise("").alias("body"), F.when(i % 2 == 0, "2024-01-02").alias("date"), "page_id")


@query(f"WITH s AS ({_sql['section_page']}), e AS ({_ENTRY.format(title=_TITLE)}) SELECT e.page_id FROM e JOIN s ON e.page_id = s.page_id WHERE body = '' OR (date IS NULL AND NOT section)")
def pending_work(spark: SparkSession, sf: str) -> DataFrame:
    return readers.pending(_entries(spark, sf)).select("page_id")


@query(f"WITH e AS ({_ENTRY.format(title=_TITLE)}) SELECT key AS archive_key, CASE WHEN date IS NULL THEN 0 ELSE epoch(CAST(date AS TIMESTAMP))::BIGINT END AS seconds, CASE WHEN page_id % 5 = 0 THEN 't' || page_id END AS derniere_vue FROM e")
def archive_articles(spark: SparkSession, sf: str) -> DataFrame:
    entries = _entries(spark, sf)
    seen = entries.where("page_id % 5 = 0").select("key", F.concat(F.lit("t"), "key").alias("seen"))
    return readers.articles_of(entries, seen).select("archive_key", X.epoch_seconds(F.col("date")).alias("seconds"), "derniere_vue")


@query("SELECT CAST(doc_id AS VARCHAR) AS key, CASE WHEN doc_id % 2 = 0 THEN text || ' new' ELSE text END AS body FROM documents")
def archive_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Every document as a JSON line; even ones come twice, and the later line holds. Torn lines and lines without a key are left out."""
    i, path = F.col("doc_id"), scratch(spark, "archive")
    line = lambda key, body: F.to_json(F.struct(key.alias("key"), body.alias("body")))
    key = i.cast("string")
    lines = F.array(line(key, F.col("text")), F.when(i % 2 == 0, line(key, F.concat("text", F.lit(" new")))), F.when(i % 7 == 0, F.lit('{"key": "torn')), F.when(i % 9 == 0, line(F.lit(""), F.col("text"))))
    read(spark, sf, "documents").select(F.explode(F.filter(lines, lambda x: x.isNotNull())).alias("value")).write.text(path)
    return readers.archive(spark, path)[0].select("key", "body")


@query("SELECT count(*) FILTER (WHERE doc_id % 7 = 0) AS corrupt, count(*) FILTER (WHERE doc_id % 9 = 0) AS keyless FROM documents")
def archive_scan_errors(spark: SparkSession, sf: str) -> DataFrame:
    i, path = F.col("doc_id"), scratch(spark, "archive")
    good = F.to_json(F.struct(F.when(i % 9 == 0, "").otherwise(i.cast("string")).alias("key"), F.col("text").alias("body")))
    lines = F.array(good, F.when(i % 7 == 0, F.lit('{"key": "torn')))
    read(spark, sf, "documents").select(F.explode(F.filter(lines, lambda x: x.isNotNull())).alias("value")).write.text(path)
    return readers.archive(spark, path)[1]


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, source || '; ' || lang AS tags FROM documents WHERE lang IN ('fr', 'en')")
def csv_export(spark: SparkSession, sf: str) -> DataFrame:
    """Written as CSV, read again, and cut to two levels."""
    path = scratch(spark, "csv")
    docs = read(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text", F.array("source", "lang").alias("tags"), F.col("lang").alias("level"))
    writers.export_csv(docs, path, {"tags": "; "})
    return readers.of_levels(readers.csv_rows(spark, path), ["fr", "en"]).select("doc_id", "text", "tags")


@query("SELECT doc_id, text FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, text FROM documents WHERE doc_id % 2 = 0 AND doc_id % 3 = 0")
def lines_appended_and_rewritten(spark: SparkSession, sf: str) -> DataFrame:
    path, docs = scratch(spark, "lines"), read(spark, sf, "documents").select("doc_id", "text")
    writers.append_lines(docs, path)
    writers.append_lines(docs.where("doc_id % 3 = 0"), path)
    writers.rewrite(spark.read.schema(docs.schema).json(path).where("doc_id % 2 = 0"), path)
    return spark.read.schema(docs.schema).json(path)


_OLD = "SELECT CAST(doc_id AS VARCHAR) AS key, CASE WHEN doc_id % 4 <> 0 THEN text END AS body, CASE WHEN doc_id % 3 = 0 THEN '2024' END AS date, doc_id FROM documents WHERE doc_id % 5 <> 0"
_NEW = "SELECT CAST(doc_id AS VARCHAR) AS key, CASE WHEN doc_id % 6 = 0 THEN text || ' more' ELSE text END AS body, CASE WHEN doc_id % 2 = 0 THEN '2025' END AS date, doc_id FROM documents WHERE doc_id % 7 <> 0 OR doc_id % 5 = 0"


def _old_and_new(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    docs, i = read(spark, sf, "documents"), F.col("doc_id")
    old = docs.where(i % 5 != 0).select(i.cast("string").alias("key"), F.when(i % 4 != 0, F.col("text")).alias("body"), F.when(i % 3 == 0, "2024").alias("date"))
    new = docs.where((i % 7 != 0) | (i % 5 == 0)).select(i.cast("string").alias("key"), F.when(i % 6 == 0, F.concat("text", F.lit(" more"))).otherwise(F.col("text")).alias("body"), F.when(i % 2 == 0, "2025").alias("date"), i.alias("seq"))
    return old, new


@query(f"WITH o AS ({_OLD}), n AS ({_NEW}) SELECT key, body, date FROM o UNION ALL SELECT key, body, date FROM n WHERE key NOT IN (SELECT key FROM o)")
def scan_merged(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _old_and_new(spark, sf)
    return J.merge_scan(old, new.unionByName(new.withColumn("body", F.lit("later")).withColumn("seq", F.col("seq") + 1_000_000_000)), "key", "seq")


@query(f"WITH o AS ({_OLD}), n AS ({_NEW}) SELECT o.key, o.body, coalesce(o.date, n.date) AS date FROM o LEFT JOIN n ON o.key = n.key")
def dates_backfilled(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _old_and_new(spark, sf)
    return J.backfill_dates(old, new.unionByName(new.withColumn("date", F.lit("2099")).withColumn("seq", F.col("seq") + 1_000_000_000).where("date IS NULL")), "key", "seq")


@query(f"WITH o AS ({_OLD}), n AS ({_NEW}) SELECT coalesce(o.key, n.key) AS key, CASE WHEN length(coalesce(left(n.body, {J.BODY_CHARS}), '')) > length(coalesce(o.body, '')) AND o.key IS NOT NULL THEN left(n.body, {J.BODY_CHARS}) WHEN o.key IS NULL THEN n.body ELSE o.body END AS body, coalesce(o.date, n.date) AS date FROM o FULL OUTER JOIN n ON o.key = n.key")
def archive_enriched(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _old_and_new(spark, sf)
    return I.enrich(old, new)


@query(f"WITH o AS ({_OLD}), n AS ({_NEW}) SELECT key, body FROM n UNION ALL SELECT key, body FROM o WHERE key NOT IN (SELECT key FROM n)")
def scan_with_archive(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _old_and_new(spark, sf)
    return J.with_archive(new.select("key", "body"), old.select("key", "body"), "key")


@query(f"WITH o AS ({_OLD}), n AS ({_NEW}) SELECT n.key, coalesce(nullif(o.body, ''), n.body) AS body FROM n LEFT JOIN o ON o.key = n.key")
def bodies_from_archive(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _old_and_new(spark, sf)
    return J.body_from_archive(new.select("key", "body"), old, "key")


@query(f"WITH o AS ({_OLD}), n AS ({_NEW}) SELECT key, 1 AS side FROM o UNION ALL SELECT key, 2 AS side FROM n WHERE key NOT IN (SELECT key FROM o)")
def priority_union(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _old_and_new(spark, sf)
    return J.priority_union(old.select("key", F.lit(1).alias("side")), new.select("key", F.lit(2).alias("side")), "key")


@query(f"WITH o AS ({_OLD}), n AS ({_NEW}) SELECT n.key, coalesce('t' || o.key, 'now') AS seen FROM n LEFT JOIN o ON n.key = o.key")
def seen_times(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _old_and_new(spark, sf)
    return J.seen_at(new.select("key"), old.select("key", F.concat(F.lit("t"), "key").alias("seen")), F.lit("now"), "key")


@query(f"WITH {ART} SELECT doc_id, norm AS body, norm IS DISTINCT FROM body AS changed FROM art")
def cleaning_pass(spark: SparkSession, sf: str) -> DataFrame:
    return J.clean_column(articles(spark, sf).select("doc_id", "body"), "body", T.normalize(F.col("body")))


@query("WITH m AS (SELECT source, text, length(regexp_extract(text, '(?is)^(.*?)Follow us on', 1)) AS n, regexp_matches(text, '(?i)follow us on') AS found FROM documents), c AS (SELECT source, trim(regexp_replace(CASE WHEN found AND n >= 0.8 * length(text) THEN substr(text, 1, n) ELSE text END, '\\s+', ' ', 'g')) AS body FROM m) SELECT source, body FROM c WHERE length(body) > 400")
def boilerplate_bodies(spark: SparkSession, sf: str) -> DataFrame:
    return readers.boilerplate_bodies(read(spark, sf, "documents").select("source", F.col("text").alias("body")))


# Reports

@query("SELECT 'n_name' AS axis, n_name AS class, count(*) AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey < 3 GROUP BY n_name")
def country_counts(spark: SparkSession, sf: str) -> DataFrame:
    nation = read(spark, sf, "nation").where("n_regionkey < 3").withColumnRenamed("n_nationkey", "s_nationkey")
    return A.facet_counts(J.look_up(read(spark, sf, "supplier"), nation, "s_nationkey", "n_name", "Autres"), {"n_name": "Autres"})


@query("WITH r AS (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS k, count(*) OVER (PARTITION BY lang) AS n FROM documents) SELECT lang, n, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS ids FROM r WHERE k <= 20 GROUP BY lang, n")
def level_sections(spark: SparkSession, sf: str) -> DataFrame:
    found = A.grouped_in_order(read(spark, sf, "documents").select("lang", "doc_id"), "lang", F.length("lang"), ["doc_id"], "doc_id", 20)
    return found.select("lang", "n", F.array_join(F.col("rows.doc_id").cast("array<string>"), ",").alias("ids"))


@query(f"WITH {COMPARED} SELECT CAST(doc_id AS VARCHAR) AS id, bucket, score FROM buc WHERE bucket LIKE 'only%' ORDER BY bucket = 'only_judge' DESC, score DESC, CAST(doc_id AS VARCHAR) LIMIT 40")
def to_review(spark: SparkSession, sf: str) -> DataFrame:
    return E.to_review(compared(spark, sf), "id", 1, 40, 0).select("id", "bucket", "score")


@query("WITH m AS (SELECT max(epoch_us(ts)) AS now FROM events) SELECT event_id FROM events, m WHERE event_id % 11 = 0 OR (now - epoch_us(ts)) / 86400e6 <= 14 ORDER BY value DESC, event_id LIMIT 15")
def synthesis_selection(spark: SparkSession, sf: str) -> DataFrame:
    events = read(spark, sf, "events")
    df = events.crossJoin(F.broadcast(events.agg(F.max("ts").alias("now"))))  # one row
    age = F.when(F.col("event_id") % 11 != 0, X.age_days(F.col("ts"), F.col("now")))
    return A.recent_best(df.withColumn("age", age), F.col("age"), F.col("value"), F.col("event_id")).select("event_id")


@query("SELECT event_id, user_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS k FROM events) WHERE k <= 3")
def newest_by_user(spark: SparkSession, sf: str) -> DataFrame:
    return A.keep_newest(read(spark, sf, "events"), [F.desc("ts"), F.col("event_id").asc()], 3, "user_id").select("event_id", "user_id")


@query("SELECT event_id FROM events ORDER BY ts DESC, event_id LIMIT 500")
def newest_cache(spark: SparkSession, sf: str) -> DataFrame:
    return A.keep_newest(read(spark, sf, "events"), [F.desc("ts"), F.col("event_id").asc()], 500).select("event_id")


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN lang ELSE 'none' END AS lang, 0 AS score FROM documents")
def audit_fields(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("lang"))
    return A.audit(docs, {"doc_id": -1, "lang": "none", "score": 0})


# Increments

@query("WITH m AS (SELECT max(epoch_us(ts)) AS now FROM events), s AS (SELECT user_id, max(epoch_us(ts)) AS last FROM events GROUP BY user_id) SELECT user_id FROM s, m WHERE user_id % 5 = 0 OR user_id % 7 = 0 OR now - last >= 7200000000")
def stale_sources(spark: SparkSession, sf: str) -> DataFrame:
    events = read(spark, sf, "events")
    last = events.groupBy("user_id").agg(F.max("ts").alias("ts")).crossJoin(F.broadcast(events.agg(F.max("ts").alias("now"))))  # one row
    sources = last.withColumns({"scanned_at": F.when(F.col("user_id") % 7 != 0, F.col("ts")), "ok": F.col("user_id") % 5 != 0})
    return I.stale_sources(sources, F.col("now"), 7200).select("user_id")


@query("WITH m AS (SELECT max(epoch_us(ts)) AS now FROM events), l AS (SELECT user_id, arg_max(event_id, ts) AS event_id, max(ts) AS ts FROM events, m WHERE now - epoch_us(ts) < 172800000000 GROUP BY user_id) SELECT user_id, event_id FROM l ORDER BY ts DESC, user_id LIMIT 100")
def page_cache(spark: SparkSession, sf: str) -> DataFrame:
    events = read(spark, sf, "events").select("user_id", "event_id", F.col("ts").alias("fetched_at"))
    rows = events.crossJoin(F.broadcast(events.agg(F.max("fetched_at").alias("now"))))  # one row
    return I.update_cache(rows.where("event_id % 2 = 0"), rows.where("event_id % 2 = 1"), F.col("now"), "user_id", n=100).select("user_id", "event_id")


@query("WITH m AS (SELECT max(event_id) FILTER (WHERE event_id % 3 = 0) + 1 AS o FROM events), b AS (SELECT user_id AS key, CASE WHEN event_id % 3 = 0 THEN event_id ELSE event_id + o END AS seq FROM events, m), f AS (SELECT key, min(seq) AS seq FROM b GROUP BY key) SELECT key, seq FROM f ORDER BY seq DESC, key LIMIT 60")
def seen_keys(spark: SparkSession, sf: str) -> DataFrame:
    events = read(spark, sf, "events").select(F.col("user_id").alias("key"), F.col("event_id").alias("seq"))
    return I.update_seen(events.where("seq % 3 = 0"), events.where("seq % 3 <> 0"), 60)


@query("WITH a AS (SELECT user_id AS source_name, event_id AS attempt, event_type IN ('view', 'click') AND user_id % 3 = 0 AS is_feed, event_id % 4 <> 0 AS ok FROM events), f AS (SELECT source_name, attempt FROM a WHERE ok AND is_feed), b AS (SELECT source_name, min(attempt) AS attempt FROM a WHERE ok AND NOT is_feed AND source_name NOT IN (SELECT source_name FROM f) GROUP BY source_name) SELECT * FROM f UNION ALL SELECT * FROM b")
def collected_sources(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("event_id")
    events = read(spark, sf, "events").select(F.col("user_id").alias("source_name"), i.alias("attempt"), i.alias("rank"), (F.col("event_type").isin("view", "click") & (F.col("user_id") % 3 == 0)).alias("is_feed"), (i % 4 != 0).alias("ok"))
    return readers.collect(events, events.select("source_name", "attempt"))


@query("WITH m AS (SELECT max(epoch_us(ts)) AS now FROM events) SELECT event_id FROM events, m WHERE now - epoch_us(ts) <= 86400000000")
def fresh_pages(spark: SparkSession, sf: str) -> DataFrame:
    events = read(spark, sf, "events")
    rows = events.crossJoin(F.broadcast(events.agg(F.max("ts").alias("now")))).withColumnRenamed("ts", "fetched_at")  # one row
    return readers.cached_pages(rows, F.col("now"), 86_400).select("event_id")


# Facets



@query(
    f"""WITH {ART}, t AS (SELECT doc_id, norm, source, trim(regexp_replace(lower(title), '[^a-z]+', ' ', 'g')) AS title FROM art)
    SELECT doc_id, CASE WHEN NOT ({_PASSES.format('title')}) THEN 'navigation' WHEN doc_id % 4 = 0 THEN 'evenement_date' WHEN length(norm) >= 3000 THEN 'rapport_analyse' WHEN {_has("title || ' ' || norm", *demo.FACETS.advocacy)} THEN 'plaidoyer_communique' ELSE 'indetermine' END AS type,
      CASE WHEN doc_id % 4 = 0 THEN 10 END AS age_jours, source = 'src7' AS source_specialisee FROM t"""
)
def article_types(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("doc_id")
    title = F.trim(F.regexp_replace(F.lower("title"), "[^a-z]+", " "))
    df = articles(spark, sf).withColumns({"title": title, "url": F.concat(F.lit("https://a.org/news/"), i.cast("string"), F.lit("/x")), "date": F.when(i % 4 == 0, F.lit("2024-01-01").cast("timestamp"))})
    return C.describe(df, demo.FACETS, F.lit("2024-01-11").cast("timestamp")).select("doc_id", "type", "age_jours", "source_specialisee")


@query(f"WITH {ART}, e AS (SELECT doc_id, {_has('head', 'this')} AS h1, {_has('head', 'was')} AS h2, {_has('norm', 'this')} AS b1, {_has('norm', 'was')} AS b2 FROM art) SELECT doc_id, concat_ws(',', CASE WHEN h1 THEN 'this' END, CASE WHEN h2 THEN 'was' END) AS head, concat_ws(',', CASE WHEN b1 THEN 'this' END, CASE WHEN b2 THEN 'was' END) AS body FROM e WHERE h1 OR h2 OR b1 OR b2")
def actor_evidence(spark: SparkSession, sf: str) -> DataFrame:
    found = C.describe(articles(spark, sf), demo.FACETS, F.lit("2026-01-01").cast("timestamp")).select("doc_id", F.try_element_at("preuves_acteur", F.lit("presse")).alias("p"))
    return found.where("p IS NOT NULL").select("doc_id", F.array_join("p.head", ",").alias("head"), F.array_join("p.body", ",").alias("body"))


# The whole score in SQL, for the vocabulary of demo.LEXICON: sets that it lacks are left out, as they match nothing.


def _any(zone: str, name: str) -> str:
    return _has(zone, *demo.LEXICON.sets[name])


def _related(targets: str, actions: str) -> str:
    t, a = ("(" + "|".join(demo.LEXICON.sets[n]) + ")" for n in (targets, actions))
    b = r"[^\p{L}\p{N}_]"
    gap = f"(?:{b}.{{0,138}}{b}|{b})"
    return f"(regexp_matches(' ' || whole || ' ', '(?s){b}{t}{gap}{a}{b}') OR regexp_matches(' ' || whole || ' ', '(?s){b}{a}{gap}{t}{b}'))"


def _listed(zone: str, *names: str) -> str:
    terms = dict.fromkeys(t for n in names for t in demo.LEXICON.sets[n])
    return "concat_ws(', ', " + ", ".join(f"CASE WHEN {_has(zone, t)} THEN '{t}' END" for t in terms) + ")"


def _either(name: str) -> str:
    return f"({_any('head', name)} OR {_any('norm', name)})"


def _points(pairs: list[tuple[str, int]]) -> str:
    return " + ".join(f"CASE WHEN {c} THEN {n} ELSE 0 END" for c, n in pairs)


_BONUSES = [
    ("event", 12), ("event AND c_events AND body_confirmation", 10), ("event AND (p_repression OR c_repression)", 18), ("event AND (r_target OR r_activist OR r_journalist)", 14), ("r_activist AND regional", 18),
    ("r_journalist AND regional", 20), ("p_prisoner", 22), ("p_press", 15), ("p_right", 8), ("anchor AND body_confirmation", 8), ("critical", 25),
]
_REASONS = [
    ("region_1 <> ''", "'region 1: ' || region_1"), ("region_1 = '' AND region_2 <> ''", "'region 2: ' || region_2"), ("region_1 = '' AND region_2 = '' AND region_3 <> ''", "'region 3: ' || region_3"),
    ("NOT geography AND specialised", "'specialised source'"), ("geography AND body_geo > 0", "'geography confirmed in the body'"), ("conf_activist", "'activist or defender targeted'"), ("conf_journalist AND NOT conf_activist", "'journalist or medium targeted'"),
    ("routine > 0", "'ordinary geopolitics or economy'"), ("noise", "'noise'"), ("event", "'regional event: for'"), ("event AND c_events AND body_confirmation", "'event confirmed in the body'"), ("event AND (p_repression OR c_repression)", "'regional event with repression'"),
    ("event AND (r_target OR r_activist OR r_journalist)", "'regional event with a target'"), ("r_activist AND regional", "'activist and repressive action'"), ("r_journalist AND regional", "'journalist and repressive action'"), ("p_prisoner", "'political prisoner'"),
    ("p_press", "'press restriction'"), ("p_right", "'specific right'"), ("anchor AND body_confirmation", "'signal confirmed in the body'"), ("critical", "'critical case'"), ("NOT regional", "'cap: no regional anchor'"),
    ("cap = 54", "'cap: confirmed in the body only'"), ("cap = 34", "'cap: no main anchor'"), ("cap = 28", "'cap: other topic'"), ("soft", "'cap: no concrete event'"),
]

_sql["full_score"] = f"""WITH {ART}, z AS (SELECT *, trim(head || ' ' || substr(norm, 1, 12000)) AS whole FROM art),
a AS (SELECT doc_id, {_listed('head', 'region_1')} AS region_1, {_listed('head', 'region_2')} AS region_2, {_listed('head', 'region_3')} AS region_3, contains(lower(source), 'src7') AS specialised,
  {_points([(_has('norm', t), 1) for t in ('the', 'with', 'les', 'der')])} AS body_geo, {_any('head', 'defenders')} AS p_defender, {_any('head', 'strong_rights')} AS p_right, {_any('head', 'press')} AS p_press, {_any('head', 'prisoners')} AS p_prisoner,
  {_any('head', 'events')} AS p_event, {_any('head', 'hr_repression')} AS p_repression, {_any('norm', 'hr_repression')} AS c_repression, {_any('norm', 'events')} AS c_events, {_any('head', 'journalists')} AS p_journalist,
  {" OR ".join(_any('norm', n) for n in ('hr_repression', 'strong_rights', 'press', 'prisoners', 'hr_actions'))} AS body_confirmation,
  {_related('activists', 'hr_actions')} AS r_activist, {_related('journalists', 'hr_actions')} AS r_journalist, {_related('targets', 'hr_actions')} AS r_target,
  {_either('activists')} AS activists, {_either('journalists')} AS has_journalist, {_either('specific_rights')} AS rights, {_either('human_rights')} AS has_human, {_either('legal_context')} AS has_legal,
  {_either('repression')} AS repression, {_either('legal_repression')} AS legal, {_any('head', 'legal_repression')} AS legal_head, {_any('norm', 'strong_rights')} AS body_be,
  {_either('repression').replace('|une', '')} AS rep_from, {_either('repression').replace('from|', '')} AS rep_une, {_has('norm', 'ed')} AS ed, {_has('norm', 'edes')} AS edes,
  {_any('head', 'noise')} AS noise, {_any('head', 'domestic')} AS domestic, {_any('head', 'major_geo')} AS major, {_any('head', 'routine_geo')} AS routine_geo, {_any('head', 'soft_topics')} AS soft_topic, {_any('head', 'other_topics')} AS other_topic,
  contains(head, 'civil society') OR contains(head, 'ngo') AS civil, {_listed('head', 'region_1', 'activists', 'repression')} AS keywords FROM z),
b AS (SELECT *, region_1 <> '' OR region_2 <> '' OR region_3 <> '' AS geography, activists OR p_defender AS has_activist, rights OR p_right AS has_rights, repression OR legal OR p_repression OR c_repression AS has_repression,
  p_journalist AND (p_repression OR p_press) AS journalist_case, p_defender AND p_repression AS defender_case FROM a),
c AS (SELECT *, geography OR specialised OR body_geo >= 2 AS regional, p_repression OR defender_case OR p_right OR p_press OR p_prisoner OR journalist_case OR p_event AS anchor FROM b),
d AS (SELECT *, regional AND has_repression AS conf_repression, regional AND has_rights AS conf_rights, regional AND r_activist AS conf_activist, regional AND r_journalist AS conf_journalist, regional AND p_event AS event,
  regional AND (has_activist OR p_defender) AND (p_repression OR defender_case OR journalist_case) AND has_repression AS critical, has_human OR has_repression OR has_rights AS issue FROM c),
e AS (SELECT *, CASE WHEN geography AND body_geo > 0 THEN 15 WHEN geography THEN 12 WHEN specialised THEN 10 ELSE 0 END AS s_geo,
  CASE WHEN conf_activist THEN 20 WHEN conf_journalist THEN 18 WHEN has_activist THEN 10 WHEN has_journalist THEN 7 WHEN civil THEN 5 ELSE 0 END AS s_target,
  least(25, {_points([('rep_from', 6), ('rep_une', 5), ('legal', 2), ('ed', 2), ('edes', 2)])}) AS rep0, least(8, {_points([('rights', 4), ('body_be', 2)])}) AS rights0,
  CASE WHEN conf_activist OR conf_journalist THEN 7 WHEN conf_repression THEN 6 WHEN major THEN 5 WHEN domestic AND issue THEN 4 WHEN has_human THEN 3 WHEN domestic THEN 2 ELSE 0 END AS s_press,
  CASE WHEN major THEN 7 WHEN routine_geo THEN 2 ELSE 0 END AS s_world, CASE WHEN routine_geo AND NOT (has_activist OR has_journalist OR issue) THEN 10 ELSE 0 END AS routine,
  rep_from OR rep_une OR legal OR ed OR edes AS rep_terms FROM d),
f AS (SELECT *, CASE WHEN legal_head AND rep0 < 10 THEN 8 ELSE rep0 END AS rep1, CASE WHEN has_human AND rights0 = 0 THEN 4 ELSE rights0 END AS rights1 FROM e),
g AS (SELECT *, CASE WHEN has_legal AND rep_terms THEN least(rep1 + 1, 30) ELSE rep1 END AS rep2, CASE WHEN conf_rights THEN least(rights1 + 2, 10) ELSE rights1 END AS s_rights FROM f),
h AS (SELECT *, CASE WHEN conf_repression THEN least(rep2 + 5, 30) ELSE rep2 END AS rep3 FROM g),
i AS (SELECT *, CASE WHEN conf_activist OR conf_journalist THEN least(rep3 + 5, 30) ELSE rep3 END AS s_repression FROM h),
j AS (SELECT *, CASE WHEN noise THEN 0 ELSE s_geo + s_target + s_repression + s_rights + s_press + s_world - routine END + {_points(_BONUSES)} AS total,
  CASE WHEN regional AND NOT p_event AND NOT anchor THEN CASE WHEN r_target OR body_confirmation THEN 54 WHEN other_topic THEN 28 ELSE 34 END END AS cap,
  CASE WHEN event AND body_confirmation THEN 55 WHEN event THEN 42 END AS floor_,
  CASE WHEN journalist_case OR p_press THEN 85 WHEN defender_case OR critical THEN 100 WHEN p_repression THEN 78 WHEN p_event AND body_confirmation THEN 72 WHEN p_right THEN 65 ELSE 1000 END AS editorial,
  regional AND NOT (defender_case OR journalist_case OR p_press OR p_repression OR p_event) AND soft_topic AS soft FROM i),
k AS (SELECT *, greatest(least(CASE WHEN regional THEN total ELSE least(total, 20) END, coalesce(cap, 1000)), coalesce(floor_, -1000)) AS bounded FROM j),
l AS (SELECT *, CAST(greatest(0, least(100, CASE WHEN soft THEN least(48, CASE WHEN regional THEN least(bounded, editorial) ELSE bounded END) WHEN regional THEN least(bounded, editorial) ELSE bounded END)) AS INTEGER) AS score FROM k)
SELECT doc_id, score, CASE WHEN NOT regional THEN CASE WHEN has_activist OR has_journalist OR p_defender OR p_right OR p_press OR p_prisoner OR journalist_case THEN 'D' ELSE 'E' END WHEN noise THEN 'E'
    WHEN score >= 75 AND (conf_activist OR conf_journalist OR conf_repression OR p_press OR critical) THEN 'A' WHEN score >= 55 THEN 'B' WHEN score >= 35 THEN 'C' ELSE 'E' END AS level,
  CASE WHEN score >= 90 THEN 'ABSOLUE' WHEN score >= 75 THEN 'TRÈS HAUTE' WHEN score >= 60 THEN 'HAUTE' WHEN score >= 40 THEN 'MOYENNE' WHEN score >= 20 THEN 'FAIBLE' ELSE 'BRUIT' END AS priority,
  CASE WHEN conf_activist THEN 'Activistes / dissidents sous pression' WHEN conf_journalist THEN 'Journalistes sous pression' WHEN p_event THEN 'Événement HR / répression régionale' WHEN conf_repression THEN 'Répression / droits humains'
    WHEN has_rights THEN 'Droits spécifiques' WHEN domestic THEN 'Politique intérieure' WHEN major THEN 'Géopolitique majeure' WHEN routine_geo THEN 'Économie / géopolitique ordinaire' ELSE 'Faible priorité' END AS theme,
  conf_activist OR conf_journalist OR (regional AND score >= 40 AND NOT noise AND (has_activist OR has_journalist OR has_repression OR has_rights OR has_human OR major OR p_event)) AS relevant,
  concat_ws('; ', {", ".join(f"CASE WHEN {c} THEN {v} END" for c, v in _REASONS)}) AS reasons, keywords FROM l"""


@query(_sql["full_score"].replace("text AS body", "CASE WHEN doc_id % 3 = 0 THEN text ELSE '' END AS body").replace("regexp_replace(text, '\\s+'", "regexp_replace(CASE WHEN doc_id % 3 = 0 THEN text ELSE '' END, '\\s+'").replace(", reasons, keywords FROM l", " FROM l").replace("SELECT doc_id, score, CASE WHEN NOT regional", "SELECT doc_id, score, conf_activist, CASE WHEN NOT regional").rpartition(",\n  concat_ws('; ',")[0] + " FROM l")
def two_pass_score(spark: SparkSession, sf: str) -> DataFrame:
    """Titles alone, and whole texts where the id is among those to be kept."""
    docs = articles(spark, sf)
    found = S.two_pass(docs, demo.LEXICON, docs.where("doc_id % 3 = 0"), "doc_id")
    return found.select("doc_id", "score", "level", "priority", "theme", "relevant", F.col("signals.confirmed_activist_pressure").alias("conf_activist"))


_WORDS = "list_filter(regexp_split_to_array({0}, '[^\\p{{L}}\\p{{M}}\\p{{N}}_]+'), lambda w: regexp_full_match(w, '[a-z]{{4,}}'))"


@query(
    f"""WITH {ART}, v AS (SELECT DISTINCT unnest({_WORDS.format('head')}) AS term FROM art), x AS (SELECT DISTINCT doc_id, unnest({_WORDS.format('norm')}) AS term FROM art)
    SELECT doc_id, left(term, 1) AS list_id, string_agg(term, ', ' ORDER BY term) AS terms FROM x WHERE term IN (SELECT term FROM v) GROUP BY doc_id, left(term, 1)"""
)
def vocabulary_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Every document against a vocabulary that grows with the table: the words of all titles, in a list for each first letter."""
    docs = articles(spark, sf)
    words = docs.select(F.explode(F.regexp_extract_all(T.normalize(F.col("title")), F.lit(r"(?U)\w+"), F.lit(0))).alias("term")).where("term RLIKE '^[a-z]{4,}$'").distinct()
    order = Window.partitionBy("list_id").orderBy("term")  # a first letter's distinct words
    vocabulary = words.withColumn("list_id", F.left("term", F.lit(1))).withColumn("ord", F.row_number().over(order))
    found = V.match_vocabulary(docs.select("doc_id", T.normalize(F.col("body")).alias("text")), vocabulary)
    return found.select("doc_id", "list_id", F.array_join("terms", ", ").alias("terms"))


# Pages

_PATH = "lower(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1))"
_IN_PATH = lambda parts: "(" + " OR ".join(f"contains(path, '{p}')" for p in parts) + ")"


@query(
    f"""WITH p AS (SELECT page_id, url, {_PATH} AS path, {_SEGMENTS} AS seg, trim(lower({_TITLE})) AS t FROM pages), s AS (SELECT *, list_transform(seg, lambda x: lower(x)) AS low FROM p)
    SELECT page_id, length(t) >= 8 AND len(list_filter(regexp_split_to_array(t, '\\s+'), lambda w: w <> '')) >= 2 AND t NOT IN ({", ".join("'" + t.replace("'", "''") + "'" for t in U.GENERIC_TITLES)})
      AND CASE WHEN path IN ('', '/') THEN false WHEN {_IN_PATH(U.NON_ARTICLE_PATHS)} OR len(list_filter(range(2, len(low) // 2 + 1), lambda k: low[1:k] = low[k + 1:2 * k])) > 0 THEN false
        WHEN {_IN_PATH(U.ARTICLE_PATHS)} THEN true WHEN regexp_matches(path, '/(19|20)[0-9]{{2}}[/-](0?[1-9]|1[0-2])[/-]') THEN len(seg) >= 3 ELSE len(seg) >= 2 END AS article FROM s"""
)
def article_link_kinds(spark: SparkSession, sf: str) -> DataFrame:
    pages = read(spark, sf, "pages").withColumn("title", F.regexp_extract("html", "(?is)<title>(.*?)</title>", 1))
    return pages.select("page_id", U.looks_like_article(F.col("url"), F.col("title")).alias("article"))


_ANCHORS = """l AS (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS href, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS shown FROM {0}),
    x AS (SELECT page_id, url, unnest(href) AS href, unnest(shown) AS title, generate_subscripts(href, 1) AS i FROM l),
    n AS (SELECT page_id, i, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || regexp_replace(href, '#.*$', '') AS link, trim(regexp_replace(title, '\\s+', ' ', 'g')) AS title FROM x)"""

_sql["page_links"] = f"WITH {_ANCHORS.format('pages')} SELECT page_id, link, arg_min(title, i) AS title FROM n WHERE title <> '' GROUP BY page_id, link"


@query(
    """WITH l AS (SELECT page_id, regexp_extract_all(html, '<a href="/([^"]*)">', 1) AS href FROM pages), x AS (SELECT page_id, unnest(href) AS href FROM l),
    d AS (SELECT DISTINCT page_id, 'site' || length(href) || '.org' AS domain FROM x) SELECT page_id, domain FROM d WHERE domain <> 'site4.org'"""
)
def outbound_citations(spark: SparkSession, sf: str) -> DataFrame:
    """Every link of a page as one to a site named by the length of its path; one site is excluded, and links home do not count."""
    links = F.regexp_extract_all("html", F.lit('<a href="/([^"]*)">'), F.lit(1))
    made = F.array_join(F.transform(links, lambda p: F.concat(F.lit('<p><a href="https://www.site'), F.length(p).cast("string"), F.lit('.org/a">a link</a></p>'))), " ")
    home = F.concat(F.lit('<a href="/home">home page</a>'), made)
    return H.outbound_domains(read(spark, sf, "pages").select("page_id", "url", home.alias("html")), ["site4.org"])


# Relations by position

_WORD = r"[\p{L}\p{M}\p{N}_]+"
_OF = lambda terms: "(" + ", ".join(f"'{t}'" for t in terms.terms) + ")"


@query(
    f"""WITH {ART}, w AS (SELECT doc_id, regexp_extract_all(norm, '{_WORD}') AS ws, regexp_split_to_array(norm, '{_WORD}') AS gs FROM art),
    u AS (SELECT doc_id, unnest(ws) AS w, unnest(gs[1:len(ws)]) AS g, generate_subscripts(ws, 1) AS i FROM w),
    p AS (SELECT doc_id, w, sum(length(g) + length(w)) OVER (PARTITION BY doc_id ORDER BY i) AS e FROM u),
    x AS (SELECT doc_id, w IN {_OF(demo.TARGETS)} AS t, e - length(w) AS s, e FROM p WHERE w IN {_OF(demo.TARGETS)} OR w IN {_OF(demo.ACTIONS)}),
    n AS (SELECT doc_id, t, s, e, max(e) FILTER (WHERE NOT t) OVER (PARTITION BY doc_id ORDER BY s ROWS UNBOUNDED PRECEDING) AS ended,
      min(s) FILTER (WHERE NOT t) OVER (PARTITION BY doc_id ORDER BY s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS begun FROM x)
    SELECT doc_id, s::BIGINT AS s, e::BIGINT AS e, least(coalesce(s - ended, 1000000), coalesce(begun - e, 1000000))::BIGINT AS gap FROM n
    WHERE t AND least(coalesce(s - ended, 1000000), coalesce(begun - e, 1000000)) <= {P.WINDOW}"""
)
def proximity_spans(spark: SparkSession, sf: str) -> DataFrame:
    """Each target of each whole text that has an action near, and the gap to the nearest."""
    texts = articles(spark, sf).select("doc_id", T.normalize(F.col("body")).alias("norm"))
    return N.nearest(N.span_rows(texts, "doc_id", "norm", demo.TARGETS), N.span_rows(texts, "doc_id", "norm", demo.ACTIONS), "doc_id")


# Streams


def _events_in_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Events with the week that they come in."""
    return read(spark, sf, "events").select("event_id", "user_id", "event_type", "ts", (F.col("event_type") != "error").alias("ok"), F.floor(F.datediff("ts", F.lit("2024-01-01").cast("date")) / 8).cast("int").alias("week"))


_FRESH = 12 * 3600


@query(
    f"""WITH RECURSIVE r AS (SELECT user_id, event_id, epoch_us(ts) AS t, coalesce(event_type <> 'error', false) AS ok, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k
      FROM events WHERE ts IS NOT NULL AND user_id IS NOT NULL),
    s AS (SELECT user_id, event_id, k, true AS due, CASE WHEN ok THEN t END AS last FROM r WHERE k = 1 UNION ALL
      SELECT r.user_id, r.event_id, r.k, s.last IS NULL OR r.t - s.last >= {_FRESH}000000, CASE WHEN s.last IS NULL OR r.t - s.last >= {_FRESH}000000 THEN CASE WHEN r.ok THEN r.t END ELSE s.last END
      FROM s JOIN r ON r.user_id = s.user_id AND r.k = s.k + 1)
    SELECT user_id, event_id, due FROM s"""
)
def due_sources_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Users as sources and events as wishes to scan; errors are scans that failed."""
    told = K.in_batches(_events_in_batches(spark, sf), "week", scratch(spark, "due"), lambda s: K.due_sources(s, "user_id", "event_id", "ts", "ok", _FRESH))
    return told.select(F.col("source").cast("long").alias("user_id"), F.col("id").alias("event_id"), "due")


@query(
    """WITH RECURSIVE r AS (SELECT user_id, event_id, epoch_us(ts) AS t, event_type AS entry, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k
      FROM events WHERE ts IS NOT NULL AND user_id IS NOT NULL AND event_type IS NOT NULL),
    s AS (SELECT user_id, event_id, k, false AS hit, [{'t': t, 'entry': entry}] AS held FROM r WHERE k = 1 UNION ALL
      SELECT user_id, event_id, k, hit, CASE WHEN hit THEN live ELSE list_sort(list_append(live, {'t': t, 'entry': entry}))[-2:] END FROM (
        SELECT *, len(list_filter(live, lambda x: x.entry = entry)) > 0 AS hit FROM (
          SELECT r.user_id, r.event_id, r.k, r.t, r.entry, list_filter(s.held, lambda x: r.t - x.t < 172800000000) AS live FROM s JOIN r ON r.user_id = s.user_id AND r.k = s.k + 1)))
    SELECT user_id, event_id, hit FROM s"""
)
def body_cache_stream(spark: SparkSession, sf: str) -> DataFrame:
    """A cache of two entries for each user, which events look up by their type."""
    told = K.in_batches(_events_in_batches(spark, sf), "week", scratch(spark, "cache"), lambda s: K.cached_lookups(s, "user_id", "event_type", "event_id", "ts", most=2))
    return told.select(F.col("source").cast("long").alias("user_id"), F.col("id").alias("event_id"), "hit")


@query(
    """WITH c AS (SELECT click_id, epoch_us(ts) AS ts, datediff('day', DATE '2024-01-01', arrived_at::DATE) // 20 AS batch FROM clicks WHERE ts IS NOT NULL AND arrived_at IS NOT NULL AND click_id IS NOT NULL),
    b AS (SELECT batch, max(ts) // 1000 AS top FROM c GROUP BY batch), w AS (SELECT batch, 1000 * (max(top) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 600000) AS mark FROM b)
    SELECT click_id, min(batch)::INTEGER AS batch FROM c JOIN w USING (batch) WHERE mark IS NULL OR ts > mark GROUP BY click_id"""
)
def first_seen_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks in the order of their arrival, some late and some twice: each once, unless it comes after the watermark."""
    clicks = read(spark, sf, "clicks").where("ts IS NOT NULL AND arrived_at IS NOT NULL AND click_id IS NOT NULL")
    rows = clicks.select("click_id", "ts", F.floor(F.datediff("arrived_at", F.lit("2024-01-01").cast("date")) / 20).cast("int").alias("batch"))
    return K.in_batches(rows, "batch", scratch(spark, "seen"), lambda s: I.first_seen(s.withColumn("ts", F.col("ts").cast("timestamp")), "click_id", "ts", "10 minutes")).select("click_id", "batch")


_WEEK = "datediff('day', DATE '2024-01-01', ts::DATE) // 8"


@query(
    f"""WITH e AS (SELECT user_id || '/' || (event_id % 40) AS key, event_type AS title, event_id % 50 AS n, CASE WHEN event_id % 3 = 0 THEN 'd' || event_id END AS date, event_id AS seq, {_WEEK} AS week FROM events)
    SELECT key, arg_min(title, week * 1000000000 + seq) AS title, max(n)::INTEGER AS n_chars, arg_min(date, week * 1000000000 + seq) FILTER (WHERE date IS NOT NULL) AS date, 'week ' || max(week) AS seen FROM e GROUP BY key"""
)
def archive_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Events as the scans of four weeks, each committed with the state of what was seen last; read as the last version has them."""
    i, path = F.col("event_id"), scratch(spark, "snapshots")
    rows = read(spark, sf, "events").select(
        F.concat_ws("/", "user_id", i % 40).alias("key"), F.col("event_type").alias("title"), F.repeat(F.lit("x"), (i % 50).cast("int")).alias("body"), F.when(i % 3 == 0, F.concat(F.lit("d"), i)).alias("date"), i.alias("seq"),
        F.floor(F.datediff("ts", F.lit("2024-01-01").cast("date")) / 8).cast("int").alias("week"),
    )
    for week in range(4):
        snapshots.commit_scan(rows.where(F.col("week") == week).drop("week"), path, f"week {week}", buckets=16)
    return snapshots.archive_seen(spark, path).select("key", "title", F.length("body").alias("n_chars"), "date", "seen")


@query(
    """WITH l AS (SELECT url, html AS content, page_id * 60 AS t FROM pages UNION ALL SELECT url, html || ' again', page_id * 60 + 86430 FROM pages WHERE page_id % 3 = 0), n AS (SELECT max(t) AS latest FROM l)
    SELECT url, CAST(max(t) AS BIGINT) AS fetched, arg_max(content, t) AS content FROM l, n WHERE latest - t <= 90000 GROUP BY url"""
)
def page_cache(spark: SparkSession, sf: str) -> DataFrame:
    """All pages put into a cache a minute apart, a third of them again a day later; those read that are 25 hours old at most."""
    path, start = scratch(spark, "pages"), 1_704_067_200
    pages = read(spark, sf, "pages").select("url", F.col("html").alias("content"), (F.col("page_id") * 60 + start).alias("at"), "page_id")
    again = pages.where("page_id % 3 = 0").withColumns({"content": F.concat("content", F.lit(" again")), "at": F.col("at") + 86_430})
    for landed in (pages, again):
        G.insert(landed.withColumn("fetched_at", F.timestamp_seconds("at")), path)
    now = again.agg(F.max("at")).first()[0]  # one number
    found = G.fresh(spark, path, datetime.fromtimestamp(now or start, timezone.utc), 90_000)
    return found.select("url", (F.unix_seconds("fetched_at") - start).alias("fetched"), "content")


@query(
    f"""WITH s AS ({_sql["full_score"]}), r AS (SELECT doc_id, split_part(text, chr(10), 1) AS title, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents),
    e AS (SELECT *, CASE doc_id % 11 WHEN 3 THEN 'not a JSON object (type=array)' WHEN 5 THEN 'title missing or empty' WHEN 7 THEN 'not JSON' WHEN 9 THEN 'empty line' ELSE CASE WHEN coalesce(title, '') = '' THEN 'title missing or empty' END END AS error FROM r)
    SELECT i AS index, error, CASE WHEN error IS NULL OR error LIKE 'title%' THEN 'u' || e.doc_id END AS url, CASE WHEN error IS NULL THEN title END AS title, CASE WHEN error IS NULL THEN s.score END AS score, CASE WHEN error IS NULL THEN s.level END AS level,
      CASE WHEN error IS NULL THEN s.theme END AS theme, CASE WHEN error IS NULL THEN s.reasons END AS reasons, i // 200 AS batch FROM e JOIN s USING (doc_id)"""
)
def scored_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Every document as a line of a request; some lines are arrays, torn or empty, or lack the title. Results and errors as they were written."""
    i, path = F.col("doc_id") % 11, scratch(spark, "requests")
    docs = articles(spark, sf).select("doc_id", "title", "body", "source", "language", F.concat(F.lit("u"), "doc_id").alias("url"))
    fields = ["body", "source", "language", "url"]
    line = F.when(i == 3, F.to_json(F.array("title"))).when(i == 5, F.to_json(F.struct(*fields))).when(i == 7, F.lit('{"title": "torn')).when(i == 9, "").otherwise(F.to_json(F.struct("title", *fields)))
    docs.select("doc_id", line.alias("value")).repartitionByRange("doc_id").sortWithinPartitions("doc_id").select("value").write.text(f"{path}/in")
    found = Q.outcomes(Q.request_lines(spark, f"{path}/in", f"{path}/staged"), demo.LEXICON)
    Q.write_outcomes(found, f"{path}/out")
    kept = spark.read.schema(f"{found.schema.toDDL()}, failed boolean").parquet(f"{path}/out")
    return kept.select("index", "error", "url", "title", "score", "level", "theme", F.array_join("reasons", "; ").alias("reasons"), F.floor(F.col("index") / Q.BATCH).alias("batch"))


@query(
    """WITH e AS (SELECT CASE WHEN event_id % 13 <> 0 THEN concat_ws('/', user_id, event_id % 40) END AS key, event_id % 50 > 0 AS body, event_id % 3 = 0 AS date, CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 8) AS INT) AS week FROM events)
    SELECT week + 1 AS version, count(*) AS rows, count(key) AS keyed, count(*) FILTER (WHERE key IS NOT NULL AND body) AS with_body, count(*) FILTER (WHERE key IS NOT NULL AND date) AS with_date FROM e WHERE week BETWEEN 0 AND 3 GROUP BY week"""
)
def run_counters(spark: SparkSession, sf: str) -> DataFrame:
    """Events as the scans of four weeks, some without a key, under a guard against collapse; the counters that each version keeps."""
    i, path = F.col("event_id"), scratch(spark, "counters")
    rows = read(spark, sf, "events").select(
        F.when(i % 13 != 0, F.concat_ws("/", "user_id", i % 40)).alias("key"), F.col("event_type").alias("title"), F.repeat(F.lit("x"), (i % 50).cast("int")).alias("body"), F.when(i % 3 == 0, F.concat(F.lit("d"), i)).alias("date"), i.alias("seq"),
        F.floor(F.datediff("ts", F.lit("2024-01-01").cast("date")) / 8).cast("int").alias("week"),
    )
    kept = [snapshots.commit_scan(rows.where(F.col("week") == week).drop("week"), path, f"week {week}", buckets=16, ratio=0.5) for week in range(4)]
    names = ("rows", "keyed", "with_body", "with_date")
    return spark.createDataFrame([(v.n, *(v.facts["counters"][n] for n in names)) for v in kept], "version int, " + ", ".join(f"{n} long" for n in names))  # a row for each version


@query(f"SELECT CAST(doc_id AS VARCHAR) AS key, score, level, priority, theme, relevant, reasons FROM ({_sql['full_score']})")
def rescored_history(spark: SparkSession, sf: str) -> DataFrame:
    """Every document archived and scored under an older lexicon, then brought up to that of `full_score`: only texts with a term that changed."""
    path = scratch(spark, "rescored")
    docs = articles(spark, sf).select(F.col("doc_id").cast("string").alias("key"), "title", "body", "source", "language", F.lit(None).cast("string").alias("date"), F.col("doc_id").alias("seq"))
    snapshots.commit_scan(docs, path, "all", buckets=16)
    own = demo.LEXICON
    before = dataclasses.replace(own, sets=own.sets | {"repression": ("from",), "prisoners": ("at", "los"), "soft_topics": ()}, weights=own.weights | {"rights": {"are": 1}})
    for lexicon in (before, own):
        rescoring.rescore(spark, path, lexicon)
    return rescoring.scores(spark, path).select("key", "score", "level", "priority", "theme", "relevant", F.array_join("reasons", "; ").alias("reasons"))


@query("SELECT s_name AS name, CASE WHEN s_suppkey % 3 = 0 THEN 'html' ELSE 'rss' END AS type, s_suppkey % 50 AS max_articles, CASE WHEN s_suppkey % 3 = 0 THEN 1 ELSE 2 END AS n_addresses, 'site' || s_nationkey || '.org' AS domain FROM supplier")
def source_registry(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as a registry of sources, written as JSON and read, with the addresses and the domain of each."""
    path, k = scratch(spark, "registry"), F.col("s_suppkey")
    site = F.concat(F.lit("https://www.site"), "s_nationkey", F.lit(".org/"))
    read(spark, sf, "supplier").select(
        F.col("s_name").alias("name"), F.when(k % 3 == 0, "html").otherwise("rss").alias("type"), site.alias("url"), F.when(k % 3 != 0, F.array(F.concat(site, F.lit("feed")))).alias("feeds"), (k % 50).alias("max_articles"), F.lit("x").alias("unknown"),
    ).write.json(path)
    found = configs.registry(spark, path)
    return found.select("name", "type", "max_articles", F.when(F.col("feeds").isNull(), 1).otherwise(1 + F.size("feeds")).alias("n_addresses"), U.domain(F.col("url")).alias("domain"))
