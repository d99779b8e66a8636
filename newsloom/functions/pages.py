"""Raw pages and feeds: links, bodies, dates, items, diagnostics. DOM work uses the standard library's parser."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shipping import arrow_udf
from .dates import parse_date
from .text import clean_text, collapse, distinctive_words, significant_words, strip_related_blocks, strip_site_name, text
from .urls import is_redirect, looks_like_article, normalize_url, title_passes

# Where pages state their date, in order of precedence: attribute, its value.
DATE_META = (("property", "article:published_time"), ("property", "og:article:published_time"), ("name", "publish-date"), ("name", "publish_date"), ("name", "publication_date"), ("name", "date"), ("name", "sailthru.date"), ("itemprop", "datePublished"), ("name", "parsely-pub-date"))
_SKIPPED = {"script", "style", "noscript", "svg", "nav", "header", "footer"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
TITLE_SHARE = 0.3


class _Page(HTMLParser):
    """One pass over a page: links, text by container, headings, metadata, JSON-LD blocks."""

    def __init__(self, source: str):
        super().__init__(convert_charrefs=True)
        self.links: list[tuple[str, str]] = []
        self.meta: list[dict[str, str]] = []
        self.times: list[str] = []
        self.ld: list[str] = []
        self.heads: list[str] = []
        self.kinds: dict[str, list[str]] = {"article": [], "main": [], "div": [], "all": []}
        self._open: list[tuple[str, str | None, bool]] = []  # tag, container, whether its text is skipped
        self._used: set[str] = set()
        self._href: str | None = None
        self._words: list[str] = []
        self._in: str | None = None
        self.feed(source)
        self.close()
        self._end_link()

    def _end_link(self) -> None:
        if self._href is not None:
            self.links.append((self._href, " ".join(" ".join(self._words).split())))
        self._href, self._words = None, []

    def handle_starttag(self, tag, attrs):
        own = {k: v or "" for k, v in attrs}
        if tag == "meta":
            self.meta.append(own)
            if own.get("property") == "og:title":
                self.heads.append(own.get("content", ""))
        if tag == "time" and own.get("datetime"):
            self.times.append(own["datetime"])
        if tag == "a":
            self._end_link()
            self._href = own.get("href", "").strip()
        if tag == "script" and "ld+json" in own.get("type", ""):
            self.ld.append("")
            self._in = "ld"
        if tag in ("title", "h1"):
            self.heads.append("")
            self._in = "head"
        if tag in _VOID:
            return
        named = f"{own.get('class', '')} {own.get('id', '')}".lower()
        skipped = tag in _SKIPPED or "comment" in named or (bool(self._open) and self._open[-1][2])
        kind = tag if tag in ("article", "main") else "div" if tag == "div" and "article" in own.get("class", "").lower() else None
        if kind in self._used:  # only the first container of a kind counts
            kind = None
        elif kind:
            self._used.add(kind)
        self._open.append((tag, kind, skipped))

    def handle_endtag(self, tag):
        if tag == "a":
            self._end_link()
        if tag in ("script", "title", "h1"):
            self._in = None
        for k in range(len(self._open) - 1, -1, -1):
            if self._open[k][0] == tag:
                del self._open[k:]
                break

    def handle_data(self, data):
        if self._in == "ld":
            self.ld[-1] += data
        elif self._in == "head":
            self.heads[-1] += data
        if self._href is not None:
            self._words.append(data)
        if not (self._open and self._open[-1][2]) and data.strip():
            self.kinds["all"].append(data.strip())
            for kind in {k for _, k, _ in self._open if k}:
                self.kinds[kind].append(data.strip())

    def ld_dates(self) -> Iterator[str]:
        for block in self.ld:
            try:
                found = json.loads(block)
            except ValueError:
                continue
            for item in found if isinstance(found, list) else [found]:
                if isinstance(item, dict):
                    for own in [item, *(g for g in item.get("@graph", []) or [] if isinstance(g, dict))]:
                        for key in ("datePublished", "dateCreated"):
                            if isinstance(own.get(key), str):
                                yield own[key]

    def dates(self) -> list[str]:
        meta = [m["content"] for attribute, value in DATE_META for m in self.meta if m.get(attribute) == value and m.get("content")]
        return [*meta, *self.times, *self.ld_dates()]

    def body(self) -> str:
        return " ".join(next((v for v in self.kinds.values() if v), []))


_PARSED = "links array<struct<href:string,title:string>>, dates array<string>, heads string, body string"


def _parse_batch(s: pd.Series) -> pd.DataFrame:
    rows = []
    for source in s:
        p = _Page(source or "")
        rows.append(([{"href": h, "title": t} for h, t in p.links], p.dates(), " ".join(p.heads), p.body()))
    return pd.DataFrame(rows, columns=["links", "dates", "heads", "body"])


_parse_udf = arrow_udf(_parse_batch, _PARSED)


def _links_batch(s: pd.Series) -> pd.Series:
    return pd.Series([[{"href": h, "title": t} for h, t in _Page(source or "").links] for source in s], dtype=object)


#: The links alone: bodies, dates and headings are neither put together nor sent.
_links_udf = arrow_udf(_links_batch, "array<struct<href: string, title: string>>")


def parse_pages(df: DataFrame, html: str = "html", out: str = "page") -> DataFrame:
    """df with a struct of each page's links, dates in order of precedence, headings and container text."""
    return df.withColumn(out, _parse_udf(text(F.col(html))))


def page_links(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """key, link, title and the columns `keep`: each page's http links with a title, once by normal form, the first of each."""
    links = df.select(key, *keep, F.col(url).alias("_base"), F.posexplode(_links_udf(text(F.col(html)))).alias("_k", "_l"))
    links = links.select(key, *keep, "_k", normalize_url(F.col("_l.href"), F.col("_base")).alias("link"), clean_text(F.col("_l.title")).alias("title"))
    first = F.min(F.struct("_k", "title"))
    return links.where(F.col("link").rlike("^https?://") & (F.col("title") != "")).groupBy(key, *keep, "link").agg(first.alias("f")).select(key, *keep, "link", "f.title")


def article_links(df: DataFrame, **names: str) -> DataFrame:
    return page_links(df, **names).where(looks_like_article(F.col("link"), F.col("title")))


def published_date(dates: Column) -> Column:
    """The first of the page's dates that parses."""
    return F.get(F.filter(F.transform(dates, parse_date), lambda d: d.isNotNull()), F.lit(0))


def matches_title(words_of: Column, expected: Column) -> Column:
    """Whether three tenths of the expected title's words are in a page's headings; true where either says too little."""
    want, have = significant_words(expected), significant_words(words_of)
    return (F.size(want) < 2) | (F.size(have) == 0) | (F.size(F.array_intersect(want, have)) / F.size(want) >= TITLE_SHARE)


def body_matches_title(body: Column, expected: Column) -> Column:
    want = distinctive_words(expected)
    return (F.size(want) == 0) | F.arrays_overlap(want, significant_words(body))


def extract_body(df: DataFrame, html: str = "html", title: str | None = None) -> DataFrame:
    """df with body and published; both are empty where the page or its body does not match the expected title."""
    out = parse_pages(df, html).withColumn("body", strip_related_blocks(clean_text(F.col("page.body")))).withColumn("published", published_date(F.col("page.dates")))
    if title:
        ok = matches_title(F.col("page.heads"), F.col(title)) & body_matches_title(F.col("body"), F.col(title))
        out = out.withColumns({"body": F.when(ok, F.col("body")).otherwise(""), "published": F.when(ok, F.col("published"))})
    return out.drop("page")


def outbound_domains(df: DataFrame, excluded: list[str], key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """key, domain: the distinct domains of other organisations that a page links to."""
    from .urls import domain, is_excluded, same_organisation

    links = page_links(df.withColumn("_own", domain(F.col(url))), key, url, html, ("_own",)).withColumn("domain", domain(F.col("link")))
    return links.where((F.col("domain") != "") & ~is_excluded(F.col("domain"), excluded) & ~same_organisation(F.col("domain"), F.col("_own"))).select(key, "domain").distinct()


_RSS = "channel struct<item:array<struct<title:string,link:string,description:string,pubDate:string>>>"
_ATOM = "entry array<struct<title:string,link:array<struct<_href:string>>,summary:string,updated:string,published:string>>"


def feed_items(df: DataFrame, content: str = "content") -> DataFrame:
    """df's rows times the items of their RSS or Atom feed: title, link, summary, date; a malformed feed has none.

    Items without title or link go. Redirect links keep no summary and lose the site name; others must look like articles.
    """
    bare = F.regexp_replace(F.regexp_replace(F.trim(text(F.col(content))), r"^<\?xml[^>]*\?>", ""), r"\sxmlns(:\w+)?=\"[^\"]*\"", "")
    well = bare.rlike(r"(?s)^\s*<(rss|feed)\b.*</(rss|feed)>\s*$")
    out = df.withColumn("_feed", F.from_xml(F.when(well, bare), f"{_RSS}, {_ATOM}", {"mode": "PERMISSIVE"}))  # one parse for both kinds
    items = F.transform(F.col("_feed.channel.item"), lambda i: F.struct(i["title"].alias("title"), i["link"].alias("link"), i["description"].alias("summary"), i["pubDate"].alias("date")))
    entries = F.transform(F.col("_feed.entry"), lambda i: F.struct(i["title"].alias("title"), F.get(i["link"], F.lit(0))["_href"].alias("link"), i["summary"].alias("summary"), F.coalesce(i["published"], i["updated"]).alias("date")))
    out = out.withColumn("_item", F.explode(F.coalesce(items, entries)))
    title = clean_text(F.col("_item.title"))
    # As a row of its own a link is made once; a filter that Spark moves below a projection would make it anew wherever it reads it.
    out = out.withColumn("link", F.explode(F.array(normalize_url(F.col("_item.link"))))).withColumns({"_title": title, "_summary": clean_text(F.col("_item.summary")), "date": parse_date(F.col("_item.date"))})
    redirect = is_redirect(F.col("link"))
    out = out.withColumn("title", F.when(redirect, strip_site_name(F.col("_title"))).otherwise(F.col("_title")))
    keep = (F.col("title") != "") & (F.col("link") != "") & F.when(redirect, title_passes(F.col("title"))).otherwise(looks_like_article(F.col("link"), F.col("title")))
    return out.where(keep).withColumn("summary", F.when(redirect, "").otherwise(F.col("_summary"))).drop("_feed", "_item", "_title", "_summary", content)


def diagnose(df: DataFrame, content: str) -> DataFrame:
    """df with bytes, chars, what the content looks like, and its counts of links, items and headings."""
    c = text(F.col(content))
    count = lambda p: F.regexp_count(c, F.lit(p))
    return df.withColumns({
        "bytes": F.octet_length(c), "chars": F.length(c), "looks_like_xml": c.rlike(r"(?is)^\s*<(\?xml|rss|feed)"), "looks_like_html": c.rlike(r"(?i)<(html|body|head|!doctype)"),
        "links": count(r"(?i)<a\s"), "items": count(r"(?i)<(item|entry)[\s>]"), "articles": count(r"(?i)<article[\s>]"), "first_links": F.slice(F.regexp_extract_all(c, F.lit(r'(?i)<a\s[^>]*href="([^"]*)"'), F.lit(1)), 1, 5),
    })


def parse_verdict(c: Column) -> Column:
    """A judge's answer as struct(pertinent, raison, confiance, erreur): errors are data.

    The first {...} of the text must be an object whose `pertinent` is a JSON boolean, not a string that reads like one.
    """
    block = F.regexp_extract(text(c), r"(?s)\{.*?\}", 0)
    v = F.try_parse_json(block)
    kind = F.coalesce(F.schema_of_variant(F.try_variant_get(v, "$.pertinent", "variant")), F.lit(""))
    level = F.lower(F.coalesce(F.try_variant_get(v, "$.confiance", "string"), F.lit("moyenne")))
    error = F.when(block == "", "no object").when(v.isNull(), "no JSON").when(kind != "BOOLEAN", "no boolean")
    ok = error.isNull()
    return F.struct(
        F.when(ok, F.try_variant_get(v, "$.pertinent", "boolean")).alias("pertinent"),
        F.when(ok, F.substring(F.coalesce(F.try_variant_get(v, "$.raison", "string"), F.lit("")), 1, 300)).alias("raison"),
        F.when(ok, F.when(level.isin("haute", "moyenne", "basse"), level).otherwise("moyenne")).alias("confiance"),
        error.alias("erreur"),
    )


__all__ = ["article_links", "body_matches_title", "collapse", "diagnose", "extract_body", "feed_items", "matches_title", "outbound_domains", "page_links", "parse_pages", "parse_verdict", "published_date"]
