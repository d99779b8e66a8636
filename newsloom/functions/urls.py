"""URL columns: normal form, keys, domains, and whether a link looks like an article."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..shipping import arrow_udf
from .arrays import bound
from .text import collapse, slugify, text

# Query parameters that only track.
TRACKING = ["utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "utm_id", "utm_referrer", "fbclid", "gclid", "yclid", "mc_cid", "mc_eid", "_hsenc", "_hsmi", "igshid", "ref", "ref_src", "spref"]

# Path parts of pages that are no articles, and of pages that are.
NON_ARTICLE_PATHS = ["/tag/", "/tags/", "/category/", "/categories/", "/author/", "/authors/", "/page/", "/pages/", "/search", "/feed", "/rss", "/privacy", "/contact", "/about", "/terms", "/login", "/signup", "/register", "/subscribe", "/newsletter", "/advertise", "/careers", "/sitemap", "/archive", "/archives", "/wp-admin", "/wp-login", "/cart", "/account", "/experts/", "/expert/", "/people/", "/person/", "/staff/", "/team/", "/scholars/", "/scholar/", "/fellows/", "/fellow/", "/contributors/", "/contributor/", "/profile/", "/profiles/", "/bio/", "/bios/", "/what-we-do/", "/human-rights-education", "/issue/", "/issues/", "/topic/", "/topics/", "/petition/", "/petitions/", "/pays-", "/classement", "/barometre", "/data/", "/get-involved/", "/tmsearch/", "_layouts/", "/news_cat/", "/other-media/", "/sports/", "/uscirf-spotlight"]
ARTICLE_PATHS = ["/news/", "/article/", "/articles/", "/stories/", "/story/", "/posts/", "/post/", "/opinion/", "/blog/"]

# Link texts that say nothing.
GENERIC_TITLES = ["read more", "lire la suite", "next", "next page", "previous", "previous page", "home", "accueil", "back", "more", "learn more", "click here", "here", "login", "log in", "sign up", "signup", "register", "subscribe", "contact", "contact us", "about", "about us", "privacy", "privacy policy", "terms", "terms of service", "search", "menu", "share", "tweet", "facebook", "twitter", "print", "comments", "continue reading", "...", "»", "«", ">>", "<<", "table of contents", "table of contents europe & central asia", "countries"]

# Path segments of index pages.
INDEX_SEGMENTS = ["about", "about-us", "archive", "archives", "author", "authors", "cat", "categories", "category", "contact", "countries", "country", "donate", "index", "newsletter", "people", "podcast", "podcasts", "ppl", "preference", "preferences", "profile", "program", "programme", "programmes", "programs", "project", "projects", "publications", "region", "regions", "rubric", "section", "sections", "series", "staff", "subscribe", "tag", "tags", "team", "theme", "themes", "topic", "topics", "ueber-uns", "what-we-do", "where-we-work"]

#: Links through this host say nothing of their target.
REDIRECT_HOST = "news.google.com"
SECTION_WORDS = 5


def _part(url: Column, part: str) -> Column:
    return F.coalesce(F.try_parse_url(text(url), F.lit(part)), F.lit(""))


def path(url: Column) -> Column:
    return _part(url, "PATH")


def domain(url: Column) -> Column:
    """The authority in lower case, without `www.`."""
    return F.regexp_replace(F.lower(_part(url, "AUTHORITY")), r"^www\.", "")


def segments(url: Column) -> Column:
    return F.filter(F.split(path(url), "/"), lambda s: s != "")


def _join_batch(base: pd.Series, url: pd.Series) -> pd.Series:
    def joined(b: str, u: str) -> str:
        try:
            return urljoin(b, u)
        except ValueError:
            return ""

    return pd.Series([joined(b, u) for b, u in zip(base, url)])


_join_udf = arrow_udf(_join_batch, "string")


def absolute(url: Column, base: Column | None) -> Column:
    """The URL against its base; only relative ones leave the JVM."""
    own = collapse(url)
    if base is None:
        return own
    return F.when(own.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:") | (own == ""), own).otherwise(_join_udf(text(base), own))


def _coded(value: Column) -> Column:
    plain = F.coalesce(F.try_url_decode(value), value)
    return F.replace(F.replace(F.url_encode(plain), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def normalize_url(url: Column, base: Column | None = None) -> Column:
    """Absolute, without fragment and tracking parameters, the query encoded anew; empty without a scheme."""
    own = F.regexp_replace(absolute(url, base), "#.*$", "")
    scheme = F.regexp_extract(own, "^[a-zA-Z][a-zA-Z0-9+.-]*:", 0)
    own = F.concat(F.lower(scheme), F.substring(own, F.length(scheme) + 1, F.length(own)))
    head, query = F.element_at(F.split(own, r"\?", 2), 1), F.get(F.split(own, r"\?", 2), F.lit(1))
    pairs = F.filter(F.split(F.coalesce(query, F.lit("")), "&"), lambda p: p != "")
    kept = F.filter(pairs, lambda p: ~F.lower(F.coalesce(F.try_url_decode(F.element_at(F.split(p, "=", 2), 1)), F.lit(""))).isin(TRACKING))
    coded = F.transform(kept, lambda p: F.concat(_coded(F.element_at(F.split(p, "=", 2), 1)), F.lit("="), _coded(F.coalesce(F.get(F.split(p, "=", 2), F.lit(1)), F.lit("")))))
    out = F.when(F.size(kept) > 0, F.concat(head, F.lit("?"), F.array_join(coded, "&"))).otherwise(head)
    return F.when(own.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), out).otherwise("")


def article_key(url: Column, title: Column) -> Column:
    """Authority and path in lower case without the slash at the end, and the query; the bare title where there is no URL."""
    own = F.regexp_replace(text(url), "#.*$", "")
    query = _part(own, "QUERY")
    key = F.concat(F.lower(_part(own, "AUTHORITY")), F.lower(F.regexp_replace(path(own), "/+$", "")), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    bare = collapse(F.regexp_replace(F.lower(text(title)), r"(?U)[^\w\s]", " "))
    return F.when(text(url) != "", key).otherwise(bare)


def is_redirect(url: Column) -> Column:
    return F.lower(_part(url, "AUTHORITY")) == REDIRECT_HOST


def organisation(url_domain: Column) -> Column:
    """The label before the last; empty if there is but one."""
    labels = F.split(text(url_domain), r"\.")
    return F.when(F.size(labels) > 1, F.get(labels, F.size(labels) - 2)).otherwise("")


def is_excluded(url_domain: Column, excluded: list[str]) -> Column:
    return F.exists(F.array(*map(F.lit, excluded)), lambda d: (url_domain == d) | F.endswith(url_domain, F.concat(F.lit("."), d)))


def same_organisation(a: Column, b: Column) -> Column:
    return (organisation(a) != "") & (organisation(a) == organisation(b))


def repeated_prefix(url: Column) -> Column:
    """Whether some prefix of two segments or more stands twice in a row at the start of the path."""

    def repeats(s: Column) -> Column:
        halves = F.when(F.size(s) >= 4, F.sequence(F.lit(2), F.floor(F.size(s) / 2).cast("int"))).otherwise(F.array().cast("array<int>"))
        return F.exists(halves, lambda k: F.slice(s, F.lit(1), k) == F.slice(s, k + 1, k))

    return bound(segments(url), repeats)


def safe_url(url: Column) -> Column:
    return F.when(F.lower(text(url)).rlike("^https?://"), text(url)).otherwise("")


def title_passes(title: Column) -> Column:
    own = F.trim(F.lower(text(title)))
    return (F.length(own) >= 8) & (F.size(F.filter(F.split(own, r"(?U)\s+"), lambda w: w != "")) >= 2) & ~own.isin(GENERIC_TITLES)


def _any_in(c: Column, parts: list[str]) -> Column:
    return bound(c, lambda own: F.exists(F.array(*map(F.lit, parts)), lambda p: F.contains(own, p)))


def looks_like_article(url: Column, title: Column) -> Column:
    """Whether a link's path and text are those of an article rather than of navigation."""
    p, n = F.lower(path(url)), F.size(segments(url))
    by_path = (
        F.when(p.isin("", "/"), False)
        .when(_any_in(p, NON_ARTICLE_PATHS) | repeated_prefix(F.lower(url)), False)
        .when(_any_in(p, ARTICLE_PATHS), True)
        .when(p.rlike(r"/(19|20)\d{2}[/-](0?[1-9]|1[0-2])[/-]"), n >= 3)
        .otherwise(n >= 2)
    )
    return (text(url) != "") & title_passes(title) & (is_redirect(url) | by_path)


# What decorates the end of a section's title, a site's name after it, and the path of a dated article.
SECTION_MARKS = "[\\s\u203a\u00bb>]+$"
SECTION_SITE = "\\s*[-\u2013\u2014|]\\s*[^-\u2013\u2014|]{1,40}$"
DATED_PATH = r"/(?:19|20)\d{2}/\d{1,2}(?:/|$)"


def looks_like_section(url: Column, title: Column) -> Column:
    """Whether a short title names the last path segment, or the path goes through an index segment."""
    own = F.regexp_replace(F.trim(text(title)), SECTION_MARKS, "")
    bare = F.trim(F.regexp_replace(own, SECTION_SITE, ""))
    s = segments(url)
    last = F.coalesce(F.get(s, F.size(s) - 1), F.lit(""))
    short = lambda c: (c != "") & (F.size(F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")) <= SECTION_WORDS)
    named = (short(own) & (slugify(own) == last)) | (short(bare) & (slugify(bare) == last))
    indexed = F.arrays_overlap(F.transform(s, F.lower), F.array(*map(F.lit, INDEX_SEGMENTS)))
    dated = path(url).rlike(DATED_PATH)
    return (own != "") & ~dated & (F.size(s) > 0) & (short(own) | short(bare)) & (named | indexed)
