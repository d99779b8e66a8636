import datetime as dt

import pytest
from pyspark.sql import functions as F

from newsloom.functions import arrays as R
from newsloom.functions import dates as X
from newsloom.functions import pages as H
from newsloom.functions import text as T
from newsloom.functions import urls as U


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(n) for n, c in columns.items())).first().asDict()


def lit(s):
    return F.lit(s).cast("string") if s is None else F.lit(s)


def cases(spark, f, pairs):
    """One job for all (input, output) pairs."""
    got = spark.range(1).select(*(f(lit(i)).alias(f"c{k}") for k, (i, _) in enumerate(pairs))).first()
    for g, (i, o) in zip(got, pairs):
        assert g == o, (i, g, o)


def test_text(spark):
    cases(spark, T.normalize, [(None, ""), ("  A \t B\n", "a b"), ("Ärger", "ärger")])
    cases(spark, T.clean_text, [(None, ""), ("a   b", "a b"), ("a &amp; b", "a & b"), ("a​b c", "ab c"), ("cafÃ©", "café"), ("plain", "plain"), ("ﬁne", "fine")])
    cases(spark, T.repair_mojibake, [("ÐšÐ°", "Ка"), ("Гј", "Гј"), ("naïve â", "naïve â"), (None, "")])
    cases(spark, T.strip_related_blocks, [("a Recommended Stories list of 3 items x y end of list b", "a b"), ("x" * 90 + " Follow us on z", "x" * 90), ("Follow us on " + "x" * 50, "Follow us on " + "x" * 50), (None, "")])
    cases(spark, T.strip_site_name, [("Some title - The Site", "Some title"), ("Some-title", "Some-title")])
    cases(spark, T.strip_byline, [("Good title By Ann Lee Some lead", "Good title"), ("By Ann Lee Some lead", "By Ann Lee Some lead"), ("No author", "No author")])
    cases(spark, T.strip_card, [("Story One two One two", "One two"), ("Plain", "Plain"), ("Date Date 1 May", "Date Date 1 May")])
    cases(spark, T.slugify, [("The Baltics!", "the-baltics"), (None, "")])
    cases(spark, T.detect_script, [("short", ""), ("это длинный русский текст да", "ru"), ("this is a long english text", "en"), ("این یک متن فارسی بلند است که", "fa")])
    cases(spark, lambda c: T.resolve_language(c, F.lit("это длинный русский текст да")), [("", "ru"), ("multi", "ru"), ("fr", "fr")])
    cases(spark, T.distinctive_words, [("alpha beta gamma delta lengthy", ["lengthy", "alpha"]), ("a b", [])])
    cases(spark, T.title_words, [("It's the co-op 42x -- été's'", ["it's", "the", "co-op", "été's"])])
    cases(spark, T.cut_to_word, [("ab cd ef", "cd ef"), ("abc", "")])
    cases(spark, lambda c: T.strip_suffix(c, F.lit(" The end")), [("text The end", "text"), ("text", "text")])
    cases(spark, lambda c: T.looks_like_refusal(c, ["i cannot"]), [("Sorry, I cannot do", True), ("Fine", False)])


def test_urls(spark):
    cases(spark, lambda c: U.normalize_url(c, F.lit("http://b.org/x/")), [("http://a.org/p?utm_source=x&b=2#f", "http://a.org/p?b=2"), ("/q?UTM_Medium=1", "http://b.org/q"), ("y?a=", "http://b.org/x/y?a="), ("", ""), (None, "")])
    cases(spark, U.normalize_url, [("no scheme", ""), ("http://a.org/?q=a~b*c", "http://a.org/?q=a~b%2Ac")])
    cases(spark, lambda c: U.article_key(c, F.lit("A, title!  here")), [("HTTP://A.org:8080/P/q/?x=1#y", "a.org:8080/p/q?x=1"), ("", "a title here")])
    cases(spark, U.domain, [("https://www.A.org/x", "a.org"), ("junk", "")])
    cases(spark, U.organisation, [("news.site.org", "site"), ("localhost", "")])
    cases(spark, lambda c: U.is_excluded(c, ["x.com"]), [("x.com", True), ("a.x.com", True), ("ax.com", False)])
    cases(spark, U.repeated_prefix, [("http://h/a/b/a/b/c", True), ("http://h/a/a/b", False), ("http://h/a/b/c/d", False)])
    cases(spark, lambda c: U.looks_like_article(c, F.lit("A proper title")), [("http://a.org/news/x", True), ("http://a.org/", False), ("http://a.org/tag/x/y", False), ("http://a.org/one", False), ("http://a.org/one/two", True), ("http://a.org/2024/05/x", True), ("http://news.google.com/rss/articles/z", True), ("", False)])
    cases(spark, lambda c: U.looks_like_article(F.lit("http://a.org/news/x"), c), [("Read more", False), ("Short", False), ("A long title", True)])
    cases(spark, lambda c: U.looks_like_section(F.lit("http://e.org/region/the-baltics"), c), [("The Baltics", True), ("A very long title of an actual article here", False)])
    cases(spark, lambda c: U.looks_like_section(c, F.lit("The Baltics")), [("http://e.org/x/the-baltics", True), ("http://e.org/2024/05/the-baltics", False), ("http://e.org/x/other", False), ("http://e.org", False)])
    cases(spark, U.safe_url, [("javascript:x", ""), ("https://a", "https://a")])


def test_dates(spark):
    at = lambda *a: dt.datetime(*a)
    cases(spark, X.parse_date, [("2024-05-01T10:00:00Z", at(2024, 5, 1, 10)), ("Wed, 01 May 2024 10:00:00 GMT", at(2024, 5, 1, 10)), ("1 May 2024 9:00:00 +0200", at(2024, 5, 1, 7)), ("2024-05-01", at(2024, 5, 1)), ("junk", None), ("", None), (None, None)])
    now = F.lit("2024-05-10 00:00:00").cast("timestamp")
    cases(spark, lambda c: X.relative_age(c.cast("timestamp"), now), [("2024-05-11", "future"), ("2024-05-09 12:00:00", "today"), ("2024-05-08 12:00:00", "yesterday"), ("2024-05-01", "9 d"), ("2024-02-01", "3 mo"), ("2020-05-10", "4 y"), (None, "")])
    cases(spark, lambda c: X.whole_days(c.cast("timestamp"), now), [("2024-05-08 12:00:00", 2), ("2024-05-07 12:00:00", 2), (None, None)])
    cases(spark, lambda c: X.is_stale(c.cast("timestamp"), now, 3600), [("2024-05-09 23:00:00", True), ("2024-05-09 23:00:01", False), (None, True)])
    cases(spark, lambda c: X.is_archival(c.cast("timestamp"), now), [("2024-01-01", True), ("2024-05-01", False), (None, False)])
    cases(spark, lambda c: X.format_date(c.cast("timestamp")), [("2024-05-01 09:05:00", "01/05/2024 à 09:05 UTC"), (None, "")])


def test_arrays(spark):
    a = lambda *x: R.literal(list(x))
    got = one(spark, u=R.ordered_union(a("b", "a"), a("a", "c")), l=R.lookup(a("x", "y", "z"), {"x": "1", "y": "1"}, "other"), w=R.without_contained(a("new york", "york"), {"york": ["new york"]}),
              s=R.weighted_sum(a("p", "q"), {"p": 5}, 25), c=R.weighted_sum(a("p", "q"), {"p": 5}, 6), e=R.weighted_sum(a(), {}, 6), k=R.clamp(F.lit(130)))
    assert got == {"u": ["b", "a", "c"], "l": ["1", "other"], "w": ["new york"], "s": 7, "c": 6, "e": 0, "k": 100}


PAGE = """<html><head><title>Big river floods town</title><meta property="article:published_time" content="2024-05-01T10:00:00Z">
<script type="application/ld+json">{"@graph": [{"datePublished": "2023-01-01"}]}</script></head><body><nav>menu</nav>
<article><h1>Big river floods town</h1><p>The river rose.</p><div class="comments">nonsense</div><script>x()</script></article>
<a href="/news/one-two">A first long title</a><a href="/news/one-two#x">Again</a><a href="mailto:x">Mail</a><a href="http://other.net/x">Other place</a></body></html>"""


def test_pages(spark):
    df = spark.createDataFrame([(1, "http://a.org/p", PAGE, "River floods town"), (2, "http://a.org/q", "<p>no <b>end", "Something else entirely"), (3, "http://a.org/r", None, "x")], "page_id long, url string, html string, want string")
    got = {r.page_id: r for r in H.extract_body(df, title="want").collect()}
    assert got[1].body == "Big river floods town The river rose." and got[1].published == dt.datetime(2024, 5, 1, 10)
    assert got[2].body == "" and got[3].body == "" and got[3].published is None
    links = {(r.link, r.title) for r in H.page_links(df).collect()}
    assert links == {("http://a.org/news/one-two", "A first long title"), ("http://other.net/x", "Other place")}
    assert [r.domain for r in H.outbound_domains(df, ["x.com"]).collect()] == ["other.net"]
    assert [r.link for r in H.article_links(df).collect()] == ["http://a.org/news/one-two"]


def test_feeds(spark):
    rss = '<?xml version="1.0"?><rss><channel><item><title>First long title</title><link>http://a.org/news/1</link><description>d &amp;amp; e</description><pubDate>Wed, 01 May 2024 10:00:00 GMT</pubDate></item><item><title>No link here</title></item><item><title>Some news story - Site</title><link>https://news.google.com/rss/x</link><description>s</description></item></channel></rss>'
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>Second long title</title><link href="http://a.org/news/2"/><updated>2024-05-01T10:00:00Z</updated></entry></feed>'
    df = spark.createDataFrame([(1, rss), (2, atom), (3, "junk <x"), (4, ""), (5, None)], "i int, content string")
    got = {(r.i, r.title, r.link, r.summary) for r in H.feed_items(df).collect()}
    assert got == {(1, "First long title", "http://a.org/news/1", "d & e"), (1, "Some news story", "https://news.google.com/rss/x", ""), (2, "Second long title", "http://a.org/news/2", "")}
    d = H.diagnose(df, "content").where("i = 1").first()
    assert (d.items, d.looks_like_xml, d.looks_like_html) == (3, True, False)


def test_a_feed_is_parsed_once_and_its_links_made_once(spark):
    """A filter moved below the projection of the links read them by making each anew; two kinds of feed took two parses."""
    df = spark.createDataFrame([(1, "<rss></rss>")], "i int, content string")
    plan = H.feed_items(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml") == 1 and plan.count("igshid") == 2  # making a link names the parameters twice


@pytest.mark.parametrize("answer, want", [('ok {"pertinent": false, "raison": "r", "confiance": "Haute"}', (False, "r", "haute", None)), ('{"pertinent": "true"}', (None, None, None, "no boolean")), ("none", (None, None, None, "no object")), ("{bad}", (None, None, None, "no JSON")), (None, (None, None, None, "no object"))])
def test_verdicts(spark, answer, want):
    assert tuple(one(spark, v=H.parse_verdict(lit(answer)))["v"]) == want


def test_batches_to_python_are_bounded(spark):
    """A worker holds so many rows of a table at a time, however many there are."""
    from newsloom.shipping import arrow_udf

    rows = spark.range(3000).select(F.col("id").cast("string").alias("s")).coalesce(1)
    assert rows.select(arrow_udf(lambda s: s.map(lambda x: len(s)), "int")(F.col("s")).alias("n")).agg(F.max("n")).first()[0] <= 1000
    assert rows.select(arrow_udf(lambda a, b: a + b, "string")(F.col("s"), F.lit("x")).alias("g")).first().g == "0x"
