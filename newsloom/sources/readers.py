"""Readers: archives in JSON lines, state, CSV, labels, registries, verdicts. Corrupt lines are counted, not fatal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import micros, parse_date
from ..functions.text import strip_related_blocks, text
from ..functions.urls import domain, looks_like_section

ARTICLE = "source string, source_label string, language string, title string, summary string, url string, body string, date timestamp"
ARCHIVE = "key string, url string, title string, summary string, source string, source_label string, language string, date string, premiere_vue string, body string"
SOURCE = "name string, short_name string, profile string, label string, type string, language string, url string, feeds array<string>, fallbacks array<string>, max_articles int"
STATE = "dernier_scan string, vus_avant map<string,string>"
MEMORY = (
    "seen_article_keys array<string>, last_collected_size int, body_cache map<string,struct<body:string,date:string,fetched_at:string>>, "
    "sources map<string,struct<last_scanned_at:string,ok:boolean,articles:array<struct<source:string,source_label:string,title:string,summary:string,url:string,date:string>>>>"
)


def archive(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The last line of each key in file order, and one row with the counts of corrupt and blank-keyed lines."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("f"), F.monotonically_increasing_id().alias("i")).where(F.trim("value") != "")
    rows = lines.withColumn("r", F.from_json("value", ARCHIVE, {"mode": "PERMISSIVE"})).withColumn("bad", F.try_parse_json("value").isNull())
    counts = rows.agg(F.count_if("bad").alias("corrupt"), F.count_if(~F.col("bad") & (F.coalesce("r.key", F.lit("")) == "")).alias("keyless"))
    last = rows.where(~F.col("bad") & (F.coalesce("r.key", F.lit("")) != "")).groupBy("r.key").agg(F.max_by("r", F.struct("f", "i")).alias("r"))
    return last.select("r.*"), counts


def articles_of(entries: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """Archive entries as articles, with their key, parsed date and when they were last seen."""
    out = entries.withColumn("archive_key", F.col("key")).withColumn("date", parse_date(F.col("date")))
    return out if seen is None else out.join(seen.select(F.col("key").alias("archive_key"), F.col("seen").alias("derniere_vue")), "archive_key", "left")


def state(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The last scan (one row), and (key, seen) of the exceptions."""
    df = spark.read.schema(STATE).option("multiLine", True).json(path)
    return df.select("dernier_scan"), df.select(F.explode("vus_avant").alias("key", "seen"))


def memory(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    df = spark.read.schema(MEMORY).option("multiLine", True).json(path)
    sources = df.select(F.explode("sources").alias("source_name", "s"))
    return {
        "seen": df.select(F.posexplode("seen_article_keys").alias("seq", "key")),
        "sources": sources.select("source_name", parse_date(F.col("s.last_scanned_at")).alias("scanned_at"), F.col("s.ok").alias("ok")),
        "articles": sources.select("source_name", F.posexplode("s.articles").alias("seq", "a")).select("source_name", "seq", "a.*"),
        "bodies": df.select(F.explode("body_cache").alias("url", "b")).select("url", "b.body", "b.date", parse_date(F.col("b.fetched_at")).alias("fetched_at")),
        "size": df.select("last_collected_size"),
    }


def csv_rows(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return df if limit is None else df.limit(limit)


def of_levels(df: DataFrame, levels: list[str]) -> DataFrame:
    return df.where(F.col("level").isin(levels))


def labels(spark: SparkSession, path: str) -> DataFrame:
    """key, pertinent of a JSON map whose values are booleans or objects with one; null means not judged."""
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,variant>").alias("m"))
    rows = whole.select(F.explode("m").alias("key", "v"))
    json = F.col("v")
    own = F.coalesce(F.try_variant_get(json, "$.pertinent", "variant"), json)  # of an object its entry, else the value itself
    # A string that reads like a boolean is none.
    value = F.when(F.schema_of_variant(own) == "BOOLEAN", F.try_variant_get(own, "$", "boolean"))
    return rows.select("key", value.alias("pertinent")).where("pertinent IS NOT NULL")


def verdicts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("cle string, pertinent boolean, raison string, confiance string, erreur string, index int").option("multiLine", True).json(path)


def prior_results(spark: SparkSession, path: str, key: str = "url") -> DataFrame:
    """The last result with a body of each URL."""
    df = spark.read.schema("results array<struct<url:string,title:string,body:string,date:string,level:string,fetch_error:string>>").option("multiLine", True).json(path)
    rows = df.select(F.posexplode("results").alias("seq", "r")).select("seq", "r.*")
    ok = (text(F.col("url")) != "") & (text(F.col("body")) != "") & (text(F.col("fetch_error")) == "")
    return rows.where(ok).groupBy(key).agg(F.max_by(F.struct("title", "body", "date", "level"), "seq").alias("r")).select(key, "r.*")


def lacks_something(body: Column, date: Column, url: Column, title: Column) -> Column:
    """Whether an entry has no body, or no date though it is no section page."""
    return (text(body) == "") | ((text(date) == "") & ~looks_like_section(url, title))


def pending(entries: DataFrame, limit: int | None = None) -> DataFrame:
    """Entries with a URL that lack a body or a date."""
    own = entries.where((text(F.col("url")) != "") & lacks_something(F.col("body"), F.col("date"), F.col("url"), F.col("title")))
    return own if limit is None else own.orderBy("key").limit(limit)


def known_domains(registry: DataFrame) -> DataFrame:
    every = F.concat(F.array("url"), F.coalesce("feeds", F.array().cast("array<string>")), F.coalesce("fallbacks", F.array().cast("array<string>")))
    return registry.select(F.explode(every).alias("u")).select(domain(F.col("u")).alias("domain")).where("domain <> ''").distinct()


def collect(attempts: DataFrame, items: DataFrame, key: str = "source_name") -> DataFrame:
    """Items of each source's attempts: all feeds that worked, or else the first fallback that did.

    attempts: source, attempt, rank, is_feed, ok; items: source, attempt and the item's columns.
    """
    fed = attempts.where("ok AND is_feed").select(key, "attempt")
    fallback = attempts.where("ok AND NOT is_feed").join(fed.select(key).distinct(), key, "left_anti").groupBy(key).agg(F.min_by("attempt", "rank").alias("attempt"))
    return items.join(fed.unionByName(fallback), [key, "attempt"])


def boilerplate_bodies(entries: DataFrame, least: int = 400) -> DataFrame:
    """source, body of the entries whose cleaned body is long enough to have boilerplate."""
    return entries.select("source", strip_related_blocks(F.col("body")).alias("body")).where(F.length("body") > least)


def cached_pages(pages: DataFrame, now: Column, ttl_seconds: int) -> DataFrame:
    """Raw pages that are still fresh at `now`."""
    return pages.where((micros(now) - micros(F.col("fetched_at"))) <= ttl_seconds * 1_000_000)
