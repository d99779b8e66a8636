"""Vocabularies as tables: matched by joins, whatever their number of lists and terms, in one pass over the texts.

A table has a row for each term of a list: list_id, ord (its place in the list) and term. What is found equals `find_terms` of
each list: terms at whole words, a leftmost scan without overlaps in which the longest term at a place shadows those within it,
and the list's own order, repeats included.

A text becomes its places where a term may begin. The word or sign at a place meets the terms that are no longer by one join; for the others
a place carries as many characters as the longest term has, and meets them by its first word, which says the lengths to try, and then by the
whole term. Both sides shuffle by key unless the vocabulary is small. If no term is longer, a text is the set of its words. Overlaps are settled by the number of such places in a term, so positions are never needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .matching import bound

#: A vocabulary of so many terms at most is broadcast: a term takes some hundred bytes.
BROADCAST_TERMS = 50_000
_PLACE = r"(?U)(?<!\w)\S"
_HEAD = r"(?U)^(?:\w+|\S)"
#: All heads of a text: one for each place.
_WORD = r"(?U)(?<!\w)(?:\w+|\S)"


def read_vocabulary(spark: SparkSession, path: str, kind: str = "json") -> DataFrame:
    """list_id, ord and term of a file of `kind` (json lines, csv with a header, parquet), terms in lower case, white space collapsed.

    Rows without a list or with a blank term go; repeated terms stay.
    """
    reader = spark.read.schema("list_id string, ord long, term string")
    return normal_vocabulary(reader.option("header", True).csv(path) if kind == "csv" else reader.format(kind).load(path))


def normal_vocabulary(vocabulary: DataFrame) -> DataFrame:
    term = F.lower(F.trim(F.regexp_replace("term", r"(?U)\s+", " ")))
    return vocabulary.select("list_id", F.col("ord").cast("long").alias("ord"), term.alias("term")).where("list_id IS NOT NULL AND term <> ''")


def match_vocabulary(texts: DataFrame, vocabulary: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, list_id and terms (in the list's order) of each text and list with a match. Texts are in normal form already.

    Null texts match nothing. Ids tell texts apart: the matches of rows that share one are those of all their texts, one after another.
    """
    terms = normal_vocabulary(vocabulary).withColumn("head", F.regexp_extract("term", _HEAD, 0))
    length, long = F.length("term"), F.col("term") != F.col("head")
    bounds = [F.count(F.lit(1)).alias("n"), F.coalesce(F.max(length), F.lit(1)).alias("longest"), F.count_if(long).alias("long")]
    size = terms.agg(*bounds, F.coalesce(F.min(F.length("head")), F.lit(1)).alias("least"), F.coalesce(F.max(F.length("head")), F.lit(1)).alias("most")).first()
    small = F.broadcast if size.n <= BROADCAST_TERMS else lambda df: df
    known = terms.groupBy("list_id", "term").agg(F.sort_array(F.collect_list("ord")).alias("ords"), F.regexp_count("term", F.lit(_PLACE)).alias("places"))
    text, fits = F.col(f"`{text_col}`"), F.length("term").between(size.least, size.most)
    words = F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))
    if not size.long:
        return _match_words(texts.select(F.col(f"`{id_col}`").alias("id"), F.explode(F.array_distinct(words)).alias("term")).where(fits), small(known.drop("places")), id_col)
    met = texts.select(F.col(f"`{id_col}`").alias("id"), F.posexplode(words).alias("at", "term")).where(fits).join(small(known), "term")
    heads = terms.where(long).select("head", length.alias("size")).groupBy("head").agg(F.collect_set("size").alias("sizes"))
    ahead = F.regexp_extract_all(text, F.lit(rf"(?Us)(?<!\w)(?=(\S.{{0,{size.longest}}}))"), F.lit(1))
    places = texts.select(F.col(f"`{id_col}`").alias("id"), F.posexplode(ahead).alias("at", "ahead"))
    tried = places.withColumn("head", F.regexp_extract("ahead", _HEAD, 0)).join(small(heads), "head").select("id", "at", "ahead", F.explode("sizes").alias("size"))
    tried = tried.where((F.length("ahead") >= F.col("size")) & ~F.substring(F.col("ahead"), F.col("size") + 1, F.lit(1)).rlike(r"(?U)\w"))
    longer = tried.select("id", "at", F.substring(F.col("ahead"), F.lit(1), F.col("size")).alias("term")).join(small(known), "term")
    met = met.unionByName(longer.where(F.col("term") != F.regexp_extract("term", _HEAD, 0)))
    spans = met.groupBy("id", "list_id").agg(F.sort_array(F.collect_list(F.struct("at", (-F.length("term")).alias("size"), "term", "ords", "places"))).alias("spans"))
    begin = F.struct(F.lit(0).cast("long").alias("next"), F.array().cast("array<struct<term:string,ords:array<long>>>").alias("found"))

    def take(state, span):
        own = F.struct(span["term"].alias("term"), span["ords"].alias("ords"))
        found = F.when(F.array_contains(state["found"], own), state["found"]).otherwise(F.array_append(state["found"], own))
        taken = F.struct((span["at"] + span["places"]).cast("long").alias("next"), found.alias("found"))
        return F.when(span["at"] >= state["next"], taken).otherwise(state)

    return spans.select(F.col("id").alias(id_col), "list_id", _listed(F.aggregate("spans", begin, take)["found"]).alias("terms"))


def _match_words(words: DataFrame, known: DataFrame, id_col: str) -> DataFrame:
    """The same where every term is one word or sign: none can shadow another, so that each word of a text is looked up once, by one join."""
    met = words.join(known, "term").groupBy("id", "list_id").agg(F.sort_array(F.collect_list(F.struct("term", "ords"))).alias("all"))
    once = bound(F.col("all"), lambda own: F.filter(own, lambda x, i: (i == 0) | (F.get(own, i - 1)["term"] != x["term"])))  # texts may share an id
    return met.select(F.col("id").alias(id_col), "list_id", _listed(once).alias("terms"))


def _listed(found: Column) -> Column:
    """The terms of structs of term and ords, in the list's order, repeats included."""
    placed = F.flatten(F.transform(found, lambda x: F.transform(x["ords"], lambda o: F.struct(o.alias("ord"), x["term"].alias("term")))))
    return F.transform(F.array_sort(placed), lambda x: x["term"])
