"""Requests to score articles, as JSON lines or one JSON document: positions, valid and refused articles in one pass, results by batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import parse_date
from ..operators.scoring import Lexicon, keywords_used, score

#: Articles of a batch, whose counts `progress` tells.
BATCH = 200
#: Parts of the score that a result shows.
SUB_SCORES = ("geography_score", "target_score", "repression_score", "rights_score", "journalism_score", "geopolitical_score")
_FIELDS = ("summary", "body", "source", "url", "language")
#: Bits of monotonically_increasing_id that count the rows of a partition.
_ROW_BITS = 33


def request_lines(spark: SparkSession, path: str, staged: str) -> DataFrame:
    """index, value: each line of the files at `path`, blank ones too, from 0 by file name and place in the file.

    A file that is read in several splits keeps its order. Numbers of rows by task are all that the driver sees.
    """
    lines = spark.read.text(path)
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_line")]
    return in_order(lines.select("value", *place), ["_file", "_block", "_line"], staged).select("index", "value")


def request_document(spark: SparkSession, path: str) -> DataFrame:
    """index, value of the array `articles` of one JSON document; ValueError where it is missing or no array.

    The document is one row of one task; requests that are larger come as lines.
    """
    doc = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v"))
    own = F.try_variant_get("v", F.lit("$.articles"), "variant")
    kinds = [r[0] for r in doc.select(F.schema_of_variant(own)).take(1)]
    if not kinds or kinds[0] is None:
        raise ValueError("`articles` is missing")
    if not kinds[0].startswith("ARRAY"):
        raise ValueError(f"`articles` has to be an array, not {kinds[0].lower()}")
    return doc.select(F.posexplode(own.cast("array<variant>")).alias("index", "v")).select(F.col("index").cast("long"), F.to_json("v").alias("value"))


def in_order(df: DataFrame, order: list[str], staged: str) -> DataFrame:
    """df with `index`, gapless from 0 by `order`; rows alike in that are in any order, so it should name a row.

    Rows are dealt by range, sorted and written once with their place in the task that wrote them; the numbers of rows by task, which are
    all that is collected, give each task the index of its first row. No row passes through one task.
    """
    spark = df.sparkSession
    df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()).write.parquet(staged)
    rows = spark.read.schema(f"{df.schema.toDDL()}, _at long").parquet(staged)
    task = F.shiftright("_at", _ROW_BITS).cast("int")
    starts, before = [], 0
    for part, n in sorted(tuple(r) for r in rows.groupBy(task).count().collect()):  # one row for each task
        starts.append((part, before))
        before += n
    start = spark.createDataFrame(starts, "_task int, _start long")
    placed = rows.withColumn("_task", task).join(F.broadcast(start), "_task")
    return placed.withColumn("index", F.col("_start") + F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1)).select("index", *df.columns)


def refusal(article: Column, value: Column) -> Column:
    """Why a parsed article is refused, or null."""
    kind = F.schema_of_variant(article)
    title = F.try_variant_get(article, F.lit("$.title"), "variant")
    words = F.when(F.schema_of_variant(title) == "STRING", F.try_variant_get(title, F.lit("$"), "string"))
    return (
        F.when(F.trim(F.coalesce(value, F.lit(""))) == "", "empty line").when(article.isNull(), "not JSON")
        .when(~kind.startswith("OBJECT"), F.concat(F.lit("not a JSON object (type="), F.lower(F.regexp_extract(kind, "^[A-Z]+", 0)), F.lit(")")))
        .when(F.coalesce(words, F.lit("")) == "", "title missing or empty")
    )


def outcomes(requests: DataFrame, lexicon: Lexicon) -> DataFrame:
    """One row for each request: index, error (null: scored), title, url, source and what the score says, null where refused.

    Valid and refused articles go the same way: a refused one is scored as an empty text and its score then left out, so that nothing is
    read twice or joined again. Fields that are no text count by their JSON; those that are missing or null are empty.
    """
    v = F.col("_v")
    parsed = requests.select("index", "value", F.try_parse_json("value").alias("_v")).withColumn("error", refusal(v, F.col("value")))
    fine = F.col("error").isNull()
    get = lambda name: F.try_variant_get(v, F.lit(f"$.{name}"), "string")
    own = {n: F.when(fine, F.coalesce(get(n), F.lit(""))).otherwise("").alias(n) for n in ("title", *_FIELDS)}
    shown = F.when(F.schema_of_variant(v).startswith("OBJECT"), get("url")).alias("_url")
    articles = parsed.select("index", "error", shown, *own.values(), F.when(fine, parse_date(get("date"))).alias("date"))
    scored = score(articles, lexicon)
    terms = [f.name for f in scored.schema["signals"].dataType if f.dataType.simpleString() == "array<string>"]
    result = {n: F.col(n) for n in ("title", "source", "score", "level", "priority", "relevant", "theme", "reasons", "language")}
    result |= {"keywords": keywords_used(terms), "sub_scores": F.struct(*(F.col(f"signals.{n}").alias(n) for n in SUB_SCORES))}
    return scored.select("index", "error", F.coalesce(F.when(fine, F.col("url")), F.col("_url")).alias("url"), *(F.when(fine, c).alias(n) for n, c in result.items()))


def write_outcomes(found: DataFrame, path: str) -> dict[str, int]:
    """Writes results and errors, in folders `failed=false` and `failed=true`, in one job; returns count, scored and failed from what was written."""
    found.withColumn("failed", F.col("error").isNotNull()).write.partitionBy("failed").mode("overwrite").parquet(path)
    kept = found.sparkSession.read.schema(f"{found.schema.toDDL()}, failed boolean").parquet(path)
    n = {r[0]: r[1] for r in kept.groupBy("failed").count().collect()}
    return {"count": sum(n.values()), "scored": n.get(False, 0), "failed": n.get(True, 0)}


def progress(found: DataFrame, batch_size: int = BATCH) -> DataFrame:
    """first, last, scored and failed of each batch of `batch_size` positions."""
    if isinstance(batch_size, bool) or not isinstance(batch_size, int) or batch_size <= 0:
        raise ValueError("batch_size has to be a positive whole number")
    batch = F.floor(F.col("index") / batch_size).alias("_batch")
    counts = found.groupBy(batch).agg(F.min("index").alias("first"), F.max("index").alias("last"), F.count_if(F.col("error").isNull()).alias("scored"), F.count_if(F.col("error").isNotNull()).alias("failed"))
    return counts.drop("_batch")
