"""Verdicts against labels: contingency, precision and recall, over-represented words, rows to review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .archive import keep_last

LIFT_LEAST, LIFT_ABOVE = 3, 1.5


def compare(articles: DataFrame, verdicts: DataFrame, key: str, seq: str) -> DataFrame:
    """Inner join of the last article of each key with its verdict, and the bucket: agreement, which of the two says yes
    alone, or `no_verdict` where the verdict is null."""
    joined = keep_last(articles, key, seq).join(verdicts, key)
    bucket = F.when(F.col("verdict").isNull(), "no_verdict").when(F.col("relevant") & F.col("verdict"), "both").when(F.col("relevant"), "only_score").when(F.col("verdict"), "only_judge").otherwise("neither")
    return joined.withColumn("bucket", bucket)


def agreement(compared: DataFrame) -> DataFrame:
    n = lambda *names: F.count_if(F.col("bucket").isin(*names))
    usable = n("both", "neither", "only_score", "only_judge")
    return compared.agg(*(n(b).alias(b) for b in ("both", "neither", "only_score", "only_judge", "no_verdict")), F.coalesce(F.bround(F.try_divide(n("both", "neither"), usable), 4), F.lit(0.0)).alias("agreement"))


def measure(predicted: Column, actual: Column) -> list[Column]:
    """Counts and measures as aggregates; 0 where undefined."""
    tp, fp, fn, tn = F.count_if(predicted & actual), F.count_if(predicted & ~actual), F.count_if(~predicted & actual), F.count_if(~predicted & ~actual)
    ratio = lambda a, b: F.coalesce(F.bround(F.try_divide(a, b), 4), F.lit(0.0))
    return [tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"), ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1")]


def over_represented(words: DataFrame, reference: DataFrame, word: str = "word") -> DataFrame:
    """word, n, lift: words whose share is over LIFT_ABOVE times that in the reference; absent ones count once there."""
    own = words.groupBy(word).agg(F.count(F.lit(1)).alias("n"))
    ref = reference.groupBy(word).agg(F.count(F.lit(1)).alias("r"))
    totals = words.agg(F.count(F.lit(1)).alias("total")).crossJoin(reference.agg(F.count(F.lit(1)).alias("ref_total")))  # one row
    lift = (F.col("n") / F.col("total")) / F.greatest(F.coalesce("r", F.lit(1)) / F.greatest("ref_total", F.lit(1)), F.lit(1e-300))
    out = own.where(F.col("n") >= LIFT_LEAST).join(ref, word, "left").crossJoin(F.broadcast(totals)).withColumn("lift", lift)
    return out.where(F.col("lift") > LIFT_ABOVE).select(word, "n", F.bround("lift", 1).alias("lift"))


def disagreements_by(compared: DataFrame, by: str, n: int = 15) -> DataFrame:
    """The n most frequent values of `by` in each bucket."""
    from .aggregates import top_by_group

    counted = compared.groupBy("bucket", F.coalesce(F.nullif(F.col(by).cast("string"), F.lit("")), F.lit("(inconnu)")).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return top_by_group(counted, "bucket", [F.desc("n"), F.col("value").asc()], n)


def to_review(compared: DataFrame, key: str, seed: int, n: int, agreements: int) -> DataFrame:
    """The n gravest disagreements (what only the judge wants first, then by score), and a seeded sample of agreements."""
    grave = F.when(F.col("bucket") == "only_judge", 2).when(F.col("bucket") == "only_score", 1).otherwise(0)
    odd = compared.where(grave > 0).orderBy(F.desc(grave), F.desc("score"), key).limit(n)
    same = compared.where(F.col("bucket").isin("both", "neither")).orderBy(F.xxhash64(key, F.lit(seed)), key).limit(agreements)
    return odd.unionByName(same)


def candidates(citations: DataFrame, known: DataFrame, domain: str = "domain", example: str = "page_id") -> DataFrame:
    """domain, n, example: how often each unknown domain is cited, and the first example."""
    return citations.join(known.select(domain).distinct(), domain, "left_anti").groupBy(domain).agg(F.count(F.lit(1)).alias("n"), F.min(example).alias("example"))
