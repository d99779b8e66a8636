"""Relations of spans as joins by position: what stands near what, for texts of any length and any number of spans.

Spans are rows: a key (of the text), start and end (end excluded). The line of positions is cut into buckets of a fixed width. A span of
one side goes to the buckets that it touches, one of the other side also to those within the window, so whatever is near meets in
a bucket, and a bucket never holds more spans than its width has places. Within a bucket two running extremes give the nearest span
before and after, so that pairs are never formed. One long text is many buckets, and they go to many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import matching
from .vocabulary import TermSet

#: Positions in a bucket, as a multiple of the window.
WIDTHS = 8


def span_rows(texts: DataFrame, key: str, text: str, terms: TermSet) -> DataFrame:
    """key, s and e of each place of a term, as `matching.spans` finds them. Null texts and texts without a term have none."""
    c = F.col(f"`{text}`")
    found = texts.where(c.rlike(terms.stems)).select(F.col(f"`{key}`"), F.explode(matching.spans(c, terms.stems)).alias("_span"))
    return found.select(F.col(f"`{key}`"), F.col("_span.s").cast("long").alias("s"), F.col("_span.e").cast("long").alias("e"))


def _buckets(first: Column, last: Column, width: int) -> Column:
    return F.explode(F.sequence(F.floor(first / width), F.floor(last / width)))


def nearest(left: DataFrame, right: DataFrame, key: str, window: int = matching.WINDOW, width: int | None = None) -> DataFrame:
    """key, s, e and gap of each span of `left` that has one of `right` at most `window` positions away in either direction.

    The gap is that to the nearest one, 0 if they overlap or touch. A span that repeats in `left` comes once; repeats in `right` change
    nothing. Spans with a null key, start or end are near nothing, nor are those that end before they start. Other columns are ignored.
    """
    width = width or max(1, window) * WIDTHS
    k = F.col(f"`{key}`").alias("_key")
    good = "_key IS NOT NULL AND s IS NOT NULL AND e >= s"
    s, e = F.col("s").cast("long").alias("s"), F.col("e").cast("long").alias("e")
    own = left.select(k, s, e).where(good).withColumn("_bucket", _buckets(F.col("s"), F.col("e"), width)).withColumn("_left", F.lit(True))
    other = right.select(k, s, e).where(good).withColumn("_bucket", _buckets(F.col("s") - window, F.col("e") + window, width)).withColumn("_left", F.lit(False))
    # Rows at one start are peers: each sees the other, before and after.
    line = Window.partitionBy("_key", "_bucket").orderBy("s")
    before, after = line.rangeBetween(Window.unboundedPreceding, Window.currentRow), line.orderBy(F.desc("s")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    told = own.unionByName(other).withColumns({"_ended": F.max(F.when(~F.col("_left"), F.col("e"))).over(before), "_begun": F.min(F.when(~F.col("_left"), F.col("s"))).over(after)})
    # least and greatest skip nulls, so a missing side must not turn a gap into 0.
    gap = F.least(F.when(F.col("_ended").isNotNull(), F.greatest(F.lit(0), F.col("s") - F.col("_ended"))), F.when(F.col("_begun").isNotNull(), F.greatest(F.lit(0), F.col("_begun") - F.col("e"))))
    near = told.where("_left").withColumn("gap", gap.cast("long")).where(F.col("gap") <= window)
    return near.groupBy("_key", "s", "e").agg(F.min("gap").alias("gap")).select(F.col("_key").alias(key), "s", "e", "gap")


def related_by_join(texts: DataFrame, key: str, text: str, targets: TermSet, actions: TermSet, window: int = matching.WINDOW) -> DataFrame:
    """key, gap of the texts that have a target within `window` characters of an action: what `related_rows` gives, by join.

    Keys must tell texts apart: spans of texts that share one are taken as those of one text; a null key is related to nothing.
    """
    both = texts.where(F.col(f"`{text}`").rlike(targets.stems) & F.col(f"`{text}`").rlike(actions.stems))
    near = nearest(span_rows(both, key, text, targets), span_rows(both, key, text, actions), key, window)
    return near.groupBy(F.col(f"`{key}`")).agg(F.min("gap").alias("gap"))
