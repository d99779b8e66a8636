"""Reports: stats, facet counts, word counts, top-k by group, orders, shared suffixes, guards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import cut_to_word, text, title_words

# Fixed value: the order of levels.
LEVEL_RANK = {"A": 5, "B": 4, "C": 3, "D": 2, "E": 1, "F": 0}
#: Rows that a section of a report shows.
SECTION_ROWS = 50
SUFFIX_LEAST, SUFFIX_MOST, SUFFIX_SHARE, SUFFIX_ROWS = 120, 4000, 0.2, 4


def stats(df: DataFrame) -> DataFrame:
    """One row: count, retained, average score, counts by level, share of relevant rows in per cent."""
    n = F.count(F.lit(1))
    kept = F.count_if(F.col("relevant"))
    levels = [F.count_if(F.col("level") == k).alias(f"level_{k.lower()}") for k in LEVEL_RANK]
    return df.agg(n.alias("total"), kept.alias("retained"), F.coalesce(F.bround(F.avg("score"), 1), F.lit(0.0)).alias("avg_score"), *levels, F.coalesce(F.bround(100 * kept / n, 1), F.lit(0.0)).alias("relevance_rate"))


def _classes(df: DataFrame, axis: str, none: str | None) -> Column:
    """The classes of an axis as an array of strings, without nulls and the null class."""
    values = F.col(axis) if dict(df.dtypes)[axis].startswith("array") else F.array(axis)
    own = F.filter(F.coalesce(values.cast("array<string>"), F.array().cast("array<string>")), lambda v: v.isNotNull())
    return own if none is None else F.array_remove(own, none)


def facet_counts(df: DataFrame, axes: dict[str, str | None]) -> DataFrame:
    """axis, class, n for all axes in one pass; the axis's null class and null values do not count."""

    def entries(axis: str) -> Column:
        return F.transform(F.array_distinct(_classes(df, axis, axes[axis])), lambda v: F.struct(F.lit(axis).alias("axis"), v.alias("class")))

    return df.select(F.explode(F.concat(*map(entries, axes))).alias("e")).groupBy("e.axis", "e.class").agg(F.count(F.lit(1)).alias("n"))


def facet_coverage(df: DataFrame, axes: dict[str, str | None]) -> DataFrame:
    """axis, described, total, coverage in per cent: rows that have any class of the axis."""
    entries = [F.struct(F.lit(axis).alias("axis"), (F.size(_classes(df, axis, none)) > 0).alias("has")) for axis, none in axes.items()]
    per = df.select(F.explode(F.array(*entries)).alias("e")).groupBy("e.axis").agg(F.count_if("e.has").alias("described"), F.count(F.lit(1)).alias("total"))
    return per.withColumn("coverage", F.bround(100 * F.col("described") / F.col("total"), 1))


def word_counts(df: DataFrame, title: str, stopwords: list[str], limit: int | None = 300) -> DataFrame:
    """word, n over all titles, without stopwords, the most frequent first and alphabetical among equals."""
    stop = df.sparkSession.createDataFrame([(w,) for w in sorted(set(stopwords))], "word string")
    words = df.select(F.explode(title_words(F.col(title))).alias("word")).where(F.length("word") > 0)
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).join(stop, "word", "left_anti").orderBy(F.desc("n"), "word")
    return counted if limit is None else counted.limit(limit)


def top_by_group(df: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    """The first n rows of each group; `order` should be total."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("rank") <= n)


def top(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def final_order(relevant: Column, level: Column, date: Column, seq: Column) -> list[Column]:
    """Relevant rows first, then by level, the newest first, then in order."""
    ranks = F.create_map(*(F.lit(x) for kv in LEVEL_RANK.items() for x in kv))
    return [F.desc(relevant), F.desc(F.coalesce(F.try_element_at(ranks, level), F.lit(-1))), F.desc_nulls_last(date), seq.asc()]


def recent_best(df: DataFrame, age: Column, score: Column, seq: Column, days: float = 14, n: int = 15) -> DataFrame:
    """The best rows of an age of `days` or less, or of none."""
    return df.where(age.isNull() | (age <= days)).orderBy(F.desc(score), seq).limit(n)


def keep_newest(df: DataFrame, order: list[Column], n: int, by: str | None = None) -> DataFrame:
    """A cache cut to its newest n rows, or n for each value of `by`."""
    return df.orderBy(*order).limit(n) if by is None else top_by_group(df, by, order, n).drop("rank")


def shares(df: DataFrame, axis: str, name: str, n: str) -> DataFrame:
    """df with each class's share of its axis's total and its bar against the largest, in per cent."""
    w = Window.partitionBy(axis)
    return df.withColumns({"share": F.bround(100 * F.col(n) / F.sum(n).over(w), 1), "bar": F.bround(100 * F.col(n) / F.max(n).over(w), 1)})


def grouped_in_order(df: DataFrame, group: str, rank: Column, fields: list[str], seq: str, n: int = SECTION_ROWS) -> DataFrame:
    """group, n and the fields of its first rows by seq as an array, `n` rows at most, groups by rank."""
    firsts = top_by_group(df, group, [F.col(seq).asc()], n)
    counted = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.min(rank).alias("_rank"))
    rows = firsts.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(seq, *(f for f in fields if f != seq)))).alias("rows"))
    return counted.join(rows, group).orderBy("_rank", group).drop("_rank")


def audit(df: DataFrame, fields: dict[str, object]) -> DataFrame:
    """The fields with their defaults where they are missing or null."""
    return df.select(*((F.coalesce(F.col(c), F.lit(d)) if c in df.columns else F.lit(d)).alias(c) for c, d in fields.items()))


def select_rows(df: DataFrame, levels: list[str] | None = None, places: list[str] | None = None, words: str = "", in_columns: tuple[str, ...] = ("title", "summary")) -> DataFrame:
    """Rows of any of the levels, with any of the places, whose columns contain the words; empty choices pass all."""
    ok = F.lit(True)
    if levels:
        ok = ok & F.col("level").isin(levels)
    if places:
        ok = ok & F.arrays_overlap("geo", F.array(*map(F.lit, places)))
    if words.strip():
        ok = ok & F.contains(F.lower(F.concat_ws(" ", *(text(F.col(c)) for c in in_columns))), F.lit(words.strip().lower()))
    return df.where(ok)


#: Steps between the lengths that a pass over the bodies tries; each divides the one before.
_SUFFIX_STEPS = (256, 16, 1)


#: Groups whose bounds are broadcast; with more, rows of one group are dealt to so many tasks at least.
BROADCAST_GROUPS, _GROUP_PARTS = 50_000, 64


def _kept(state: DataFrame) -> DataFrame:
    """A row for each group, computed once: kept in the checkpoint folder, or by the executors of a session without one."""
    has = state.sparkSession.sparkContext._jsc.sc().getCheckpointDir().isDefined()
    return state.checkpoint() if has else state.localCheckpoint()


def _with_groups(rows: DataFrame, state: DataFrame) -> DataFrame:
    """rows (g, b) with their group's columns. Rows stay where they are, or are dealt by group and body, so that no task gets a whole group."""
    if state.count() <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(state), "g")
    parts = state.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(_GROUP_PARTS - 1))))
    return rows.withColumn("_part", F.pmod(F.xxhash64("b"), F.lit(_GROUP_PARTS)).cast("int")).join(parts, ["g", "_part"]).drop("_part")


def shared_suffix(df: DataFrame, group: str, body: str, least: int = SUFFIX_LEAST, most: int = SUFFIX_MOST) -> DataFrame:
    """group, suffix: the longest suffix that enough of a group's bodies share, from a word's start on.

    A suffix of n + 1 characters that m bodies share implies one of n, so each pass narrows the length down: it hashes every body's
    suffixes at sixteen lengths, and one aggregation over all groups finds the longest that enough bodies share. Enough are
    SUFFIX_ROWS and SUFFIX_SHARE of the rows; no suffix is longer than the group's shortest body.
    """
    rows = df.select(F.col(group).alias("g"), F.right(text(F.col(body)), F.lit(most)).alias("b"))
    bounds = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min(F.length("b")).alias("hi"))
    state = bounds.select("g", F.greatest(F.lit(SUFFIX_ROWS), F.floor(F.col("n") * SUFFIX_SHARE).cast("int")).alias("need"), F.lit(0).alias("lo"), "hi")
    for step in _SUFFIX_STEPS:
        state = _kept(state)
        lengths = F.filter(F.transform(F.sequence(F.lit(1), F.lit(-(-most // step) if step == _SUFFIX_STEPS[0] else 16)), lambda k: F.col("lo") + k * step), lambda n: n <= F.col("hi"))
        tried = _with_groups(rows, state).select("g", "need", F.explode(F.transform(lengths, lambda n: F.struct(n.alias("n"), F.md5(F.right("b", n)).alias("s")))).alias("x"))
        tried = tried.groupBy("g", "need", "x.n", "x.s").agg(F.count(F.lit(1)).alias("c"))
        longest = tried.where(F.col("c") >= F.col("need")).groupBy("g").agg(F.max("n").alias("found"))
        state = state.join(longest, "g", "left").select("g", "need", F.coalesce("found", "lo").alias("lo"), "hi")
    found = _with_groups(rows, _kept(state.where(F.col("lo") >= least))).groupBy("g", F.right("b", F.col("lo")).alias("s")).agg(F.count(F.lit(1)).alias("c"))
    best = found.groupBy("g").agg(F.max(F.struct("c", "s")).alias("x")).select(F.col("g").alias(group), cut_to_word(F.col("x.s")).alias("suffix"))
    return best.where(F.length("suffix") >= least)


class CorpusCollapse(RuntimeError):
    """The corpus is too small against the run before."""


def guard_size(count: int, previous: int, ratio: float = 0.5) -> None:
    if count < int(previous * ratio):
        raise CorpusCollapse(f"{count} rows, {previous} before")
