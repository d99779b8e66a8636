"""Runs: stretches of words that repeat with a period, by Kolpakov and Kucherov's algorithm.

A run has a smallest period q, at least LEAST words and TIMES * q, and no neighbouring word extends it.

1. In a run, each window of `gram_size` words stands once more, q words away. So words outside of all windows that repeat are
   in no run, and cut the text into parts of their own; what is left of them is cut again until nothing changes. Few words
   remain, and these are told apart exactly.
2. A part is factorised: a factor is the longest prefix of the rest that begins earlier too, as a suffix automaton with the
   first place of each state tells.
3. Main's algorithm finds the runs that touch a factor's border, from the longest common extensions for each period to the left
   and right of it. Such a run reaches back over the factor before by less than its period, so windows are short.
4. Other runs lie within a factor, and are copied from its earlier occurrence.

Time and memory are linear in a text's words; texts are handled where they lie, without a shuffle.
"""

from __future__ import annotations

from array import array
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import documents, fresh, prepare, task
from ._words import chunks, grams, raw, spans, word_hashes

LEAST, TIMES = 24, 3


class Automaton:
    """A suffix automaton: states with one transition keep it in arrays, only those that branch have a dictionary."""

    def __init__(self, seq: list[int]):
        self.length, self.link, self.first = array("i", [0]), array("i", [-1]), array("i", [-1])
        self.word, self.to, self.more = array("i", [-1]), array("i", [-1]), {}
        last = 0
        for i, c in enumerate(seq):
            last = self._extend(last, c, i)

    def step(self, state: int, word: int) -> int:
        """The state after a word, -1 if there is none."""
        if self.word[state] == word:
            return self.to[state]
        found = self.more.get(state)
        return found.get(word, -1) if found else -1

    def _set(self, state: int, word: int, to: int) -> None:
        if self.word[state] in (-1, word):
            self.word[state], self.to[state] = word, to
        else:
            self.more.setdefault(state, {})[word] = to

    def _add(self, length: int, link: int, first: int, word: int = -1, to: int = -1) -> int:
        for column, value in ((self.length, length), (self.link, link), (self.first, first), (self.word, word), (self.to, to)):
            column.append(value)
        return len(self.length) - 1

    def _extend(self, last: int, c: int, i: int) -> int:
        now, p, q = self._add(self.length[last] + 1, 0, i), last, -1
        while p != -1:
            q = self.step(p, c)
            if q != -1:
                break
            self._set(p, c, now)
            p = self.link[p]
        if p == -1:
            return now
        if self.length[p] + 1 == self.length[q]:
            self.link[now] = q
            return now
        clone = self._add(self.length[p] + 1, self.link[q], self.first[q], self.word[q], self.to[q])
        if q in self.more:
            self.more[clone] = dict(self.more[q])
        while p != -1 and self.step(p, c) == q:
            self._set(p, c, clone)
            p = self.link[p]
        self.link[q] = self.link[now] = clone
        return now


def factorise(seq: list[int]) -> list[tuple[int, int, int]]:
    """(start, end, the earlier start or -1 for a new word) of each factor; occurrences may overlap."""
    auto, out, i, n = Automaton(seq), [], 0, len(seq)
    while i < n:
        state, size, earlier = 0, 0, -1
        while i + size < n:
            state = auto.step(state, seq[i + size])
            if state == -1 or auto.first[state] - size >= i:
                break
            earlier = auto.first[state] - size
            size += 1
        out.append((i, i + max(size, 1), earlier))
        i += max(size, 1)
    return out


def common_prefixes(x: list[int]) -> list[int]:
    """Of each place, how much of x stands there again (its Z function)."""
    n = len(x)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and x[k] == x[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def touching(seq: list[int], a: int, b: int, e: int, least: int, times: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, period) of the runs that touch the border b of the factors [a, b) and [b, e) and end by e."""
    if (e - a) * times < least * (times - 1):  # what touches b and ends by e is shorter
        return
    most = (e - a) // (times - 1)
    lo, hi = max(0, a - most - 1), min(len(seq), e + 1)
    left, right = seq[lo:b], seq[b:hi]
    m, r = len(left), len(right)
    ahead = common_prefixes([*right, -1, *left, *right])  # from r + 1 on: how far `right` stands at each place of the window
    back = common_prefixes([*left[::-1], -1, *right[::-1], *left[::-1]])
    for p in range(1, most + 1):
        need = max(least, times * p)
        if p <= r:
            after, before = (ahead[r + 1 + m + p] if p < r else 0), back[m + 1 + r - p]
            start, end = b - before, b + p + after
            if end - start >= need and end <= e and (start > lo or not lo):
                yield start, end, p
        if p <= m:
            after, before = ahead[r + 1 + m - p], (back[m + 1 + r + p] if p < m else 0)
            start, end = b - p - before, b + after
            if end - start >= need and end <= e and (start > lo or not lo):
                yield start, end, p


def runs(seq: list[int], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and then period."""
    found: dict[tuple[int, int], int] = {}
    starts: list[int] = []
    ends: dict[int, list[int]] = {}

    def add(start: int, end: int, period: int) -> None:
        if (start, end) not in found:
            if start not in ends:
                insort(starts, start)
            ends.setdefault(start, []).append(end)
            found[start, end] = period
        found[start, end] = min(found[start, end], period)

    factors = factorise(seq)
    for k, (b, e, earlier) in enumerate([*factors, (len(seq), len(seq), -1)]):
        for run in touching(seq, factors[k - 1][0] if k else 0, b, e, least, times):
            add(*run)
        if earlier < 0 or e - b < least:
            continue
        at = bisect_right(starts, earlier)
        while at < len(starts) and starts[at] < earlier + e - b - 1:
            start = starts[at]
            for end in list(ends[start]):
                if end < earlier + e - b:
                    add(start + b - earlier, end + b - earlier, found[start, end])
            at += 1
    return sorted((s, e - s, p) for (s, e), p in found.items())


def gram_size(least: int = LEAST, times: int = TIMES) -> int:
    return -(-least * (times - 1) // times)


def repetitive(words: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int]]:
    """The stretches (start, end) of hashed words that hold all runs: each of their words is in a window that stands there again."""
    size, open_, out = gram_size(least, times), [(0, len(words))], []
    while open_:
        b, e = open_.pop()
        if e - b < least:
            continue
        windows = grams(words[b:e], size)
        ranked = np.sort(windows)
        again = ranked[1:][ranked[1:] == ranked[:-1]]
        if not len(again):
            continue
        hit = np.isin(windows, again)
        cover = np.zeros(e - b + 1, np.int64)
        cover[:-size] += hit
        cover[size:] -= hit
        inside = np.concatenate(([0], np.cumsum(cover[:-1]) > 0, [0])).astype(np.int8)
        edges = np.diff(inside)
        parts = list(zip((np.flatnonzero(edges == 1) + b).tolist(), (np.flatnonzero(edges == -1) + b).tolist()))
        if parts == [(b, e)]:
            out.append((b, e))
        else:
            open_ += parts
    return sorted(out)


def text_runs(text: bytes | memoryview, starts: np.ndarray, ends: np.ndarray, words: np.ndarray, least: int, times: int) -> list[tuple[int, int, int]]:
    """Runs of a text whose words have these bounds and hashes."""
    out = []
    for b, e in repetitive(words, least, times):
        names: dict[bytes, int] = {}
        seq = [names.setdefault(bytes(text[s:t]), len(names)) for s, t in zip(starts[b:e].tolist(), ends[b:e].tolist())]
        out += [(b + s, n, p) for s, n, p in runs(seq, least, times)]
    return out


def kept_text(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, stays: np.ndarray) -> bytes:
    """The words that stay, joined by one space."""
    if not stays.any():
        return b""
    mask = np.zeros(len(data) + 1, np.int8)
    np.add.at(mask, starts[stays], 1)
    np.add.at(mask, ends[stays], -1)
    taken = np.cumsum(mask[:-1], dtype=np.int8).astype(bool)
    spaces = ends[stays][:-1]
    out = data.copy()
    out[spaces] = 32
    taken[spaces] = True
    return out[taken].tobytes()


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _collapse(batches: Iterator[pa.RecordBatch], least: int, times: int) -> Iterator[pa.RecordBatch]:
    """The text (the first column) of each row becomes its number of words, its runs and its collapsed text."""
    for batch in chunks(batches, text=0):
        data, bounds = raw(batch.column(0))
        starts, ends, first = spans(data, bounds)
        words = word_hashes(data, starts, ends)[0]
        found, texts = [], []
        for k in range(batch.num_rows):
            b, e, at = int(first[k]), int(first[k + 1]), int(bounds[k])
            own = data[at : int(bounds[k + 1])]
            s, t = starts[b:e] - at, ends[b:e] - at
            mine = text_runs(own, s, t, words[b:e], least, times)
            stays = np.ones(e - b, bool)
            for start, length, period in mine:
                stays[start + period : start + length] = False
            found.append([{"start": x, "length": y, "period": z} for x, y, z in mine])
            texts.append(kept_text(own, s, t, stays).decode())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[1:], pa.array(np.diff(first).astype(np.int64)), pa.array(found, pa.list_(_RUN)), pa.array(texts, pa.string())],
            names=[*batch.schema.names[1:], "n_words", "runs", "collapsed"],
        )


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """Row by row: the id, n_words, runs (an array of start, length, period, by start and then period) and the collapsed text.

    In the collapsed text, a word is gone if any run contains it after that run's first `period` words; the others are joined
    by one space. A null or wordless text has no words, no runs and an empty collapsed text. Rows are treated one by one,
    repeated ids and texts too; texts may have any length; other columns are ignored, whatever their names; an empty table
    gives no rows.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{id_col}`").alias("id"))
    kind = rows.schema["id"].dataType.simpleString()
    done = rows.mapInArrow(task("runs", lambda x: _collapse(x, least, times)), f"id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    return done.withColumnRenamed("id", id_col)


def with_periods(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the text of every tenth document, by the crc32 of its id, made periodic from some word on.

    With h the crc32 and g = floor(h / 10), each word i >= a becomes word a + (i - a) % p, for a = g % n and
    p = 1 + floor((n - a) / (3 + g % 8)), where n is the number of words. Null ids, and texts without words, are left.
    """
    names = fresh(docs.columns, "_h", "_words", "_n", "_a", "_p")
    h, words, n, a, p = (F.col(f"`{c}`") for c in names)
    g = F.floor(h / 10)
    out = docs.withColumn(names[0], F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")))
    out = out.withColumn(names[1], F.when(h % 10 == 0, F.regexp_extract_all(F.col(f"`{text_col}`").cast("string"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))))
    out = out.withColumn(names[2], F.size(words)).withColumn(names[3], F.when(n > 0, (g % n).cast("int")))
    out = out.withColumn(names[4], F.when(n > 0, (1 + F.floor((n - a) / (3 + g % 8))).cast("int")))
    changed = F.array_join(F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, a + (i - a) % p))), " ")
    return out.withColumn(text_col, F.when(n > 0, changed).otherwise(F.col(f"`{text_col}`"))).drop(*names)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collapse_runs(with_periods(documents(spark, sf_dir).select("doc_id", "text")))
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    better = lambda kept, run: F.when(kept.isNull() | (run["length"] * kept["period"] > kept["length"] * run["period"]), run).otherwise(kept)
    line = lambda run: F.concat(F.concat_ws(",", run["start"].cast("string"), run["length"].cast("string"), run["period"].cast("string")), F.lit("\n"))
    return found.withColumn("best", F.aggregate("runs", none, better)).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
