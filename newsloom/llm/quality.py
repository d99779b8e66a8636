"""Quality by a support vector machine on naive Bayes features.

A text's n-grams are indicators: shapes of one to four characters (letters and digits by kind, other signs as
themselves), words, pairs of words, and pairs of equal words. Each is scaled by its log-count ratio between the classes,
each row by the root of its n-grams, and dual coordinate descent fits a linear hinge-loss model. A logistic curve, fitted
on a fifth of the sample that the model has not seen, turns margins into scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import Staged, documents, prepare, task, with_unique
from ._words import CHUNK_BYTES, chunks, mix, raw, spans, word_hashes

#: The model learns from at most SAMPLE labelled texts of each class, the least by hash, of any length, as far as their n-grams
#: take SAMPLE_BYTES over all classes.
SAMPLE, SAMPLE_BYTES = 1500, 1 << 27
WORD_BITS = 18
COST, EPOCHS = 1.0, 12
SMOOTHING = 1.0
PREDICT_AT = 0.7

# Kinds of bytes: space, line end, lower, upper, digit, letters beyond ASCII, and the signs, some by themselves.
_KIND = np.full(256, 6, np.uint8)
_KIND[[32, 9]], _KIND[[10, 11, 12, 13]] = 0, 1
_KIND[ord("a") : ord("z") + 1], _KIND[ord("A") : ord("Z") + 1], _KIND[ord("0") : ord("9") + 1] = 2, 3, 4
_KIND[128:] = 5
for _k, _own in enumerate((".,;:", "!?", "'\"-", "|", "#", "$%", "&*", "<>", "/\\")):
    _KIND[[ord(c) for c in _own]] = 7 + _k
SHAPES = 16 + 16**2 + 16**3 + 16**4
SIZE = SHAPES + 1 + (1 << WORD_BITS)


def features(batch: pa.RecordBatch, text: int) -> Iterator[np.ndarray]:
    """Of each text, the numbers of its n-grams, once each."""
    data, bounds = raw(batch.column(text))
    starts, ends, first = spans(data, bounds)
    words = word_hashes(data, starts, ends)[0]
    seen = np.zeros(SHAPES, bool)
    shift = np.uint64(64 - WORD_BITS)
    for k in range(batch.num_rows):
        for b in range(bounds[k], bounds[k + 1], CHUNK_BYTES):  # with the three bytes that n-grams reach into the next piece
            own = _KIND[data[b : min(b + CHUNK_BYTES + 3, bounds[k + 1])]].astype(np.int64)
            code, base = own, 0
            for n in range(1, 5):
                if len(own) < n:
                    break
                code = own if n == 1 else code[:-1] * 16 + own[n - 1 :]
                seen[code + base] = True
                base += 16**n
        shapes = np.flatnonzero(seen)
        seen[shapes] = False
        w = words[first[k] : first[k + 1]]
        pairs = mix(w[:-1] * np.uint64(0x9E3779B97F4A7C15) + w[1:])
        named = np.unique(np.concatenate([w >> shift, pairs >> shift]).astype(np.int64)) + SHAPES + 1
        same = [SHAPES] if len(w) > 1 and np.any(w[1:] == w[:-1]) else []
        yield np.concatenate([shapes, np.array(same, np.int64), named]).astype(np.int32)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, own: np.ndarray) -> float:
        return float(self.weights[own].sum() / np.sqrt(max(1, len(own))) + self.bias)

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -500, 500)))


def fit(rows: list[np.ndarray], labels: np.ndarray, seed: int = 1) -> Model:
    """Labels are 0 and 1. Without rows of both classes, every score is the share of label 1 (a half, if no rows)."""
    if not len(labels) or labels.min() == labels.max():
        share = labels.mean() if len(labels) else 0.5
        return Model(np.zeros(SIZE, np.float32), 0.0, 0.0, float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    held, used = order[: len(order) // 5], order[len(order) // 5 :]
    if len(set(labels[used])) < 2 or len(set(labels[held])) < 2:
        held = used = order
    counts = np.full((2, SIZE), SMOOTHING)
    for i in used:
        counts[labels[i]][rows[i]] += 1
    n = np.array([max(1, (labels[used] == c).sum()) for c in (0, 1)]) + 2 * SMOOTHING
    ratio = np.log(counts[1] / n[1]) - np.log(counts[0] / n[0])
    # Dual coordinate descent for the hinge loss; the bias is one more feature of value 1.
    y = np.where(labels == 1, 1.0, -1.0)
    values = [ratio[r] / np.sqrt(max(1, len(r))) for r in rows]
    square = np.array([v @ v + 1 for v in values])
    share = np.array([(labels[used] == c).mean() for c in (0, 1)])
    bound = COST * 0.5 / share[labels]  # classes weigh alike
    w, bias, alpha = np.zeros(SIZE), 0.0, np.zeros(len(rows))
    for _ in range(EPOCHS):
        for i in rng.permutation(used):
            gradient = y[i] * (w[rows[i]] @ values[i] + bias) - 1
            after = min(max(alpha[i] - gradient / square[i], 0.0), bound[i])
            if after != alpha[i]:
                w[rows[i]] += (after - alpha[i]) * y[i] * values[i]
                bias += (after - alpha[i]) * y[i]
                alpha[i] = after
    model = Model((w * ratio).astype(np.float32), bias, 1.0, 0.0)
    m = np.array([model.margin(rows[i]) for i in held])
    t = labels[held].astype(float)
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps of a logistic fit, a little regularised
        p = 1 / (1 + np.exp(-np.clip(a * m + b, -30, 30)))
        g = np.array([((p - t) * m).sum() + 1e-2 * a, (p - t).sum() + 1e-2 * b])
        v = p * (1 - p)
        h = np.array([[(v * m * m).sum() + 1e-2, (v * m).sum()], [(v * m).sum(), v.sum() + 1e-2]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
    model.slope, model.offset = max(float(a), 1e-3), float(b)
    return model


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f.tobytes() for f in features(batch, 1)], pa.binary())], names=["label", "f"])


def remainder(doc_id, n: int):
    """crc32 of the id as text, mod n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def sampled(rows: DataFrame, label: str, h, per: int) -> DataFrame:
    """The rows whose hash h is least in their label, with the hash as _h in [0, 1): of each label about `per` hashes or some
    more, up to a fifth and four standard deviations.

    A label's share follows from an estimate of its number of hashes, so no rows of a label have to meet.
    """
    rows = rows.withColumn("_h", F.pmod(h, F.lit(1 << 30)) / F.lit(float(1 << 30)))
    counts = Staged(rows.groupBy(label).agg(F.count(F.lit(1)).alias("_held"), F.approx_count_distinct("_h", 0.03).alias("_kinds")), "labels")
    total = counts.df.agg(F.coalesce(F.sum("_held"), F.lit(0))).first()[0]
    return with_unique(rows, counts, [label], "_held", total).where(F.col("_h") * F.col("_kinds") < 1.2 * per + 4 * per**0.5).drop("_held", "_kinds")


def bounded(found: Staged, label: str, h: str, value: str, per: int, most: int) -> list:
    """The rows of a small staged sample of least hash: `per` of each label, and `most` bytes of `value` over all labels, though one of each label at least.

    The driver gets labels, hashes and sizes, and then the rows that these choose.
    """
    by_label: dict = {}
    for r in sorted(found.df.select(label, h, F.octet_length(value).alias("size")).collect(), key=lambda r: (r[0], r[1])):
        by_label.setdefault(r[0], []).append((r[1], r[2]))
    last = []
    for name, own in by_label.items():
        total, take = 0, 0
        while take < min(per, len(own)) and (not take or total + own[take][1] <= most // len(by_label)):
            total += own[take][1]
            take += 1
        last.append((name, own[take - 1][0]))
    if not last:
        return []
    limits = found.spark.createDataFrame(last, found.df.select(label, F.col(h).alias("_last")).schema)
    rows = found.df.join(F.broadcast(limits), label).where(F.col(h) <= F.col("_last")).drop("_last")
    taken: dict = {}
    for r in sorted(rows.collect(), key=lambda r: (r[label], r[h], r[value])):
        taken.setdefault(r[label], []).append(r)
    return [r for own in taken.values() for r in own[:per]]


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Fits a model on a bounded sample (SAMPLE, SAMPLE_BYTES) of labelled texts; labels other than 0 and 1, and without a document, do not count.

    Labels and texts meet by id. Equal texts of one label count once, whatever their number; null texts count as empty. Texts of
    any length are learned from as a whole.
    """
    prepare(docs.sparkSession)
    named = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label")).where("label IN (0, 1) AND id IS NOT NULL").distinct()
    ids = sampled(named, "label", F.xxhash64("id"), SAMPLE)  # 2 * SAMPLE rows or some more
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(ids), "id").select("label", "text").distinct()
    found = Staged(found.mapInArrow(task("quality", _features), "label int, f binary").withColumn("h", F.crc32("f")), "quality-sample")
    own = bounded(found, "label", "h", "f", SAMPLE, SAMPLE_BYTES)
    found.drop()
    return fit([np.frombuffer(r.f, np.int32) for r in own], np.array([r.label for r in own], int))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every row. Null counts as the empty text, which has a score too; equal texts have equal scores.

    Null and repeated ids keep a row each. Other columns are ignored, whatever their names; texts may have any length; an
    empty table gives no rows.
    """
    prepare(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in chunks(batches):
            margins = np.array([own.margin(f) for f in features(batch, 1)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own.score(margins))], names=["doc_id", "score"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("t"))
    return rows.mapInArrow(task("quality", run), "doc_id long, score double")


def op2_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(remainder(F.col("doc_id"), 4) != 2)
    found = score(docs, learn(docs, labels))
    return found.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score", (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"))
