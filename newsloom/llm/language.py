"""Language of each word by a linear-chain conditional random field, and of a text from its words.

A word's features are its byte n-grams with marks at both ends (those at a mark are its affixes) and its place in a
learned lexicon of each language's frequent words. Transitions between languages are learned from sequences that
splice spans of texts of different languages. Forward-backward over a whole text gives each word's chances; blocks of
words are chained by their transfer matrices, so that numpy runs over all texts of a batch at once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import Staged, documents, prepare, task
from ._words import chunks, mix
from .quality import bounded, remainder, sampled

#: The model learns from at most SAMPLE texts of each language, the least by hash, as far as they take SAMPLE_TOTAL bytes over all
#: languages. A text of over SAMPLE_BYTES bytes is learned from in PIECES pieces, evenly spread from its start to its end.
SAMPLE, SAMPLE_BYTES, SAMPLE_TOTAL, PIECES = 300, 1 << 16, 1 << 26, 16
#: The languages of most rows are learned, so many at most; texts with rarer labels are not learned from.
LANGUAGES = 64
FEATURE_BITS = 17
LEXICON = 400
SEQUENCES, SEQUENCE_WORDS, SPAN_WORDS = 2400, 40, (3, 25)
EPOCHS, BATCH, RATE, DECAY = 6, 100, 0.3, 1e-5
BLOCK = 32
#: Words whose chances are computed at once. A longer text is labelled in stretches of that many, which hand their messages on.
STRETCH = 1 << 17
#: Distinct words whose emissions a worker keeps at most.
CACHE_WORDS = 300_000
UNKNOWN = "und"
_BEGIN, _END = 2, 3  # control bytes as marks


def _has_letter(word: str) -> bool:
    return word.isalpha() or any(c.isalpha() for c in word)


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all words in a row, and each word's first."""
    data = np.frombuffer(("\x02" + "\x03\x02".join(words) + "\x03").encode("utf-8", "replace"), np.uint8)
    word = np.cumsum(data == _BEGIN) - 1
    ends = data == _END
    numbers, owners = [], []
    h = data.astype(np.uint64) + np.uint64(1)
    inside = np.ones(len(data), bool)
    for n in range(2, 5):
        if len(data) < n:
            break
        h = h[:-1] * np.uint64(0x100000001B3) + data[n - 1 :].astype(np.uint64)
        inside = inside[:-1] & ~ends[n - 2 : len(data) - 1]
        numbers.append((mix(h[inside] + np.uint64(n)) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64))
        owners.append(word[: len(h)][inside])
    numbers, owners = np.concatenate(numbers), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return numbers[order], np.searchsorted(owners[order], np.arange(len(words)))


@dataclass
class Crf:
    """Labels, n-gram weights (2**FEATURE_BITS, labels), the lexicon's words with their weights, and transitions."""

    labels: list[str]
    weights: np.ndarray
    lexicon: dict[str, np.ndarray]
    transition: np.ndarray
    start: np.ndarray
    _known: dict[str, int] = field(default_factory=dict)
    _table: list[np.ndarray] = field(default_factory=list)

    def __getstate__(self):
        return self.labels, self.weights, self.lexicon, self.transition, self.start

    def __setstate__(self, state):
        self.labels, self.weights, self.lexicon, self.transition, self.start = state
        self._known, self._table = {}, []

    def emissions(self, words: list[str]) -> np.ndarray:
        numbers, first = word_features(words)
        out = np.add.reduceat(self.weights[numbers], first, axis=0)
        for k, w in enumerate(words):
            if (own := self.lexicon.get(w)) is not None:
                out[k] += own
        return out

    def look_up(self, texts: list[list[str]]) -> tuple[list[np.ndarray], np.ndarray]:
        """Of each text, the rows of its words with a letter in the table of emissions that comes with them."""
        known = self._known
        if len(known) > CACHE_WORDS:
            known.clear()
            self._table.clear()
        new = list({w for words in texts for w in words}.difference(known))
        lettered = [w for w in new if _has_letter(w)]
        known.update(dict.fromkeys(new, -1))
        at = sum(map(len, self._table))
        if lettered:
            self._table.append(self.emissions(lettered).astype(np.float32))
            known.update(zip(lettered, range(at, at + len(lettered))))
            if len(self._table) > 50:
                self._table[:] = [np.concatenate(self._table)]
        table = np.concatenate(self._table) if self._table else np.zeros((0, len(self.labels)), np.float32)
        rows = [np.fromiter(map(known.__getitem__, words), np.int64, len(words)) for words in texts]
        return [r[r >= 0] for r in rows], table

    def _blocked(self, texts: list[np.ndarray], table: np.ndarray) -> tuple:
        """Texts in blocks of words, and each block's transfer matrix."""
        k = len(self.labels)
        size = np.array([len(t) for t in texts])
        blocks = -(-size // BLOCK)
        first = np.concatenate(([0], np.cumsum(blocks)))
        total = int(first[-1])
        rows = np.full(total * BLOCK, -1)
        place = np.concatenate([first[d] * BLOCK + np.arange(n) for d, n in enumerate(size)])
        rows[place] = np.concatenate(texts)
        real = (rows >= 0).reshape(total, BLOCK)
        e = table[rows.reshape(total, BLOCK)].astype(np.float64)
        e = np.exp(np.maximum(e - e.max(axis=2, keepdims=True), -60))
        step = np.exp(self.transition - self.transition.max())
        transfer = np.broadcast_to(np.eye(k), (total, k, k)).copy()
        for t in range(BLOCK):
            after = (transfer.reshape(-1, k) @ step).reshape(total, k, k) * e[:, t, None, :]
            after /= after.max(axis=(1, 2), keepdims=True)
            transfer = np.where(real[:, t, None, None], after, transfer)
        return blocks, first, place, real, e, step, transfer

    def _into(self) -> np.ndarray:
        """What comes into a text's first word. The first step too passes `step`: this times step is the wanted prior."""
        step = np.exp(self.transition - self.transition.max())
        return np.exp(self.start - self.start.max()) @ np.linalg.pinv(step)

    def _long(self, text: np.ndarray, table: np.ndarray) -> np.ndarray:
        """The chances in a text of any length: stretches hand on what comes into them from before and from behind."""
        pieces = [text[b : b + STRETCH] for b in range(0, len(text), STRETCH)]
        passed = []
        for piece in pieces:
            through = np.eye(len(self.labels))
            for own in self._blocked([piece], table)[-1]:
                through = through @ own
                through /= through.max()
            passed.append(through)
        into, behind = [self._into()], [np.ones(len(self.labels))]
        for through in passed[:-1]:
            x = into[-1] @ through
            into.append(x / np.abs(x).max())
        for through in passed[:0:-1]:
            x = through @ behind[-1]
            behind.append(x / x.max())
        return np.concatenate([self.posteriors([p], table, x, y) for p, x, y in zip(pieces, into, behind[::-1])])

    def posteriors(self, texts: list[np.ndarray], table: np.ndarray, before: np.ndarray | None = None, after_all: np.ndarray | None = None) -> np.ndarray:
        """Each word's chances of each label, all texts in a row, by forward-backward within each text.

        What comes into the texts from before and from behind is a text's beginning and end, if it isn't told.
        """
        k = len(self.labels)
        if not sum(map(len, texts)):
            return np.zeros((0, k))
        blocks, first, place, real, e, step, transfer = self._blocked(texts, table)
        total = int(first[-1])
        # Along each text: what comes into its blocks from before and from behind.
        into, behind = np.empty((total, k)), np.ones((total, k))
        if after_all is not None:
            behind[first[1:][blocks > 0] - 1] = after_all
        start = self._into() if before is None else before
        for j in range(int(blocks.max())):
            own = np.flatnonzero(blocks > j)
            at = first[own] + j
            if j:
                x = np.einsum("bi,bij->bj", into[at - 1], transfer[at - 1])
                into[at] = x / np.abs(x).max(axis=1, keepdims=True)
            else:
                into[at] = start
        for j in range(int(blocks.max()) - 2, -1, -1):
            own = np.flatnonzero(blocks > j + 1)
            at = first[own] + j
            x = np.einsum("bij,bj->bi", transfer[at + 1], behind[at + 1])
            behind[at] = x / x.max(axis=1, keepdims=True)
        forward = np.empty((total, BLOCK, k))
        x = into
        for t in range(BLOCK):
            after = (x @ step) * e[:, t]
            after = np.maximum(after, 0)
            after /= np.maximum(after.max(axis=1, keepdims=True), 1e-300)
            x = np.where(real[:, t, None], after, x)
            forward[:, t] = x
        x = behind
        for t in range(BLOCK - 1, -1, -1):
            forward[:, t] *= x
            before = (e[:, t] * x) @ step.T
            before /= before.max(axis=1, keepdims=True)
            x = np.where(real[:, t, None], before, x)
        found = forward.reshape(-1, k)[place]
        return found / np.maximum(found.sum(axis=1, keepdims=True), 1e-300)

    def label(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Of each text, its lettered words' chances of each label; no words if no label was learned."""
        if not self.labels:
            return iter([np.zeros((0, 1))] * len(texts))
        return self._labelled(texts)

    def _labelled(self, texts: list[str]) -> Iterator[np.ndarray]:
        rows, table = self.look_up([t.lower().split() for t in texts])
        waiting: list[np.ndarray] = []
        for k, own in enumerate(rows):
            waiting.append(own)
            if k + 1 == len(rows) or sum(map(len, waiting)) + len(rows[k + 1]) > STRETCH:  # a long text waits alone
                found = self._long(own, table) if len(own) > STRETCH else self.posteriors(waiting, table)
                at = np.cumsum([0, *map(len, waiting)])
                yield from (found[b:e] for b, e in zip(at[:-1], at[1:]))
                waiting = []


def fit(texts: list[tuple[str, str]], seed: int = 1) -> Crf:
    """texts: (label, text). With one label or none the model gives that label, or nothing, to every word."""
    rng = np.random.default_rng(seed)
    labels = sorted({lang for lang, _ in texts})
    k = len(labels)
    words: list[list[list[str]]] = [[] for _ in labels]
    for lang, text in texts:
        if own := [w for w in text.lower().split() if _has_letter(w)]:
            words[labels.index(lang)].append(own)
    frequent = [[w for w, _ in Counter(w for own in docs for w in own).most_common(LEXICON)] for docs in words]
    lexicon = sorted({w for own in frequent for w in own})
    number = {w: 1 + j for j, w in enumerate(lexicon)}
    model = Crf(labels, np.zeros((1 << FEATURE_BITS, max(1, k)), np.float32), {}, np.zeros((max(1, k),) * 2), np.zeros(max(1, k)))
    usable = [j for j in range(k) if words[j]]
    if len(usable) < 2:
        return model
    spliced, truth = [], np.empty((SEQUENCES, SEQUENCE_WORDS), np.int64)
    for s in range(SEQUENCES):
        own: list[str] = []
        mixed = rng.random() < 0.5
        j = int(rng.choice(usable))
        while len(own) < SEQUENCE_WORDS:
            if mixed:
                j = int(rng.choice(usable))
            doc = words[j][rng.integers(len(words[j]))]
            n = min(int(rng.integers(*SPAN_WORDS)) if mixed else SEQUENCE_WORDS, SEQUENCE_WORDS - len(own))
            b = int(rng.integers(max(1, len(doc) - n + 1)))
            part = doc[b : b + n]
            truth[s, len(own) : len(own) + len(part)] = j
            own += part
        spliced.append(own)
    kinds = sorted({w for own in spliced for w in own})
    numbers, first = word_features(kinds)
    bounds = np.append(first, len(numbers))
    at = {w: i for i, w in enumerate(kinds)}
    rows = np.array([[at[w] for w in own] for own in spliced])
    lex = np.array([number.get(w, 0) for w in kinds])
    weights, lex_weights = np.zeros((1 << FEATURE_BITS, k)), np.zeros((len(lexicon) + 1, k))
    transition, start = np.zeros((k, k)), np.zeros(k)
    squares = [np.full_like(x, 1e-6) for x in (weights, lex_weights, transition, start)]

    def update(x: np.ndarray, gradient: np.ndarray, which: int, own=slice(None)) -> None:
        squares[which][own] += gradient**2
        x[own] -= RATE * (gradient + DECAY * x[own]) / np.sqrt(squares[which][own])

    for _ in range(EPOCHS):
        order = rng.permutation(SEQUENCES)
        for b in range(0, SEQUENCES, BATCH):
            own = order[b : b + BATCH]
            used, back = np.unique(rows[own], return_inverse=True)
            back = back.reshape(len(own), SEQUENCE_WORDS)
            size = bounds[used + 1] - bounds[used]
            flat = numbers[np.repeat(bounds[used] - np.cumsum(size) + size, size) + np.arange(size.sum())]
            holder = np.repeat(np.arange(len(used)), size)
            table = np.add.reduceat(weights[flat], np.cumsum(size) - size, axis=0) + lex_weights[lex[used]] * (lex[used] > 0)[:, None]
            e = table[back]
            e = np.exp(e - e.max(axis=2, keepdims=True))
            step = np.exp(transition - transition.max())
            f, g = np.empty_like(e), np.empty_like(e)
            x = np.exp(start - start.max()) * e[:, 0]
            for t in range(SEQUENCE_WORDS):
                if t:
                    x = (x @ step) * e[:, t]
                x = x / x.sum(axis=1, keepdims=True)
                f[:, t] = x
            x = np.ones_like(x)
            for t in range(SEQUENCE_WORDS - 1, -1, -1):
                g[:, t] = x
                x = (e[:, t] * x) @ step.T
                x = x / x.sum(axis=1, keepdims=True)
            p = f * g
            p /= p.sum(axis=2, keepdims=True)
            wrong = p.copy()
            y = truth[own]
            wrong[np.arange(len(own))[:, None], np.arange(SEQUENCE_WORDS)[None, :], y] -= 1
            pair = np.einsum("btk,kl,btl->btkl", f[:, :-1], step, e[:, 1:] * g[:, 1:])
            pair /= pair.sum(axis=(2, 3), keepdims=True)
            moved = pair.sum(axis=(0, 1))
            np.add.at(moved, (y[:, :-1].ravel(), y[:, 1:].ravel()), -1)
            by_word = np.zeros((len(used), k))
            np.add.at(by_word, back.ravel(), wrong.reshape(-1, k))
            touched, name = np.unique(flat, return_inverse=True)
            gradient = np.zeros((len(touched), k))
            np.add.at(gradient, name, by_word[holder])
            update(weights, gradient / len(own), 0, touched)
            in_lexicon = np.flatnonzero(lex[used])
            update(lex_weights, by_word[in_lexicon] / len(own), 1, lex[used[in_lexicon]])
            update(transition, moved / len(own), 2)
            update(start, wrong[:, 0].sum(axis=0) / len(own), 3)
    model.weights, model.transition, model.start = weights.astype(np.float32), transition, start
    model.lexicon = {w: lex_weights[j].astype(np.float32) for w, j in number.items()}
    return model


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> Crf:
    """Fits a model on a bounded sample (SAMPLE, SAMPLE_TOTAL) of the texts with one of the LANGUAGES most frequent labels.

    Null texts and labels do not count, and rarer labels are never predicted.

    Equal texts of one label count once, whatever their number and ids. An empty table gives a model without labels.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(f"`{label_col}`").cast("string").alias("label"), F.col(f"`{text_col}`").cast("string").alias("text")).where("label IS NOT NULL AND text IS NOT NULL")
    known = [r.label for r in rows.groupBy("label").count().orderBy(F.desc("count"), "label").limit(LANGUAGES).collect()]
    size = SAMPLE_BYTES // (4 * PIECES)  # characters, of four bytes at most
    piece = lambda k: F.substring("text", (1 + F.floor(k * (F.length("text") - size) / (PIECES - 1))).cast("int"), F.lit(size))
    spread = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(PIECES - 1)), piece), " ")
    rows = rows.where(F.col("label").isin(known)).withColumn("h", F.xxhash64("text"))
    rows = rows.withColumn("text", F.when(F.octet_length("text") > SAMPLE_BYTES, spread).otherwise(F.col("text")))
    found = Staged(sampled(rows, "label", F.col("h"), SAMPLE).drop("h").distinct(), "language-sample")  # SAMPLE rows of each language or some more
    own = bounded(found, "label", "_h", "text", SAMPLE, SAMPLE_TOTAL)
    found.drop()
    return fit([(r.label, r.text) for r in own])


_NAMED = "doc_id long, lang_pred string, score double, switches long"


def identify(docs: DataFrame, model: Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score and switches: the label with most of the words' chances, its share of them, and how
    often the likeliest label changes from word to word.

    A text that is null or has no letter is `und` with score 0; so is any text if no label was learned. Of labels with equal
    shares the first by name holds. Null and repeated ids keep a row each. Other columns are ignored, whatever their names; texts may
    have any length (STRETCH); an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in chunks(batches):
            names, scores, switches = [], [], []
            for p in own.label([t or "" for t in batch.column(1).to_pylist()]):
                share = p.mean(axis=0) if len(p) else None
                best = p.argmax(axis=1)
                names.append(own.labels[int(share.argmax())] if len(p) else UNKNOWN)
                scores.append(min(1.0, float(share.max())) if len(p) else 0.0)
                switches.append(int((best[1:] != best[:-1]).sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(switches, pa.int64())], names=["doc_id", "lang_pred", "score", "switches"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("t"))
    return rows.mapInArrow(task("language", run), _NAMED)


def accept(docs: DataFrame, model: Crf, least: float, text_col: str = "text") -> DataFrame:
    """The rows of docs, as they are, whose text has a language with a score of `least` or more.

    A model that learned from fewer than two languages tells none apart: then every text with a letter stays. Null texts and
    those without letters go. Repeated rows are judged alike. All columns stay, whatever their names; an empty table stays empty.
    """
    prepare(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)
    tells = len(model.labels) > 1 and bool(model.weights.any())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in chunks(batches, text=at):
            texts = [t or "" for t in batch.column(at).to_pylist()]
            stays = [len(p) > 0 and float(p.mean(axis=0).max()) >= least for p in own.label(texts)] if tells else [_has_letter(t) for t in texts]
            yield batch.filter(pa.array(stays, pa.bool_()))

    return docs.mapInArrow(task("language", run), docs.schema)


def op4_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = learn(docs.where(remainder(F.col("doc_id"), 3) != 1))
    return identify(docs, model).select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score", "switches")
