"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text's features are the n-grams of 3 to 6 bytes of its A-Z lower-cased form,
white space counted as a blank and a blank at either end.  An n-gram is its bytes
packed in 64 bits, so no two share a feature.  It enters twice: as presence, and
as density c / (c + bytes / ``SPAN``) of its c occurrences, since a long text
holds nearly every n-gram once by chance.

Fitting reads a bounded sample, the ``TRAIN_DOCS`` labelled documents with the
smallest hashes of their ids.  Spark counts for each n-gram how many toxic and
how many clean documents hold it; the log ratio r of both smoothed shares scales
the feature.  The ``FEATURES`` n-grams with the largest G statistic (those in at
least ``MIN_DOCS`` documents) enter a logistic regression on r-scaled presence
and density, fitted on the driver from the sample's few hits.  Scoring reads all whole texts:
a table of 2**22 bits rules out nearly all other n-grams, the rest are looked up.

Cases: a null or empty text holds no n-gram and gets the intercept's score; null
or missing labels are not learned from, repeated ones are averaged; without
labels of both classes the score is the mean label (0.5 without any); rows with a
null doc_id are scored and not held out; an empty table gives no rows.  Columns
other than doc_id and text are never inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import column, map_arrow, slices, staged
from ticklake.llm.words import text_buffer

SIZES = (3, 4, 5, 6)
TRAIN_DOCS, MIN_DOCS, FEATURES = 6000, 5, 2048
SMOOTHING, STEPS, RATE, DECAY, SPAN = 1.0, 300, 0.05, 0.5, 400
THRESHOLD = 0.7
SLICE = 1 << 20
_BITS = 22
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[9:14] = 32


def _folded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, each between blanks; where each text begins, one more at the end)."""
    data, off = text_buffer(texts)
    n = len(off) - 1
    first = off + 2 * np.arange(n + 1)
    out = np.full(first[-1], 32, np.uint8)
    inside = np.ones(len(out), bool)
    inside[first[:-1]] = inside[first[1:] - 1] = False
    out[inside] = _FOLD[data]
    return out, first


def ngrams(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(n, packed n-grams from each position on) for every size; the length is part of the value."""
    packed = np.zeros(len(data), np.uint64)
    for n in range(1, max(SIZES) + 1):
        packed = (packed[:len(data) - n + 1] << np.uint64(8)) | data[n - 1:]
        if n in SIZES:
            yield n, packed | np.uint64(n << 56)


def _slot(keys: np.ndarray) -> np.ndarray:
    return (keys * _SPREAD) >> np.uint64(64 - _BITS)


@dataclass
class Model:
    """Sorted n-grams with their scaled weights (rows: presence, density); ``constant`` replaces them where there is nothing to learn from."""
    keys: np.ndarray
    weights: np.ndarray
    intercept: float
    constant: float | None = None

    def hits(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, feature, density) of all known n-grams, each pair of text and feature once."""
        if not hasattr(self, "_table"):
            self._table = np.zeros(1 << _BITS, bool)
            self._table[_slot(self.keys)] = True
        data, first = _folded(texts)
        found = []
        for n, packed in ngrams(data):
            at = np.flatnonzero(self._table[_slot(packed)])
            place = np.searchsorted(self.keys, packed[at])
            place[place == len(self.keys)] = 0
            known = self.keys[place] == packed[at]
            at, place = at[known], place[known]
            text = np.searchsorted(first, at, "right") - 1
            within = at + n <= first[text + 1]
            found.append(text[within] * len(self.keys) + place[within])
        pairs, count = np.unique(np.concatenate(found), return_counts=True)
        text = pairs // len(self.keys)
        return text, pairs % len(self.keys), count / (count + np.diff(first)[text] / SPAN)

    def scores(self, texts: pa.Array) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        text, feature, density = self.hits(texts)
        value = self.weights[0][feature] + density * self.weights[1][feature]
        return _sigmoid(np.bincount(text, value, len(texts)) + self.intercept)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, size: int) -> DataFrame:
    """(label, text) of the labelled documents to learn from."""
    chosen = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
              .groupBy(F.col("doc_id").cast("long").alias("_labelled")).agg((F.avg("toxic") >= 0.5).cast("int").alias("label"))
              .orderBy(F.xxhash64("_labelled"), "_labelled").limit(size))
    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .join(F.broadcast(chosen), F.col("doc_id") == F.col("_labelled")).select("doc_id", "label", "text"))


def ngram_counts(sample: DataFrame) -> DataFrame:
    """(ngram, toxic, clean): documents of either label that hold an n-gram."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, target=SLICE):
            label = column(part, "label").to_numpy(zero_copy_only=False).astype(bool)
            data, first = _folded(column(part, "text"))
            text_at = np.repeat(np.arange(part.num_rows), np.diff(first))
            for n, packed in ngrams(data):
                text = text_at[:len(packed)]
                inside = text == text_at[n - 1:]
                text, packed = text[inside], packed[inside]
                by = np.lexsort((text, packed))
                text, packed = text[by], packed[by]
                once = np.concatenate([[True], (packed[1:] != packed[:-1]) | (text[1:] != text[:-1])])[:len(packed)]
                text, packed = text[once], packed[once]
                keys, at = np.unique(packed, return_inverse=True)
                toxic = np.bincount(at, label[text], len(keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(toxic), pa.array(np.bincount(at, minlength=len(keys)) - toxic)],
                    names=["ngram", "toxic", "clean"])

    return (map_arrow(sample, step, "ngram long, toxic long, clean long")
            .groupBy("ngram").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def log_ratios(counts: DataFrame, features: int, n_toxic: int, n_clean: int) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams ascending, their log-count ratios) of the most telling n-grams."""
    total = float(n_toxic + n_clean)

    def term(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    there = F.col("toxic") + F.col("clean")
    g = (term(F.col("toxic"), there * n_toxic / total) + term(F.col("clean"), there * n_clean / total)
         + term(n_toxic - F.col("toxic"), (total - there) * n_toxic / total) + term(n_clean - F.col("clean"), (total - there) * n_clean / total))
    best = counts.filter(there >= MIN_DOCS).withColumn("g", g).orderBy(F.desc("g"), "ngram").limit(features)
    rows = np.array([tuple(r) for r in best.select("ngram", "toxic", "clean").collect()], np.int64).reshape(-1, 3)
    rows = rows[np.argsort(rows[:, 0].view(np.uint64) if len(rows) else rows[:, 0])]
    keys = np.ascontiguousarray(rows[:, 0]).view(np.uint64)
    ratio = np.log((rows[:, 1] + SMOOTHING) / (n_toxic + 2 * SMOOTHING)) - np.log((rows[:, 2] + SMOOTHING) / (n_clean + 2 * SMOOTHING))
    return keys, ratio


def fit(text: np.ndarray, feature: np.ndarray, density: np.ndarray, labels: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on ratio-scaled presence and density, by Adam on the mean log loss with an L2 penalty."""
    n, size = len(labels), len(ratio)
    w, b = np.zeros((2, size)), np.array([np.log(labels.mean() / (1 - labels.mean()))])
    state = [[x, np.zeros_like(x), np.zeros_like(x)] for x in (w, b)]
    x = np.stack([ratio[feature], ratio[feature] * density])
    for step in range(1, STEPS + 1):
        p = _sigmoid(np.bincount(text, (x * w[:, feature]).sum(axis=0), n) + b)
        miss = (p - labels) / n
        grads = np.stack([np.bincount(feature, row * miss[text], size) for row in x]) + DECAY / n * w, miss.sum(keepdims=True)
        for (at, m, v), grad in zip(state, grads, strict=True):
            m += 0.1 * (grad - m)
            v += 0.001 * (grad**2 - v)
            at -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w * ratio, float(b[0])


def train(docs: DataFrame, labels: DataFrame, sample: int = TRAIN_DOCS, features: int = FEATURES) -> Model:
    """Fit on the labelled documents outside the held-out fold (label column ``toxic``)."""
    chosen = staged(_sample(docs, labels, sample), "toxicity-sample")
    n_toxic, n = chosen.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count(F.lit(1))).first()
    none = np.zeros(0)
    if n_toxic in (0, n):
        return Model(none, none, 0.0, n_toxic / n if n else 0.5)
    keys, ratio = log_ratios(ngram_counts(chosen), features, n_toxic, n - n_toxic)
    if not len(keys):
        return Model(none, none, 0.0, n_toxic / n)
    known = Model(keys, none, 0.0)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, target=SLICE):
            text, feature, density = known.hits(column(part, "text"))
            cuts = np.searchsorted(text, np.arange(part.num_rows + 1))
            packed = [[x[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)] for x in (feature.astype("<i4"), density.astype("<f4"))]
            yield pa.RecordBatch.from_arrays([column(part, "doc_id"), column(part, "label"), *(pa.array(x, pa.binary()) for x in packed)],
                                             names=["doc_id", "label", "features", "density"])

    # at most ``sample`` rows of known n-grams
    rows = map_arrow(chosen, step, "doc_id long, label int, features binary, density binary").collect()
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["features"]), bytes(r["density"])))
    feature, density = (np.frombuffer(b"".join(r[c] for r in rows), kind) for c, kind in (("features", "<i4"), ("density", "<f4")))
    text = np.repeat(np.arange(len(rows)), [len(r["features"]) // 4 for r in rows])
    weights, intercept = fit(text, feature.astype(np.int64), density.astype(float), np.array([r["label"] for r in rows], float), ratio)
    return Model(keys, weights, intercept)


def score(docs: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """doc_id and the score of every whole text in the column ``out``."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, target=SLICE):
            yield pa.RecordBatch.from_arrays([column(part, "doc_id"), pa.array(model.scores(column(part, "text")), pa.float64())],
                                             names=["doc_id", out])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), step, f"doc_id long, `{out}` double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    return score(docs, train(docs, labels)).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
