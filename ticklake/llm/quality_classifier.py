"""Quality classifier: gated-attention multiple-instance learning over passages.

A document is a bag of passages of ``PASSAGE`` words; every passage of the
whole text is encoded (statistics of its characters and words, and a signed
hash projection of its words).  A hidden layer, a gated attention (tanh branch
times sigmoid branch, softmax over the document's passages) and a logistic
output on the weighted passage representation are fitted to document labels
alone, on the driver, from a bounded sample: at most ``TRAIN_DOCS`` labelled
documents, those with the smallest hashes of their ids, each with at most
``TRAIN_PASSAGES`` passages (of a longer one, those with the smallest hashes of
their places, spread over the whole document).  Scoring covers all documents and all
passages, each task by itself.

Cases: an empty or null text is one passage without words; null or missing
labels are not learned from, repeated ones are averaged; without labels of
both classes the score is the mean label (0.5 without any); an empty table
gives no rows.  Columns other than doc_id and text are never inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import column, map_arrow, slices
from ticklake.llm.words import Words, mix

PASSAGE = 64
TRAIN_DOCS, TRAIN_PASSAGES = 6000, 64
THRESHOLD = 0.7
HIDDEN, ATTENTION, PROJECTED, EPOCHS, RATE, DECAY = 24, 16, 16, 240, 0.02, 1e-4

_CLASSES = np.zeros((8, 256), dtype=np.int32)
for _i, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b"|", b"#*$%&<>^~=@_\\/+", b"!?", b".,;:'\"-()")):
    _CLASSES[_i, list(_chars)] = 1
_CLASSES[7, 128:] = 1


def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(features of all passages, index of each text's first passage, one more at the end)."""
    words = Words(texts)
    counts = words.counts
    per = np.maximum(1, -(-counts // PASSAGE))
    first = np.concatenate([[0], np.cumsum(per)])
    total = first[-1]
    n = np.zeros(total)
    text = words.text_of()
    passage = first[text] + (np.arange(len(words)) - words.first[text]) // PASSAGE
    np.add.at(n, passage, 1)
    out = np.zeros((total, 14 + PROJECTED), dtype=np.float32)
    if len(words):
        size = (words.end - words.start).astype(np.float64)
        chars = np.bincount(passage, size, total)
        safe, letters = np.maximum(n, 1), np.maximum(chars, 1)
        for k in range(8):
            run = np.concatenate([[0], np.cumsum(_CLASSES[k][words.data])])
            out[:, k] = np.bincount(passage, run[words.end] - run[words.start], total) / letters
        out[:, 8] = chars / safe / 10
        out[:, 9] = np.sqrt(np.maximum(0, np.bincount(passage, size**2, total) / safe - (chars / safe) ** 2)) / 10
        hashes = words.hashes(lower=True)
        mixed = hashes ^ (passage.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, at = np.unique(mixed, return_index=True)
        out[:, 10] = np.bincount(passage[at], minlength=total) / safe
        again = np.zeros(len(words))
        again[1:] = (hashes[1:] == hashes[:-1]) & (passage[1:] == passage[:-1])
        out[:, 11] = np.bincount(passage, again, total) / safe
        short = size <= 3
        out[:, 12] = np.bincount(passage, short, total) / safe
        sign = np.where(hashes >> np.uint64(63), 1.0, -1.0)
        slot = (hashes % np.uint64(PROJECTED)).astype(np.int64)
        out[:, 14:] = (np.bincount(passage * PROJECTED + slot, sign, total * PROJECTED).reshape(total, PROJECTED) / np.sqrt(safe)[:, None])
    out[:, 13] = np.log1p(n) / 4
    return out, first


@dataclass
class Model:
    """Weights; ``constant`` replaces them where there is nothing to learn from."""
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    constant: float | None = None

    def scores(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(first) - 1, self.constant)
        return _forward(self.weights, (features - self.mean) / self.scale, first)["p"]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _forward(w: dict[str, np.ndarray], x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
    bag = np.repeat(np.arange(len(first) - 1), np.diff(first))
    h = np.tanh(x @ w["W"] + w["b"])
    t, g = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
    e = (t * g) @ w["a"]
    e = np.exp(e - np.maximum.reduceat(e, first[:-1])[bag])
    a = e / np.add.reduceat(e, first[:-1])[bag]
    z = np.add.reduceat(a[:, None] * h, first[:-1], axis=0)
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "bag": bag, "p": _sigmoid(z @ w["c"] + w["d"][0])}


def fit(features: np.ndarray, first: np.ndarray, labels: np.ndarray, seed: int = 7) -> Model:
    """Adam on the log loss of bags, all bags at a time."""
    if not len(labels) or labels.min() == labels.max():
        return Model(np.zeros(1), np.ones(1), {}, float(labels.mean()) if len(labels) else 0.5)
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-3
    x = ((features - mean) / scale).astype(np.float64)
    rng = np.random.default_rng(seed)
    n = x.shape[1]
    w = {"W": rng.normal(0, n**-0.5, (n, HIDDEN)), "b": np.zeros(HIDDEN), "V": rng.normal(0, HIDDEN**-0.5, (HIDDEN, ATTENTION)),
         "U": rng.normal(0, HIDDEN**-0.5, (HIDDEN, ATTENTION)), "a": rng.normal(0, ATTENTION**-0.5, ATTENTION),
         "c": rng.normal(0, HIDDEN**-0.5, HIDDEN), "d": np.zeros(1)}
    m, v = ({k: np.zeros_like(p) for k, p in w.items()} for _ in range(2))
    for step in range(1, EPOCHS + 1):
        f = _forward(w, x, first)
        h, t, g, a, z, bag = (f[k] for k in ("h", "t", "g", "a", "z", "bag"))
        dy = (f["p"] - labels) / len(labels)
        dz = dy[:, None] * w["c"]
        dh = a[:, None] * dz[bag]
        da = np.einsum("ij,ij->i", h, dz[bag])
        de = a * (da - np.add.reduceat(a * da, first[:-1])[bag])
        dt, dg = de[:, None] * w["a"] * g * (1 - t**2), de[:, None] * w["a"] * t * g * (1 - g)
        dh = (dh + dt @ w["V"].T + dg @ w["U"].T) * (1 - h**2)
        grad = {"W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ dg, "a": (t * g).T @ de, "c": z.T @ dy, "d": np.array([dy.sum()])}
        for k in w:
            grad[k] += DECAY * w[k]
            m[k] = 0.9 * m[k] + 0.1 * grad[k]
            v[k] = 0.999 * v[k] + 0.001 * grad[k] ** 2
            w[k] -= RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, w)


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Rows whose labels are never learned from."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def spread(first: int, end: int, most: int = TRAIN_PASSAGES) -> np.ndarray:
    """Places of the passages to learn from: all of a short document, ``most`` of a long one, chosen by hash."""
    places = np.arange(end - first, dtype=np.uint64)
    chosen = np.argsort(mix(places + np.uint64(1)))[:most] if len(places) > most else places
    return first + np.sort(chosen).astype(np.int64)


def train(docs: DataFrame, labels: DataFrame, sample: int = TRAIN_DOCS) -> Model:
    """Fit on the labelled documents outside the held-out fold (label column ``quality``)."""
    chosen = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out())
              .groupBy(F.col("doc_id").alias("_labelled")).agg((F.avg("quality") >= 0.5).cast("double").alias("label"))
              .orderBy(F.xxhash64("_labelled"), "_labelled").limit(sample))
    bags = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("_labelled"))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            features, first = encode(column(part, "text"))
            blobs = [features[spread(a, b)].tobytes() for a, b in zip(first, first[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([column(part, "doc_id"), column(part, "label"), pa.array(blobs, pa.binary())],
                                             names=["doc_id", "label", "bag"])

    rows = map_arrow(bags, step, "doc_id long, label double, bag binary").collect()
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["bag"])))
    parts = [np.frombuffer(r["bag"], np.float32).reshape(-1, 14 + PROJECTED) for r in rows]
    first = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return fit(np.concatenate(parts) if parts else np.zeros((0, 14 + PROJECTED), np.float32), first, np.array([r["label"] for r in rows]))


def score(docs: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text in the column ``out``."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            p = model.scores(*encode(column(part, "text").cast(pa.string())))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p, pa.float64())], names=[*part.schema.names, out])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return map_arrow(docs, step, f"{fields}, `{out}` double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return score(docs, train(docs, labels)).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents that the classifier rejects."""
    return score(docs, train(docs, labels), "__llm_score").filter(F.col("__llm_score") >= THRESHOLD).drop("__llm_score")
