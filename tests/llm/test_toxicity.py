"""Toxicity: n-grams and scores against plain counts, held-out accuracy, odd inputs."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from ticklake.llm import toxicity as tx


def plain_ngrams(text):
    b = ("" if text is None else text).encode()
    b = b" " + bytes(32 if 9 <= x <= 13 else x + 32 if 65 <= x <= 90 else x for x in b) + b" "
    return Counter(b[i:i + n] for n in tx.SIZES for i in range(len(b) - n + 1))


def packed(gram):
    return int.from_bytes(gram, "big") | len(gram) << 56


TEXTS = ["You IDIOT\tyou", None, "", "é", "a", "clean words here", "you idiot you " * 50]


def test_counts_are_of_whole_texts(spark):
    rows = [(i, i % 2, t) for i, t in enumerate(TEXTS)]
    got = {r.ngram: (r.toxic, r.clean) for r in tx.ngram_counts(spark.createDataFrame(rows, "doc_id long, label int, text string")).collect()}
    want = {}
    for _, label, t in rows:
        for g in plain_ngrams(t):
            a, b = want.get(packed(g), (0, 0))
            want[packed(g)] = (a + label, b + 1 - label)
    assert got == want


def test_scores_equal_a_plain_sum():
    grams = sorted({packed(g) for t in TEXTS[:6] for g in plain_ngrams(t)})[::2]
    rng = np.random.default_rng(1)
    model = tx.Model(np.array(grams, np.uint64), rng.normal(0, 0.1, (2, len(grams))), -0.3)
    got = model.scores(pa.array(TEXTS, pa.string()))
    for text, p in zip(TEXTS, got, strict=True):
        size, value = len((text or "").encode()) + 2, -0.3
        for g, c in plain_ngrams(text).items():
            if packed(g) in grams:
                i = grams.index(packed(g))
                value += model.weights[0][i] + model.weights[1][i] * c / (c + size / tx.SPAN)
        assert math.isclose(p, 1 / (1 + math.exp(-value)), rel_tol=1e-9)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = {r.doc_id: r for r in tx.classify(docs.withColumn("score", docs.lang), labels).collect()}
    assert len(out) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in out.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out.values())
    held = [(out[r.doc_id], r.toxic) for r in labels.collect() if out[r.doc_id].held_out]
    toxic, clean = ([r.predicted for r, t in held if t == x] for x in (1, 0))
    assert sum(toxic) >= 0.7 * len(toxic) and sum(clean) <= 0.01 * len(clean)


def test_held_out_labels_are_not_read(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("toxic", tx.F.when(tx.held_out(), 1 - tx.F.col("toxic")).otherwise(tx.F.col("toxic")))
    a, b = tx.train(docs, labels), tx.train(docs, turned)
    assert (a.keys == b.keys).all() and (a.weights == b.weights).all() and a.intercept == b.intercept


def test_nothing_to_learn_from_nulls_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "x"), (1, "x"), (None, None), (3, "")], "doc_id long, text string")
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    rows = tx.classify(docs, none).collect()
    assert len(rows) == 4 and {r.score for r in rows} == {0.5} and not next(r for r in rows if r.doc_id is None).held_out
    learned = next(i for i in range(9) if zlib.crc32(str(i).encode()) % 3 != 1)
    one = spark.createDataFrame([(learned, 1)], "doc_id long, toxic int")
    both = spark.createDataFrame([(learned, "x")], "doc_id long, text string").unionAll(docs)
    assert {r.score for r in tx.classify(both, one).collect()} == {1.0}
    assert tx.classify(docs.limit(0), none).collect() == []


def test_repeated_labels_and_long_texts(spark):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1][:24]
    rows = [(d, "awful stuff" if i % 2 else "fine stuff") for i, d in enumerate(ids)] + [(1000, "fine stuff " * 200_000 + "awful " * 9)]
    labels = [(d, i % 2) for i, d in enumerate(ids)] * 2
    out = {r.doc_id: r.score for r in tx.classify(spark.createDataFrame(rows, "doc_id long, text string"),
                                                   spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    assert min(out[d] for d in ids[1::2]) > max(out[d] for d in ids[::2]) and out[1000] > out[ids[0]]
