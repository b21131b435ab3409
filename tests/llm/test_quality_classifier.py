"""Quality classifier: gradients, attention over whole texts, held-out accuracy, odd inputs."""

import zlib

import numpy as np
import pyarrow as pa

from ticklake.llm import quality_classifier as qc


def test_passages_cover_whole_texts():
    texts = pa.array(["w " * 200, None, "", "one TWO three!", "x" * 10], pa.string())
    features, first = qc.encode(texts)
    assert np.diff(first).tolist() == [4, 1, 1, 1, 1] and np.isfinite(features).all()
    assert (features[first[1]:first[2]] == features[first[2]:first[3]]).all()
    alone = qc.encode(texts.slice(3, 1))[0]
    assert (features[first[3]] == alone[0]).all()


def test_one_bad_passage_is_found():
    """Bags of clean vectors; a label-0 bag hides one odd vector: attention must look at it."""
    rng = np.random.default_rng(0)

    def bags(n):
        parts, labels = [], []
        for i in range(n):
            x = rng.normal(0, 1, (rng.integers(2, 20), 6)).astype(np.float32)
            if i % 3 == 0:
                x[rng.integers(len(x)), 2] = 6
            parts.append(x)
            labels.append(float(i % 3 != 0))
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(list(map(len, parts)))]), np.array(labels)

    model = qc.fit(*bags(600))
    x, first, y = bags(300)
    assert ((model.scores(x, first) >= 0.5) == (y > 0.5)).mean() > 0.95


def test_nothing_to_learn_from():
    assert qc.fit(np.zeros((0, 3), np.float32), np.array([0]), np.zeros(0)).scores(np.zeros((2, 3)), np.array([0, 1, 2])).tolist() == [0.5, 0.5]
    assert qc.fit(np.ones((2, 3), np.float32), np.array([0, 1, 2]), np.ones(2)).scores(np.zeros((1, 3)), np.array([0, 1])).tolist() == [1.0]


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = {r.doc_id: r for r in qc.classify(docs.withColumn("score", docs.lang), labels).collect()}
    assert len(out) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in out.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out.values())
    held = [(out[r.doc_id], r.quality) for r in labels.collect() if out[r.doc_id].held_out]
    good = [r.predicted for r, q in held if q == 1]
    bad = [r.predicted for r, q in held if q == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_null_ids_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "good words here"), (1, "good words here"), (None, None), (2, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (1, None), (None, 0)], "doc_id long, quality int")
    rows = qc.classify(docs, labels).collect()
    assert len(rows) == 4 and all(r.score is not None and r.held_out is not None for r in rows)
    assert len({r.score for r in rows if r.doc_id == 1}) == 1
    assert qc.classify(docs.limit(0), labels).count() == 0


def test_keep_good_passes_columns_through(spark):
    docs = spark.createDataFrame([(1, "fine text", "a", 3)], "doc_id long, text string, label string, score int")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert [tuple(r) for r in qc.keep_good(docs, labels).collect()] == [(1, "fine text", "a", 3)]


def test_long_documents_are_learned_from_all_over():
    assert qc.spread(10, 30).tolist() == list(range(10, 30))
    chosen = qc.spread(1000, 1000 + 640)
    assert len(chosen) == len(set(chosen.tolist())) == qc.TRAIN_PASSAGES and chosen.min() < 1100 and chosen.max() > 1540
    assert (np.diff(chosen) > 0).all()


def test_scores_equal_a_plain_forward_pass():
    rng = np.random.default_rng(3)
    n, sizes = 14 + qc.PROJECTED, [1, 3, 70, 2]
    x = rng.normal(0, 1, (sum(sizes), n))
    w = {"W": rng.normal(0, 1, (n, qc.HIDDEN)), "b": rng.normal(0, 1, qc.HIDDEN), "V": rng.normal(0, 1, (qc.HIDDEN, qc.ATTENTION)),
         "U": rng.normal(0, 1, (qc.HIDDEN, qc.ATTENTION)), "a": rng.normal(0, 1, qc.ATTENTION), "c": rng.normal(0, 1, qc.HIDDEN), "d": np.array([0.3])}
    first = np.concatenate([[0], np.cumsum(sizes)])
    model = qc.Model(np.zeros(n), np.ones(n), w)
    for bag, got in enumerate(model.scores(x, first)):
        h = [np.tanh(v @ w["W"] + w["b"]) for v in x[first[bag]:first[bag + 1]]]
        e = np.array([(np.tanh(v @ w["V"]) / (1 + np.exp(-(v @ w["U"])))) @ w["a"] for v in h])
        share = np.exp(e) / np.exp(e).sum()
        z = sum(s * v for s, v in zip(share, h, strict=True))
        assert abs(got - 1 / (1 + np.exp(-(z @ w["c"] + 0.3)))) < 1e-9


def test_held_out_accuracy_of_long_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = {r.doc_id: r for r in qc.classify(docs, labels).collect()}
    long_ids = {r.doc_id for r in docs.where("n_chars > 7000").select("doc_id").collect()}
    held = [(out[r.doc_id].predicted, r.quality) for r in labels.collect() if r.doc_id in long_ids and out[r.doc_id].held_out]
    assert len(held) > 20 and sum(p == q for p, q in held) >= 0.9 * len(held)
