"""Substring dedup against a direct reading of every window."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from ticklake.llm import substring_dedup as sd
from ticklake.llm.words import Words

GAP = re.compile(r"[\x20\x09-\x0D]+")


def plain(docs, window):
    words = {d: [w for w in GAP.split(t or "") if w] for d, t in docs}
    least = {}
    for d in sorted(words):
        for i in range(len(words[d]) - window + 1):
            least.setdefault(tuple(words[d][i:i + window]), d)
    out = {}
    for d, ws in words.items():
        gone = set()
        for i in range(len(ws) - window + 1):
            if least[tuple(ws[i:i + window])] < d:
                gone |= set(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
        out[d] = (len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def corpus(seed, n=60, window=50):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(rng.choice([3, 40, 5000]))]
    passages = [[rng.choice(vocab) for _ in range(rng.randint(window - 3, 3 * window))] for _ in range(6)]
    docs = []
    for d in range(n):
        ws = []
        for _ in range(rng.randint(0, 4)):
            kind = rng.random()
            if kind < 0.5:
                p = rng.choice(passages)
                ws += p if rng.random() < 0.5 else p[rng.randint(0, 5):len(p) - rng.randint(0, 5)]
            elif kind < 0.6:
                ws += [rng.choice(vocab)] * rng.randint(1, 2 * window)
            else:
                ws += [rng.choice(vocab) for _ in range(rng.randint(1, window))]
        if rng.random() < 0.3 and docs and docs[-1][1]:
            ws = docs[-1][1].split()
            if ws and rng.random() < 0.7:
                ws[rng.randrange(len(ws))] = "edit"
        docs.append((d, rng.choice([" ", "\n", " \t "]).join(ws)))
    return docs


@pytest.mark.parametrize(("seed", "window", "k"), [(1, 50, 20), (2, 50, 20), (3, 50, 20), (4, 8, 3), (5, 8, 3), (6, 5, 5), (7, 6, 2)])
def test_equals_brute_force(spark, seed, window, k):
    docs = corpus(seed, window=window)
    docs += [(100, None), (101, ""), (102, " \n"), (103, docs[0][1]), (104, "é " * (window + 2)), (105, "é " * (window + 2))]
    random.Random(seed).shuffle(docs)
    df = spark.createDataFrame([(d, t, 1, "clash") for d, t in docs], "doc_id long, text string, at int, kmer string").repartition(5)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in sd.digests(df, window, k).collect()}
    assert got == plain(docs, window)


@pytest.mark.parametrize(("seed", "window", "k", "bits"), [(1, 50, 20, 5), (3, 50, 20, 1), (5, 8, 3, 8), (7, 6, 2, 3)])
def test_colliding_hashes_change_nothing(spark, seed, window, k, bits):
    docs = corpus(seed, window=window)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in sd.digests(df, window, k, bits).collect()}
    assert got == plain(docs, window)


def test_a_long_passage_is_one_path(spark):
    rng = random.Random(5)
    passage = [f"p{rng.randrange(10**6)}" for _ in range(3000)]
    docs = [(d, " ".join(f"d{d}x{i}" for i in range(70)) + " " + " ".join(passage)) for d in range(4)]
    taken = sd.edges(spark.createDataFrame(docs, "doc long, text string"))
    kmers = {}
    for r in taken.collect():
        kmers.setdefault(r.kmer, []).append(r)
    shared = [r for rows in kmers.values() if len(rows) == 4 and len({x.path for x in rows}) == 1 for r in rows]
    found = sd.chains(spark.createDataFrame(shared, taken.schema)).collect()
    assert len(shared) > 400 and len(found) == 1
    assert found[0].total == sum(r.n for r in shared) // 4


def test_every_window_takes_one_edge():
    rng = np.random.default_rng(0)
    texts = pa.array([" ".join(map(str, rng.integers(0, m, n))) for m, n in [(2, 500), (10**6, 700), (1, 90), (5, 49)]])
    words = Words(texts)
    text, _, _, begin, n = sd.taken_edges(words, 50, 20)
    covered = np.repeat(begin - words.first[text], n) + np.concatenate([np.arange(x) for x in n])
    per = np.repeat(text, n)
    for t, total in enumerate([451, 651, 41, 0]):
        assert sorted(covered[per == t]) == list(range(total))


def test_repeated_rows_null_ids_and_empty_table(spark):
    long = " ".join(f"x{i}" for i in range(80))
    df = spark.createDataFrame([(1, long), (1, long), (2, long), (None, None)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in sd.digests(df).collect())
    assert got == [(0, 0, 0), (1, 80, 0), (1, 80, 0), (2, 80, 80)]
    assert sd.digests(df.limit(0)).count() == 0


def test_remove_repeats_keeps_columns_and_clean_texts(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    df = spark.createDataFrame([(1, "a\n" + passage, "x", 5), (2, "b " + passage + "  c", "y", None), (3, "clean \n text", None, 7)],
                               "doc_id long, text string, at string, spans int")
    got = {r.doc_id: r for r in sd.remove_repeats(df).collect()}
    assert got[1].text == "a\n" + passage and got[3].text == "clean \n text"
    assert (got[2].text, got[2].at, got[2].spans) == ("b c", "y", None)
