"""The language model against a plain dictionary implementation, probabilities that sum to one, and perplexity."""

import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ticklake.llm import ngram_lm as lm

GAP = re.compile(r"[\x20\x09-\x0D]+")


def split(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in GAP.split(low) if w] + ["</s>"]


def is_held(d):
    return d is not None and zlib.crc32(str(d).encode()) % 7 == 2


class Plain:
    def __init__(self, docs):
        self.pairs, self.words = Counter(), Counter()
        for d, t in docs:
            if not is_held(d):
                ws = split(t)
                self.words.update(ws)
                self.pairs.update(zip(["<s>", *ws], ws, strict=False))
        self.n, self.v = sum(self.words.values()), len(self.words)
        self.follow, self.before = defaultdict(Counter), Counter(w for _, w in self.pairs)
        for (a, w), c in self.pairs.items():
            self.follow[a][w] = c
        self.d2 = self.discounts(Counter(self.pairs.values()))
        self.d1 = self.discounts(Counter(self.before.values()))

    @staticmethod
    def discounts(cc):
        n1, n2, n3, n4 = (cc[i] for i in (1, 2, 3, 4))
        if not n1 or not n2:
            return [0, 0.5, 0.5, 0.5]
        y = n1 / (n1 + 2 * n2)
        raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, (3 - 4 * y * n4 / n3) if n3 else 2 - 3 * y * n3 / n2]
        return [0] + [min(max(x, 0.05), i + 1 - 0.05) for i, x in enumerate(raw)]

    def low(self, w):
        types = len(self.pairs)
        if not types:
            return 1 / (self.v + 1)
        back = sum(self.d1[min(c, 3)] for c in self.before.values()) / types
        c = self.before[w]
        return (c - self.d1[min(c, 3)]) / types + back / (self.v + 1)

    def p(self, w, a):
        f = self.follow.get(a)
        if not f:
            return self.low(w)
        total = sum(f.values())
        return (f[w] - self.d2[min(f[w], 3)]) / total + sum(self.d2[min(c, 3)] for c in f.values()) / total * self.low(w)

    def row(self, d, t):
        ws = split(t)
        return (is_held(d), len(ws), sum(w in self.words for w in ws), self.n,
                sum(math.log10((self.words[w] + 1) / (self.n + self.v + 1)) for w in ws),
                sum(math.log10(self.p(w, a)) for a, w in zip(["<s>", *ws], ws, strict=False)))


def corpus(seed=1, n=120):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["É", "Été", "THE", "The", "the"]
    docs = [(d, " ".join(vocab[min(int(rng.expovariate(0.08)), 64)] for _ in range(rng.randint(0, 60)))) for d in range(n)]
    return [*docs, (1000, None), (1001, ""), (1002, "hot pair " * 3000), (1003, "never seen words here"), (None, "null id")]


@pytest.mark.parametrize("slice_bytes", [300, 12 << 20])
def test_equals_a_plain_model(spark, monkeypatch, slice_bytes):
    monkeypatch.setattr(lm, "SLICE", slice_bytes)
    monkeypatch.setattr(lm, "MIN_SHARDS", 7)
    docs = corpus()
    plain = Plain(docs)
    df = spark.createDataFrame([(d, t, 1, "clash") for d, t in docs], "doc_id long, text string, n int, score string").repartition(4)
    rows = lm.score_documents(df, 2).collect()
    assert len(rows) == len(docs)
    text = dict(docs)
    for r in rows:
        want = plain.row(r.doc_id, text[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[:4]
        assert r.base_score == pytest.approx(want[4], rel=1e-9) and r.score == pytest.approx(want[5], rel=1e-9)


def test_probabilities_sum_to_one():
    plain = Plain(corpus())
    for a in ["<s>", "w1", "w30", "unseen"]:
        assert sum(plain.p(w, a) for w in plain.words) + plain.low("unseen") * (
            sum(plain.d2[min(c, 3)] for c in plain.follow[a].values()) / max(1, sum(plain.follow[a].values())) if plain.follow.get(a) else 1
        ) == pytest.approx(1)


def test_nothing_to_train_on_and_empty_table(spark):
    held = next(d for d in range(100) if is_held(d))
    row = lm.score_documents(spark.createDataFrame([(held, "a b")], "doc_id long, text string"), 2).first()
    assert (row.train_tokens, row.n_tokens, row.n_known, row.score) == (0, 3, 0, 0.0)
    assert lm.score_documents(spark.createDataFrame([], "doc_id long, text string"), 2).count() == 0


def test_beats_the_base_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = lm.score_documents(docs, 2).filter("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert r.s > r.b


def plain_scores(docs, order):
    """Scores by dictionaries of tuples; a k-gram that opens a text counts its occurrences at every order."""
    raw = [Counter() for _ in range(order + 1)]
    for d, t in docs:
        if not is_held(d):
            ws = ["<s>", *split(t)]
            for k in range(1, order + 1):
                raw[k].update(tuple(ws[i - k:i]) for i in range(max(k, 2), len(ws) + 1))
    grams = [Counter() for _ in range(order + 1)]
    for k in range(1, order + 1):
        if k < order:
            grams[k].update(g[1:] for g in raw[k + 1])
            grams[k].update({g: c for g, c in raw[k].items() if g[0] == "<s>"})
        else:
            grams[k] = raw[k]
    discounts = [Plain.discounts(Counter(g.values())) for g in grams]
    followers = [defaultdict(list) for _ in grams]
    for k in range(1, order + 1):
        for g, c in grams[k].items():
            followers[k][g[:-1]].append(c)
    vocabulary = len(raw[1])

    def p(context, w):
        if context is None:
            return 1 / (vocabulary + 1)
        k, low = len(context) + 1, p(context[1:] if context else None, w)
        cs = followers[k].get(context)
        if not cs:
            return low
        c = grams[k][(*context, w)]
        return (c - discounts[k][min(c, 3)]) / sum(cs) + sum(discounts[k][min(x, 3)] for x in cs) / sum(cs) * low

    def score(t):
        ws = ["<s>", *split(t)]
        return sum(math.log10(p(tuple(ws[max(0, i - order + 1):i]), ws[i])) for i in range(1, len(ws)))

    words = [*(w for w, in raw[1]), "unseen"]
    for context in [("<s>",), ("w1", "w2"), ("hot", "pair"), ("<s>", "hot"), ("unseen", "w1")]:
        assert sum(p(context, w) for w in words) == pytest.approx(1)
    return {d: score(t) for d, t in docs}


@pytest.mark.parametrize("order,round_bytes", [(3, 2000), (3, 64 << 20), (4, 64 << 20)])
def test_higher_orders_equal_a_plain_model(spark, monkeypatch, order, round_bytes):
    monkeypatch.setattr(lm, "SLICE", 300)
    monkeypatch.setattr(lm, "MIN_SHARDS", 7)
    monkeypatch.setattr(lm, "ROUND_BYTES", round_bytes)
    docs = corpus(seed=2, n=60)
    docs += [(2000 + i, docs[i][1]) for i in range(20)]  # copies: common longer contexts
    want = plain_scores(docs, order)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.score for r in lm.score_documents(df, order).collect()}
    assert got == pytest.approx(want, rel=1e-9)


def test_the_query_looks_at_two_words_before(spark, tmp_path):
    """a b is followed by c, x b by y: only a model of order 3 tells them apart."""
    from ticklake.llm.queries import op9_lm_scoring
    train = [(d, "a b c" if d % 2 else "x b y") for d in range(60) if not is_held(d)]
    held = [d for d in range(100, 200) if is_held(d)]
    rows = [*train, (held[0], "a b c"), (held[1], "a b y")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.score for r in op9_lm_scoring(spark, str(tmp_path)).collect()}
    assert got[held[0]] > got[held[1]] + 1


def test_no_file_per_shard(spark, monkeypatch):
    """Slices used to look into files of every shard, mapped at random; now shards answer them, and only the scores stay."""
    from ticklake.llm.common import shared_dir
    monkeypatch.setattr(lm, "SLICE", 300)
    monkeypatch.setattr(lm, "MIN_SHARDS", 23)
    monkeypatch.setattr(lm, "ROUND_BYTES", 2000)
    folder = f"{shared_dir(spark)}/llm"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    docs = corpus(seed=3, n=50)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = lm.score_documents(df)
    assert {x.rsplit("-", 1)[0] for x in set(os.listdir(folder)) - before} == {"scores"}
    assert {r.doc_id: r.score for r in got.collect()} == pytest.approx(plain_scores(docs, 3), rel=1e-9)


def test_texts_without_words(spark):
    """No k-gram above order 2 is asked for."""
    docs = [(d, t) for d, t in enumerate([None, "", " ", "\t"] * 5)]
    rows = lm.score_documents(spark.createDataFrame(docs, "doc_id long, text string"), 4).collect()
    want = plain_scores(docs, 4)
    assert len(rows) == 20 and all(r.n_tokens == 1 and r.score == pytest.approx(want[r.doc_id], rel=1e-9) for r in rows)


def test_sorting_is_a_stable_argsort():
    rng = np.random.default_rng(4)
    high = rng.integers(0, 2**63, 1000, dtype=np.uint64)
    for x in (high, high[:1], high[:0], rng.choice(high[:50], 1000), np.arange(1000, dtype=np.uint64)[::-1] % np.uint64(7),
              np.concatenate([high, high ^ np.uint64(1)])):  # the last two: hashes that differ in low bits only
        assert (lm.sorting(x) == np.argsort(x, kind="stable")).all()
        values, at, number = lm.distinct(x)
        assert (values == np.unique(x)).all() and (x[at] == values).all() and (values[number] == x).all()


def test_runs_of_numbers_survive():
    sizes = np.array([0, 3, 0, 2, 1, 0])
    x = np.array([0, 254, 255, 256, 2**40, 7])
    low, apart = lm.small(np.stack([x, x[::-1]], axis=1), sizes, 2)
    assert len(low) == len(apart) == 6
    some = slice(1, 4)  # a part of an array, as Spark's batches may be
    assert (lm.whole(low[some], apart[some], 2) == np.stack([x, x[::-1]], axis=1)[:5]).all()
    again, found = lm.joined(lm.binaries(x, sizes), np.int64)
    assert (again == x).all() and (found == sizes).all()


def test_few_and_many_counts_of_a_context():
    stats = np.array([[0, 0, 0, 0], [1, 1, 0, 0], [43, 15, 14, 0], [16, 16, 0, 0], [30, 0, 15, 0], [3, 0, 0, 1], [10**12, 300, 2**33, 255]])
    code, low, apart = lm.coded(stats, np.array([2, 0, 5]))
    assert (lm.decoded(code, low, apart) == stats).all() and (lm.decoded(code[1:], low[1:], apart[1:]) == stats[2:]).all()
