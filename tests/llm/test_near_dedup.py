"""Near duplicates: groups against all pairs, signatures against Jaccard, components against a plain union-find."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticklake.llm import near_dedup as nd
from ticklake.llm.common import staged
from ticklake.llm.components import connected_components

GAP = re.compile(r"[\x20\x09-\x0D]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, size):
    words = [w for w in GAP.split(lower(text)) if w]
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else ({tuple(words)} if words else set())


def plain(docs, size, percent):
    sets = {d: shingles(t, size) for d, t in docs}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


def corpus(seed, families=6, members=14):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    docs = []
    for _ in range(families):
        base = [rng.choice(vocab) for _ in range(rng.choice([1, 2, 3, 8, 40, 120]))]
        edits = rng.choice([0.005, 0.015, 0.03, 0.08])
        for _ in range(members):
            ws = [rng.choice(vocab) if rng.random() < edits else w for w in base]
            ws = ws + [rng.choice(vocab)] * (rng.random() < 0.2)
            docs.append(" ".join(w.upper() if rng.random() < 0.1 else w for w in ws))
    docs += [None, "", "  \n", "É é", "é É", docs[0], docs[-1]]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize(("seed", "size", "percent"), [(1, 3, 85), (2, 3, 85), (3, 5, 80), (4, 5, 80)])
def test_groups_equal_brute_force(spark, seed, size, percent, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 5)
    docs = corpus(seed)
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, rep string, key int").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in nd.groups(df, size, percent).collect()}
    assert got == plain(docs, size, percent)


def test_block_forest_equals_all_pairs():
    rng = random.Random(8)
    for _ in range(40):
        sets = [np.array(sorted(rng.sample(range(30), rng.randint(5, 25))), np.uint64) for _ in range(20)]
        start = np.array([rng.randrange(8) for _ in sets])
        sides = np.array([rng.choice([1, 2]) for _ in sets]) * (rng.random() < 0.5)
        links = nd.block_forest(np.arange(20), start, sides, sets, 60)

        def closed(edges, start=start):
            label = list(start)
            for a, b in edges:
                x, y = label[a], label[b]
                label = [x if v == y else v for v in label]
            return [label.index(v) for v in label]

        every = [(a, b) for a in range(20) for b in range(a) if (not sides[a] or sides[a] != sides[b])
                 and 100 * len(set(sets[a]) & set(sets[b])) >= 60 * len(set(sets[a]) | set(sets[b]))]
        assert closed(links) == closed(every)


def test_signature_estimates_jaccard_and_bands_meet():
    rng = np.random.default_rng(2)
    for n in (1, 7, 40, 300, 4000):
        errors, missed = [], 0
        for _ in range(30):
            pool = rng.integers(0, 2**63, 2 * n, dtype=np.uint64)
            cut = max(0, int(n * 0.08))
            a, b = pool[:n], pool[cut:n + cut]
            true = (n - cut) / (n + cut)
            x, y = nd.super_minhash(a), nd.super_minhash(b)
            errors.append((x == y).mean() - true)
            missed += not (nd.band_keys(x) == nd.band_keys(y)).any()
        assert abs(np.mean(errors)) < 0.03 and missed == 0


def test_signature_is_the_smallest_rank_of_each_place():
    rng = np.random.default_rng(4)
    s = rng.integers(0, 2**63, 9, dtype=np.uint64)
    each = np.array([nd.super_minhash(s[i:i + 1]) for i in range(9)])
    assert (nd.super_minhash(s) == each.min(axis=0)).all()
    assert all(sorted(e >> nd.FRACTION_BITS) == list(range(nd.M)) for e in each)


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(0, 200)] + [(500, 500 + i) for i in range(1, 300)] + [(1000 + rng.randrange(300), 1000 + rng.randrange(300)) for _ in range(150)]
    rng.shuffle(links)
    df = staged(spark.createDataFrame(links, "a long, b long").repartition(7), "t")
    got = {r.node: r.group for r in connected_components(df).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    want = {x: find(x) for x in parent}
    assert {x: got.get(x, x) for x in want} == want


def test_repeated_rows_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (7, "a b c d"), (8, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in nd.groups(df, 3, 85).collect()), key=str)
    assert got == [(5, None, False), (5, None, False), (7, None, False), (8, 8, True), (None, None, True)]
    assert nd.groups(df.limit(0), 3, 85).count() == 0
    assert sorted(r.doc_id or 0 for r in nd.keep_first(df, 3, 85).collect()) == [0, 8]


def test_keep_first_leaves_one_row_of_rows_that_share_an_id(spark):
    from ticklake.llm.near_dedup import keep_first
    text = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(None, text), (None, text), (1, text), (1, text), (1, other), (0, other), (None, "alone here"), (5, None), (5, ""), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("__extra", F.lit(1))
    kept = sorted(((r.doc_id, r.text) for r in keep_first(df, 5, 80).collect()), key=str)
    assert kept == sorted([(None, text), (0, other), (None, "alone here"), (5, None), (5, ""), (5, None)], key=str)
