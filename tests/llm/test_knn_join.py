"""kNN join against all pairs, ties, odd vectors, pruning and hot cells."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticklake.llm import knn_join


def plain(rows, k):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in {i: v for i, v in good if i % 50 == 0}.items():
        scored = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in good if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, k=5, pivots=16):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, cell int, v string").repartition(4)
    vectors = knn_join.whole_numbers(df)
    return sorted(tuple(r) for r in knn_join.top_k(vectors, F.col("vec_id") % 50 == 0, k, pivots).collect())


def f32(x):
    return float(np.float32(x))


@pytest.mark.parametrize("spread", [0.02, 3.0])
def test_equals_all_pairs(spark, spread, monkeypatch):
    monkeypatch.setattr(knn_join, "MIN_BLOCK", 20)
    rng = random.Random(1)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    rows = [(i, [f32(x + rng.gauss(0, spread)) for x in rng.choice(centres)]) for i in range(400)]
    rows += [(i, rows[0][1]) for i in range(400, 600)]  # one common vector: ties and a hot cell
    assert run(spark, rows) == plain(rows, 5)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [2.0]),
            (6, []), (None, [1.0, 1.0]), (50, [-1.0, 0.5]), (7, [-0.001, 0.0]), (8, [3e4, -3e4])]
    assert run(spark, rows) == plain(rows, 5)
    assert run(spark, rows[:1]) == [] and run(spark, rows[1:2]) == []


def test_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(knn_join, "MAX_BLOCK", 3)
    rng = random.Random(2)
    rows = [(i * 10, [f32(rng.gauss(0, 1)) for _ in range(3)]) for i in range(120)]
    assert run(spark, rows, pivots=4) == plain(rows, 5)


def test_far_cells_are_left_out(spark):
    """Where cells are tight, a query goes to few of them."""
    rng = np.random.default_rng(0)
    pivots = np.eye(8) * 1000
    near, radius = np.full((8, 6), 1.0), np.full(8, 2.0)
    df = spark.createDataFrame([(0, [int(x) for x in rng.integers(0, 3, 8) + pivots[3]])], "vec_id long, v array<long>")
    assert knn_join.route(df, pivots, near, radius, 5).first()["cells"] == [3]


def test_repeated_rows(spark):
    rows = [(0, [1.0]), (0, [1.0]), (1, [2.0]), (1, [2.0])]
    assert run(spark, rows, k=3) == [(0, 1, 1, 131072), (0, 2, 1, 131072)]


def test_zero_queries_with_small_cells(spark):
    """Vectors of whole-number form zero keep their rows where cells hold fewer than k + 1 vectors."""
    rng = random.Random(3)
    rows = [(i, [f32(rng.gauss(0, 1)) for _ in range(4)]) for i in range(1, 40)]
    rows += [(0, [0.0, 0.001, 0.0, 0.0]), (50, []), (100, [1.0, 0.0, 0.0, 0.0])]
    got = run(spark, rows, pivots=32)
    assert got == plain(rows, 5) and {r[0] for r in got} == {0, 50, 100}


def test_data_goes_only_where_it_is_asked_for(spark, monkeypatch):
    """Copies of a data row follow the questions to its own cell, however many queries there are elsewhere."""
    monkeypatch.setattr(knn_join, "MAX_BLOCK", 10)
    cells = spark.createDataFrame([(i, i % 4, 0.0, [i]) for i in range(80)], "vec_id long, cell int, far double, v array<long>")
    queries = spark.createDataFrame([(i, [1], [0]) for i in range(95)] + [(100, [1], [0, 2])], "query_id long, q array<long>, cells array<int>")
    data, asked = knn_join.deal(cells, queries, dict.fromkeys(range(4), 20), 4, 8)
    copies = {r["cell"]: r["n"] for r in data.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    assert copies == {0: 20 * 10, 2: 20}  # 96 and 1 questions, none of cells 1 and 3
    assert asked.count() == 96 * 3 + 3 and asked.select("cell", "block", "query_id").distinct().count() == 96 * 3 + 3


def test_more_pivots_than_a_step_holds(spark, monkeypatch):
    monkeypatch.setattr(knn_join, "STEP_CELLS", 200)
    rng = random.Random(4)
    rows = [(i, [f32(rng.gauss(0, 1)) for _ in range(3)]) for i in range(300)]
    assert run(spark, rows, pivots=40) == plain(rows, 5)
