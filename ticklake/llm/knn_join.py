"""Exact top-k search by inner product: a Voronoi kNN join.

Vectors become whole numbers.  A bounded sample gives the pivots, every vector
goes to its nearest pivot's cell, and a cell's summary is its radius and its
few smallest distances.  For a query q and a vector x of a cell with pivot p,
``|q.x - q.p| <= |q| |x - p|``; so the scores of the pivots themselves and the
cells' smallest distances bound a query's k-th best score from below, a cell's
radius bounds its scores from above, and a query goes only to cells that may
hold one of its k best.  Cells are cut into blocks (a common vector may fill a
cell with a third of all rows), and the queries that ask a cell into parts; a
data row is copied once per part that asks its own cell, not at all where none
does.  Each (block, part) is solved by itself, and the best are merged.  Pivots
grow with the square root of the rows, within ``PIVOTS`` and ``MAX_PIVOTS``.

Cases: null vectors and those with null or non-finite components take no part;
shorter vectors count as padded with zeros; ties go to the smaller id; a
query never finds its own id; null ids take no part; repeated query rows
ask once, repeated candidate rows are candidates each; fewer candidates than
k give fewer rows; an empty table gives none.  Whole numbers beyond 64 bits
saturate, inner products beyond 64 bits wrap.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.llm.common import column, map_arrow, ship_package, staged

PIVOTS, MAX_PIVOTS = 128, 4096
MIN_BLOCK, MAX_BLOCK = 256, 4096
STEP_CELLS = 1 << 22  # numbers that one step of a worker holds at once


def whole_numbers(rows: DataFrame, vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, v): components floor(scale * x), x as double, of the vectors that take part."""
    x = F.col(vector)
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    return (rows.filter(F.col("vec_id").isNotNull() & x.isNotNull() & ~odd)
            .select(F.col("vec_id").cast("long"), F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v")))


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of a list array as floats, padded with zeros."""
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(-1, width).astype(np.float64)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers."""
    top = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * q.shape[1]
    if top < 2**53:
        return np.rint(q @ x.T).astype(np.int64)
    return q.astype(np.int64) @ x.astype(np.int64).T


def _slices(batches: Iterator[pa.RecordBatch], cells_a_row: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices whose rows need at most ``STEP_CELLS`` numbers."""
    rows = max(1, STEP_CELLS // cells_a_row)
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def assign(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Add the nearest pivot's cell and the distance to it."""
    width, squares = pivots.shape[1], (pivots**2).sum(axis=1)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, len(pivots) + width):
            x = _matrix(column(batch, "v"), width)
            cell = np.argmin(squares - 2 * (x @ pivots.T), axis=1)
            far = np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(far)],
                                             names=[*batch.schema.names, "cell", "far"])

    return map_arrow(vectors, step, "vec_id long, v array<long>, cell int, far double")


def route(queries: DataFrame, pivots: np.ndarray, near: np.ndarray, radius: np.ndarray, k: int) -> DataFrame:
    """(query_id, q, cells): the cells that may hold one of a query's k best."""
    width = pivots.shape[1]
    known = np.where(np.isinf(near), 0.0, near)  # a zero vector's norm times inf would be nan

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, len(pivots) * (k + 4) + width):
            q = _matrix(column(batch, "v"), width)
            at, norm = q @ pivots.T, np.sqrt((q**2).sum(axis=1))[:, None]
            # k + 1 vectors with at least these scores, one of which may be the query itself
            sure = np.where(np.isinf(near), -np.inf, at[:, :, None] - norm[:, :, None] * known).reshape(len(q), -1)
            bound = np.partition(sure, -k - 1, axis=1)[:, -k - 1] if sure.shape[1] > k else np.full(len(q), -np.inf)
            slack = 1e-9 * (1 + np.abs(at) + norm * radius)
            go = (at + norm * radius + slack >= bound[:, None]) & (radius >= 0)
            cells = [np.flatnonzero(g).astype(np.int32) for g in go]
            yield pa.RecordBatch.from_arrays([column(batch, "vec_id"), column(batch, "v"), pa.array(cells, pa.list_(pa.int32()))],
                                             names=["query_id", "q", "cells"])

    return map_arrow(queries, step, "query_id long, q array<long>, cells array<int>")


def deal(cells: DataFrame, queries: DataFrame, sizes: dict[int, int], n_pivots: int, block: int) -> tuple[DataFrame, DataFrame]:
    """The data rows and the questions by (cell, block, part): a cell has a part per ``MAX_BLOCK`` queries that ask it."""
    asking = {r["cell"]: r["n"] for r in queries.select(F.explode("cells").alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks = F.lit([-(-sizes.get(c, 1) // block) for c in range(n_pivots)])
    parts = F.lit([-(-asking.get(c, 0) // MAX_BLOCK) for c in range(n_pivots)])
    data = (cells.filter(F.get(parts, F.col("cell")) > 0)
            .withColumn("block", F.pmod(F.xxhash64("vec_id", "far"), F.get(blocks, F.col("cell"))).cast("int"))
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.get(parts, F.col("cell")) - 1)))
            .select("cell", "block", "part", "vec_id", "v"))
    asked = (queries.withColumn("cell", F.explode("cells"))
             .withColumn("part", F.pmod(F.xxhash64("query_id"), F.get(parts, F.col("cell"))).cast("int"))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.get(blocks, F.col("cell")) - 1)))
             .select("cell", "block", "part", "query_id", "q"))
    return data, asked


def top_k(vectors: DataFrame, is_query: Column, k: int, n_pivots: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of all vectors for each one that ``is_query`` picks.

    vectors: (vec_id, v) as from ``whole_numbers``.
    """
    vectors = staged(vectors, "vectors")
    n, width = vectors.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    width = max(1, width)
    n_pivots = n_pivots or min(MAX_PIVOTS, max(PIVOTS, math.isqrt(n)))
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n_pivots).collect()
    pivots = np.zeros((max(1, len(sample)), width))
    for i, r in enumerate(sample):
        pivots[i, :len(r["v"])] = r["v"]
    pivots = np.unique(pivots, axis=0)
    cells = staged(assign(vectors, pivots), "cells")

    closest = Window.partitionBy("cell").orderBy("far")
    summary = (cells.withColumn("i", F.row_number().over(closest)).filter(F.col("i") <= k + 1).select("cell", "i", "far").collect())
    sizes = {r["cell"]: r for r in cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("r")).collect()}
    near = np.full((len(pivots), k + 1), np.inf)
    for r in summary:
        near[r["cell"], r["i"] - 1] = r["far"]
    near = near * (1 + 1e-9) + 1e-6
    radius = np.array([sizes[c]["r"] * (1 + 1e-9) + 1e-6 if c in sizes else -1.0 for c in range(len(pivots))])

    block = min(MAX_BLOCK, max(MIN_BLOCK, -(-n // n_pivots)))
    queries = staged(route(cells.filter(is_query).select("vec_id", "v").dropDuplicates(["vec_id"]), pivots, near, radius, k), "queries")
    data, asked = deal(cells, queries, {c: r["n"] for c, r in sizes.items()}, len(pivots), block)

    def solve(data: pa.Table, asked: pa.Table) -> pa.Table:
        data = data.combine_chunks().sort_by("vec_id")
        ids, asks = data.column("vec_id").to_numpy(), asked.column("query_id").to_numpy()
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(ids) and len(asks):
            x = _matrix(data.column("v").combine_chunks(), width)
            q = _matrix(asked.combine_chunks().column("q").combine_chunks(), width)
            for a in range(0, len(q), 512):
                scores = _products(q[a:a + 512], x)
                own = asks[a:a + 512, None] == ids
                masked = np.where(own, np.iinfo(np.int64).min, scores)
                best = np.argsort(~masked, axis=1, kind="stable")[:, :k]  # ~x falls as x rises, without overflow
                row = np.repeat(np.arange(len(scores)), best.shape[1])
                col = best.ravel()
                keep = ~own[row, col]
                found.append((asks[a:a + 512][row][keep], ids[col][keep], scores[row, col][keep]))
        parts = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 3
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), parts, strict=True)})

    ship_package(vectors.sparkSession)
    keys = ["cell", "block", "part"]
    solved = data.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(solve, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (solved.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int"), "vec_id", "score"))
