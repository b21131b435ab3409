"""Connected components of a table of links, by union-find within tasks and star contraction between them.

Each round first contracts the links of every task with a local union-find
(only a forest leaves the task), then makes the neighbours of each node above it
point to its smallest neighbour, and those below likewise; rounds end when
nothing changes.  Smallest neighbours are aggregates, so a node with a third
of all links costs one row per task.  Links are two numbers; nothing is
collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import column, map_arrow, staged

#: Links that one local union-find holds at a time.
LOCAL_LINKS = 500_000


def _forest(links: DataFrame) -> DataFrame:
    """(node, root) pairs, node > root, that connect what the links of each task connect."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            root = x
            while parent.get(root, root) != root:
                root = parent[root]
            while parent.get(x, x) != root:
                parent[x], x = root, parent[x]
            return root

        def emit() -> pa.RecordBatch:
            found = [(x, find(x)) for x in list(parent)]
            found = [(x, r) for x, r in found if x != r]
            return pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in found], pa.int64()), pa.array([r for _, r in found], pa.int64())], names=["node", "root"])

        for batch in batches:
            for a, b in zip(column(batch, "node").to_pylist(), column(batch, "root").to_pylist(), strict=True):
                a, b = find(a), find(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            if len(parent) >= LOCAL_LINKS:
                yield emit()
                parent.clear()
        yield emit()

    return map_arrow(links, step, "node long, root long")


def _star(links: DataFrame, above: bool) -> DataFrame:
    """Neighbours above (or below) each node point to the smallest one around it."""
    if above:
        both = links.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(
            links.select(F.col("root").alias("u"), F.col("node").alias("v")))
    else:
        both = links.select(F.col("node").alias("u"), F.col("root").alias("v"))
    both = staged(both, "links")
    least = staged(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), F.least("u", "m").alias("m")), "least")
    moved = both.join(least, F.col("u") == F.col("_u"))
    if above:
        out = moved.filter("v > u").select(F.col("v").alias("node"), F.col("m").alias("root"))
    else:
        out = moved.select(F.col("v").alias("node"), F.col("m").alias("root")).unionByName(
            least.select(F.col("_u").alias("node"), F.col("m").alias("root")))
    return out.filter("node != root").dropDuplicates()


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "root").cast("decimal(20,0)"))).first())


def connected_components(pairs: DataFrame) -> DataFrame:
    """(node, group) for every node of ``pairs`` (a, b): group is the smallest node that it is linked with, by any chain."""
    links = pairs.filter("a != b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
    links = staged(_forest(links), "forest")
    mark = _mark(links)
    while True:
        links = staged(_star(staged(_star(links, True), "star"), False), "star")
        now = _mark(links)
        if now == mark:
            break
        mark = now
    # every node now points to its group's smallest node, which itself is not among the nodes
    return links.select("node", F.col("root").alias("group")).unionByName(
        links.select(F.col("root").alias("node"), F.col("root").alias("group")).dropDuplicates())
