"""Merkle dataset manifest: a 16-ary hash tree with path-copied versions.

One tree for each source over its leaves (ascending doc_id), and one tree over
the sources' roots.  A changed leaf does not rebuild the tree: it creates a
version that shares every untouched node and owns copies of its ancestors only.

1. Leaves are hashed by SQL functions and sorted by (source, doc_id) in ranges;
   a leaf's position is its place in the range plus the sizes of the ranges before.
2. 4,096 consecutive nodes of a tree are an aligned block: one row, whose three
   levels are hashed in one task.  The blocks' roots are the nodes of the next
   round, until each tree has one node; then the tree of sources goes the same way.
3. On the way down every block gets the siblings on the path from its root to the
   root of all.  A task then finishes the proofs of its leaves, copies the
   ancestors of each changed leaf inside its block, and goes on with the version
   through the distributed upper levels with these siblings.

No task holds more than a block and one path (15 siblings a level); a hot source
is many blocks.

Cases: a null is hashed as ``-``; rows with a null doc_id stand first in their
source and never change; equal doc_ids are ordered by leaf hash (equal rows are
interchangeable); a null source is a tree of its own, before all others; an
empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.llm.common import column, map_arrow, ship_package, staged

FANOUT, HEIGHT = 16, 3
BLOCK = FANOUT**HEIGHT
RANGE_ROWS = 250_000
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_TOP = "/"


def leaf_hash(*values: Column) -> Column:
    """SHA-256 of values, each ``-`` if null, else its UTF-8 byte count, ``:`` and itself."""
    parts = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def lowered(text: Column) -> Column:
    """A-Z of a text as a-z, everything else unchanged."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tampered(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def leaves(docs: DataFrame, changed: Column, new_text: Column) -> DataFrame:
    """(tree, doc_id, hash, new_hash): leaf hashes; ``new_hash`` only where ``changed``."""
    d = docs.select(*(F.col(c).cast("long" if c in ("doc_id", "n_chars") else "string").alias(c) for c in FIELDS))
    tree = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    return d.select(tree.alias("tree"), "doc_id", leaf_hash(*(F.col(c) for c in FIELDS)).alias("hash"),
                    F.when(changed, leaf_hash(*(new_text if c == "text" else F.col(c) for c in FIELDS))).alias("new_hash"))


def positions(nodes: DataFrame, order: list[str], name: str) -> DataFrame:
    """``nodes`` (a written table) with ``position`` (from 0, in the order of ``order``) and ``n`` (size) in their tree."""
    spark = nodes.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-nodes.count() // RANGE_ROWS))
    salted = nodes.withColumn("_salt", F.monotonically_increasing_id())
    dealt = (salted.repartitionByRange(ranges, F.col("tree"), *(F.col(c).asc_nulls_first() for c in order), F.col("_salt"))
             .sortWithinPartitions(F.col("tree"), *(F.col(c).asc_nulls_first() for c in order), F.col("_salt"))
             .withColumn("_place", F.monotonically_increasing_id()).drop("_salt"))
    dealt = staged(dealt, name).withColumn("_range", F.shiftright("_place", 33))
    tree = Window.partitionBy("tree")
    spans = (dealt.groupBy("tree", "_range").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
             .withColumn("_before", F.coalesce(F.sum("_rows").over(tree.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             .withColumn("n", F.sum("_rows").over(tree)))
    return (dealt.join(spans, ["tree", "_range"])
            .withColumn("position", F.col("_place") - F.col("_first") + F.col("_before"))
            .drop("_range", "_place", "_first", "_rows", "_before"))


def _levels(nodes: list[bytes], n: int) -> list[list[bytes]]:
    """A block's nodes and the levels above, up to three and until its tree (n nodes where the block starts) has one node."""
    out = [nodes]
    while n > 1 and len(out) <= HEIGHT:
        low = out[-1]
        out.append([sha256(b"".join(low[i:i + FANOUT])).hexdigest().encode() for i in range(0, len(low), FANOUT)])
        n = -(-n // FANOUT)
    return out


def _siblings(levels: list[list[bytes]], i: int) -> tuple[list[bytes], list[bytes]]:
    """Joined siblings left and right of node i of the lowest level and of its ancestors, level by level."""
    left, right = [], []
    for level in levels[:-1]:
        start = i - i % FANOUT
        left.append(b"".join(level[start:i]))
        right.append(b"".join(level[i + 1:start + FANOUT]))
        i //= FANOUT
    return left, right


def copied_path(node: bytes, left: list[bytes], right: list[bytes]) -> list[bytes]:
    """The nodes that a version owns: the new node and copies of all its ancestors, up to the root."""
    out = [node]
    for a, b in zip(left, right, strict=True):
        out.append(sha256(a + out[-1] + b).hexdigest().encode())
    return out


_PATH = "left array<string>, right array<string>"
_BLOCK = "tree string, n long, block long, root string, ids array<long>, names array<string>, nodes array<string>, changed array<string>"


def _blocks(nodes: DataFrame, name: str) -> DataFrame:
    """One row for each aligned block of nodes (tree, n, position, doc_id, name, hash, new_hash)."""
    def block(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("position")
        n = table.column("n")[0].as_py()
        hashes = table.column("hash").to_pylist()
        top = _levels([h.encode() for h in hashes], n)[-1]
        row = {"tree": key[0].as_py(), "n": n, "block": key[1].as_py(), "root": top[0].decode(), "ids": table.column("doc_id").to_pylist(),
               "names": table.column("name").to_pylist(), "nodes": hashes, "changed": table.column("new_hash").to_pylist()}
        return pa.Table.from_pylist([row], schema)

    text = pa.string()
    schema = pa.schema([("tree", text), ("n", pa.int64()), ("block", pa.int64()), ("root", text), ("ids", pa.list_(pa.int64())),
                        ("names", pa.list_(text)), ("nodes", pa.list_(text)), ("changed", pa.list_(text))])
    ship_package(nodes.sparkSession)
    dealt = nodes.withColumn("block", F.floor(F.col("position") / BLOCK).cast("long"))
    return staged(dealt.groupBy("tree", "block").applyInArrow(block, _BLOCK), name)


def _climb(nodes: DataFrame, name: str) -> list[DataFrame]:
    """Blocks of all rounds, from the nodes up; a tree ends in the round where ``n`` fits one block."""
    rounds = [_blocks(nodes, name)]
    none = F.lit(None).cast("string")
    while rounds[-1].filter(F.col("n") > BLOCK).limit(1).count():
        upper = rounds[-1].filter(F.col("n") > BLOCK).select(
            "tree", F.ceil(F.col("n") / BLOCK).cast("long").alias("n"), F.col("block").alias("position"),
            F.lit(None).cast("long").alias("doc_id"), none.alias("name"), F.col("root").alias("hash"), none.alias("new_hash"))
        rounds.append(_blocks(upper, name))
    return rounds


def _roots(rounds: list[DataFrame]) -> DataFrame:
    """(tree, root) of every tree."""
    ended = [r.filter(F.col("n") <= BLOCK).select("tree", "root") for r in rounds]
    return reduce(DataFrame.unionAll, ended)


def _lists(batch: pa.RecordBatch, row: int, *names: str) -> list[list]:
    return [column(batch, c)[row].as_py() for c in names]


def _node_paths(blocks: DataFrame) -> DataFrame:
    """Each node of blocks (with the path of their root): (tree, block: its position, name, subroot, all, left, right)."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                tree, n, at, names, nodes, subroot, whole, left, right = _lists(
                    batch, row, "tree", "n", "block", "names", "nodes", "subroot", "all", "left", "right")
                levels = _levels([x.encode() for x in nodes], n)
                paths = [_siblings(levels, i) for i in range(len(nodes))]
                count = len(nodes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tree] * count, pa.string()), pa.array(range(at * BLOCK, at * BLOCK + count), pa.int64()),
                     pa.array(names, pa.string()), pa.array([subroot] * count, pa.string()), pa.array([whole] * count, pa.string()),
                     *(pa.array([[x.decode() for x in own[side]] + upper for own in paths], pa.list_(pa.string()))
                       for side, upper in ((0, left), (1, right)))],
                    names=["tree", "block", "name", "subroot", "all", "left", "right"])

    return map_arrow(blocks, step, f"tree string, block long, name string, subroot string, all string, {_PATH}")


def _with_paths(blocks: DataFrame, ended: DataFrame, carried: DataFrame | None) -> DataFrame:
    """Blocks with the path of their root: ``ended`` (by tree) where the tree ends here, else ``carried`` (by tree and block)."""
    out = blocks.filter(F.col("n") <= BLOCK).join(ended, "tree")
    if carried is not None:
        out = out.unionByName(blocks.filter(F.col("n") > BLOCK).join(carried.drop("name"), ["tree", "block"]))
    return out


def _descend(rounds: list[DataFrame], ended: DataFrame, name: str) -> DataFrame:
    """The lowest round's blocks with the paths of their roots to the root of all."""
    carried = None
    for r in reversed(rounds[1:]):
        carried = staged(_node_paths(_with_paths(r, ended, carried)), name)
    return _with_paths(rounds[0], ended, carried)


def _finish(blocks: DataFrame) -> DataFrame:
    """Proofs and versions of all leaves of the lowest blocks."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                n, ids, names, nodes, changed, subroot, whole, left, right = _lists(
                    batch, row, "n", "ids", "names", "nodes", "changed", "subroot", "all", "left", "right")
                nodes = [x.encode() for x in nodes]
                levels = _levels(nodes, n)
                left, right = ([x.encode() for x in side] for side in (left, right))
                above = b"".join(a + b for a, b in zip(left, right, strict=True))
                proofs, versions = [], []
                for i, new in enumerate(changed):
                    own_left, own_right = _siblings(levels, i)
                    proofs.append(sha256(b"".join(a + b for a, b in zip(own_left, own_right, strict=True)) + above).hexdigest())
                    path = copied_path(new.encode() if new else nodes[i], own_left + left, own_right + right)
                    versions.append([x.decode() for x in path])
                count = len(nodes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array([x.decode() for x in nodes]), pa.array([subroot] * count), pa.array([whole] * count),
                     pa.array(proofs), pa.array([v[-1] for v in versions]),
                     pa.array([v if new else None for v, new in zip(versions, changed, strict=True)], pa.list_(pa.string()))],
                    names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "version"])

    return map_arrow(blocks, step, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
                                   "version array<string>")


def manifest(docs: DataFrame, changed: Column, new_text: Column) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, version of every row.

    docs: doc_id, source, lang, n_chars, text.  ``changed`` names the rows that
    make a version of the tree, ``new_text`` is their text in it; ``version``
    lists the nodes that this version does not share, from the leaf to its root.
    """
    none = F.lit(None).cast("string")
    found = staged(leaves(docs, changed, new_text), "merkle-leaves")
    placed = positions(found, ["doc_id", "hash"], "merkle-order").withColumn("name", none)
    rounds = _climb(placed, "merkle-blocks")
    roots = staged(_roots(rounds).select(F.lit(_TOP).alias("tree"), F.col("tree").alias("name"), F.col("root").alias("hash")), "merkle-roots")
    sources = positions(roots, ["name"], "merkle-sources").withColumns(
        {"doc_id": F.lit(None).cast("long"), "new_hash": none})
    top = _climb(sources, "merkle-top")
    nothing = F.array().cast("array<string>")
    whole = top[-1].select("tree", none.alias("subroot"), F.col("root").alias("all"), nothing.alias("left"), nothing.alias("right"))
    above = staged(_node_paths(_descend(top, whole, "merkle-paths")), "merkle-paths")
    above = (above.select(F.col("name").alias("tree"), "all", "left", "right")
             .join(roots.select(F.col("name").alias("tree"), F.col("hash").alias("subroot")), "tree"))
    return _finish(_descend(rounds, above, "merkle-paths"))


def verified_documents(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs`` under tampering: A-Z of every text whose id's CRC-32 is divisible by 5 become a-z."""
    out = manifest(docs, tampered(F.col("doc_id")), lowered(F.col("text")))
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"),
                      F.coalesce(F.size("version"), F.lit(0)).alias("nodes_copied"))
