"""Conversation prefix trie by truncation peeling.

A conversation is a sequence of turns; its prefix of d turns is a node of depth
d, shared by all conversations that begin with it.  A prefix is known by a
chained 128-bit digest of its turns, so nodes of equal depth compare in 16 bytes.

1. Equal sequences are merged first: ids are sorted in ranges, packed into rows of
   joined decimal ids, and these rows are hashed in order (SHA-256 runs through all
   ids of one sequence, so its packed rows pass one task as a stream).
2. Peeling descends from the deepest turn: conversations that end at depth d join
   the nodes that survive from depth d + 1 without their last turn, equal prefixes
   are grouped, and their sums (members, children, leaves, saved tokens) are final
   at that moment.  Each node is found and aggregated once.
3. Sequences below one prefix are peeled in one task while they hold at most
   ``limit`` turns (or few sequences).  A larger prefix is cut one turn deeper, as
   often as needed; the nodes above the cuts are peeled by Spark, one grouping
   with partial sums for each depth.

Cases: null role or text is empty; turns are ordered by number, nulls first, then
by digest (repeated rows stay); rows with a null conv_id belong to no conversation
and are left out; an empty table has no nodes; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import md5, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import column, map_arrow, staged

KEY = 16
LIMIT, FEW = 1_000_000, 64
CHUNK_TURNS, IDS_PER_ROW = 200_000, 4096
WORD = r"[^\x20\x09-\x0D]+"
NO_ENDS = sha256(b"").hexdigest()
_NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
         "ends_sha256 string")
_SUMS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as digest ``d`` of role and text and number of words ``w`` of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long"),
        F.struct(F.col("turn").cast("long").alias("turn"), digest.alias("d"), F.regexp_count(text, F.lit(WORD)).alias("w")).alias("turn"))
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))


def share_heads(found: DataFrame, family: int = 20, spread: int = 4) -> DataFrame:
    """Conversations rebuilt: each begins with the first h turns of the first one of its family (id - id % family), and goes on with
    its own turns after its first h; h is the CRC-32 of its id modulo ``spread``."""
    found = staged(found, "turns")
    first = F.col("conv_id") - F.col("conv_id") % family
    heads = (found.filter(F.col("conv_id") % family == 0)
             .select(F.col("conv_id").alias("_first"), F.slice("turns", 1, spread - 1).alias("_head")))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % spread).cast("int")
    none = F.array().cast(found.schema["turns"].dataType)
    turns = F.concat(F.coalesce(F.slice("_head", F.lit(1), h), none), F.slice("turns", h + 1, F.size("turns")))
    return found.join(heads, first == F.col("_first"), "left").select("conv_id", turns.alias("turns"))


def _chained(found: DataFrame) -> DataFrame:
    """(conv_id, length, last, keys, words): digests of all prefixes and words of all turns, packed."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, words = column(batch, "d"), column(batch, "w")
            rows = []
            for i in range(batch.num_rows):
                key, keys = b"", []
                for digest in digests[i].as_py():
                    key = md5(key + digest).digest()
                    keys.append(key)
                rows.append((len(keys), key, b"".join(keys), np.array(words[i].as_py(), "<i4").tobytes()))
            length, last, keys, sizes = zip(*rows, strict=True) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [column(batch, "conv_id"), pa.array(length, pa.int64()), *(pa.array(x, pa.binary()) for x in (last, keys, sizes))],
                names=["conv_id", "length", "last", "keys", "words"])

    flat = found.select("conv_id", F.transform("turns", lambda t: t["d"]).alias("d"), F.transform("turns", lambda t: t["w"]).alias("w"))
    return map_arrow(flat, step, "conv_id long, length long, last binary, keys binary, words binary")


def _merged(chained: DataFrame, ids_per_row: int) -> DataFrame:
    """One row for each different sequence: (last, length, n, conv_id: the smallest, ends: digest of all its ids, keys, words)."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, last = column(batch, "conv_id").to_pylist(), column(batch, "last").to_pylist()
            cuts, at = [], 0
            for i in range(1, len(ids) + 1):
                if i == len(ids) or last[i] != last[at] or i - at == ids_per_row:
                    cuts.append((at, i))
                    at = i
            first = pa.array([a for a, _ in cuts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([last[a] for a, _ in cuts], pa.binary()), column(batch, "conv_id").take(first),
                 pa.array([b - a for a, b in cuts], pa.int64()), pa.array([",".join(map(str, ids[a:b])) for a, b in cuts]),
                 *(column(batch, c).take(first) for c in ("length", "keys", "words"))],
                names=["last", "conv_id", "n", "ids", "length", "keys", "words"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, hashed = None, None
        schema = pa.schema([("last", pa.binary()), ("length", pa.int64()), ("n", pa.int64()), ("conv_id", pa.int64()),
                            ("ends", pa.string()), ("keys", pa.binary()), ("words", pa.binary())])
        for batch in batches:
            done = []
            for new in batch.to_pylist():
                if row and new["last"] == row["last"]:
                    row["n"] += new["n"]
                    hashed.update(b"," + new["ids"].encode())
                    continue
                if row:
                    done.append(row | {"ends": hashed.hexdigest()})
                row, hashed = new, sha256(new["ids"].encode())
            yield pa.RecordBatch.from_pylist(done, schema)
        if row:
            yield pa.RecordBatch.from_pylist([row | {"ends": hashed.hexdigest()}], schema)

    spark = chained.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = chained.repartitionByRange(ranges, "last", "conv_id").sortWithinPartitions("last", "conv_id")
    packed = map_arrow(ordered, pack, "last binary, conv_id long, n long, ids string, length long, keys binary, words binary")
    by_sequence = packed.repartition(F.col("last")).sortWithinPartitions("last", "conv_id")
    return map_arrow(by_sequence, digest, "last binary, length long, n long, conv_id long, ends string, keys binary, words binary")


def _prefix(d: int, name: str = "keys") -> Column:
    return F.substring(name, 1, KEY * d)


def _cut(items: DataFrame, limit: int) -> tuple[DataFrame, DataFrame | None, int]:
    """(sequences with the depth ``cut`` of the prefix they are peeled under, those that end above every cut, the deepest cut)."""
    rest, cut, above, d = items.filter("length > 0"), [], [], 1
    while True:
        large = staged(rest.groupBy(_prefix(d).alias("_large"))
                       .agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col("length") - (d - 1)).alias("_turns"))
                       .filter((F.col("_turns") > limit) & (F.col("_n") > FEW)).select("_large"), "trie-large")
        if not large.limit(1).count():
            cut.append(rest.withColumn("cut", F.lit(d).cast("long")))
            break
        found = staged(rest.join(large, _prefix(d) == F.col("_large"), "left"), "trie-cut")
        deeper = F.col("_large").isNotNull()
        cut.append(found.filter(~deeper).drop("_large").withColumn("cut", F.lit(d).cast("long")))
        above.append(found.filter(deeper & (F.col("length") == d)).drop("_large"))
        rest = found.filter(deeper & (F.col("length") > d)).drop("_large")
        d += 1
    return reduce(DataFrame.unionAll, cut), reduce(DataFrame.unionAll, above) if above else None, d


def _peel(chunk: pa.Table) -> pa.RecordBatch:
    """All nodes from the cuts down of the sequences of whole groups."""
    length, cut, count, conv = (chunk.column(c).to_numpy() for c in ("length", "cut", "n", "conv_id"))
    start = np.cumsum(length) - length
    keys = np.frombuffer(b"".join(chunk.column("keys").to_pylist()), "<u8").reshape(-1, 2)
    words = np.frombuffer(b"".join(chunk.column("words").to_pylist()), "<i4").astype(np.int64)
    order = np.argsort(-length, kind="stable")
    border = np.searchsorted(-length[order], -np.arange(int(length.max(initial=0)) + 2), "right")
    none = np.zeros(0, np.int64)
    alive = {c: none for c in ("item", "n", "conv", "leaves", "saved")}  # nodes one turn deeper, without their last turn
    levels, open_rows = [], None
    for d in range(int(length.max(initial=0)), 0, -1):
        ended = order[border[d + 1]:border[d]]
        item = np.concatenate([alive["item"], ended])
        if not len(item):
            open_rows = None
            continue
        n = np.concatenate([alive["n"], count[ended]])
        low = np.concatenate([alive["conv"], conv[ended]])
        child = np.arange(len(item)) < len(alive["item"])
        key = keys[start[item] + d - 1]
        by = np.lexsort((key[:, 1], key[:, 0]))
        new = np.concatenate([[True], (key[by][1:] != key[by][:-1]).any(axis=1)])
        group = np.empty(len(item), np.int64)
        group[by] = np.cumsum(new) - 1
        first, size = np.flatnonzero(new), int(new.sum())
        rep = item[by][first]
        total = np.add.reduceat(n[by], first)
        smallest = np.minimum.reduceat(low[by], first)
        children = np.bincount(group, child, size).astype(np.int64)
        leaves, saved = np.zeros(size, np.int64), np.zeros(size, np.int64)
        np.add.at(leaves, group[child], alive["leaves"])
        np.add.at(saved, group[child], alive["saved"])
        leaves = np.where(children == 0, 1, leaves)
        saved += (total - 1) * words[start[rep] + d - 1]
        end = np.full(size, -1, np.int64)
        end[group[~child]] = ended
        if open_rows is not None:
            open_rows["parent"][open_rows["alive"]] = smallest[group[child]]
        top = cut[rep] == d
        open_rows = {"conv": smallest, "depth": np.full(size, d), "parent": np.full(size, -1, np.int64), "n": total, "children": children,
                     "leaves": leaves, "saved": saved, "end": end, "top": top, "rep": rep, "alive": ~top}
        levels.append(open_rows)
        alive = {"item": rep[~top], "n": total[~top], "conv": smallest[~top], "leaves": leaves[~top], "saved": saved[~top]}
    rows = {c: np.concatenate([x[c] for x in levels]) if levels else none for c in
            ("conv", "depth", "parent", "n", "children", "leaves", "saved", "end", "top", "rep")}
    top = rows["top"].astype(bool)
    names = chunk.column("ends").to_pylist()
    packed = [[x[start[r]:start[r] + d].tobytes() if t else None for r, d, t in zip(rows["rep"], rows["depth"], top, strict=True)]
              for x in (keys, words.astype("<i4"))]
    return pa.RecordBatch.from_arrays(
        [pa.array(rows["conv"]), pa.array(rows["depth"], pa.int64()), pa.array(rows["parent"], mask=top),
         *(pa.array(rows[c], pa.int64()) for c in ("n", "children", "leaves", "saved")),
         pa.array([names[e] if e >= 0 else NO_ENDS for e in rows["end"]], pa.string()), pa.array(top),
         *(pa.array(x, pa.binary()) for x in packed)],
        names=[*_SUMS, "top", "keys", "words"])


def _peeled(cut: DataFrame, chunk_turns: int) -> DataFrame:
    """Nodes from the cuts down; those at a cut are marked ``top`` and keep the digests and words of their path."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, turns = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            turns += int(column(batch, "length").to_numpy().sum())
            group = column(batch, "group").to_pylist()
            whole = next((i for i in range(len(group) - 1, 0, -1) if group[i] != group[i - 1]), 0)
            if turns >= chunk_turns and whole:
                held[-1] = batch.slice(0, whole)
                yield _peel(pa.Table.from_batches(held))
                held = [batch.slice(whole)]
                turns = int(column(held[0], "length").to_numpy().sum())
        if held:
            yield _peel(pa.Table.from_batches(held))

    group = F.substring("keys", KEY * (F.col("cut") - 1) + 1, F.lit(KEY))
    dealt = cut.select(group.alias("group"), "cut", "length", "n", "conv_id", "ends", "keys", "words").repartition(F.col("group"))
    return map_arrow(dealt.sortWithinPartitions("group"), step, f"{_NODE}, top boolean, keys binary, words binary")


def _grouped(children: DataFrame, ended: DataFrame | None, d: int) -> DataFrame:
    """Nodes of depth d: children without their last turn, and sequences that end here, grouped by their prefix."""
    stripped = children.select(
        _prefix(d).alias("keys"), F.substring("words", 1, 4 * d).alias("words"), "n_convs", "conv_id", F.lit(1).cast("long").alias("child"),
        "n_leaves", "saved_tokens", F.lit(None).cast("string").alias("ends"))
    if ended is not None:
        none = F.lit(0).cast("long")
        stripped = stripped.unionAll(ended.filter(F.col("length") == d).select(
            "keys", "words", F.col("n"), "conv_id", none, none, none, "ends"))
    word = [F.conv(F.hex(F.substring("words", 4 * (d - 1) + i, 1)), 16, 10).cast("long") * 256 ** (i - 1) for i in (1, 2, 3, 4)]
    return stripped.groupBy("keys", "words").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("child").alias("n_children"),
        F.sum("n_leaves").alias("_leaves"), F.sum("saved_tokens").alias("_saved"), F.max("ends").alias("ends")).select(
        "conv_id", F.lit(d).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children",
        F.when(F.col("n_children") == 0, 1).otherwise(F.col("_leaves")).cast("long").alias("n_leaves"),
        (F.col("_saved") + (F.col("n_convs") - 1) * reduce(Column.__add__, word)).alias("saved_tokens"),
        F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"), F.lit(True).alias("top"), "keys", "words")


def prefix_trie(found: DataFrame, limit: int = LIMIT, chunk_turns: int = CHUNK_TURNS, ids_per_row: int = IDS_PER_ROW) -> DataFrame:
    """All nodes of the trie of ``found`` (conv_id, turns): conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.  The root has depth 0."""
    spark = found.sparkSession
    items = staged(_merged(staged(_chained(found), "trie-chained"), ids_per_row), "trie-items")
    cut, above, deepest = _cut(items, limit)
    peeled = staged(_peeled(cut, chunk_turns), "trie-nodes")
    out = [peeled.filter("NOT top").select(*_SUMS)]
    level = peeled.filter(F.col("top") & (F.col("depth") == deepest))
    for d in range(deepest - 1, 0, -1):
        parents = staged(_grouped(level, above, d), "trie-level")
        own = parents.select(F.col("keys").alias("_parent"), F.col("conv_id").alias("_smallest"))
        out.append(level.drop("parent_conv_id").withColumn("_path", _prefix(d)).join(own, F.col("_path") == F.col("_parent"))
                   .withColumn("parent_conv_id", F.col("_smallest")).select(*_SUMS))
        level = parents.unionByName(peeled.filter(F.col("top") & (F.col("depth") == d)))
    turnless = items.filter("length = 0").select("conv_id", F.col("n").alias("n_convs"), F.lit(0).cast("long").alias("child"),
                                                 F.lit(0).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), "ends")
    root = (level.select("conv_id", "n_convs", F.lit(1).cast("long"), "n_leaves", "saved_tokens", F.lit(None).cast("string"))
            .toDF(*turnless.columns).unionAll(turnless)
            .agg(F.min("conv_id"), F.sum("n_convs"), F.sum("child"), F.sum("n_leaves"), F.sum("saved_tokens"), F.max("ends")).first())
    if root[0] is None:
        return spark.createDataFrame([], _NODE)
    out.append(level.withColumn("parent_conv_id", F.lit(root[0]).cast("long")).select(*_SUMS))
    out.append(spark.createDataFrame([(root[0], 0, None, root[1], root[2], root[3] if root[2] else 1, root[4], root[5] or NO_ENDS)], _NODE))
    return reduce(DataFrame.unionAll, out)
