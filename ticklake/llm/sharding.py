"""Sharding: a k-d tree over metadata, cut at distributed weighted medians.

Coordinates are whole numbers: 20 bits of the dimension (scaled logarithm of
the size, or a hash of source / language) above 40 tie bits from the row, so
that a cut can fall inside a value that a third of all rows share.  Each level
cuts every node along its widest dimension where the bytes on the left reach
the node's share; the cut is found by histogram refinement (four rounds of 15
bits), so the driver only ever sees one number per node.

Cases: a null text has size 1; null metadata has coordinate 0; equal rows may
share their tie bits and then stay together; fewer rows than shards leave
shards empty; an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.llm.common import number_rows, staged

CODE_BITS, TIE_BITS, STEP_BITS = 20, 40, 15
DIMENSIONS = ("size", "source", "lang")


def _code(name: str) -> Column:
    if name == "size":
        return F.least(F.floor(F.log2(F.col("size").cast("double")) * 16384), F.lit(2**CODE_BITS - 1)).cast("long")
    return F.when(F.col(name).isNull(), F.lit(0)).otherwise(F.shiftrightunsigned(F.xxhash64(name), 64 - CODE_BITS)).cast("long")


def metadata(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes plus 1), text_crc32 and a coordinate per dimension."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    df = docs.select("doc_id", "source", "lang", (F.octet_length(text) + 1).cast("long").alias("size"),
                     F.crc32(text.cast("binary")).alias("text_crc32"))
    tie = F.shiftrightunsigned(F.xxhash64("doc_id", "text_crc32", "size"), 64 - TIE_BITS)
    return df.select("doc_id", "size", "text_crc32",
                     *(F.shiftleft(_code(d), TIE_BITS).bitwiseOR(tie).alias(f"_{d}") for d in DIMENSIONS))


def _case(values: dict[int, object], kind: str) -> Column:
    out = F.lit(None).cast(kind)
    for node, value in values.items():
        out = F.when(F.col("_node") == node, F.lit(value).cast(kind)).otherwise(out)
    return out


def _cuts(rows: DataFrame, axis: dict[int, str], target: dict[int, float]) -> dict[int, int]:
    """Per node the coordinate from which on rows go right."""
    position = F.lit(None).cast("long")
    for node, d in axis.items():
        position = F.when(F.col("_node") == node, F.col(f"_{d}")).otherwise(position)
    rows = rows.filter(F.col("_node").isin(list(axis))).select("_node", "size", position.alias("_at"))
    low, before = dict.fromkeys(axis, 0), dict.fromkeys(axis, 0)
    after: dict[int, int] = {}
    for shift in range(CODE_BITS + TIE_BITS - STEP_BITS, -1, -STEP_BITS):
        bucket = F.shiftright(F.col("_at"), shift)
        part = rows if shift + STEP_BITS >= CODE_BITS + TIE_BITS else rows.filter(
            F.shiftright(F.col("_at"), shift + STEP_BITS) == _case({k: v >> (shift + STEP_BITS) for k, v in low.items()}, "long"))
        run = Window.partitionBy("_node").orderBy("_b")
        sums = (part.groupBy("_node", bucket.alias("_b")).agg(F.sum("size").alias("_w"))
                .withColumn("_sum", F.sum("_w").over(run) + _case(before, "long")))
        found = (sums.filter(F.col("_sum") >= _case(target, "double")).groupBy("_node")
                 .agg(F.min(F.struct("_b", "_w", "_sum")).alias("x")).select("_node", "x.*").collect())
        for r in found:
            low[r["_node"]] = r["_b"] << shift
            before[r["_node"]], after[r["_node"]] = r["_sum"] - r["_w"], r["_sum"]
    # the row where the share is reached goes to the side that is left nearer to its share
    return {k: low[k] + 1 if after.get(k, 0) - target[k] <= target[k] - before[k] else low[k] for k in axis}


def kd_shards(rows: DataFrame, target_bytes: int | None = None, shards: int | None = None) -> DataFrame:
    """Add ``shard`` to a written ``metadata`` table: leaves of about ``target_bytes``, or ``shards`` equal leaves."""
    if shards is None:
        total = rows.agg(F.sum("size")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    leaves = {0: shards}  # node -> shards below it; a node is named by its first shard
    df = rows.withColumn("_node", F.lit(0))
    while any(n > 1 for n in leaves.values()):
        spans = df.groupBy("_node").agg(F.sum("size").alias("w"), *(
            f(F.shiftright(f"_{d}", TIE_BITS)).alias(f"{name}_{d}") for d in DIMENSIONS for name, f in (("lo", F.min), ("hi", F.max)))).collect()
        if len(leaves) == 1 and spans:
            whole = {d: max(1, spans[0][f"hi_{d}"] - spans[0][f"lo_{d}"]) for d in DIMENSIONS}
        axis, target = {}, {}
        for r in spans:
            n = leaves[r["_node"]]
            if n > 1:
                axis[r["_node"]] = max(DIMENSIONS, key=lambda d, r=r: (r[f"hi_{d}"] - r[f"lo_{d}"]) / whole[d])
                target[r["_node"]] = r["w"] * (n // 2) / n
        if not axis:
            break
        right = F.lit(0)
        for node, cut in _cuts(df, axis, target).items():
            right = F.when((F.col("_node") == node) & (F.col(f"_{axis[node]}") >= cut), F.lit(leaves[node] // 2)).otherwise(right)
        df = df.withColumn("_node", F.col("_node") + right)
        leaves = {k: v for node, n in leaves.items() for k, v in (
            ((node, n // 2), (node + n // 2, n - n // 2)) if n > 1 else ((node, n),))}
    return df.withColumnRenamed("_node", "shard")


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of all documents (law: near-equal bytes)."""
    placed = staged(kd_shards(staged(metadata(docs), "metadata"), shards=shards).select(
        "doc_id", "size", "text_crc32", F.col("shard").cast("int")), "shards")
    return number_rows(placed, ["shard"], ["doc_id", "text_crc32", "size"], "slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
