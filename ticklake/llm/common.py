"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Text bytes that one step inside a task works on at a time.
SLICE_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.

    Only a local session (tests) may leave it unset; it then gets a fresh
    folder.  A cluster without one is an error, since each executor would
    write to a disk of its own.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def staged(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared directory and read it back.

    Cuts the lineage so that neither a lost executor nor a second use
    repeats the work above.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def remove_staged(*tables: DataFrame) -> None:
    """Delete tables of ``staged`` that nothing reads any more."""
    for df in tables:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._staged_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def ship_package(spark: SparkSession) -> None:
    """Let the executors import this package, wherever the driver was started."""
    sc = spark.sparkContext
    if getattr(sc, "_llm_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.basename(root)
    path = os.path.join(tempfile.mkdtemp(prefix="llm-code-"), f"{name}-llm.zip")
    with zipfile.ZipFile(path, "w") as z:
        z.write(os.path.join(root, "__init__.py"), f"{name}/__init__.py")
        here = os.path.join(root, "llm")
        for f in sorted(os.listdir(here)):
            if f.endswith(".py"):
                z.write(os.path.join(here, f), f"{name}/llm/{f}")
    sc.addPyFile(path)
    sc._llm_shipped = True


def map_arrow(df: DataFrame, step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    ship_package(df.sparkSession)
    return df.mapInArrow(step, schema)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", target: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each part holds about ``target`` bytes of text (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size.astype(np.int64)) // target
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def number_rows(df: DataFrame, group: list[str], order: list[str], out: str, per_bucket: int = 50_000,
                rows: int | None = None) -> DataFrame:
    """Number the rows of each group from 0 without a gap.

    A group is cut into hash buckets of about ``per_bucket`` rows, numbered
    apart and shifted by the counts of the buckets before, so that no task
    sees a whole group.  ``df`` must be cheap to read twice and stable (a
    written table).
    """
    n = df.count() if rows is None else rows
    buckets = max(1, -(-n // per_bucket))
    keyed = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shift = (keyed.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
             .withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0)))
             .select(*(F.col(g).alias(f"_g{i}") for i, g in enumerate(group)), F.col("_bucket").alias("_b"), "_shift"))
    inside = Window.partitionBy(*group, "_bucket").orderBy(*order)
    same = F.col("_bucket") == F.col("_b")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return (keyed.withColumn("_row", F.row_number().over(inside) - 1)
            .join(shift, same)
            .withColumn(out, (F.col("_row") + F.col("_shift")).cast("long"))
            .drop("_bucket", "_row", "_shift", "_b", *(f"_g{i}" for i in range(len(group)))))
