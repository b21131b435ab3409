"""Sinks and callbacks.

User callbacks are plain ``foreachBatch`` functions ``fn(batch_df,
batch_id)``; the library wraps them so every micro-batch is written
idempotently (keyed by ``batch_id``) before the callback sees it.
"""

from __future__ import annotations

from collections.abc import Callable

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

BatchFn = Callable[[DataFrame, int], None]


def parquet_batch_writer(path: str) -> BatchFn:
    """Append each micro-batch under ``batch_id=<n>``; a replayed batch
    overwrites its own folder (exactly-once output with the checkpoint)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}"))
    return write


def with_callback(sink: BatchFn, callback: BatchFn | None) -> BatchFn:
    """Run the sink, then the user's callback, for every micro-batch;
    the batch is decoded once and kept for both."""
    def run(batch: DataFrame, batch_id: int) -> None:
        if callback is None:
            sink(batch, batch_id)
            return
        batch.persist()
        try:
            sink(batch, batch_id)
            callback(batch, batch_id)
        finally:
            batch.unpersist()
    return run


def start(df: DataFrame, fn: BatchFn, checkpoint: str, output_mode: str = "append",
          available_now: bool = True, name: str | None = None) -> StreamingQuery:
    """Start a ``foreachBatch`` query; ``available_now`` drains the source
    and stops (T8), otherwise it runs until ``query.stop()``."""
    w = df.writeStream.foreachBatch(fn).outputMode(output_mode).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.start()


def latest_from_changes(changes: DataFrame, keys: list[str]) -> DataFrame:
    """Read side of an update-mode change log: the newest row per key."""
    others = [c for c in changes.columns if c not in keys]
    return (changes.groupBy(*keys)
            .agg(F.max_by(F.struct(*others), F.col("batch_id")).alias("_r"))
            .select(*keys, "_r.*").drop("batch_id"))


def _generations(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete generations under ``path``, ascending."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    found = [int(n.split("=")[1]) for n in names if n.startswith("generation=")]
    return sorted(n for n in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/generation={n}/_SUCCESS")))


def latest_table_writer(path: str, keys: list[str]) -> BatchFn:
    """A table of the newest row per key.  Each update-mode micro-batch
    replaces the rows of its keys in a new generation, and readers switch to it
    once it is complete, so reading never touches more than one row per key.
    The generation before stays for readers that have it open, older ones go; a
    replayed batch writes its own generation again from the one before it."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            earlier = [n for n in _generations(spark, path) if n < batch_id]
            rows = batch
            if earlier:
                same = reduce(Column.__and__, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys])
                kept = spark.read.parquet(f"{path}/generation={earlier[-1]}").alias("o").join(batch.select(*keys).alias("n"), same, "left_anti")
                rows = kept.unionByName(batch)
            rows.write.mode("overwrite").parquet(f"{path}/generation={batch_id}")
        finally:
            batch.unpersist()
        for n in earlier[:-1]:
            old = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/generation={n}")
            old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
    return write


def read_latest_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete generation of a ``latest_table_writer``."""
    return spark.read.parquet(f"{path}/generation={_generations(spark, path)[-1]}")
