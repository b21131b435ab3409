"""Continuous price pipeline (T1-T4, T7, T8, B15) on Structured Streaming.

* ``latest_state_stream`` (T3, the default): decode -> stream-static join
  with the master -> ``groupBy(key).agg(max_by ...)`` in **update** mode.
  JVM-only; the state store keeps one fixed-width aggregate row per instrument
  and partial aggregation runs before the shuffle, so a hot instrument costs a
  few partial rows per task.  A control stream resets keys (re-subscription) or,
  without a key, all of them (reconnect); the later of write and reset wins.
* ``snapshot_stream`` + ``snapshot_writer`` (T2): one full record per packet.
  Every micro-batch runs the batch operator ``tick_snapshots`` - which cuts a
  hot key into buckets - started from the state that the batch before left in
  a small table of typed rows, and writes its own snapshots and state.
* ``with_quarantine`` (B15): good and rejected packets of one decoding go to
  two sinks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import decode
from ..operators.ticks import (ORD, STATE_COLS, finish_latest, latest_aggregate, state_seeds,  # noqa: F401
                               tick_snapshots)
from .sinks import BatchFn


def decoded_stream(frames: DataFrame, master: DataFrame) -> DataFrame:
    """T1 stateless part: split + decode + resolve (good and bad rows)."""
    return decode.price_packets(frames, master)


def latest_state_stream(frames: DataFrame, master: DataFrame, control: DataFrame | None = None) -> DataFrame:
    """Streaming aggregate of the conflated state (hash-aggregated,
    fixed-width state rows); run in update mode, finish with
    ``finish_latest`` on the sink side (``resets=True`` with a control stream)."""
    return latest_aggregate(decode.good(decoded_stream(frames, master)), control)


# ---------------------------------------------------------------------------
# Per-packet snapshots, each micro-batch seeded with the state before it
# ---------------------------------------------------------------------------

_PACKET = ["instrument_key", "decimals", *ORD, "packet_type", *STATE_COLS, "depth_buy", "depth_sell"]


def snapshot_stream(good: DataFrame, control: DataFrame | None = None) -> DataFrame:
    """T2 input: good packets and, marked by ``control_ts``, control rows of a second stream."""
    packets = good.select(*_PACKET, F.lit(None).cast("timestamp_ntz").alias("control_ts"))
    if control is None:
        return packets
    return packets.unionByName(control.where(F.col("ts").isNotNull()).select(
        "instrument_key", F.col("ts").cast("timestamp_ntz").alias("control_ts")), allowMissingColumns=True)


def snapshot_writer(out: str, state: str, rows_per_bucket: int | None = None) -> BatchFn:
    """T2 sink: the snapshots of each micro-batch under ``out``/batch_id=n, the
    state after it under ``state``/batch_id=n, started from batch n - 1.  A
    replayed batch overwrites its own folders, so output and state stay those
    of one pass; rows of a batch are ordered by arrival, batches as they come."""
    options = {} if rows_per_bucket is None else {"rows_per_bucket": rows_per_bucket}

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            good = batch.where(F.col("control_ts").isNull())
            control = batch.where(F.col("control_ts").isNotNull()).select("instrument_key", F.col("control_ts").alias("ts"))
            earlier, seen = None, 0
            if batch_id > 0:
                before = spark.read.parquet(f"{state}/batch_id={batch_id - 1}")
                earlier = before.where(F.col("instrument_key").isNotNull())
                seen = before.where(F.col("instrument_key").isNull()).agg(F.max("is_reset")).first()[0]
            snaps = tick_snapshots(good, control, seeds=earlier, reconnects=seen, **options)
            snaps.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
            after = state_seeds(good, control, earlier, seen)
            reconnects = control.where(F.col("instrument_key").isNull()).agg((F.count("ts") + seen).alias("is_reset"))
            (after.unionByName(reconnects.withColumns({"instrument_key": F.lit(None).cast("string"), "bucket": F.lit(0).cast("long")}),
                               allowMissingColumns=True)
             .write.mode("overwrite").parquet(f"{state}/batch_id={batch_id}"))
        finally:
            batch.unpersist()
    return write


# ---------------------------------------------------------------------------
# Rejected packets
# ---------------------------------------------------------------------------

def with_quarantine(good_sink: BatchFn, reject_sink: BatchFn) -> BatchFn:
    """Two outputs of one decoding: a micro-batch of decoded packets (prices or
    orders) is kept once, its good rows go to one sink, place and reason of the
    rejected ones to the other.  Both sinks key their output by the batch, so a
    replay repeats neither."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            good_sink(decode.good(batch).drop("error"), batch_id)
            reject_sink(decode.quarantine(batch), batch_id)
        finally:
            batch.unpersist()
    return write
