"""Streaming state carried across micro-batches equals the batch result."""

import os
import time

from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import SF0001
from ticklake.operators import decode, ticks
from ticklake.session import scratch_path
from ticklake.sources import fixtures as fx
from ticklake.sources.frames import FRAME_SCHEMA, stream_frames
from ticklake.streaming.sinks import latest_from_changes, parquet_batch_writer, start
from ticklake.streaming.ticks import decoded_stream, finish_latest, latest_state_stream, snapshot_stream, snapshot_writer

COLS = ["instrument_key", "frame_id", "packet_seq", "epoch", "ltp", "prev_close", "open_interest",
        "last_trade_time", "best_bid_price", "change", "open_interest_chg", "total_bid_qty_prcnt"]


def _land_in_order(spark, frames, parts=4):
    """Write frames as ``parts`` files, one write per arrival-order range, so
    file modification order equals arrival order."""
    path = scratch_path(spark, "ordered-frames")
    # test-only: a global ntile over a small fixture to cut arrival-order ranges
    ranked = frames.withColumn("_part", F.ntile(parts).over(Window.orderBy("recv_ts", "frame_id")))
    for i in range(1, parts + 1):
        ranked.where(F.col("_part") == i).drop("_part").coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)
    return path


def test_multi_batch_streams_match_batch(spark):
    m = fx.fixture_master(spark, SF0001)
    frames = fx.fixture_price_frames(spark, SF0001, m)
    path = _land_in_order(spark, frames)
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 4

    # T2 across micro-batches (one file per trigger)
    snaps = snapshot_stream(decode.good(decoded_stream(stream_frames(spark, path, max_files_per_trigger=1), m)))
    out = scratch_path(spark, "snap-out")
    q = start(snaps, snapshot_writer(out, scratch_path(spark, "snap-state")), scratch_path(spark, "snap-ckpt"))
    q.awaitTermination()
    batches = spark.read.parquet(out).select("batch_id").distinct().count()
    assert batches >= 2
    got = spark.read.parquet(out).select(*COLS)
    good = decode.good(decode.price_packets(spark.read.schema(FRAME_SCHEMA).parquet(path), m))
    want = ticks.tick_snapshots(good, materialize=False).select(*COLS)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0

    # T3 across micro-batches
    agg = latest_state_stream(stream_frames(spark, path, max_files_per_trigger=1), m)
    out2 = scratch_path(spark, "latest-out")
    q = start(agg, parquet_batch_writer(out2), scratch_path(spark, "latest-ckpt"), output_mode="update")
    q.awaitTermination()
    lat = finish_latest(latest_from_changes(spark.read.parquet(out2), ["instrument_key"]))
    cols = [c for c in COLS if c not in ("frame_id", "packet_seq", "epoch")]
    want2 = ticks.latest_state(good).select(*cols)
    assert lat.select(*cols).exceptAll(want2).count() == 0 and want2.exceptAll(lat.select(*cols)).count() == 0


def test_order_stream_callback_sees_every_order(spark):
    from ticklake.operators import orders
    from ticklake.sources.frames import write_frames
    from ticklake.streaming.orders import order_stream
    from ticklake.streaming.sinks import with_callback
    m = fx.fixture_master(spark, SF0001)
    path = scratch_path(spark, "cb-order-frames")
    write_frames(fx.fixture_order_frames(spark, SF0001, m), path, files=3)
    seen = []

    def on_order_update(batch, batch_id):          # X1: a user callback per micro-batch
        per_frame = orders.orders_by_frame(batch.select("frame_id", "packet_seq", "recv_ts", "order_no"))
        seen.append((batch_id, batch.count(), per_frame.count()))

    out = scratch_path(spark, "cb-out")
    q = start(order_stream(stream_frames(spark, path, max_files_per_trigger=1), m),
              with_callback(parquet_batch_writer(out), on_order_update), scratch_path(spark, "cb-ckpt"))
    q.awaitTermination()
    n_orders = fx.read_table(spark, SF0001, "orders").count()
    assert sum(n for _, n, _ in seen) == n_orders == spark.read.parquet(out).count()
    assert sum(f for _, _, f in seen) == (n_orders + 1) // 2      # two orders per frame
    assert len(seen) >= 2


def test_streams_with_resets_over_several_batches(spark):
    """A key of a third of all packets, resets and reconnects: snapshots of each batch start from the state before it."""
    from ticklake.streaming.sinks import latest_table_writer, read_latest_table
    m = fx.fixture_master(spark, SF0001)
    good = decode.good(decode.price_packets(fx.fixture_price_frames(spark, SF0001, m), m))
    hot = F.when(F.col("frame_id") % 3 == 0, F.lit("HOT-D-NSE")).otherwise(F.col("instrument_key"))
    good = good.withColumns({"instrument_key": hot, "decimals": F.when(F.col("frame_id") % 3 == 0, 2).otherwise(F.col("decimals"))})
    events = fx.read_table(spark, SF0001, "events")
    log = fx.subscription_log(events, m).unionByName(fx.reconnect_log(events)).select("ts", "instrument_key")
    rows = snapshot_stream(good, log)
    path = scratch_path(spark, "ordered-rows")
    ranked = rows.withColumn("_at", F.coalesce("control_ts", "recv_ts")).withColumn("_part", F.ntile(4).over(Window.orderBy("_at")))
    # rows of one time stay in one file: batches are cut between times
    ranked = ranked.withColumn("_part", F.min("_part").over(Window.partitionBy("_at"))).persist()
    for i in range(1, 5):
        ranked.where(F.col("_part") == i).drop("_part", "_at").coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
    out, state = scratch_path(spark, "seeded-out"), scratch_path(spark, "seeded-state")
    start(stream, snapshot_writer(out, state, rows_per_bucket=60), scratch_path(spark, "seeded-ckpt")).awaitTermination()
    got = spark.read.parquet(out)
    assert got.select("batch_id").distinct().count() == 4
    cols = [*COLS, "depth_buy", "depth_sell"]
    want = ticks.tick_snapshots(good, log).select(*cols)
    assert got.count() == want.count()
    assert got.select(*cols).exceptAll(want).count() == 0

    table = scratch_path(spark, "latest-table")
    changes = ticks.latest_aggregate(
        spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path).where("control_ts IS NULL"),
        spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path).where("control_ts IS NOT NULL")
        .select(F.col("control_ts").alias("ts"), "instrument_key"))
    start(changes, latest_table_writer(table, ["instrument_key"]), scratch_path(spark, "table-ckpt"), output_mode="update").awaitTermination()
    last = read_latest_table(spark, table)
    keys = log.select("instrument_key").union(good.select("instrument_key")).distinct().count()
    assert last.count() == keys and len([d for d in os.listdir(table) if d.startswith("generation=")]) == 2
    wanted = ticks.latest_state(good, log)
    assert finish_latest(last, resets=True).exceptAll(wanted).count() == 0 and last.where("instrument_key IS NOT NULL").count() == wanted.count()


def test_good_and_rejected_make_all_packets(spark):
    from ticklake.sources.frames import write_frames
    from ticklake.streaming.ticks import with_quarantine
    m = fx.fixture_master(spark, SF0001)
    frames = fx.fixture_price_frames(spark, SF0001, m).unionByName(fx.malformed_price_frames(fx.read_table(spark, SF0001, "events"), m))
    path, kept, bad = (scratch_path(spark, n) for n in ("mixed", "mixed-good", "mixed-bad"))
    write_frames(frames, path)
    start(decoded_stream(stream_frames(spark, path, max_files_per_trigger=1), m), with_quarantine(parquet_batch_writer(kept), parquet_batch_writer(bad)),
          scratch_path(spark, "mixed-ckpt")).awaitTermination()
    packets = decode.price_packets(spark.read.schema(FRAME_SCHEMA).parquet(path), m)
    assert spark.read.parquet(kept).count() + spark.read.parquet(bad).count() == packets.count()
    rejected = spark.read.parquet(bad).select("frame_id", "packet_seq", "reason")
    assert rejected.exceptAll(decode.quarantine(packets).select("frame_id", "packet_seq", "reason")).count() == 0 < rejected.count()
