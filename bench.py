"""Benchmark: headline operators over landed inputs.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Step 1 (timed separately, not in the total) lands the inputs a real
deployment would already have: the raw instrument master as CSV, the price
and order frame tables and the subscription log as Parquet.  Step 2 runs
each headline query end to end into Spark's ``noop`` sink (full execution,
nothing collected), twice, and reports the better run per query (the first
runs are listed under ``first_run``); one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from ticklake.operators import decode, lookup, orders, ticks  # noqa: E402
from ticklake.session import build_session, scratch_path  # noqa: E402
from ticklake.sources import fixtures as fx  # noqa: E402
from ticklake.sources.frames import read_frames, stream_frames, write_frames  # noqa: E402
from ticklake.sources.master import ingest_master, read_master_csv  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app_name="ticklake-bench")

    # -- land inputs --------------------------------------------------------
    t0 = time.time()
    csv_path = scratch_path(spark, "master-csv")
    fx.raw_master_from_part(fx.read_table(spark, sf_dir, "part")).write.option("header", True).csv(csv_path)
    master_path = scratch_path(spark, "master")
    ingest_master(read_master_csv(spark, csv_path)).write.parquet(master_path)
    master = spark.read.parquet(master_path)
    price_path, order_path, ctl_path = (scratch_path(spark, n) for n in ("price", "order", "control"))
    write_frames(fx.fixture_price_frames(spark, sf_dir, master), price_path, files=int(cpus))
    write_frames(fx.fixture_order_frames(spark, sf_dir, master), order_path, files=int(cpus))
    fx.subscription_log(fx.read_table(spark, sf_dir, "events"), master).write.parquet(ctl_path)
    land_sec = time.time() - t0

    price = read_frames(spark, price_path)
    order = read_frames(spark, order_path)
    control = spark.read.parquet(ctl_path)

    def good_packets():
        return decode.good(decode.price_packets(price, master))

    def stream_latest():
        from ticklake.streaming.sinks import parquet_batch_writer, start
        from ticklake.streaming.ticks import latest_state_stream
        q = start(latest_state_stream(stream_frames(spark, price_path), master),
                  parquet_batch_writer(scratch_path(spark, "bench-stream-out")),
                  scratch_path(spark, "bench-stream-ckpt"), output_mode="update")
        q.awaitTermination()

    queries = {
        "master_ingest_csv": lambda: run(ingest_master(read_master_csv(spark, csv_path))),
        "option_chains_all": lambda: run(lookup.option_chains(master, fx.chain_requests(master))),
        "instruments_batch_lookup": lambda: run(lookup.instruments_lookup(
            master, fx.lookup_requests(master).withColumn("batch_id", F.concat_ws(":", "exchange", "instrument_type")))),
        "decode_price_packets": lambda: run(decode.price_packets(price, master)),
        "tick_latest": lambda: run(ticks.latest_state(good_packets())),
        "tick_snapshots": lambda: run(ticks.tick_snapshots(good_packets(), control)),
        "market_status": lambda: run(ticks.market_status(good_packets())),
        "orders_enriched": lambda: run(orders.enrich_orders(decode.good(orders.order_updates(order)), master)),
        "orders_latest": lambda: run(orders.latest_orders(decode.good(orders.order_updates(order)))),
        "stream_tick_latest": stream_latest,
    }
    # warm-up: JIT / Python workers (not timed)
    run(lookup.option_chain(master, "U0", "NSE"))

    # each query twice; report the better run (steady state, not JIT warm-up)
    times, first = {}, {}
    for name, fn in queries.items():
        runs = []
        for _ in range(2):
            t = time.time()
            fn()
            runs.append(time.time() - t)
        first[name] = round(runs[0], 3)
        times[name] = round(min(runs), 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times,
                      "sf": sf, "land_inputs_sec": round(land_sec, 3), "cpus": int(cpus),
                      "first_run": first}))
    spark.stop()


if __name__ == "__main__":
    main()
