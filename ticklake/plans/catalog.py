"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (or data Spark derives from them by
the fixture rules) in full; the matching DuckDB SQL is in ``oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import decode, lookup, orders, ticks
from ..operators.frames import split_price_frames
from ..schemas import INSTRUMENT_COLUMNS
from ..sources import fixtures as fx
from ..sources.master import MASTER_COLUMNS, latest_snapshot, snapshot_date

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


def _master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.fixture_master(spark, sf_dir)


# --- master (S1-S3) ----------------------------------------------------------

@query("master_ingest")
def q_master_ingest(spark, sf_dir):
    """S1 end to end: the raw master lands as CSV (as the exchange publishes
    it), is read back with the explicit schema and derived."""
    from ..session import scratch_path
    from ..sources.master import ingest_master, read_master_csv
    path = scratch_path(spark, "master-csv")
    fx.raw_master_from_part(fx.read_table(spark, sf_dir, "part")).write.option("header", True).csv(path)
    return ingest_master(read_master_csv(spark, path))


@query("master_ingest_reordered")
def q_master_ingest_reordered(spark, sf_dir):
    """A master file with its columns in another order and one more column."""
    from ..session import scratch_path
    from ..sources.master import ingest_master, read_master_csv
    path = scratch_path(spark, "master-csv")
    raw = fx.raw_master_from_part(fx.read_table(spark, sf_dir, "part"))
    raw.select(F.concat(F.lit("x"), F.col("SEM_SMST_SECURITY_ID").cast("string")).alias("SM_SYMBOL_NAME"),
               *[F.col(f"`{c}`") for c in reversed(raw.columns)]).write.option("header", True).csv(path)
    return ingest_master(read_master_csv(spark, path))


@query("master_latest_snapshot")
def q_master_latest_snapshot(spark, sf_dir):
    m = _master(spark, sf_dir)
    early = m.withColumn("snapshot_date", snapshot_date(F.lit("2024-01-02 08:00:00").cast("timestamp_ntz")))
    late = (m.withColumn("lot_units", F.col("lot_units") * 2)
            .withColumn("snapshot_date", snapshot_date(F.lit("2024-01-02 09:00:00").cast("timestamp_ntz"))))
    return latest_snapshot(early.unionByName(late)).select(*MASTER_COLUMNS, "snapshot_date")


@query("master_scan_current")
def q_master_scan_current(spark, sf_dir):
    """S3: the current master of a folder of three snapshots; only the newest partition is read."""
    from ..session import scratch_path
    from ..sources.master import scan_master, write_snapshot
    m, path = _master(spark, sf_dir), scratch_path(spark, "snapshots")
    for day, lots in (("2024-01-02 07:00:00", 1), ("2024-01-03 09:00:00", 3), ("2024-01-02 09:00:00", 2)):
        write_snapshot(m.withColumn("lot_units", F.col("lot_units") * lots), path, day)
    return scan_master(spark, path).select(*MASTER_COLUMNS, "snapshot_date")


@query("master_needs_refresh")
def q_master_needs_refresh(spark, sf_dir):
    """S2 on real file times, asked at 07:00, 08:30 and 09:00 of the days before and after the file was written."""
    from ..session import scratch_path
    from ..sources.master import files_need_refresh
    path = scratch_path(spark, "master")
    _master(spark, sf_dir).write.parquet(path)
    days = spark.read.parquet(path).select(F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("t")).agg(F.max("t").alias("t"))
    clocks = F.array(*map(F.lit, ("07:00:00", "08:30:00", "09:00:00")))
    asked = days.select(F.explode(F.array(F.lit(-1), F.lit(1))).alias("day"), "t").select("day", "t", F.explode(clocks).alias("clock"))
    now = F.to_timestamp_ntz(F.concat(F.date_add(F.to_date("t"), F.col("day")).cast("string"), F.lit(" "), F.col("clock")))
    asked = asked.select("day", "clock", now.alias("now_ts"))
    return asked.join(files_need_refresh(spark, path, asked.select("now_ts")), "now_ts").select("day", "clock", "stale")


@query("master_bad_values")
def q_master_bad_values(spark, sf_dir):
    """Values that do not parse are counted while the ingest job runs (expiry texts of every 10th and 7th row are spoilt)."""
    from pyspark.sql import Observation

    from ..session import scratch_path
    from ..sources.master import ingest_master, read_master_csv
    path = scratch_path(spark, "master-csv")
    raw = fx.raw_master_from_part(fx.read_table(spark, sf_dir, "part"))
    expiry, lots = F.col("SEM_EXPIRY_DATE"), F.col("SEM_LOT_UNITS").cast("string")
    key = F.col("SEM_SMST_SECURITY_ID")
    spoilt = F.when(key % 10 == 0, F.lit("2024-13-45 14:30:00")).when(key % 7 == 0, F.lit("2024-01-04 29:61:00")).otherwise(expiry)
    raw.withColumns({"SEM_EXPIRY_DATE": spoilt, "SEM_LOT_UNITS": F.when(key % 11 == 0, F.lit("many")).otherwise(lots)}
                    ).write.option("header", True).csv(path)
    counts = Observation()
    ingest_master(read_master_csv(spark, path, "_bad"), counts, "_bad").write.parquet(scratch_path(spark, "master"))
    return spark.createDataFrame([{k: int(v) for k, v in counts.get.items()}], "rows long, bad_dates long, bad_times long, bad_lines long")


# --- option chains (L4, A2, A3, P9, P11) ----------------------------------------

@query("option_chain")
def q_option_chain(spark, sf_dir):
    return lookup.option_chain(_master(spark, sf_dir), "U0", "NSE")


@query("option_chain_fallback")
def q_option_chain_fallback(spark, sf_dir):
    return lookup.option_chain(_master(spark, sf_dir), "u1", "nse", "2030-01-01")


@query("option_chain_listed")
def q_option_chain_listed(spark, sf_dir):
    return lookup.option_chain(_master(spark, sf_dir), "U2", "BSE", "2024-02-01")


@query("option_chains_all")
def q_option_chains_all(spark, sf_dir):
    m = _master(spark, sf_dir)
    return lookup.option_chains(m, fx.chain_requests(m))



# --- price frames (B1, B3-B13, J2) ---------------------------------------------

def _price_packets(spark, sf_dir):
    m = _master(spark, sf_dir)
    return decode.price_packets(fx.fixture_price_frames(spark, sf_dir, m), m)


PK = ["frame_id", "packet_seq", "instrument_key"]


def _typed(spark, sf_dir, t: int, *cols):
    d = decode.good(_price_packets(spark, sf_dir))
    return d.where(F.col("packet_type") == t).select(*PK, *cols)


@query("packets")
def q_packets(spark, sf_dir):
    m = _master(spark, sf_dir)
    p = decode.decode_header(split_price_frames(fx.fixture_price_frames(spark, sf_dir, m)))
    p = decode.resolve_instruments(p.withColumn("error", F.lit(None).cast("string")), m)
    return p.select("frame_id", "recv_ts", "packet_seq", "seg_code", "security_id", "packet_length",
                    "packet_type", "instrument_key", decode.code_decimals(F.col("seg_code")).alias("decimals"))


@query("decode_trade")
def q_decode_trade(spark, sf_dir):
    return _typed(spark, sf_dir, 1, "ltp", "last_traded_qty", "volume", "average_price", "open_interest",
                  "last_trade_time", "last_updated_time")


@query("decode_depth")
def q_decode_depth(spark, sf_dir):
    d = _typed(spark, sf_dir, 2, "depth_buy", "depth_sell")
    sides = F.array(F.struct(F.lit("buy").alias("side"), F.col("depth_buy").alias("levels")),
                    F.struct(F.lit("sell").alias("side"), F.col("depth_sell").alias("levels")))
    s = d.select(*PK, F.explode(sides).alias("s"))
    lv = s.select(*PK, F.col("s.side").alias("side"), F.posexplode("s.levels").alias("level", "l"))
    return lv.select(*PK, "side", "level", F.col("l.quantity").alias("quantity"),
                     F.col("l.price").alias("price"), F.col("l.orders").alias("orders"))


@query("decode_ohlc")
def q_decode_ohlc(spark, sf_dir):
    return _typed(spark, sf_dir, 3, "open", "close", "high", "low")


@query("decode_index")
def q_decode_index(spark, sf_dir):
    from ..functions.numeric import with_change
    d = decode.good(_price_packets(spark, sf_dir)).where(F.col("packet_type") == 5)
    return with_change(d, "ltp", "prev_close", "decimals", "change", "change_prcnt").select(
        *PK, "ltp", "open", "prev_close", "high", "low", "last_trade_time", "change", "change_prcnt")


@query("decode_top")
def q_decode_top(spark, sf_dir):
    return _typed(spark, sf_dir, 6, "total_ask_qty", "total_bid_qty", "best_bid_qty", "best_ask_qty",
                  "best_bid_price", "best_ask_price", "total_bid_ask_qty", "total_bid_qty_prcnt",
                  "total_ask_qty_prcnt")


@query("decode_status")
def q_decode_status(spark, sf_dir):
    return _typed(spark, sf_dir, 29, "status_msg", "status_value", "market_status")


@query("decode_prev_close")
def q_decode_prev_close(spark, sf_dir):
    return _typed(spark, sf_dir, 32, "prev_close", "prev_open_interest")


@query("decode_circuit")
def q_decode_circuit(spark, sf_dir):
    return _typed(spark, sf_dir, 33, "upper_circuit", "lower_circuit")


@query("decode_week52")
def q_decode_week52(spark, sf_dir):
    return _typed(spark, sf_dir, 36, "week52_high", "week52_low")


@query("decode_oi")
def q_decode_oi(spark, sf_dir):
    return _typed(spark, sf_dir, 37, "open_interest")


# --- tick state (A4, A5, W1, W3, T4, B15) --------------------------------------

def _depth_columns() -> list:
    return [F.col(f"depth_{side}")[i][field].alias(f"depth_{side}_{what}{i}")
            for side in ("buy", "sell") for i in range(5)
            for what, field in (("qty", "quantity"), ("price", "price"), ("orders", "orders"))]


def _whole(df: DataFrame) -> DataFrame:
    """The whole state, with quantity, price and orders of all five levels of both sides as columns."""
    return df.select(*(c for c in df.columns if c not in ("depth_buy", "depth_sell")), *_depth_columns())


def _whole_depth(df: DataFrame, *keys: str) -> DataFrame:
    """The keys with all five levels of both sides."""
    return df.select(*keys, *_depth_columns())


def _control(spark, sf_dir, master):
    return fx.subscription_log(fx.read_table(spark, sf_dir, "events"), master)


def _control_with_reconnects(spark, sf_dir, master):
    return _control(spark, sf_dir, master).unionByName(fx.reconnect_log(fx.read_table(spark, sf_dir, "events")))


def _tick_snapshots(spark, sf_dir):
    m = _master(spark, sf_dir)
    good = decode.good(decode.price_packets(fx.fixture_price_frames(spark, sf_dir, m), m))
    return ticks.tick_snapshots(good, _control(spark, sf_dir, m))


@query("tick_snapshots")
def q_tick_snapshots(spark, sf_dir):
    return _whole(_tick_snapshots(spark, sf_dir))


@query("tick_snapshots_depth")
def q_tick_snapshots_depth(spark, sf_dir):
    return _whole_depth(_tick_snapshots(spark, sf_dir), "instrument_key", "frame_id", "packet_seq")


@query("tick_epochs")
def q_tick_epochs(spark, sf_dir):
    return q_tick_snapshots(spark, sf_dir).select("frame_id", "packet_seq", "instrument_key", "epoch")


@query("tick_latest")
def q_tick_latest(spark, sf_dir):
    return _whole(ticks.latest_state(decode.good(_price_packets(spark, sf_dir))))


@query("tick_latest_depth")
def q_tick_latest_depth(spark, sf_dir):
    return _whole_depth(ticks.latest_state(decode.good(_price_packets(spark, sf_dir))), "instrument_key")


@query("tick_latest_reset")
def q_tick_latest_reset(spark, sf_dir):
    """A4 with W3 and T7: re-subscriptions and reconnects empty the state."""
    m = _master(spark, sf_dir)
    good = decode.good(decode.price_packets(fx.fixture_price_frames(spark, sf_dir, m), m))
    return _whole(ticks.latest_state(good, _control_with_reconnects(spark, sf_dir, m)))


@query("tick_epochs_reconnect")
def q_tick_epochs_reconnect(spark, sf_dir):
    """W1 with T7: whole snapshots, where one reconnect row resets every key."""
    m = _master(spark, sf_dir)
    good = decode.good(decode.price_packets(fx.fixture_price_frames(spark, sf_dir, m), m))
    return _whole(ticks.tick_snapshots(good, _control_with_reconnects(spark, sf_dir, m)))


@query("market_status")
def q_market_status(spark, sf_dir):
    return ticks.market_status(decode.good(_price_packets(spark, sf_dir)))


def _malformed_packets(spark, sf_dir):
    m = _master(spark, sf_dir)
    frames = fx.malformed_price_frames(fx.read_table(spark, sf_dir, "events"), m)
    return decode.price_packets(frames, m)


@query("quarantine")
def q_quarantine(spark, sf_dir):
    q = decode.quarantine(_malformed_packets(spark, sf_dir))
    return q.groupBy("reason").agg(F.count(F.lit(1)).alias("packets"))


@query("unknown_type_ticks")
def q_unknown_type_ticks(spark, sf_dir):
    g = decode.good(_malformed_packets(spark, sf_dir))
    return g.agg(F.count(F.lit(1)).alias("packets"), F.countDistinct("instrument_key").alias("instruments"))


# --- orders (B2, B14, F19-F25, J4, A6, A7) ---------------------------------------

ORDER_VIEW = ["frame_id", "packet_seq", "recv_ts", "instrument_key", "msg_len", "exchange", "segment",
              "security_id", "security_id_num", "exch_order_no", "order_no", "order_no_num", "order_type",
              "validity", "quantity", "traded_qty", "remaining_quantity", "price", "avg_traded_price",
              "trigger_price", "lot_size", "tick_size", "order_date_time", "exch_order_time",
              "last_updated_time", "status", "splatform", "remarks_1", "order_label", "disp_quantity",
              "disp_traded_qty", "disp_remaining_quantity", "utf8_valid"]


def _orders(spark, sf_dir, master=None):
    m = master if master is not None else _master(spark, sf_dir)
    return orders.order_updates(fx.fixture_order_frames(spark, sf_dir, m))


@query("orders_decoded")
def q_orders_decoded(spark, sf_dir):
    return decode.good(_orders(spark, sf_dir)).select(*ORDER_VIEW)


@query("orders_decoded_whole")
def q_orders_decoded_whole(spark, sf_dir):
    """Every field of the record, all of them filled, with the numeric twin of every text field."""
    from ..schemas import ORDER_LAYOUT
    m = _master(spark, sf_dir)
    o = orders.numeric_twins(decode.good(orders.order_updates(fx.whole_order_frames(spark, sf_dir, m), keep_personal=True)))
    derived = [c for c in ORDER_VIEW if c not in {n for n, _, _ in ORDER_LAYOUT} and not c.endswith("_num")]
    return o.select(*derived, *(n for n, _, _ in ORDER_LAYOUT), *(f"{n}_num" for n in orders.TEXT_FIELDS))


@query("orders_enriched")
def q_orders_enriched(spark, sf_dir):
    m = _master(spark, sf_dir)
    return _whole_enriched(orders.enrich_orders(decode.good(_orders(spark, sf_dir, m)), m))


def _whole_enriched(df: DataFrame) -> DataFrame:
    return df.select(*ORDER_VIEW, "inst_trading_symbol", "inst_display_name", "inst_type", "inst_lot_units")


@query("orders_by_frame")
def q_orders_by_frame(spark, sf_dir):
    g = orders.orders_by_frame(decode.good(_orders(spark, sf_dir)).select(
        "frame_id", "packet_seq", "recv_ts", "order_no", "instrument_key"))
    return g.select("frame_id", "recv_ts", F.size("orders").alias("n_orders"),
                    F.array_join(F.transform("orders", lambda o: o["order_no"]), ",").alias("order_nos"))


@query("orders_by_frame_enriched")
def q_orders_by_frame_enriched(spark, sf_dir):
    """A6 after J4: the join puts the key first, packet order must stay."""
    m = _master(spark, sf_dir)
    g = orders.orders_by_frame(orders.enrich_orders(decode.good(_orders(spark, sf_dir, m)), m))
    return g.select("frame_id", "recv_ts", F.size("orders").alias("n_orders"),
                    F.array_join(F.transform("orders", lambda o: o["order_no"]), ",").alias("order_nos"))


@query("orders_latest")
def q_orders_latest(spark, sf_dir):
    o = decode.good(_orders(spark, sf_dir)).select(*ORDER_VIEW)
    return orders.latest_orders(o)


@query("orders_latest_reset")
def q_orders_latest_reset(spark, sf_dir):
    m = _master(spark, sf_dir)
    o = decode.good(_orders(spark, sf_dir, m)).select(*ORDER_VIEW)
    return orders.latest_orders(o, _order_resets(spark, sf_dir, m))


def _order_resets(spark, sf_dir, master):
    """Re-subscriptions and reconnects, moved by the gap between the first event and the first order, which lie years apart."""
    log = _control_with_reconnects(spark, sf_dir, master)
    first = fx.read_table(spark, sf_dir, "events").agg(F.min(F.col("ts").cast("timestamp_ntz")).alias("t"))
    start = fx.read_table(spark, sf_dir, "orders").agg(F.min(F.col("o_orderdate").cast("timestamp_ntz")).alias("t"))
    gap = F.timestamp_diff("SECOND", first.scalar(), start.scalar())
    return log.withColumn("ts", F.timestamp_add("SECOND", gap, F.col("ts")))


@query("order_quarantine")
def q_order_quarantine(spark, sf_dir):
    m = _master(spark, sf_dir)
    o = orders.order_updates(fx.malformed_order_frames(fx.read_table(spark, sf_dir, "orders"), m))
    reason = F.coalesce(F.col("error"), F.when(~F.col("utf8_valid"), F.lit("invalid_utf8")))
    return (o.select(reason.alias("reason")).where(F.col("reason").isNotNull())
            .groupBy("reason").agg(F.count(F.lit(1)).alias("packets")))


# --- lookups (P4-P11, A1-A3, J1, J3, F4-F7, S10) -----------------------------------

@query("instrument_lookup")
def q_instrument_lookup(spark, sf_dir):
    return lookup.instrument_lookup(_master(spark, sf_dir), "u0", "nse", "OPTIDX", expiry_date="2024-01-04",
                                    strike=100, option_type="CE")


@query("instrument_lookup_equity")
def q_instrument_lookup_equity(spark, sf_dir):
    return lookup.instrument_lookup(_master(spark, sf_dir), "U3", "NSE", "EQUITY")


@query("instruments_batch_lookup")
def q_instruments_batch_lookup(spark, sf_dir):
    m = _master(spark, sf_dir)
    req = fx.lookup_requests(m).withColumn("batch_id", F.concat_ws(":", "exchange", "instrument_type"))
    return lookup.instruments_lookup(m, req)


@query("trading_symbols")
def q_trading_symbols(spark, sf_dir):
    from ..functions.symbols import instrument_type_col, trading_symbol
    from ..schemas import INSTRUMENT_TYPES
    m = _master(spark, sf_dir)
    flags = [F.col("instrument_type") == k for k in INSTRUMENT_TYPES]
    und = F.get(F.split("trading_symbol", "-"), 0)
    built = trading_symbol(und, "exchange", "instrument_type", "expiry_date", "strike_price",
                           F.when(F.col("instrument_type").startswith("OPT"), F.col("option_type")))
    return m.select("instrument_key", instrument_type_col(*flags).alias("resolved_type"),
                    built.alias("built_symbol"), (built == F.col("trading_symbol")).alias("matches"))


@query("expiry_dates_opt")
def q_expiry_dates_opt(spark, sf_dir):
    m = _master(spark, sf_dir)
    return lookup.expiry_dates_all(m, fx.fixture_underlyings(m), of_fut=False)


@query("expiry_dates_fut")
def q_expiry_dates_fut(spark, sf_dir):
    m = _master(spark, sf_dir)
    return lookup.expiry_dates_all(m, fx.fixture_underlyings(m), of_fut=True)


@query("nearest_expiry")
def q_nearest_expiry(spark, sf_dir):
    m = _master(spark, sf_dir)
    return lookup.nearest_expiry(m, fx.fixture_underlyings(m))


@query("resolve_keys")
def q_resolve_keys(spark, sf_dir):
    m = _master(spark, sf_dir)
    keys = _control(spark, sf_dir, m).select("instrument_key")
    r = lookup.resolve_keys(m, keys)
    return r.select(*INSTRUMENT_COLUMNS, F.col("price_updates.ltp").alias("ltp"),
                    F.col("price_updates.volume").alias("volume"),
                    F.col("order_updates").isNull().alias("no_order_update"))


@query("drop_empty_columns")
def q_drop_empty_columns(spark, sf_dir):
    from ..operators.display import drop_empty_columns
    return drop_empty_columns(lookup.instrument_lookup(_master(spark, sf_dir), "U4", "NSE", "FUTIDX",
                                                       expiry_date="2024-01-18"))


@query("drop_empty_columns_futures")
def q_drop_empty_columns_futures(spark, sf_dir):
    """P4 over every futures contract of the master: strike and option type are empty for all of them."""
    from ..operators.display import drop_empty_columns
    return drop_empty_columns(_master(spark, sf_dir).where(F.col("instrument_type").startswith("FUT")).select(*INSTRUMENT_COLUMNS))


@query("vertical_view")
def q_vertical_view(spark, sf_dir):
    from ..operators.display import vertical_view
    return vertical_view(_master(spark, sf_dir).select(*INSTRUMENT_COLUMNS), ["instrument_key"])


@query("segment_codes")
def q_segment_codes(spark, sf_dir):
    from ..functions.codes import code_decimals, code_exchange, code_segment, segment_code, wire_key
    from ..functions.wire import date_to_wire_seconds
    m = _master(spark, sf_dir)
    code = segment_code("exchange", "segment")
    return m.select("instrument_key", code.alias("seg_code"), code_decimals(code).alias("decimals"),
                    code_exchange(code).alias("code_exchange"), code_segment(code).alias("code_segment"),
                    wire_key(code, F.col("security_id")).alias("wire_key"),
                    date_to_wire_seconds(F.col("expiry_date")).alias("expiry_wire_seconds"))


# --- subscriptions (S6, U1, U2, T6, J5-J7) -------------------------------------------

@query("subscription_plan")
def q_subscription_plan(spark, sf_dir):
    from ..operators.subscriptions import request_plan
    m = _master(spark, sf_dir)
    return request_plan(_control(spark, sf_dir, m), m).select(
        "event_id", "instrument_key", "action", "mode", "seg_code", "request_seq", "request_code")


@query("registry_current")
def q_registry_current(spark, sf_dir):
    from ..operators.subscriptions import current_registry
    m = _master(spark, sf_dir)
    return current_registry(_control(spark, sf_dir, m))


@query("unsubscribe_all_plan")
def q_unsubscribe_all_plan(spark, sf_dir):
    from ..operators.subscriptions import current_registry, unsubscribe_all
    m = _master(spark, sf_dir)
    plan = unsubscribe_all(current_registry(_control(spark, sf_dir, m)), m)
    return plan.select("group", "instrument_key", "mode", "seg_code", "request_seq", "request_code")


# --- streaming (S4, S5, S7, S8, T1-T8, X1) ---------------------------------------------
# Each query lands the fixture frames as Parquet files in the shared
# checkpoint folder, drains them with a Structured Streaming query
# (``trigger(availableNow=True)``) into a foreachBatch Parquet sink, and
# returns the sink's content shaped like the batch twin (same oracle).

def _run_stream(spark, df, mode: str, tag: str) -> DataFrame:
    from ..session import scratch_path
    from ..streaming.sinks import parquet_batch_writer, start
    out = scratch_path(spark, f"{tag}-out")
    q = start(df, parquet_batch_writer(out), scratch_path(spark, f"{tag}-ckpt"), output_mode=mode)
    q.awaitTermination()
    return spark.read.parquet(out)


def _run_latest(spark, df, tag: str) -> DataFrame:
    """Drain an update-mode aggregate into a table of one row per key."""
    from ..session import scratch_path
    from ..streaming.sinks import latest_table_writer, read_latest_table, start
    out = scratch_path(spark, f"{tag}-out")
    start(df, latest_table_writer(out, ["instrument_key"]), scratch_path(spark, f"{tag}-ckpt"), output_mode="update").awaitTermination()
    return read_latest_table(spark, out)


def _landed_control(spark, log):
    from ..session import scratch_path
    from ..sources.frames import stream_control
    path = scratch_path(spark, "control")
    log.write.parquet(path)
    return stream_control(spark, path)


def _land(spark, frames, sf_dir, table: str, tag: str, packets_per_row: int = 1) -> str:
    """Frames of packets made from a table, landed in files whose number grows with its rows."""
    from ..session import scratch_path
    from ..sources.frames import ORDER_PACKETS, PRICE_PACKETS, files_for, write_frames
    packets = fx.read_table(spark, sf_dir, table).count() * packets_per_row
    path = scratch_path(spark, tag)
    write_frames(frames, path, files_for(packets, ORDER_PACKETS if table == "orders" else PRICE_PACKETS))
    return path


def _landed_price_frames(spark, sf_dir, m):
    from ..sources.frames import stream_frames
    return stream_frames(spark, _land(spark, fx.fixture_price_frames(spark, sf_dir, m), sf_dir, "events", "price-frames"))


def _stream_tick_latest(spark, sf_dir, log=None):
    from ..streaming.ticks import finish_latest, latest_state_stream
    m = _master(spark, sf_dir)
    control = None if log is None else _landed_control(spark, log(spark, sf_dir, m))
    agg = latest_state_stream(_landed_price_frames(spark, sf_dir, m), m, control)
    return finish_latest(_run_latest(spark, agg, "tick-latest"), resets=log is not None)


@query("stream_tick_latest")
def q_stream_tick_latest(spark, sf_dir):
    return _whole(_stream_tick_latest(spark, sf_dir))


@query("stream_tick_latest_reset")
def q_stream_tick_latest_reset(spark, sf_dir):
    return _whole(_stream_tick_latest(spark, sf_dir, _control_with_reconnects))


@query("stream_tick_latest_depth")
def q_stream_tick_latest_depth(spark, sf_dir):
    return _whole_depth(_stream_tick_latest(spark, sf_dir), "instrument_key")


def _stream_tick_snapshots(spark, sf_dir, log=_control):
    from ..session import scratch_path
    from ..streaming.sinks import start
    from ..streaming.ticks import decoded_stream, snapshot_stream, snapshot_writer
    m = _master(spark, sf_dir)
    out = scratch_path(spark, "tick-snapshots-out")
    frames = _landed_price_frames(spark, sf_dir, m)
    rows = snapshot_stream(decode.good(decoded_stream(frames, m)), _landed_control(spark, log(spark, sf_dir, m)))
    sink = snapshot_writer(out, scratch_path(spark, "tick-snapshots-state"))
    start(rows, sink, scratch_path(spark, "tick-snapshots-ckpt")).awaitTermination()
    return spark.read.parquet(out).drop("batch_id")


@query("stream_tick_snapshots")
def q_stream_tick_snapshots(spark, sf_dir):
    return _whole(_stream_tick_snapshots(spark, sf_dir))


@query("stream_tick_epochs_reconnect")
def q_stream_tick_epochs_reconnect(spark, sf_dir):
    return _whole(_stream_tick_snapshots(spark, sf_dir, _control_with_reconnects))


@query("stream_tick_snapshots_depth")
def q_stream_tick_snapshots_depth(spark, sf_dir):
    return _whole_depth(_stream_tick_snapshots(spark, sf_dir), "instrument_key", "frame_id", "packet_seq")


@query("stream_orders")
def q_stream_orders(spark, sf_dir):
    from ..sources.frames import stream_frames
    from ..streaming.orders import order_stream
    m = _master(spark, sf_dir)
    path = _land(spark, fx.fixture_order_frames(spark, sf_dir, m), sf_dir, "orders", "order-frames")
    return _whole_enriched(_run_stream(spark, order_stream(stream_frames(spark, path), m), "append", "orders"))


@query("stream_order_callback")
def q_stream_order_callback(spark, sf_dir):
    """A user's callback sees every micro-batch after the sink has it; here it writes each frame's list of orders."""
    from ..session import scratch_path
    from ..sources.frames import stream_frames
    from ..streaming.orders import order_stream
    from ..streaming.sinks import parquet_batch_writer, start, with_callback
    m = _master(spark, sf_dir)
    out, seen = (scratch_path(spark, n) for n in ("order-sink", "order-callback"))
    path = _land(spark, fx.fixture_order_frames(spark, sf_dir, m), sf_dir, "orders", "order-frames")

    def on_orders(batch: DataFrame, batch_id: int) -> None:
        per_frame = orders.orders_by_frame(batch.select("frame_id", "packet_seq", "recv_ts", "order_no"))
        parquet_batch_writer(seen)(per_frame, batch_id)

    start(order_stream(stream_frames(spark, path, max_files_per_trigger=2), m), with_callback(parquet_batch_writer(out), on_orders),
          scratch_path(spark, "callback-ckpt")).awaitTermination()
    return spark.read.parquet(seen).select("frame_id", "recv_ts", F.size("orders").alias("n_orders"),
                                           F.array_join(F.transform("orders", lambda o: o["order_no"]), ",").alias("order_nos"))


def _run_quarantine(spark, decoded, tag: str) -> DataFrame:
    """Good and rejected packets of one stream, per reason (null: good)."""
    from ..session import scratch_path
    from ..streaming.sinks import parquet_batch_writer, start
    from ..streaming.ticks import with_quarantine
    good, bad = scratch_path(spark, f"{tag}-good"), scratch_path(spark, f"{tag}-bad")
    start(decoded, with_quarantine(parquet_batch_writer(good), parquet_batch_writer(bad)), scratch_path(spark, f"{tag}-ckpt")).awaitTermination()
    kept = spark.read.parquet(good).select("frame_id", "packet_seq", F.lit(None).cast("string").alias("reason"))
    return kept.unionAll(spark.read.parquet(bad).select("frame_id", "packet_seq", "reason"))


@query("stream_quarantine")
def q_stream_quarantine(spark, sf_dir):
    """Every packet of a stream of good and malformed frames, with its reason."""
    from ..sources.frames import stream_frames
    from ..streaming.ticks import decoded_stream
    m = _master(spark, sf_dir)
    bad = fx.malformed_price_frames(fx.read_table(spark, sf_dir, "events"), m)
    path = _land(spark, fx.fixture_price_frames(spark, sf_dir, m).unionByName(bad), sf_dir, "events", "mixed-price-frames", packets_per_row=2)
    return _run_quarantine(spark, decoded_stream(stream_frames(spark, path), m), "quarantine")


@query("stream_order_quarantine")
def q_stream_order_quarantine(spark, sf_dir):
    """The same for order frames."""
    from ..sources.frames import stream_frames
    m = _master(spark, sf_dir)
    bad = fx.malformed_order_frames(fx.read_table(spark, sf_dir, "orders"), m)
    path = _land(spark, fx.fixture_order_frames(spark, sf_dir, m).unionByName(bad), sf_dir, "orders", "mixed-order-frames", packets_per_row=2)
    return _run_quarantine(spark, orders.order_updates(stream_frames(spark, path)), "order-quarantine")


# --- more coverage: S9/F26, J5-J7, A3 (futures), T5/A7 streaming ------------------

@query("records_export")
def q_records_export(spark, sf_dir):
    from ..operators.display import to_records
    return to_records(_master(spark, sf_dir).select(*INSTRUMENT_COLUMNS))


@query("nearest_expiry_fut")
def q_nearest_expiry_fut(spark, sf_dir):
    m = _master(spark, sf_dir)
    return lookup.nearest_expiry(m, fx.fixture_underlyings(m), of_fut=True)


def _registry_parts(spark, sf_dir, twentieths: int = 10):
    """The registry before a moment of the log's own time range, and the log from then on."""
    from ..operators.subscriptions import current_registry
    m = _master(spark, sf_dir)
    log = _control(spark, sf_dir, m)
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    ends = log.agg(F.min(us).alias("a"), F.max(us).alias("b"))
    cut = ends.select(F.expr(f"a + (b - a) * {twentieths} div 20").alias("us")).scalar()
    before = current_registry(log.where(us < cut))
    return before, log.where(us >= cut)


@query("registry_registered_unsubs")
def q_registry_registered_unsubs(spark, sf_dir):
    from ..operators.subscriptions import registered
    reg, later = _registry_parts(spark, sf_dir)
    return registered(later.where(F.col("action") == "UNSUBSCRIBE"), reg).select(
        "event_id", "instrument_key", "ts")


@query("registry_after_unsubscribe")
def q_registry_after_unsubscribe(spark, sf_dir):
    from ..operators.subscriptions import unregister
    reg, later = _registry_parts(spark, sf_dir, 19)
    return unregister(reg, later.where(F.col("action") == "UNSUBSCRIBE"))


@query("registry_after_upsert")
def q_registry_after_upsert(spark, sf_dir):
    from ..operators.subscriptions import upsert
    reg, later = _registry_parts(spark, sf_dir)
    # several changes of one key may come; the last one counts
    fresh = later.where(F.col("action") == "SUBSCRIBE").select(
        "instrument_key", "mode", F.col("ts").alias("since_ts"), "event_id")
    order = F.struct("since_ts", "event_id")
    return upsert(reg, fresh.withColumn("_order", order), "_order").select(*reg.columns)


@query("stream_orders_latest")
def q_stream_orders_latest(spark, sf_dir):
    from ..sources.frames import stream_frames
    from ..streaming.orders import latest_order_stream
    m = _master(spark, sf_dir)
    path = _land(spark, fx.fixture_order_frames(spark, sf_dir, m), sf_dir, "orders", "order-frames")
    last = _run_latest(spark, latest_order_stream(stream_frames(spark, path)), "orders-latest")
    return last.select("instrument_key", "orders_seen", *(c for c in ORDER_VIEW if c != "instrument_key"))


@query("registered_ticks")
def q_registered_ticks(spark, sf_dir):
    """The packet stream restricted to currently registered instruments
    (left-semi join with the registry, which is bounded by the instrument
    count)."""
    from ..operators.joins import sized_side
    from ..operators.subscriptions import current_registry, registered
    m = _master(spark, sf_dir)
    good = decode.good(decode.price_packets(fx.fixture_price_frames(spark, sf_dir, m), m))
    reg = sized_side(current_registry(_control(spark, sf_dir, m)).select("instrument_key"))
    return registered(good, reg).select("frame_id", "packet_seq", "instrument_key", "packet_type")


@query("registry_with_auto")
def q_registry_with_auto(spark, sf_dir):
    """The registry after the whole log and all packets, which register their instruments themselves."""
    from ..operators.subscriptions import registry_with_auto
    m = _master(spark, sf_dir)
    good = decode.good(decode.price_packets(fx.fixture_price_frames(spark, sf_dir, m), m))
    return registry_with_auto(_control(spark, sf_dir, m), good)


@query("registered_ticks_asof")
def q_registered_ticks_asof(spark, sf_dir):
    """Each packet with its instrument's registration at that moment."""
    from ..operators.subscriptions import membership_asof
    m = _master(spark, sf_dir)
    good = decode.good(decode.price_packets(fx.fixture_price_frames(spark, sf_dir, m), m))
    return membership_asof(good.select("frame_id", "packet_seq", "instrument_key", "recv_ts"), _control(spark, sf_dir, m))
