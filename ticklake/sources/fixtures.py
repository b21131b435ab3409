"""Test inputs derived from the driver's tables by fixed, documented rules.

Real market data is not available offline, so the instrument master, the
price/order frame tables and the request tables are *derived* from
``part``, ``events`` and ``orders`` (see FIXTURES.md).  Every builder is a
Spark job over the whole input table; the binary encoders run vectorised in
NumPy inside ``mapInArrow`` (one Arrow batch at a time, no per-row Python),
and frames are assembled there too, from inputs that Spark shuffled by frame
and sorted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.codes import segment_code
from ..functions.symbols import strike_text, trading_symbol
from ..functions.wire import ts_to_wire_seconds
from ..operators.joins import sized_side
from ..schemas import INSTRUMENT_TYPES, ORDER_LAYOUT, ORDER_PACKET_LEN

# FIXED VALUES — fixture rules (FIXTURES.md)
PACKET_TYPE_CYCLE = [1, 2, 3, 5, 6, 29, 32, 33, 36, 37]
STATUS_VALUE_CYCLE = [1.0, 3.0, 5.0, 6.0, 9.0]
PLATFORM_CYCLE = ["BSKT1", "STRGBSK", "FOVR", "SIP", "TV_TERMINAL", "IBERG", "WEB"]
FIRST_EXPIRY = "2024-01-04"
EXPIRY_STEP_DAYS = 14
EXPIRY_TIME = "14:30:00"
PACKETS_PER_PRICE_FRAME = 4
PACKETS_PER_ORDER_FRAME = 2
ORDER_SECURITY_MOD = 150


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------------------
# instrument master (raw CSV shape) from part
# ---------------------------------------------------------------------------

def raw_master_from_part(part: DataFrame) -> DataFrame:
    p = F.col("p_partkey")
    q = F.floor(p / 10)
    kind = F.element_at(F.array(*[F.lit(k) for k in INSTRUMENT_TYPES]), (p % 10 + 1).cast("int"))
    is_cur = kind.endswith("CUR")
    is_com = kind.isin("FUTCOM", "OPTFUT")
    is_opt = kind.startswith("OPT")
    is_fut = kind.startswith("FUT")
    dated = ~kind.isin("INDEX", "EQUITY")
    segment = (F.when(kind == "INDEX", "I").when(kind == "EQUITY", "E").when(is_cur, "C")
               .when(is_com, "M").otherwise("D"))
    exchange = F.when(is_cur, "BSE").when(is_com, "MCX").otherwise("NSE")
    underlying = F.concat(F.lit("U"), (F.floor(p / 40) % 5).cast("string"))
    expiry = F.date_add(F.lit(FIRST_EXPIRY).cast("date"), (F.lit(EXPIRY_STEP_DAYS) * (q % 4)).cast("int"))
    strike = F.when(is_opt, F.lit(100.0) + F.lit(50.0) * F.floor(p / 400)
                    + F.when(kind == "OPTCUR", F.lit(0.5)).otherwise(F.lit(0.0)))
    opt_type = (F.when(is_opt, F.when(F.floor(p / 200) % 2 == 0, "CE").otherwise("PE"))
                .when(is_fut, "NA"))
    display = (F.when(is_opt, F.concat_ws(" ", underlying, F.upper(F.date_format(expiry, "dd MMM")),
                                          strike_text(strike),
                                          F.when(opt_type == "CE", "CALL").otherwise("PUT")))
               .when(is_fut, F.concat_ws(" ", underlying, F.upper(F.date_format(expiry, "MMM")), F.lit("FUT")))
               .otherwise(underlying))
    return part.select(
        exchange.alias("SEM_EXM_EXCH_ID"),
        segment.alias(" SEM_SEGMENT"),
        p.cast("long").alias("SEM_SMST_SECURITY_ID"),
        kind.alias("SEM_INSTRUMENT_NAME"),
        (q % 4).cast("int").alias("SEM_EXPIRY_CODE"),
        trading_symbol(underlying, exchange, kind, F.when(dated, expiry), strike, opt_type)
        .alias("SEM_TRADING_SYMBOL"),
        F.col("p_size").cast("double").alias("SEM_LOT_UNITS"),
        display.alias("SEM_CUSTOM_SYMBOL"),
        F.when(dated, F.concat(F.date_format(expiry, "yyyy-MM-dd"), F.lit(" " + EXPIRY_TIME)))
        .alias("SEM_EXPIRY_DATE"),
        strike.cast("double").alias("SEM_STRIKE_PRICE"),
        opt_type.alias("SEM_OPTION_TYPE"),
        F.lit(5.0).alias("SEM_TICK_SIZE"),
        F.when(dated, F.when(q % 4 < 2, "W").otherwise("M")).alias("SEM_EXPIRY_FLAG"),
    )


def fixture_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical master built from ``part`` (S1 derivations applied)."""
    from .master import ingest_master
    return ingest_master(raw_master_from_part(read_table(spark, sf_dir, "part")))


def fixture_underlyings(master: DataFrame) -> DataFrame:
    """Distinct (underlying, exchange) of the dated contracts."""
    return (master.where(F.col("expiry_date_str").isNotNull())
            .select(F.get(F.split("trading_symbol", "-"), 0).alias("underlying"), "exchange")
            .distinct())


# ---------------------------------------------------------------------------
# price frames from events
# ---------------------------------------------------------------------------

_HEADER = [("code", "u1"), ("zero", "<u4"), ("sid", "<u4"), ("len", "u1"), ("type", "u1")]


def _body_fields(t: int):
    if t == 1:
        return [("ltp", "<f4"), ("last_qty", "<u2"), ("vol", "<u4"), ("avg", "<f4"), ("oi", "<u4"),
                ("trade_time", "<u4"), ("update_time", "<u4")]
    if t == 2:
        out = []
        for i in range(5):
            out += [(f"bq{i}", "<u4"), (f"sq{i}", "<u4"), (f"bo{i}", "<u2"), (f"so{i}", "<u2"),
                    (f"bp{i}", "<f4"), (f"sp{i}", "<f4")]
        return out
    if t == 3:
        return [("o", "<f4"), ("c", "<f4"), ("h", "<f4"), ("l", "<f4")]
    if t == 5:
        return [("ltp", "<f4"), ("o", "<f4"), ("prev_close", "<f4"), ("h", "<f4"), ("l", "<f4"), ("trade_time", "<u4")]
    if t == 6:
        return [("total_ask", "<u4"), ("total_bid", "<u4"), ("best_bid_qty", "<u4"), ("best_ask_qty", "<u4"), ("best_bid_price", "<f4"),
                ("best_ask_price", "<f4")]
    if t == 29:
        return [("msg", "S3"), ("val", "<f4")]
    if t in (32, 33, 36):
        return [("a", "<f4"), ("b", "<f4")]
    if t == 37:
        return [("oi", "<u4")]
    return []


def _fill_body(t: int, rec, v, k, eid, s):
    f4 = np.float32
    if t == 1:
        rec["ltp"] = v.astype(f4); rec["last_qty"] = k; rec["vol"] = eid; rec["avg"] = v.astype(f4)
        rec["oi"] = np.where(k % 10 == 0, 4294967295, 1000 + k); rec["trade_time"] = s; rec["update_time"] = s
    elif t == 2:
        for i in range(5):
            rec[f"bq{i}"] = k + i; rec[f"sq{i}"] = k + 2 * i
            rec[f"bo{i}"] = i + 1; rec[f"so{i}"] = i + 2
            rec[f"bp{i}"] = (v - i).astype(f4); rec[f"sp{i}"] = (v + i).astype(f4)
    elif t == 3:
        rec["o"] = v.astype(f4); rec["c"] = (v + 1).astype(f4)
        rec["h"] = (v + 2).astype(f4); rec["l"] = (v - 1).astype(f4)
    elif t == 5:
        rec["ltp"] = v.astype(f4); rec["o"] = (v - 1).astype(f4)
        rec["prev_close"] = np.where(k == 0, 0.0, v + 1).astype(f4)
        rec["h"] = (v + 2).astype(f4); rec["l"] = (v - 2).astype(f4); rec["trade_time"] = s
    elif t == 6:
        rec["total_ask"] = k; rec["total_bid"] = np.where(k == 0, 0, 2 * k); rec["best_bid_qty"] = k + 1
        rec["best_ask_qty"] = k + 2; rec["best_bid_price"] = v.astype(f4); rec["best_ask_price"] = (v + 0.05).astype(f4)
    elif t == 29:
        rec["msg"] = b"OK"
        rec["val"] = np.asarray(STATUS_VALUE_CYCLE, dtype=f4)[k % 5]
    elif t == 32:
        rec["a"] = np.where(k == 0, 0.0, v).astype(f4); rec["b"] = (k * 10).astype(f4)
    elif t in (33, 36):
        rec["a"] = (v + 10).astype(f4); rec["b"] = (v - 10).astype(f4)
    elif t == 37:
        rec["oi"] = 1000 + 2 * k


# packet type -> full packet length (header + body); unknown types: header only
_FULL_LEN = np.full(256, 11, dtype=np.int64)
for _t in (1, 2, 3, 5, 6, 29, 32, 33, 36, 37):
    _FULL_LEN[_t] = 11 + np.dtype(_body_fields(_t)).itemsize


def _fixed_width(col: pa.Array, width: int) -> np.ndarray:
    """Arrow string/binary column -> NumPy ``S<width>`` (NUL-padded,
    truncated) straight from the offset and data buffers, no per-row Python."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int32)[col.offset: col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(col.buffers()[2], dtype=np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    lengths = np.minimum(np.diff(offsets), width)
    row = np.repeat(np.arange(n), lengths)
    place = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out = np.zeros((n, width), dtype=np.uint8)
    out[row, place] = data[offsets[row] + place]
    return out.view(f"S{width}").ravel()


def _binary_from_rows(lengths: np.ndarray, fill) -> pa.Array:
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    data = np.zeros(int(offsets[-1]), dtype=np.uint8)
    fill(data, offsets[:-1])
    return pa.Array.from_buffers(pa.binary(), len(lengths),
                                 [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _encode_price_batches(batches):
    for b in batches:
        n = b.num_rows
        eid = b.column("event_id").to_numpy(zero_copy_only=False).astype(np.int64)
        ptype = b.column("ptype").to_numpy(zero_copy_only=False).astype(np.int64)
        code = b.column("seg_code").to_numpy(zero_copy_only=False).astype(np.int64)
        sid = b.column("security_id").to_numpy(zero_copy_only=False).astype(np.int64)
        hdr_len = b.column("hdr_len").to_numpy(zero_copy_only=False).astype(np.int64)
        keep = b.column("keep_len").to_numpy(zero_copy_only=False).astype(np.int64)
        v = b.column("v").to_numpy(zero_copy_only=False).astype(np.float64)
        k = b.column("k").to_numpy(zero_copy_only=False).astype(np.int64)
        s = b.column("s").to_numpy(zero_copy_only=False).astype(np.int64)
        full_len = _FULL_LEN[ptype] if n else np.zeros(0, np.int64)
        out_len = np.where(keep >= 0, np.minimum(keep, full_len), full_len)

        def fill(data, starts):
            for t in np.unique(ptype):
                m = ptype == t
                fields = _HEADER + _body_fields(int(t))
                rec = np.zeros(int(m.sum()), dtype=np.dtype(fields))
                rec["code"] = code[m]; rec["sid"] = sid[m]; rec["type"] = t
                rec["len"] = np.where(hdr_len[m] >= 0, hdr_len[m], rec.dtype.itemsize)
                _fill_body(int(t), rec, v[m], k[m], eid[m], s[m])
                raw = rec.view(np.uint8).reshape(int(m.sum()), rec.dtype.itemsize)
                lens = out_len[m]
                for width in np.unique(lens):
                    mm = lens == width
                    idx = starts[m][mm][:, None] + np.arange(int(width))[None, :]
                    data[idx] = raw[mm][:, : int(width)]

        packet = _binary_from_rows(out_len, fill)
        yield pa.RecordBatch.from_arrays(
            [b.column("frame_id"), b.column("event_id"), b.column("recv_part"), packet],
            names=["frame_id", "event_id", "recv_part", "packet"])


_PACKET_SCHEMA = T.StructType([
    T.StructField("frame_id", T.LongType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("recv_part", T.TimestampNTZType()),
    T.StructField("packet", T.BinaryType()),
])


def _packet_inputs(events: DataFrame, master: DataFrame) -> DataFrame:
    codes = sized_side(master.select(
        F.col("security_id"), segment_code("exchange", "segment").alias("seg_code")))
    e = events.select(
        "event_id", "ts", "user_id", "value",
        F.get_json_object("props", "$.k").cast("long").alias("k"))
    return (e.join(codes, e.user_id == codes.security_id, "inner")
            .select(
                F.floor(F.col("event_id") / PACKETS_PER_PRICE_FRAME).cast("long").alias("frame_id"),
                "event_id",
                F.col("ts").cast("timestamp_ntz").alias("recv_part"),
                F.element_at(F.array(*[F.lit(t) for t in PACKET_TYPE_CYCLE]),
                             (F.col("event_id") % 10 + 1).cast("int")).alias("ptype"),
                "seg_code", "security_id",
                F.lit(-1).alias("hdr_len"), F.lit(-1).alias("keep_len"),
                F.col("value").alias("v"), "k",
                ts_to_wire_seconds(F.col("ts")).alias("s")))


_FRAME_SCHEMA = T.StructType([
    T.StructField("frame_id", T.LongType()),
    T.StructField("recv_ts", T.TimestampNTZType()),
    T.StructField("frame", T.BinaryType()),
])


def _whole_frames(batches):
    """Sorted batches cut anew, so that each ends with the last row of a frame."""
    rest = []
    for b in batches:
        if not b.num_rows:
            continue
        ids = b.column("frame_id").to_numpy(zero_copy_only=False)
        others = np.flatnonzero(ids != ids[-1])
        cut = others[-1] + 1 if len(others) else 0
        if rest and (cut or rest[-1].column("frame_id")[-1] != b.column("frame_id")[0]):
            yield pa.concat_batches([*rest, b.slice(0, cut)])
            rest = []
        elif cut:
            yield b.slice(0, cut)
        rest.append(b.slice(cut))
    if rest:
        yield pa.concat_batches(rest)


def _join_packets(batches):
    """Encoded packets in order of frame and event -> frames: packets side by
    side are the frame's bytes under coarser offsets.  Packets of one event
    come in the order of their bytes."""
    for b in batches:
        if not b.num_rows:
            continue
        frame, event = (b.column(c).to_numpy(zero_copy_only=False) for c in ("frame_id", "event_id"))
        packet = b.column("packet")
        tied = (frame[1:] == frame[:-1]) & (event[1:] == event[:-1])
        if tied.any():
            order = np.arange(len(frame))
            cuts = np.flatnonzero(np.concatenate([[True], ~tied, [True]]))
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if hi - lo > 1:
                    order[lo:hi] = sorted(range(lo, hi), key=lambda i: packet[i].as_py())
            packet = packet.take(pa.array(order))
        starts = np.flatnonzero(np.concatenate([[True], frame[1:] != frame[:-1]]))
        offsets = np.frombuffer(packet.buffers()[1], np.int32)[packet.offset:packet.offset + len(frame) + 1]
        never = np.iinfo(np.int64).min
        at = b.column("recv_part").cast(pa.int64()).fill_null(never).to_numpy()
        last = np.maximum.reduceat(at, starts)
        yield pa.RecordBatch.from_arrays(
            [b.column("frame_id").take(pa.array(starts)), pa.array(last, mask=last == never).cast(pa.timestamp("us")),
             pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets[np.append(starts, len(frame))]), packet.buffers()[2]])],
            names=["frame_id", "recv_ts", "frame"])


def _assemble_frames(inputs: DataFrame, encode) -> DataFrame:
    """Packet inputs -> frames in event order.  The inputs, far narrower than
    packets, are shuffled by frame and sorted; each task then encodes them and
    joins the packets of a frame, which lie side by side."""
    rows = inputs.repartition("frame_id").sortWithinPartitions("frame_id", "event_id")
    return rows.mapInArrow(lambda batches: _join_packets(encode(_whole_frames(batches))), _FRAME_SCHEMA)


def price_frames_from_events(events: DataFrame, master: DataFrame) -> DataFrame:
    """``(frame_id, recv_ts, frame)``: one packet per event, four per frame."""
    return _assemble_frames(_packet_inputs(events, master), _encode_price_batches)


def fixture_price_frames(spark: SparkSession, sf_dir: str, master: DataFrame | None = None) -> DataFrame:
    master = master if master is not None else fixture_master(spark, sf_dir)
    return price_frames_from_events(read_table(spark, sf_dir, "events"), master)


# Malformed price frames: one frame per event, the defect chosen by the
# event's position in a 6-cycle.  Expected outcome per kind:
#   0 truncated body          -> quarantine 'truncated'
#   1 length byte 5           -> quarantine 'bad_length'
#   2 frame shorter than 10 B -> quarantine 'short_frame'
#   3 unknown packet type 99  -> kept: a tick with no field written
#   4 unknown segment code 200-> quarantine 'unknown_segment'
#   5 unknown security id     -> quarantine 'unknown_instrument'
MALFORMED_PRICE_KINDS = ["truncated", "bad_length", "short_frame", "unknown_type",
                         "unknown_segment", "unknown_instrument"]
UNKNOWN_SECURITY_OFFSET = 10_000_000


def malformed_price_frames(events: DataFrame, master: DataFrame) -> DataFrame:
    base = _packet_inputs(events, master)
    kind = F.col("event_id") % 6
    bad = base.select(
        F.col("event_id").alias("frame_id"), "event_id", "recv_part",
        F.when(kind == 3, F.lit(99)).when(kind.isin(0, 1, 2), F.lit(1)).otherwise(F.lit(37)).alias("ptype"),
        F.when(kind == 4, F.lit(200)).otherwise(F.col("seg_code")).alias("seg_code"),
        F.when(kind == 5, F.col("security_id") + UNKNOWN_SECURITY_OFFSET)
        .otherwise(F.col("security_id")).alias("security_id"),
        F.when(kind == 1, F.lit(5)).when(kind == 0, F.lit(37)).otherwise(F.lit(-1)).alias("hdr_len"),
        F.when(kind == 0, F.lit(20)).when(kind == 2, F.lit(8)).otherwise(F.lit(-1)).alias("keep_len"),
        "v", "k", "s")
    packets = bad.mapInArrow(_encode_price_batches, _PACKET_SCHEMA)
    return packets.select("frame_id", F.col("recv_part").alias("recv_ts"), F.col("packet").alias("frame"))


# ---------------------------------------------------------------------------
# order frames from orders
# ---------------------------------------------------------------------------

_NP_KIND = {"i16": "<i2", "i32": "<i4", "f64": "<f8", "c": "S1"}


def _order_dtype() -> np.dtype:
    names, formats, offsets = [], [], []
    for name, off, kind in ORDER_LAYOUT:
        names.append(name)
        formats.append(_NP_KIND.get(kind, "S" + kind[1:]))
        offsets.append(off)
    return np.dtype({"names": names, "formats": formats, "offsets": offsets,
                     "itemsize": ORDER_PACKET_LEN})


def _encode_order_batches(batches):
    dt = _order_dtype()
    for b in batches:
        n = b.num_rows
        rec = np.zeros(n, dtype=dt)
        for name, _, kind in ORDER_LAYOUT:
            if name not in b.schema.names:
                continue  # stays empty
            if kind in ("i16", "i32", "f64"):
                rec[name] = b.column(name).to_numpy(zero_copy_only=False)
            else:
                rec[name] = _fixed_width(b.column(name), rec.dtype[name].itemsize)
        keep = b.column("keep_len").to_numpy(zero_copy_only=False).astype(np.int64)
        lens = np.where(keep >= 0, np.minimum(keep, ORDER_PACKET_LEN), ORDER_PACKET_LEN)
        raw = rec.view(np.uint8).reshape(n, ORDER_PACKET_LEN)

        def fill(data, starts):
            for width in np.unique(lens):
                mm = lens == width
                idx = starts[mm][:, None] + np.arange(int(width))[None, :]
                data[idx] = raw[mm][:, : int(width)]

        packet = _binary_from_rows(lens, fill)
        yield pa.RecordBatch.from_arrays(
            [b.column("frame_id"), b.column("event_id"), b.column("recv_part"), packet],
            names=["frame_id", "event_id", "recv_part", "packet"])


def _order_inputs(orders: DataFrame, master: DataFrame) -> DataFrame:
    inst = sized_side(master.select(
        F.col("security_id").alias("m_id"), F.col("exchange").alias("m_exchange"),
        F.col("segment").alias("m_segment")).where(F.col("m_id").between(1 - ORDER_SECURITY_MOD, ORDER_SECURITY_MOD - 1)))  # no remainder lies beyond
    o = orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
                      (F.col("o_orderkey") % ORDER_SECURITY_MOD).alias("sec"))
    qty = F.lit(100) + F.col("o_orderkey") % 500
    when_text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return (o.join(inst, o.sec == inst.m_id, "inner")
            .select(
                F.floor(F.col("o_orderkey") / PACKETS_PER_ORDER_FRAME).cast("long").alias("frame_id"),
                F.col("o_orderkey").alias("event_id"),
                F.col("o_orderdate").cast("timestamp_ntz").alias("recv_part"),
                F.col("m_exchange").alias("exchange"), F.col("m_segment").alias("segment"),
                F.col("sec").cast("string").alias("security_id"),
                F.col("o_orderkey").cast("string").alias("exch_order_no"),
                F.col("o_orderkey").cast("string").alias("order_no"),
                qty.cast("int").alias("quantity"),
                F.floor(qty / 2).cast("int").alias("traded_qty"),
                (qty - F.floor(qty / 2)).cast("int").alias("remaining_quantity"),
                (F.col("o_orderkey") % 5).cast("int").alias("lot_size"),
                F.col("o_totalprice").alias("price"), F.col("o_totalprice").alias("avg_traded_price"),
                F.lit(5.0).alias("tick_size"),
                when_text.alias("order_date_time"), when_text.alias("exch_order_time"),
                when_text.alias("last_updated_time"),
                F.element_at(F.array(*[F.lit(x) for x in PLATFORM_CYCLE]),
                             (F.col("o_orderkey") % 7 + 1).cast("int")).alias("splatform"),
                F.col("o_orderstatus").alias("status"),
                F.get(F.split("o_orderpriority", " "), 0).alias("order_type"),
                F.lit("").alias("remarks"),
                F.lit(ORDER_PACKET_LEN).cast("int").alias("msg_len"),
                F.lit(-1).alias("keep_len")))


def order_frames_from_orders(orders: DataFrame, master: DataFrame) -> DataFrame:
    return _assemble_frames(_order_inputs(orders, master), _encode_order_batches)


def fixture_order_frames(spark: SparkSession, sf_dir: str, master: DataFrame | None = None) -> DataFrame:
    master = master if master is not None else fixture_master(spark, sf_dir)
    return order_frames_from_orders(read_table(spark, sf_dir, "orders"), master)


# Every field of the record filled: those that the fixtures above leave empty
# take a value from the order's key and the field's offset.
def _filled(off: int, kind: str) -> Column:
    key = F.col("event_id")
    if kind == "i16":
        return ((key * (off + 1)) % 65536 - 32768).cast("int")
    if kind == "i32":
        return ((key * 7919 + off * 104729) % 4294967296 - 2147483648).cast("int")
    if kind == "f64":
        return ((key % 100003).cast("double") * 0.25 + off) * F.when(key % 2 == 1, -1.0).otherwise(1.0)
    if kind == "c":
        return F.chr(F.lit(48) + (key + off) % 43)
    text = F.when((key + off) % 2 == 0, key.cast("string")).otherwise(F.concat(F.lit(f"{off}-"), key.cast("string")))
    return F.substring(text, 1, int(kind[1:]))


def whole_order_frames(spark: SparkSession, sf_dir: str, master: DataFrame | None = None) -> DataFrame:
    """``fixture_order_frames`` with all fields of every record filled."""
    master = master if master is not None else fixture_master(spark, sf_dir)
    base = _order_inputs(read_table(spark, sf_dir, "orders"), master).drop("remarks")
    have = set(base.columns)
    fill = {n: _filled(off, kind) for n, off, kind in ORDER_LAYOUT if n not in have}
    return _assemble_frames(base.withColumns(fill), _encode_order_batches)


# Malformed order frames, one per order, by position in a 4-cycle:
#   0 length field 0          -> quarantine 'bad_length'
#   1 length field 500        -> quarantine 'bad_length'
#   2 truncated packet (700B) -> quarantine 'truncated'
#   3 invalid UTF-8 in remarks-> decoded with replacement, flagged
MALFORMED_ORDER_KINDS = ["zero_length", "length_500", "truncated", "invalid_utf8"]


def malformed_order_frames(orders: DataFrame, master: DataFrame) -> DataFrame:
    kind = F.col("event_id") % 4
    base = _order_inputs(orders, master)
    bad = (base.withColumn("frame_id", F.col("event_id"))
           .withColumn("msg_len", F.when(kind == 0, F.lit(0)).when(kind == 1, F.lit(500))
                       .otherwise(F.col("msg_len")).cast("int"))
           .withColumn("keep_len", F.when(kind == 2, F.lit(700)).otherwise(F.lit(-1)))
           .withColumn("remarks", F.when(kind == 3, F.unhex(F.lit("41FF42")))
                       .otherwise(F.lit(b"").cast("binary"))))
    packets = bad.mapInArrow(_encode_order_batches, _PACKET_SCHEMA)
    return packets.select("frame_id", F.col("recv_part").alias("recv_ts"), F.col("packet").alias("frame"))


# ---------------------------------------------------------------------------
# request and control tables
# ---------------------------------------------------------------------------

def lookup_requests(master: DataFrame) -> DataFrame:
    """One request per dated contract, built from the row's own fields."""
    m = master.where(F.col("instrument_type").startswith("OPT") | F.col("instrument_type").startswith("FUT"))
    return m.select(
        F.monotonically_increasing_id().alias("request_id"),
        F.get(F.split("trading_symbol", "-"), 0).alias("instrument"),
        "exchange", "instrument_type",
        F.col("expiry_date_str").alias("expiry_date"),
        F.when(F.col("instrument_type").startswith("OPT"), F.col("strike_price")).alias("strike"),
        F.when(F.col("instrument_type").startswith("OPT"), F.col("option_type")).alias("option_type"))


def chain_requests(master: DataFrame) -> DataFrame:
    """Per (underlying, exchange) with options: one request for a listed
    expiry (the latest), one for an unlisted date, one with no date."""
    opts = master.where(F.col("instrument_type").startswith("OPT")).select(
        F.get(F.split("trading_symbol", "-"), 0).alias("underlying"), "exchange", "expiry_date_str")
    per = opts.groupBy("underlying", "exchange").agg(F.max("expiry_date_str").alias("latest"))
    return per.select("underlying", "exchange", F.explode(F.array(
        F.col("latest"), F.lit("2030-01-01"), F.lit(None).cast("string"))).alias("expiry_date"))


def subscription_log(events: DataFrame, master: DataFrame) -> DataFrame:
    """``(ts, instrument_key, action, mode)``: signup events subscribe (FULL
    when k is even), error events unsubscribe."""
    keys = sized_side(master.select("security_id", "instrument_key"))
    e = events.where(F.col("event_type").isin("signup", "error")).select(
        "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type",
        F.get_json_object("props", "$.k").cast("long").alias("k"))
    return (e.join(keys, e.user_id == keys.security_id, "inner")
            .select("event_id", "ts", "instrument_key",
                    F.when(F.col("event_type") == "signup", "SUBSCRIBE").otherwise("UNSUBSCRIBE").alias("action"),
                    F.when(F.col("k") % 2 == 0, "FULL").otherwise("QUOTE").alias("mode")))


def reconnect_log(events: DataFrame) -> DataFrame:
    """Control rows without a key: every tenth error (k divisible by 10) is a lost connection."""
    k = F.get_json_object("props", "$.k").cast("long")
    return events.where((F.col("event_type") == "error") & (k % 10 == 0)).select(
        "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), F.lit(None).cast("string").alias("instrument_key"),
        F.lit("RECONNECT").alias("action"), F.lit(None).cast("string").alias("mode"))
