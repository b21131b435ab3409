"""Order updates.

Order packets are fixed 1,008-byte records, so a batch of them is one array
of records: numbers are read from it as they lie, text fields as valid UTF-8
with NULs stripped.  Invalid UTF-8 is replaced and flagged (``utf8_valid``),
not fatal (D2).  What is derived from the fields are native expressions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.codes import order_label
from ..functions.numeric import lots, tick_scale
from ..functions.text import PY_SPACE, digits_to_long, instrument_key, time_text_iso
from ..schemas import ORDER_LAYOUT, ORDER_PACKET_LEN, ORDER_PERSONAL_FIELDS
from .joins import sized_side

PKT = "packet"
ORD = ["recv_ts", "frame_id", "packet_seq"]
NUMERIC_TWINS = ["security_id", "exch_order_no", "order_no"]
TEXT_FIELDS = [n for n, _, k in ORDER_LAYOUT if k == "c" or k.startswith("s")]
TIME_FIELDS = [n for n, _, _ in ORDER_LAYOUT if n.endswith("_time")]


def _width(kind: str) -> int:
    return 1 if kind == "c" else int(kind[1:])


_RECORD = np.dtype({"names": [n for n, _, _ in ORDER_LAYOUT], "offsets": [off for _, off, _ in ORDER_LAYOUT], "itemsize": ORDER_PACKET_LEN,
                    "formats": [{"i16": "<i2", "i32": "<i4", "f64": "<f8"}.get(k) or f"S{_width(k)}" for _, _, k in ORDER_LAYOUT]})
_FIELD_TYPES = {"i16": T.IntegerType(), "i32": T.IntegerType(), "f64": T.DoubleType()}


def _clean_text(field: np.ndarray, bad: np.ndarray) -> pa.Array:
    """Fixed-width text (rows of bytes) -> valid UTF-8 stripped as ``strip_nul`` does; rows in ``bad`` hold invalid bytes, which are replaced."""
    n, width = field.shape
    raw = pa.Array.from_buffers(pa.binary(width), n, [None, pa.py_buffer(np.ascontiguousarray(field))]).cast(pa.binary())
    if len(bad):
        values = np.array(raw.to_pylist(), object)
        values[bad] = [v.decode("utf-8", "replace").encode() for v in values[bad]]
        raw = pa.array(values, pa.binary())
    text = pc.utf8_trim(pc.utf8_trim(raw.cast(pa.string()), "\x00"), PY_SPACE)
    return pc.replace_substring(text, "\x00", "")


def _valid_rows(data: np.ndarray) -> np.ndarray:
    """Whether all text fields of each record are valid UTF-8; only records with a byte beyond ASCII in them are decoded."""
    inside = np.zeros(ORDER_PACKET_LEN, np.uint8)
    texts = [(off, off + _width(k)) for _, off, k in ORDER_LAYOUT if k == "c" or k.startswith("s")]
    for a, b in texts:
        inside[a:b] = 0x80
    valid = np.ones(len(data), bool)
    for i in np.flatnonzero((data.view(np.uint64) & inside.view(np.uint64)).any(axis=1)):
        try:
            # a NUL ends any partial sequence, so this is valid if each field is
            b"\0".join(data[i, a:b].tobytes() for a, b in texts).decode("utf-8")
        except UnicodeDecodeError:
            valid[i] = False
    return valid


def _read_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fields of whole records (column ``packet``, null for the others), read from their bytes as one array of records."""
    for batch in batches:
        packet = batch.column("packet")
        whole = packet.drop_null().cast(pa.binary())
        there = pc.is_valid(packet).to_numpy(zero_copy_only=False)
        at = pa.array(np.cumsum(there) - 1, mask=~there)  # each row's record
        start = np.frombuffer(whole.buffers()[1], np.int32)[whole.offset] if len(whole) else 0
        bytes_ = np.frombuffer(whole.buffers()[2], np.uint8, len(whole) * ORDER_PACKET_LEN, start) if len(whole) else np.zeros(0, np.uint8)
        data = np.ascontiguousarray(bytes_).reshape(-1, ORDER_PACKET_LEN)
        if data.ctypes.data % 8:
            data = data.copy()
        records, valid = data.view(_RECORD)[:, 0], _valid_rows(data)
        columns = {}
        for name, off, kind in ORDER_LAYOUT:
            if kind in _FIELD_TYPES:
                columns[name] = pa.array(records[name].astype(np.float64 if kind == "f64" else np.int32))
            else:
                field = data[:, off:off + _width(kind)]
                columns[name] = _clean_text(field, np.flatnonzero(~valid & (field >= 0x80).any(axis=1)))
        columns["utf8_valid"] = pa.array(valid)
        kept = batch.schema.names[:-1]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(v.take(at) for v in columns.values())], names=[*kept, *columns])


def decode_order_packets(packets: DataFrame, keep_personal: bool = False) -> DataFrame:
    """B14 + F19-F25: split order packets -> typed, cleaned, derived rows.

    ``error`` is set for packets that are not whole records (from the split);
    those rows carry no fields."""
    from .decode import order_error
    p = packets.withColumn("error", F.when(F.col("split_error").isNotNull(), F.col("split_error"))
                           .when(order_error().isNotNull(), order_error())
                           .when(F.length(PKT) != ORDER_PACKET_LEN, F.lit("bad_length")))
    # a rejected packet carries no fields: its bytes are not read
    p = p.select(*ORD, "error", F.when(F.col("error").isNull(), F.col(PKT)).alias(PKT))
    fields = [T.StructField(n, _FIELD_TYPES.get(k, T.StringType())) for n, _, k in ORDER_LAYOUT]
    p = p.mapInArrow(_read_records, T.StructType([*p.drop(PKT).schema, *fields, T.StructField("utf8_valid", T.BooleanType())]))
    # F19 numeric twins, F20 time text, F21 tick scale, D4 lot guard
    p = p.withColumns({f"{n}_num": digits_to_long(n) for n in NUMERIC_TWINS})
    p = p.withColumns({n: time_text_iso(n) for n in TIME_FIELDS})
    p = p.withColumns({
        "tick_size": tick_scale("tick_size"),
        "lot_size": F.coalesce(F.nullif(F.col("lot_size"), F.lit(0)), F.lit(1)),
    })
    # F23 quantities in lots, F24 label, F25 key
    p = p.withColumns({
        "disp_remaining_quantity": lots("remaining_quantity", "lot_size"),
        "disp_traded_qty": lots("traded_qty", "lot_size"),
        "disp_quantity": lots("quantity", "lot_size"),
        "remarks_1": F.col("splatform"),
        "order_label": order_label("splatform"),
        "instrument_key": instrument_key(
            F.coalesce(F.col("security_id_num").cast("string"), F.col("security_id")), "segment", "exchange"),
    })
    fields = [n for n, _, _ in ORDER_LAYOUT if keep_personal or n not in ORDER_PERSONAL_FIELDS]
    derived = [f"{n}_num" for n in NUMERIC_TWINS] + [
        "disp_remaining_quantity", "disp_traded_qty", "disp_quantity", "remarks_1", "order_label",
        "instrument_key", "utf8_valid"]
    out = p.select(*ORD, "error", *fields, *derived)
    # a rejected packet carries no fields
    return out.withColumns({c: F.when(F.col("error").isNull(), F.col(c)) for c in fields + derived})


def numeric_twins(orders: DataFrame) -> DataFrame:
    """F19 for every text field: ``<name>_num`` is the number of an all-digit text, else null.

    Twins and text fields that ``orders`` has or lacks are left so."""
    have = set(orders.columns)
    return orders.withColumns({f"{n}_num": digits_to_long(n) for n in TEXT_FIELDS if n in have and f"{n}_num" not in have})


def order_record_type() -> T.StructType:
    """The record of one decoded order: what ``decode_order_packets`` returns after the error, personal fields left out."""
    record = T.StructType([T.StructField(n, _FIELD_TYPES.get(k, T.StringType())) for n, _, k in ORDER_LAYOUT if n not in ORDER_PERSONAL_FIELDS])
    for n in [*(f"{n}_num" for n in NUMERIC_TWINS), "disp_remaining_quantity", "disp_traded_qty", "disp_quantity"]:
        record.add(n, T.LongType())
    for n in ("remarks_1", "order_label", "instrument_key"):
        record.add(n, T.StringType())
    return record.add("utf8_valid", T.BooleanType())


def order_updates(frames: DataFrame, keep_personal: bool = False) -> DataFrame:
    from .frames import split_order_frames
    return decode_order_packets(split_order_frames(frames), keep_personal)


def enrich_orders(orders: DataFrame, master: DataFrame) -> DataFrame:
    """Attach the instrument (left join; Spark's own size check decides on a broadcast)."""
    inst = sized_side(master.select(
        "instrument_key", F.col("trading_symbol").alias("inst_trading_symbol"),
        F.col("display_name").alias("inst_display_name"), F.col("instrument_type").alias("inst_type"),
        F.col("lot_units").alias("inst_lot_units")))
    return orders.join(inst, "instrument_key", "left")


def orders_by_frame(orders: DataFrame) -> DataFrame:
    """The list of a frame's orders, in packet order.  A frame's size is
    bounded by the feed's frame length, so each group is small."""
    fields = ["packet_seq", *(c for c in orders.columns if c not in ("frame_id", "packet_seq"))]  # sorts by the first
    return orders.groupBy("frame_id").agg(
        F.min("recv_ts").alias("recv_ts"),
        F.array_sort(F.collect_list(F.struct(*fields))).alias("orders"))


def latest_orders(orders: DataFrame, control: DataFrame | None = None) -> DataFrame:
    """Last order per instrument (partial aggregation map-side); a frame
    that landed twice counts twice in ``orders_seen`` and shows once.

    Only the key and the packed arrival order are hash-aggregated, and whole
    records are read for the winners alone.  With a control log (``ts,
    instrument_key``; a null key for all) an instrument whose last reset came
    after its last order has no order: its order columns are null."""
    from .ticks import arrival_order, reset_rows
    if orders.isStreaming:
        return _latest_orders_stream(orders)
    order = arrival_order()
    last = orders.groupBy("instrument_key").agg(F.max(order).alias("_last"), F.count(F.lit(1)).alias("orders_seen"))
    last = last.withColumnRenamed("instrument_key", "_key")
    others = [c for c in orders.columns if c != "instrument_key"]
    if control is not None:
        resets = reset_rows(control).select("instrument_key", order.alias("_at"))
        own = resets.where(F.col("instrument_key").isNotNull()).groupBy("instrument_key").agg(F.max("_at").alias("_at"))
        shared = resets.where(F.col("instrument_key").isNull()).agg(F.max("_at").alias("at"))  # one row
        last = last.join(own, F.col("_key") == F.col("instrument_key"), "left").withColumn(
            "_gone", F.coalesce(F.greatest(F.col("_at"), shared.select("at").scalar()) > F.col("_last"), F.lit(False))).drop("instrument_key", "_at")
    else:
        last = last.withColumn("_gone", F.lit(False))
    found = orders.withColumn("_order", order).join(last, F.col("instrument_key").eqNullSafe(F.col("_key")) & (F.col("_order") == F.col("_last")))
    found = found.dropDuplicates(["instrument_key"])
    if control is None:
        return found.select("instrument_key", "orders_seen", *others)
    return found.select("instrument_key", "orders_seen", *(F.when(~F.col("_gone"), F.col(c)).alias(c) for c in others))


def _latest_orders_stream(orders: DataFrame) -> DataFrame:
    """The streaming form keeps the record in its state."""
    others = [c for c in orders.columns if c != "instrument_key"]
    agg = orders.groupBy("instrument_key").agg(
        F.max_by(F.struct(*others), F.struct(*ORD)).alias("_o"), F.count(F.lit(1)).alias("orders_seen"))
    return agg.select("instrument_key", "orders_seen", "_o.*")
