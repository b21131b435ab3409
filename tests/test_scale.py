"""Frames and orders at size: narrow shuffles, files that grow in number, records read as arrays."""

import contextlib
import io
import os
import random

import pyarrow as pa
from pyspark.sql import functions as F

from tests.conftest import SF0001
from ticklake.functions import text, wire
from ticklake.operators import decode, orders
from ticklake.plans import catalog
from ticklake.schemas import ORDER_LAYOUT, ORDER_PACKET_LEN
from ticklake.sources import fixtures as fx
from ticklake.sources import frames as fr


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_frames_equal_a_native_grouping(spark):
    """Rows that come twice, and events of one id with different packets."""
    m = fx.fixture_master(spark, SF0001)
    events = fx.read_table(spark, SF0001, "events").limit(300)
    events = events.unionAll(events.where("event_id % 3 = 0")).unionAll(events.where("event_id % 5 = 0").withColumn("value", F.col("value") + 1))
    inputs = fx._packet_inputs(events, m)
    packets = inputs.mapInArrow(fx._encode_price_batches, fx._PACKET_SCHEMA)
    want = (packets.groupBy("frame_id").agg(F.max("recv_part").alias("recv_ts"), F.array_sort(F.collect_list(F.struct("event_id", "packet"))).alias("p"))
            .select("frame_id", "recv_ts", F.aggregate("p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["packet"])).alias("frame")))
    got = fx._assemble_frames(inputs, fx._encode_price_batches)
    assert "ObjectHashAggregate" not in _plan(got)  # no packet is shuffled
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_frames_are_cut_whole_from_any_batches():
    rng = random.Random(5)
    ids = sorted(rng.randrange(12) for _ in range(60))
    for size in (1, 2, 7, 60):
        batches = [pa.RecordBatch.from_pydict({"frame_id": pa.array(ids[i:i + size], pa.int64())}) for i in range(0, 60, size)]
        parts = [b.column(0).to_pylist() for b in fx._whole_frames(iter(batches)) if b.num_rows]
        assert [x for p in parts for x in p] == ids
        assert all(a[-1] != b[0] for a, b in zip(parts, parts[1:]))


def test_landed_files_grow_with_the_table(spark, monkeypatch):
    assert [fr.files_for(n, 100) for n in (0, 400, 401, 5000)] == [4, 4, 5, 50]
    m = fx.fixture_master(spark, SF0001)
    monkeypatch.setattr(fr, "ORDER_PACKETS", 100)
    path = catalog._land(spark, fx.fixture_order_frames(spark, SF0001, m), SF0001, "orders", "grown")
    n = fx.read_table(spark, SF0001, "orders").count()
    assert sum(f.endswith(".parquet") for f in os.listdir(path)) == n // 100 > 4
    assert decode.good(orders.order_updates(fr.read_frames(spark, path))).count() == n


def test_order_records_equal_native_readers(spark):
    """Odd bytes in every field: blanks, NULs, invalid and whole UTF-8, any number."""
    rng = random.Random(3)
    bits = [b"A", b"7", b" ", b"\x00", b"\t", "é".encode(), "€".encode(), " ".encode(), b"\xff", b"\xe2\x82", b"\xf0\x9f", b"\xed\xa0\x80", b"\x85"]
    rows = []
    for i in range(400):
        record = bytearray(rng.randbytes(ORDER_PACKET_LEN))
        for _, off, kind in ORDER_LAYOUT:
            if kind == "c" or kind.startswith("s"):
                w = orders._width(kind)
                odd = bits if i % 2 else bits[:5]
                record[off:off + w] = b"".join(rng.choice(odd) for _ in range(rng.randrange(w + 1))).ljust(w, b"\x00")[:w]
        rows.append((i, bytes(record) if i % 7 else bytes(record[:rng.randrange(ORDER_PACKET_LEN)])))
    packets = (spark.createDataFrame(rows, "frame_id long, packet binary")
               .selectExpr("frame_id", "timestamp_ntz'2024-01-01' AS recv_ts", "0 AS packet_seq", "packet", "CAST(NULL AS STRING) AS split_error"))
    number = {"i16": wire.i16, "i32": wire.i32, "f64": wire.f64}
    whole = F.length("packet") == ORDER_PACKET_LEN
    fields = {n: (number[k]("packet", off) if k in number else text.strip_nul(wire.raw_text("packet", off, orders._width(k))))
              for n, off, k in ORDER_LAYOUT if n not in ("tick_size", "lot_size", *orders.TIME_FIELDS)}
    parts = [x for _, off, k in ORDER_LAYOUT if k == "c" or k.startswith("s") for x in (F.substring("packet", off + 1, orders._width(k)), F.lit(b"\x00"))]
    fields["utf8_valid"] = F.is_valid_utf8(F.concat(*parts).cast("string"))
    want = packets.select("frame_id", *(F.when(whole, c).alias(n) for n, c in fields.items())).orderBy("frame_id").collect()
    got = orders.decode_order_packets(packets, keep_personal=True).select("frame_id", *fields).orderBy("frame_id").collect()
    assert list(map(repr, got)) == list(map(repr, want))
    assert {r.utf8_valid for r in got} == {True, False, None}
