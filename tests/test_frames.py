import struct

from pyspark.sql import types as T

from ticklake.operators import decode, orders
from ticklake.operators.frames import split_order_frames, split_price_frames
from ticklake.schemas import ORDER_LAYOUT

SCHEMA = T.StructType([T.StructField("frame_id", T.LongType()), T.StructField("recv_ts", T.TimestampNTZType()),
                       T.StructField("frame", T.BinaryType())])


def _hdr(code, sid, length, ptype):
    return struct.pack("<BIIBB", code, 0, sid, length, ptype)


def _frames(spark, frames):
    import datetime as dt
    return spark.createDataFrame([(i, dt.datetime(2024, 1, 1), bytearray(f)) for i, f in enumerate(frames)], SCHEMA)


def test_price_split_edge_cases(spark):
    oi = _hdr(1, 7, 15, 37) + struct.pack("<I", 1234)
    ohlc = _hdr(2, 8, 27, 3) + struct.pack("<4f", 1.0, 2.0, 3.0, 0.5)
    frames = [oi + ohlc,                       # two packets
              oi + _hdr(1, 7, 5, 37) + b"\x00" * 4,   # second length < 11: walk stops
              oi + b"\x01\x02\x03",            # 3 bytes left: cannot read a length
              oi + ohlc[:20],                  # last packet truncated
              b"",                             # empty frame: no packets
              oi + _hdr(1, 7, 14, 37) + b"\x00" * 3]   # right length byte, short body
    got = split_price_frames(_frames(spark, frames)).orderBy("frame_id", "packet_seq").collect()
    shape = [(r["frame_id"], r["packet_seq"], len(r["packet"]), r["split_error"]) for r in got]
    assert shape == [(0, 0, 15, None), (0, 1, 27, None),
                     (1, 0, 15, None), (1, 1, 15, "bad_length"),
                     (2, 0, 15, None), (2, 1, 3, "short_frame"),
                     (3, 0, 15, None), (3, 1, 20, "truncated"),
                     (5, 0, 15, None), (5, 1, 14, None)]
    dec = decode.decode_price_packets(split_price_frames(_frames(spark, frames)))
    errs = {(r["frame_id"], r["packet_seq"]): (r["error"], r["open_interest"], r["close"])
            for r in dec.collect()}
    assert errs[(0, 0)] == (None, 1234, None) and errs[(0, 1)] == (None, None, 2.0)
    assert errs[(5, 1)][0] == "bad_body_length" and errs[(3, 1)][0] == "truncated"


def _order_packet(length=1008, text=b"ABC"):
    buf = bytearray(1008)
    offs = {n: (o, k) for n, o, k in ORDER_LAYOUT}
    struct.pack_into("<h", buf, offs["msg_len"][0], length)
    struct.pack_into("<i", buf, offs["quantity"][0], 250)
    struct.pack_into("<i", buf, offs["lot_size"][0], 0)
    struct.pack_into("<d", buf, offs["price"][0], -1234.5)
    buf[offs["exchange"][0]:offs["exchange"][0] + 3] = b"NSE"
    buf[offs["segment"][0]] = ord("D")
    buf[offs["security_id"][0]:offs["security_id"][0] + 3] = b"042"
    buf[offs["remarks"][0]:offs["remarks"][0] + len(text)] = text
    buf[offs["order_date_time"][0]:offs["order_date_time"][0] + 19] = b"2024-01-02 09:15:00"
    return bytes(buf)


def test_order_split_and_decode(spark):
    good = _order_packet()
    frames = [good + good, _order_packet(length=0), _order_packet(length=500), good + good[:700],
              _order_packet(text=b"A\xffB")]
    sp = split_order_frames(_frames(spark, frames)).orderBy("frame_id", "packet_seq").collect()
    assert [(r["frame_id"], r["packet_seq"], r["split_error"]) for r in sp] == [
        (0, 0, None), (0, 1, None), (1, 0, "bad_length"), (2, 0, "bad_length"), (3, 0, None), (3, 1, "truncated"),
        (4, 0, None)]
    dec = orders.order_updates(_frames(spark, frames)).where("error IS NULL").orderBy("frame_id").collect()
    r = dec[0]
    assert (r["quantity"], r["lot_size"], r["disp_quantity"], r["price"]) == (250, 1, 250, -1234.5)   # D4
    assert r["instrument_key"] == "42-D-NSE" and r["security_id"] == "042" and r["security_id_num"] == 42
    assert r["order_date_time"] == "2024-01-02T09:15:00" and r["utf8_valid"]
    bad = [x for x in dec if x["frame_id"] == 4][0]
    assert bad["utf8_valid"] is False and bad["remarks"] == "A�B"


def test_price_split_equals_a_plain_walk(spark):
    """Frames of 0 to 3,000 packets, cut at any byte, against a walk in Python; null frames hold nothing."""
    import datetime as dt
    import random
    rng = random.Random(11)
    frames = []
    for _ in range(120):
        f = b"".join(_hdr(2, rng.randrange(9), n, 3) + rng.randbytes(n - 11) for n in rng.choices([11, 15, 27, 255, 43], k=rng.choice([0, 1, 4, 40])))
        frames.append(f[:len(f) - rng.choice([0, 0, 1, 5, 12])] + rng.choice([b"", b"", b"\x01", rng.randbytes(30)]))
    frames += [b"".join(_hdr(2, i, 11, 3) for i in range(3000)), b"\x00" * 9, b"\x00" * 10]
    want = []
    for i, f in enumerate(frames):
        at, seq = 0, 0
        while at < len(f):
            left, n = len(f) - at, f[at + 9] if len(f) - at > 9 else 0
            error = "short_frame" if left < 10 else "bad_length" if n < 11 else "truncated" if n > left else None
            stop = at + n if error is None else len(f)
            want.append((i, seq, f[at:stop], error))
            at, seq = stop, seq + 1
    df = _frames(spark, frames).repartition(3).unionByName(spark.createDataFrame([(-1, dt.datetime(2024, 1, 1), None)], SCHEMA))
    got = [(r.frame_id, r.packet_seq, bytes(r.packet), r.split_error) for r in split_price_frames(df).collect()]
    assert sorted(got, key=lambda r: r[:2]) == want
    assert split_price_frames(df.limit(0)).count() == 0
