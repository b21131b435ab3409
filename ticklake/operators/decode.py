"""Price packet decoding (B3-B13, B15) and instrument resolution.

``decode_price_packets`` turns split packets into one *wide* row per packet:
every tick-state column exists on every row and is non-null exactly when
this packet type writes it (P12: one pass of ``when(packet_type == k)``
columns, all native expressions).  That shape feeds the state operators
directly: "latest state" is "last non-null value per column".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import wire
from ..functions.codes import (code_decimals, code_known, market_status_text,  # noqa: F401
                               segment_code)
from ..functions.numeric import oi_sentinel, round_f32, with_book_shares
from ..functions.text import strip_nul
from ..schemas import BODY_LEN, DEPTH_LEVEL, DEPTH_LEVELS, HEADER_LEN
from .joins import sized_side

B = HEADER_LEN  # body offset
PKT = "packet"


def _on(t: int, value: Column) -> Column:
    return F.when(F.col("packet_type") == t, value)


def _r(x: Column) -> Column:
    return round_f32(x, F.col("decimals"))


# Body word offsets each packet type reads (u16 fields are the low half of
# the u32 read at the same offset) and which of them are f32.  A word is
# only read for the packet types that use it, so a 4-byte open-interest
# packet does not pay for the 30 words of a depth packet.
_DEPTH_WORDS = [20 * i + d for i in range(DEPTH_LEVELS) for d in (0, 4, 8, 10, 12, 16)]
_TYPE_WORDS = {
    1: [0, 4, 6, 10, 14, 18, 22], 2: _DEPTH_WORDS, 3: [0, 4, 8, 12], 5: [0, 4, 8, 12, 16, 20],
    6: [0, 4, 8, 12, 16, 20], 29: [3], 32: [0, 4], 33: [0, 4], 36: [0, 4], 37: [0],
}
_TYPE_FLOATS = {
    1: [0, 10], 2: [20 * i + d for i in range(DEPTH_LEVELS) for d in (12, 16)], 3: [0, 4, 8, 12],
    5: [0, 4, 8, 12, 16], 6: [16, 20], 29: [3], 32: [0, 4], 33: [0, 4], 36: [0, 4],
}


def _users(table: dict[int, list[int]]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for t, offs in table.items():
        for o in offs:
            out.setdefault(o, []).append(t)
    return out


_WORD_USERS = _users(_TYPE_WORDS)
_FLOAT_USERS = _users(_TYPE_FLOATS)
_WORDS = sorted(_WORD_USERS)
_FLOATS = sorted(_FLOAT_USERS)


def _w(o: int) -> Column:
    return F.col(f"_w{o}")


def _h16(o: int) -> Column:
    return _w(o).bitwiseAND(65535)


def _f(o: int) -> Column:
    return F.col(f"_f{o}")


def _depth(side: str) -> Column:
    # per level (20 bytes): bid qty u32, ask qty u32, bid orders u16,
    # ask orders u16, bid price f32, ask price f32 — prices not rounded.
    q_off, o_off, p_off = (0, 8, 12) if side == "buy" else (4, 10, 16)
    levels = [F.struct(_w(20 * i + q_off).alias("quantity"),
                       _f(20 * i + p_off).alias("price"),
                       _h16(20 * i + o_off).cast("int").alias("orders"))
              for i in range(DEPTH_LEVELS)]
    return F.array(*levels).cast(f"array<{DEPTH_LEVEL.simpleString()}>")


def decode_header(packets: DataFrame) -> DataFrame:
    """Header fields; the second u32 of the header is ignored."""
    return packets.withColumns({
        "seg_code": wire.u8(PKT, 0),
        "security_id": wire.u32(PKT, 5),
        "packet_length": wire.u8(PKT, 9),
        "packet_type": wire.u8(PKT, 10),
    })


def order_error() -> Column:
    """Packets whose place in the arrival order is unknown or beyond its bounds."""
    from .ticks import arrival_bounds
    known = arrival_bounds() & F.col("frame_id").between(0, 2 ** 56 - 1) & F.col("packet_seq").between(0, 2 ** 16 - 1)
    return F.when(~F.coalesce(known, F.lit(False)), F.lit("bad_arrival_order"))


def _body_error() -> Column:
    body = F.length(PKT) - B
    expected = F.create_map(*[F.lit(x) for kv in BODY_LEN.items() for x in kv])[F.col("packet_type")]
    return (F.when(F.col("split_error").isNotNull(), F.col("split_error"))
            .when(order_error().isNotNull(), order_error())
            .when(F.length(PKT) < B, F.lit("truncated"))
            .when(expected.isNotNull() & (body != expected), F.lit("bad_body_length"))
            .when(~code_known(F.col("seg_code")), F.lit("unknown_segment")))


def decode_price_packets(packets: DataFrame) -> DataFrame:
    """B3-B13 on split packets -> wide decoded rows + ``error`` column.

    Staged projections (words read once from O(1) binary slices -> floats
    -> per-type columns) keep every generated method small enough for
    whole-stage codegen.
    """
    h = decode_header(packets).withColumn("decimals", code_decimals(F.col("seg_code")))
    h = h.withColumn("error", _body_error())
    ptype = F.col("packet_type")
    h = h.withColumns({f"_w{o}": F.when(ptype.isin(_WORD_USERS[o]), wire.uint_le(PKT, B + o, 4))
                       for o in _WORDS})
    h = h.withColumns({f"_f{o}": F.when(ptype.isin(_FLOAT_USERS[o]), wire.f32_from_bits(_w(o)))
                       for o in _FLOATS})
    status_value = _r(_f(3))
    cols = {
        # 1 trade, 5 index
        "ltp": _on(1, _r(_f(0))).otherwise(_on(5, _r(_f(0)))),
        "last_traded_qty": _on(1, _h16(4)),
        "volume": _on(1, _w(6)),
        "average_price": _on(1, _r(_f(10))),
        "open_interest": _on(1, oi_sentinel(_w(14))).otherwise(_on(37, _w(0))),
        "last_trade_time": _on(1, wire.wire_seconds_to_ts(_w(18)))
        .otherwise(_on(5, wire.wire_seconds_to_ts(_w(20)))),
        "last_updated_time": _on(1, wire.wire_seconds_to_ts(_w(22))),
        # 3 OHLC: wire order open, close, high, low; 5 index
        "open": _on(3, _r(_f(0))).otherwise(_on(5, _r(_f(4)))),
        "close": _on(3, _r(_f(4))),
        "high": _on(3, _r(_f(8))).otherwise(_on(5, _r(_f(12)))),
        "low": _on(3, _r(_f(12))).otherwise(_on(5, _r(_f(16)))),
        "prev_close": _on(5, _r(_f(8))).otherwise(_on(32, _r(_f(0)))),
        # 6 top of book: total ask, total bid, best bid qty, best ask qty, bid px, ask px
        "total_ask_qty": _on(6, _w(0)),
        "total_bid_qty": _on(6, _w(4)),
        "best_bid_qty": _on(6, _w(8)),
        "best_ask_qty": _on(6, _w(12)),
        "best_bid_price": _on(6, _r(_f(16))),
        "best_ask_price": _on(6, _r(_f(20))),
        # 32 previous close / OI, 33 circuit (upper first), 36 52-week (high first)
        "prev_open_interest": _on(32, _r(_f(4))),
        "upper_circuit": _on(33, _r(_f(0))),
        "lower_circuit": _on(33, _r(_f(4))),
        "week52_high": _on(36, _r(_f(0))),
        "week52_low": _on(36, _r(_f(4))),
        # 2 depth
        "depth_buy": _on(2, _depth("buy")),
        "depth_sell": _on(2, _depth("sell")),
        # 29 market status (global, not the instrument)
        "status_msg": _on(29, strip_nul(F.substring(PKT, B + 1, 3).cast("string"))),
        "status_value": _on(29, status_value),
        "market_status": _on(29, market_status_text(F.floor(status_value))),
    }
    # a packet with an error writes nothing
    cols = {k: F.when(F.col("error").isNull(), v) for k, v in cols.items()}
    scratch = [f"_w{o}" for o in _WORDS] + [f"_f{o}" for o in _FLOATS]
    out = h.withColumns(cols).drop(*scratch)
    # shares are of the two quantities, which only top-of-book packets write
    return with_book_shares(out, "total_bid_qty", "total_ask_qty", "decimals",
                            "total_bid_ask_qty", "total_bid_qty_prcnt", "total_ask_qty_prcnt")


# ---------------------------------------------------------------------------
# instrument resolution (J2 with D1)
# ---------------------------------------------------------------------------

def resolution_table(master: DataFrame) -> DataFrame:
    """(security_id, seg_code) -> instrument_key, built with the forward code
    map (F9) so an index resolves on any exchange (D1) and every code the
    feed can send maps back (D12); an id that two instruments of one code share
    is ambiguous.  Bounded by the master's size."""
    return (master.select("security_id", segment_code("exchange", "segment").alias("seg_code"),
                          "instrument_key")
            .where(F.col("seg_code") >= 0)
            .groupBy("security_id", "seg_code").agg(
                F.min("instrument_key").alias("instrument_key"),
                (F.min("instrument_key") != F.max("instrument_key")).alias("_ambiguous")))


def resolve_instruments(decoded: DataFrame, master: DataFrame) -> DataFrame:
    """Attach ``instrument_key``; unknown instruments get
    ``error='unknown_instrument'`` (the feed would fail on them)."""
    res = sized_side(resolution_table(master))
    out = decoded.join(res, ["security_id", "seg_code"], "left")
    return out.withColumn("error", F.coalesce(
        F.col("error"), F.when(F.col("instrument_key").isNull(), F.lit("unknown_instrument"))
        .when(F.col("_ambiguous"), F.lit("ambiguous_instrument")))).drop("_ambiguous")


def price_packets(frames: DataFrame, master: DataFrame) -> DataFrame:
    """Frames -> resolved, decoded packets (good and bad rows)."""
    from .frames import split_price_frames
    return resolve_instruments(decode_price_packets(split_price_frames(frames)), master)


def good(df: DataFrame) -> DataFrame:
    return df.where(F.col("error").isNull())


def quarantine(df: DataFrame) -> DataFrame:
    """``(frame_id, packet_seq, reason)`` of every rejected packet."""
    return df.where(F.col("error").isNotNull()).select(
        "frame_id", "recv_ts", "packet_seq", F.col("error").alias("reason"))
