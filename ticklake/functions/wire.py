"""Little-endian readers over a BinaryType column, as native Column
expressions (JVM-side, inside whole-stage codegen; no Python per row).

Offsets are 0-based byte offsets into the binary value.  Callers check the
length first (see ``operators.decode``); a reader over missing bytes yields
garbage or null, never an exception.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import WIRE_EPOCH


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def uint_le(col, offset: int, nbytes: int) -> Column:
    """Unsigned little-endian integer of 1..7 bytes as LongType: the bytes
    are reordered as O(1) binary slices, hexed once, and read base-16."""
    b = _c(col)
    big_endian = F.concat(*[F.substring(b, offset + i + 1, 1) for i in reversed(range(nbytes))])
    return F.conv(F.hex(big_endian), 16, 10).cast("long")


def u8(col, offset: int) -> Column:
    return F.conv(F.hex(F.substring(_c(col), offset + 1, 1)), 16, 10).cast("int")


def u16(col, offset: int) -> Column:
    return uint_le(col, offset, 2)


def u32(col, offset: int) -> Column:
    return uint_le(col, offset, 4)


def i16(col, offset: int) -> Column:
    u = uint_le(col, offset, 2)
    return F.when(u >= 32768, u - 65536).otherwise(u).cast("int")


def i32(col, offset: int) -> Column:
    u = uint_le(col, offset, 4)
    return F.when(u >= 2147483648, u - 4294967296).otherwise(u).cast("int")


def f32_from_bits(bits: Column) -> Column:
    """IEEE-754 single from its 32 bits (LongType) -> exact DoubleType."""
    sign = F.when(bits >= 2147483648, F.lit(-1.0)).otherwise(F.lit(1.0))
    exp = F.shiftright(bits, 23).bitwiseAND(255)
    man = bits.bitwiseAND(8388607)
    normal = sign * (man + 8388608).cast("double") * F.pow(F.lit(2.0), exp - 150)
    sub = sign * man.cast("double") * F.pow(F.lit(2.0), F.lit(-149.0))
    special = F.when(man == 0, sign * F.lit(float("inf"))).otherwise(F.lit(float("nan")))
    return F.when(exp == 0, sub).when(exp == 255, special).otherwise(normal)


def f32(col, offset: int) -> Column:
    return f32_from_bits(u32(col, offset))


def f64(col, offset: int) -> Column:
    """IEEE-754 double from 8 little-endian bytes, read as two 32-bit halves so
    no step overflows a signed 64-bit value."""
    lo = u32(col, offset)
    hi = u32(col, offset + 4)
    sign = F.when(hi >= 2147483648, F.lit(-1.0)).otherwise(F.lit(1.0))
    exp = F.shiftright(hi, 20).bitwiseAND(2047)
    man = hi.bitwiseAND(1048575) * F.lit(4294967296) + lo
    normal = sign * (man + F.lit(4503599627370496)).cast("double") * F.pow(F.lit(2.0), exp - 1075)
    sub = sign * man.cast("double") * F.pow(F.lit(2.0), F.lit(-1074.0))
    special = F.when(man == 0, sign * F.lit(float("inf"))).otherwise(F.lit(float("nan")))
    return F.when(exp == 0, sub).when(exp == 2047, special).otherwise(normal)


def raw_text(col, offset: int, nbytes: int) -> Column:
    """Fixed-width text field: bytes -> valid UTF-8 string (bad bytes replaced)."""
    return F.make_valid_utf8(F.substring(_c(col), offset + 1, nbytes).cast("string"))


_EPOCH = f"timestamp_ntz'{WIRE_EPOCH}'"


def wire_seconds_to_ts(seconds: Column) -> Column:
    """Wire seconds -> naive local wall-clock (TIMESTAMP_NTZ)."""
    return F.timestamp_add("SECOND", seconds, F.expr(_EPOCH))


def date_to_wire_seconds(d: Column) -> Column:
    """Date -> wire seconds, truncating to midnight first (as the feed's
    helper does; not a true inverse of ``wire_seconds_to_ts``)."""
    return F.datediff(d.cast("date"), F.lit("1980-01-01").cast("date")).cast("long") * 86400 - 19800


def ts_to_wire_seconds(ts: Column) -> Column:
    """Wall-clock timestamp -> whole wire seconds (floor); used by encoders."""
    return F.timestamp_diff("SECOND", F.expr(_EPOCH), ts.cast("timestamp_ntz"))
