"""Text helpers as native Column expressions (F1-F3, F7, F8, F19, F20, F25,
F28)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def instrument_key(security_id, segment, exchange) -> Column:
    """``id-segment-exchange``; null when any part is null (``concat``, not
    ``concat_ws``)."""
    return F.concat(_c(security_id).cast("string"), F.lit("-"), _c(segment),
                    F.lit("-"), _c(exchange))


def split_part(col, index: int, sep: str = " ") -> Column:
    """0-based part of ``split``; null when missing (split into exactly N)."""
    return F.get(F.split(_c(col), sep), index)


def parse_date(col) -> Column:
    """``yyyy-MM-dd`` text -> DateType, null when unparsable."""
    return F.try_to_timestamp(_c(col), F.lit("yyyy-MM-dd")).cast("date")


def time_seconds(col) -> Column:
    """``HH:mm:ss`` text -> seconds of day (IntegerType), null when invalid."""
    c = _c(col)
    ok = c.rlike(r"^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$")
    parts = F.split(c, ":")
    secs = (F.get(parts, 0).cast("int") * 3600 + F.get(parts, 1).cast("int") * 60
            + F.get(parts, 2).cast("int"))
    return F.when(ok, secs)


# Characters Python's str.strip() removes (ASCII and Latin-1 range).
PY_SPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"


def strip_nul(col) -> Column:
    """Strip NULs at both ends, then blanks, then drop inner NULs (no regex:
    ``btrim`` with a character set, then ``replace``)."""
    c = F.btrim(_c(col), F.lit("\x00"))
    c = F.btrim(c, F.lit(PY_SPACE))
    return F.replace(c, F.lit("\x00"), F.lit(""))


def digits_to_long(col) -> Column:
    """All-digit text -> BIGINT, otherwise null (the numeric twin column)."""
    c = _c(col)
    return F.when(c.rlike(r"^[0-9]+$"), c.try_cast("long"))


def time_text_iso(col) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` -> ``yyyy-MM-ddTHH:mm:ss`` (spaces to T)."""
    return F.replace(_c(col), F.lit(" "), F.lit("T"))
