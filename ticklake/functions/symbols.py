"""Instrument kind resolver and trading-symbol builder."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import (DAY_EXPIRY_EXCHANGES, DAY_EXPIRY_TYPES, FUTURE_TYPES,
                       INSTRUMENT_TYPES, OPTION_TYPES)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def instrument_type(**flags: bool) -> str:
    """Python-side resolver for call arguments: ``is_optidx=True`` -> 'OPTIDX'.
    First true flag in precedence order wins; none -> ''."""
    for kind in INSTRUMENT_TYPES:
        if flags.get(f"is_{kind.lower()}"):
            return kind
    return ""


def instrument_type_col(*flag_cols_in_precedence: Column) -> Column:
    """Column form over ten boolean columns given in ``INSTRUMENT_TYPES``
    order."""
    out = F.lit("")
    for kind, flag in reversed(list(zip(INSTRUMENT_TYPES, flag_cols_in_precedence))):
        out = F.when(flag, F.lit(kind)).otherwise(out)
    return out


def strike_text(strike) -> Column:
    """Python ``str(float)`` style for the values strikes take: integral
    strikes print without a decimal part, others as the shortest text."""
    s = _c(strike)
    return (F.when(s.isNull(), F.lit(None).cast("string"))
            .when(s == F.floor(s), F.floor(s).cast("long").cast("string"))
            .otherwise(s.cast("string")))


def trading_symbol(underlying, exchange, kind, expiry_date, strike=None,
                   option_type=None) -> Column:
    """``UPPER-<expiry>-<strike>-<CE|PE|FUT>``; index/equity -> underlying.
    Expiry is ``ddMMMyyyy`` for day-expiry kinds on BSE/MCX, else
    ``MMMyyyy``; null parts are skipped (``concat_ws``)."""
    u, x, k, d = _c(underlying), _c(exchange), _c(kind), _c(expiry_date).cast("date")
    is_opt = k.isin(OPTION_TYPES)
    is_fut = k.isin(FUTURE_TYPES)
    day_fmt = x.isin(DAY_EXPIRY_EXCHANGES) & k.isin(DAY_EXPIRY_TYPES)
    expiry_text = F.when(day_fmt, F.date_format(d, "ddMMMyyyy")).otherwise(F.date_format(d, "MMMyyyy"))
    opt = _c(option_type) if option_type is not None else F.lit(None).cast("string")
    suffix = (F.when(is_opt & opt.isNotNull(), opt)
              .when(is_fut, F.lit("FUT"))
              .otherwise(F.lit("")))
    strike_part = strike_text(strike) if strike is not None else F.lit(None).cast("string")
    built = F.concat_ws("-", F.upper(u), expiry_text, strike_part, suffix)
    return (F.when(k.isin("INDEX", "EQUITY"), u)
            .when(d.isNotNull(), built))
