"""Code tables (F9-F11, S6 request codes, F24 order labels) as native
expressions over literal maps — no join, no Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import (FULL, INDEX_SEGMENT_CODE, MARKET_STATUS, ORDER_LABELS,
                       QUOTE, REQUEST_CODE_OTHER, REQUEST_CODE_SUB_FULL,
                       REQUEST_CODE_SUB_QUOTE, REQUEST_CODE_SUB_QUOTE_INDEX,
                       REQUEST_CODE_UNSUB_FULL, REQUEST_CODE_UNSUB_QUOTE,
                       SEGMENT_BY_CODE, SEGMENT_CODES, SUBSCRIBE, UNSUBSCRIBE)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _map(pairs) -> Column:
    return F.create_map(*[F.lit(v) for kv in pairs for v in kv])


def segment_code(exchange, segment) -> Column:
    """(exchange, segment) -> wire code; empty segment -1, segment I -> 0,
    unknown -> -1 (F9)."""
    x, s = _c(exchange), _c(segment)
    lookup = _map([(f"{e}|{g}", c) for e, g, c in SEGMENT_CODES])
    return (F.when(s.isNull() | (s == ""), F.lit(-1))
            .when(s == "I", F.lit(INDEX_SEGMENT_CODE))
            .otherwise(F.coalesce(lookup[F.concat_ws("|", x, s)], F.lit(-1))))


def code_exchange(code) -> Column:
    return _map([(c, e) for c, e, _, _ in SEGMENT_BY_CODE if e is not None])[_c(code)]


def code_segment(code) -> Column:
    return _map([(c, s) for c, _, s, _ in SEGMENT_BY_CODE])[_c(code)]


def code_decimals(code) -> Column:
    return F.coalesce(_map([(c, d) for c, _, _, d in SEGMENT_BY_CODE])[_c(code)], F.lit(2))


def code_known(code) -> Column:
    return _c(code).isin([c for c, _, _, _ in SEGMENT_BY_CODE])


def wire_key(code, security_id) -> Column:
    """Key named by the wire alone (index -> ``id-I-IDX``); '' when unmapped."""
    ex = F.when(_c(code) == INDEX_SEGMENT_CODE, F.lit("IDX")).otherwise(code_exchange(code))
    return F.coalesce(F.concat(_c(security_id).cast("string"), F.lit("-"), code_segment(code),
                               F.lit("-"), ex), F.lit(""))


def market_status_text(value) -> Column:
    """Status value -> PREOPEN/OPEN/POSTCLOSE/CLOSE, else null."""
    return _map(list(MARKET_STATUS.items()))[_c(value).cast("int")]


def request_code(action, mode, segment) -> Column:
    a, m, s = _c(action), _c(mode), _c(segment)
    return (F.when((a == SUBSCRIBE) & (m == QUOTE),
                   F.when(s == "I", F.lit(REQUEST_CODE_SUB_QUOTE_INDEX)).otherwise(F.lit(REQUEST_CODE_SUB_QUOTE)))
            .when((a == UNSUBSCRIBE) & (m == QUOTE), F.lit(REQUEST_CODE_UNSUB_QUOTE))
            .when((a == SUBSCRIBE) & (m == FULL), F.lit(REQUEST_CODE_SUB_FULL))
            .when((a == UNSUBSCRIBE) & (m == FULL), F.lit(REQUEST_CODE_UNSUB_FULL))
            .otherwise(F.lit(REQUEST_CODE_OTHER)))


def order_label(platform) -> Column:
    p = _c(platform)
    out = F.lit("")
    for needles, label in reversed(ORDER_LABELS):
        cond = None
        for n in needles:
            cond = p.contains(n) if cond is None else (cond | p.contains(n))
        out = F.when(cond, F.lit(label)).otherwise(out)
    return out
