"""DuckDB oracle SQL for every registered query.

Each string runs on DuckDB against the driver's tables (views ``part``,
``events``, ``orders`` ...).  The fixture rules are re-stated here in SQL
*independently* of the Spark code, so a Spark bug does not hide itself in
the oracle.  Shared CTEs are plain text prepended to each query.
"""

from __future__ import annotations

from ..schemas import ORDER_LAYOUT

# FIXED VALUES — same fixture rules as sources/fixtures.py, in SQL.
MASTER_CTE = r"""
m0 AS (
  SELECT p_partkey AS p, p_partkey // 10 AS q, p_size,
         ['INDEX','EQUITY','FUTIDX','FUTSTK','FUTCUR','FUTCOM','OPTIDX','OPTSTK','OPTCUR','OPTFUT'][(p_partkey % 10) + 1] AS kind,
         'U' || CAST((p_partkey // 40) % 5 AS VARCHAR) AS underlying
  FROM part
),
m1 AS (
  SELECT *,
    CASE WHEN kind = 'INDEX' THEN 'I' WHEN kind = 'EQUITY' THEN 'E' WHEN kind LIKE '%CUR' THEN 'C'
         WHEN kind IN ('FUTCOM','OPTFUT') THEN 'M' ELSE 'D' END AS segment,
    CASE WHEN kind LIKE '%CUR' THEN 'BSE' WHEN kind IN ('FUTCOM','OPTFUT') THEN 'MCX' ELSE 'NSE' END AS exchange,
    CASE WHEN kind IN ('INDEX','EQUITY') THEN NULL
         ELSE CAST(DATE '2024-01-04' + CAST(14 * (q % 4) AS INTEGER) AS DATE) END AS exp_d,
    CASE WHEN kind LIKE 'OPT%' THEN 100.0 + 50.0 * (p // 400) + CASE WHEN kind = 'OPTCUR' THEN 0.5 ELSE 0.0 END END AS strike,
    CASE WHEN kind LIKE 'OPT%' THEN CASE WHEN (p // 200) % 2 = 0 THEN 'CE' ELSE 'PE' END
         WHEN kind LIKE 'FUT%' THEN 'NA' END AS opt
  FROM m0
),
m2 AS (
  SELECT *,
    CASE WHEN strike IS NULL THEN NULL WHEN strike = floor(strike) THEN CAST(CAST(strike AS BIGINT) AS VARCHAR)
         ELSE CAST(strike AS VARCHAR) END AS strike_txt,
    CASE WHEN exchange IN ('BSE','MCX') AND kind IN ('FUTCUR','OPTCUR','OPTFUT','FUTCOM')
         THEN strftime(exp_d, '%d%b%Y') ELSE strftime(exp_d, '%b%Y') END AS exp_txt
  FROM m1
),
master AS (
  SELECT exchange, segment, CAST(p AS BIGINT) AS security_id, kind AS instrument_type,
    CAST(q % 4 AS INTEGER) AS expiry_code,
    CASE WHEN kind IN ('INDEX','EQUITY') THEN underlying
         ELSE concat_ws('-', upper(underlying), exp_txt, strike_txt,
                        CASE WHEN kind LIKE 'OPT%' THEN opt ELSE 'FUT' END) END AS trading_symbol,
    CAST(p_size AS DOUBLE) AS lot_units,
    CASE WHEN kind LIKE 'OPT%' THEN concat_ws(' ', underlying, upper(strftime(exp_d, '%d %b')), strike_txt,
                                              CASE WHEN opt = 'CE' THEN 'CALL' ELSE 'PUT' END)
         WHEN kind LIKE 'FUT%' THEN concat_ws(' ', underlying, upper(strftime(exp_d, '%b')), 'FUT')
         ELSE underlying END AS display_name,
    CASE WHEN exp_d IS NULL THEN NULL ELSE strftime(exp_d, '%Y-%m-%d') || ' 14:30:00' END AS expiry_raw,
    CAST(strike AS DOUBLE) AS strike_price,
    opt AS option_type,
    5.0::DOUBLE AS tick_size,
    CASE WHEN exp_d IS NULL THEN NULL WHEN q % 4 < 2 THEN 'W' ELSE 'M' END AS expiry_type,
    CAST(p AS VARCHAR) || '-' || segment || '-' || exchange AS instrument_key,
    CASE WHEN exp_d IS NULL THEN NULL ELSE strftime(exp_d, '%Y-%m-%d') END AS expiry_date_str,
    CASE WHEN exp_d IS NULL THEN NULL ELSE '14:30:00' END AS expiry_time_str,
    exp_d AS expiry_date,
    CASE WHEN exp_d IS NULL THEN NULL ELSE 52200 END AS expiry_time_s,
    underlying AS _underlying
  FROM m2
)"""

INSTRUMENT_COLS = ("exchange, segment, security_id, instrument_type, trading_symbol, display_name, "
                   "instrument_key, lot_units, strike_price, option_type, tick_size, expiry_date_str, expiry_type")
CHAIN_COLS = ("trading_symbol, security_id, strike_price, option_type, lot_units, tick_size, expiry_date_str, "
              "expiry_type, exchange, segment, instrument_type, display_name, instrument_key")
MASTER_COLS = ("exchange, segment, security_id, instrument_type, expiry_code, trading_symbol, lot_units, "
               "display_name, expiry_raw, strike_price, option_type, tick_size, expiry_type, instrument_key, "
               "expiry_date_str, expiry_time_str, expiry_date, expiry_time_s")

OPTION_SHAPE = ("instrument_type LIKE 'OPT%' AND (trading_symbol LIKE '%-CE' OR trading_symbol LIKE '%-PE') "
                "AND (display_name LIKE '%CALL' OR display_name LIKE '%PUT') AND option_type IN ('CE','PE')")
FUTURE_SHAPE = "instrument_type LIKE 'FUT%' AND trading_symbol LIKE '%-FUT' AND display_name LIKE '%FUT'"


def _q(body_ctes: str, select: str) -> str:
    return "WITH " + MASTER_CTE + (",\n" + body_ctes if body_ctes else "") + "\n" + select


ORACLE: dict[str, str] = {}

ORACLE["master_ingest"] = _q("", f"SELECT {MASTER_COLS} FROM master")

ORACLE["master_ingest_reordered"] = _q(
    "", f"SELECT {MASTER_COLS}, 'x' || CAST(security_id AS VARCHAR) AS \"SM_SYMBOL_NAME\" FROM master")

ORACLE["master_latest_snapshot"] = _q("", "SELECT " + MASTER_COLS.replace(
    "lot_units,", "lot_units * 2 AS lot_units,") + ", DATE '2024-01-02' AS snapshot_date FROM master")

ORACLE["option_chain"] = _q("""
opts AS (SELECT * FROM master WHERE exchange = 'NSE' AND trading_symbol LIKE 'U0-%' AND """ + OPTION_SHAPE + """),
chosen AS (SELECT arg_min(expiry_date_str, expiry_date) AS e FROM opts)""",
                            f"SELECT {CHAIN_COLS} FROM opts WHERE expiry_date_str = (SELECT e FROM chosen)")

ORACLE["option_chain_fallback"] = _q("""
opts AS (SELECT * FROM master WHERE exchange = 'NSE' AND trading_symbol LIKE 'U1-%' AND """ + OPTION_SHAPE + """),
chosen AS (SELECT CASE WHEN count(*) FILTER (WHERE expiry_date_str = '2030-01-01') > 0 THEN '2030-01-01'
                       ELSE arg_min(expiry_date_str, expiry_date) END AS e FROM opts)""",
                                     f"SELECT {CHAIN_COLS} FROM opts WHERE expiry_date_str = (SELECT e FROM chosen)")

ORACLE["option_chain_listed"] = _q("""
opts AS (SELECT * FROM master WHERE exchange = 'BSE' AND trading_symbol LIKE 'U2-%' AND """ + OPTION_SHAPE + """),
chosen AS (SELECT CASE WHEN count(*) FILTER (WHERE expiry_date_str = '2024-02-01') > 0 THEN '2024-02-01'
                       ELSE arg_min(expiry_date_str, expiry_date) END AS e FROM opts)""",
                                   f"SELECT {CHAIN_COLS} FROM opts WHERE expiry_date_str = (SELECT e FROM chosen)")

ORACLE["option_chains_all"] = _q("""
opts AS (SELECT *, split_part(trading_symbol, '-', 1) AS und FROM master WHERE """ + OPTION_SHAPE + """),
per AS (SELECT und, exchange, max(expiry_date_str) AS latest, arg_min(expiry_date_str, expiry_date) AS nearest
        FROM opts GROUP BY und, exchange),
req AS (SELECT und, exchange, latest AS requested_expiry, nearest FROM per
        UNION ALL SELECT und, exchange, '2030-01-01', nearest FROM per
        UNION ALL SELECT und, exchange, NULL, nearest FROM per),
chosen AS (SELECT r.*, CASE WHEN EXISTS (SELECT 1 FROM opts o WHERE o.und = r.und AND o.exchange = r.exchange
                                         AND o.expiry_date_str = r.requested_expiry)
                            THEN r.requested_expiry ELSE r.nearest END AS chosen FROM req r)""",
                                 f"""SELECT c.und AS underlying, c.requested_expiry,
  {', '.join('o.' + x.strip() for x in CHAIN_COLS.split(','))}
FROM chosen c JOIN opts o ON o.und = c.und AND o.exchange = c.exchange AND o.expiry_date_str = c.chosen""")


# ---------------------------------------------------------------------------
# price frames: packets re-derived from events, decoded values in SQL
# ---------------------------------------------------------------------------

def R(x: str) -> str:
    """Half-even rounding at the packet's precision."""
    def at(places: int) -> str:
        # the exact binary value decides ties: DOUBLE -> DECIMAL text of all its digits
        s = f"list_transform([CAST(({x}) AS DOUBLE)], lambda v: {_EXACT.format(s=float(10 ** places), places=places)})[1]"
        return s
    return f"(CASE WHEN dp = 4 THEN {at(4)} ELSE {at(2)} END)"


# v * s = p + e exactly (v split in two halves); the nearest whole number, ties to even, over s
_EXACT = ("CASE WHEN abs(v) * {s} < 4503599627370496 THEN list_transform([{{'p': abs(v) * {s}, "
          "'h': abs(v) * 134217729.0 - (abs(v) * 134217729.0 - abs(v))}}], lambda t: "
          "(CASE WHEN v < 0 THEN -1 ELSE 1 END) * (floor(t.p) + CASE "
          "WHEN t.p - floor(t.p) > 0.5 THEN 1 WHEN t.p - floor(t.p) < 0.5 THEN 0 "
          "WHEN (t.h * {s} - t.p) + (abs(v) - t.h) * {s} > 0 THEN 1 WHEN (t.h * {s} - t.p) + (abs(v) - t.h) * {s} < 0 THEN 0 "
          "ELSE CAST(floor(t.p) AS BIGINT) % 2 END) / {s} + 0.0)[1] ELSE round_even(v, {places}) END")


def F32(x: str) -> str:
    return f"CAST(CAST(({x}) AS FLOAT) AS DOUBLE)"


def TS(x: str) -> str:
    return f"(TIMESTAMP '1980-01-01 05:30:00' + to_seconds(CAST(({x}) AS BIGINT)))"


SEG_CODE_SQL = """CASE WHEN segment IS NULL OR segment = '' THEN -1 WHEN segment = 'I' THEN 0
  WHEN exchange = 'NSE' AND segment = 'E' THEN 1 WHEN exchange = 'NSE' AND segment = 'D' THEN 2
  WHEN exchange = 'NSE' AND segment = 'C' THEN 3 WHEN exchange = 'NSE' AND segment = 'M' THEN 10
  WHEN exchange = 'BSE' AND segment = 'E' THEN 4 WHEN exchange = 'BSE' AND segment = 'C' THEN 7
  WHEN exchange = 'BSE' AND segment = 'D' THEN 8 WHEN exchange = 'BSE' AND segment = 'M' THEN 9
  WHEN exchange = 'MCX' AND segment = 'M' THEN 5 WHEN exchange = 'NCDEX' AND segment = 'M' THEN 6
  WHEN exchange = 'ICEX' AND segment = 'M' THEN 11 ELSE -1 END"""

PACKETS_CTE = f"""
ev AS (
  SELECT e.event_id, e.ts, e.user_id AS security_id, e.value AS v,
         CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS k,
         [1,2,3,5,6,29,32,33,36,37][(e.event_id % 10) + 1] AS packet_type,
         e.event_id // 4 AS frame_id, CAST(e.event_id % 4 AS INTEGER) AS packet_seq,
         m.instrument_key, m.exchange, m.segment,
         CAST(floor((epoch_us(e.ts) - epoch_us(TIMESTAMP '1980-01-01 05:30:00')) / 1000000) AS BIGINT) AS s
  FROM events e JOIN master m ON m.security_id = e.user_id
),
pk AS (
  SELECT *, max(ts) OVER (PARTITION BY frame_id) AS recv_ts, {SEG_CODE_SQL} AS seg_code FROM ev
),
pd AS (
  SELECT *, CASE WHEN seg_code IN (3, 7, 8) THEN 4 ELSE 2 END AS dp,
    11 + CASE packet_type WHEN 1 THEN 26 WHEN 2 THEN 100 WHEN 3 THEN 16 WHEN 5 THEN 24 WHEN 6 THEN 24
                          WHEN 29 THEN 7 WHEN 32 THEN 8 WHEN 33 THEN 8 WHEN 36 THEN 8 WHEN 37 THEN 4 END
      AS packet_length
  FROM pk
)"""


def _pq(body_ctes: str, select: str) -> str:
    return "WITH " + MASTER_CTE + ",\n" + PACKETS_CTE + (",\n" + body_ctes if body_ctes else "") + "\n" + select


PK = "frame_id, packet_seq, instrument_key"

ORACLE["packets"] = _pq("", """SELECT frame_id, recv_ts, packet_seq, seg_code, security_id, packet_length,
  packet_type, instrument_key, dp AS decimals FROM pd""")

ORACLE["decode_trade"] = _pq("", f"""SELECT {PK}, {R(F32('v'))} AS ltp, k AS last_traded_qty, event_id AS volume,
  {R(F32('v'))} AS average_price, CASE WHEN k % 10 = 0 THEN 0 ELSE 1000 + k END AS open_interest,
  {TS('s')} AS last_trade_time, {TS('s')} AS last_updated_time FROM pd WHERE packet_type = 1""")

ORACLE["decode_depth"] = _pq("", f"""
SELECT {PK}, 'buy' AS side, CAST(i AS INTEGER) AS level, k + i AS quantity, {F32('v - i')} AS price,
       CAST(i + 1 AS INTEGER) AS orders
FROM pd, range(5) t(i) WHERE packet_type = 2
UNION ALL
SELECT {PK}, 'sell' AS side, CAST(i AS INTEGER) AS level, k + 2 * i AS quantity, {F32('v + i')} AS price,
       CAST(i + 2 AS INTEGER) AS orders
FROM pd, range(5) t(i) WHERE packet_type = 2""")

ORACLE["decode_ohlc"] = _pq("", f"""SELECT {PK}, {R(F32('v'))} AS open, {R(F32('v + 1'))} AS close,
  {R(F32('v + 2'))} AS high, {R(F32('v - 1'))} AS low FROM pd WHERE packet_type = 3""")

ORACLE["decode_index"] = _pq(f"""
ix AS (SELECT {PK}, dp, s, {R(F32('v'))} AS ltp, {R(F32('v - 1'))} AS open,
              {R(F32('CASE WHEN k = 0 THEN 0 ELSE v + 1 END'))} AS prev_close,
              {R(F32('v + 2'))} AS high, {R(F32('v - 2'))} AS low FROM pd WHERE packet_type = 5),
ic AS (SELECT *, CASE WHEN prev_close <= 0 THEN 0.0 ELSE {R('ltp - prev_close')} END AS change FROM ix)""",
                               f"""SELECT {PK}, ltp, open, prev_close, high, low, {TS('s')} AS last_trade_time, change,
  CASE WHEN prev_close <= 0 THEN 0.0 ELSE {R('100 * (change / prev_close)')} END AS change_prcnt FROM ic""")

ORACLE["decode_top"] = _pq(f"""
tb AS (SELECT {PK}, dp, v, k AS total_ask_qty, CASE WHEN k = 0 THEN 0 ELSE 2 * k END AS total_bid_qty,
              k + 1 AS best_bid_qty, k + 2 AS best_ask_qty FROM pd WHERE packet_type = 6)""",
                             f"""SELECT {PK}, total_ask_qty, total_bid_qty, best_bid_qty, best_ask_qty,
  {R(F32('v'))} AS best_bid_price, {R(F32('v + 0.05'))} AS best_ask_price,
  total_ask_qty + total_bid_qty AS total_bid_ask_qty,
  CASE WHEN total_ask_qty + total_bid_qty = 0 THEN 0.0
       ELSE {R('CAST(total_bid_qty AS DOUBLE) / (total_ask_qty + total_bid_qty) * 100')} END AS total_bid_qty_prcnt,
  CASE WHEN total_ask_qty + total_bid_qty = 0 THEN 0.0
       ELSE {R('CAST(total_ask_qty AS DOUBLE) / (total_ask_qty + total_bid_qty) * 100')} END AS total_ask_qty_prcnt
FROM tb""")

STATUS_VALUE = R(F32("[1.0, 3.0, 5.0, 6.0, 9.0][(k % 5) + 1]"))
ORACLE["decode_status"] = _pq("", f"""SELECT {PK}, 'OK' AS status_msg, {STATUS_VALUE} AS status_value,
  CASE CAST(floor({STATUS_VALUE}) AS INTEGER) WHEN 1 THEN 'PREOPEN' WHEN 3 THEN 'OPEN' WHEN 5 THEN 'POSTCLOSE'
       WHEN 6 THEN 'CLOSE' END AS market_status FROM pd WHERE packet_type = 29""")

ORACLE["decode_prev_close"] = _pq("", f"""SELECT {PK}, {R(F32('CASE WHEN k = 0 THEN 0 ELSE v END'))} AS prev_close,
  {R(F32('k * 10'))} AS prev_open_interest FROM pd WHERE packet_type = 32""")

ORACLE["decode_circuit"] = _pq("", f"""SELECT {PK}, {R(F32('v + 10'))} AS upper_circuit,
  {R(F32('v - 10'))} AS lower_circuit FROM pd WHERE packet_type = 33""")

ORACLE["decode_week52"] = _pq("", f"""SELECT {PK}, {R(F32('v + 10'))} AS week52_high,
  {R(F32('v - 10'))} AS week52_low FROM pd WHERE packet_type = 36""")

ORACLE["decode_oi"] = _pq("", f"""SELECT {PK}, 1000 + 2 * k AS open_interest FROM pd WHERE packet_type = 37""")


# ---------------------------------------------------------------------------
# tick state
# ---------------------------------------------------------------------------

def _oi_default() -> str:
    return "CASE WHEN k % 10 = 0 THEN 0 ELSE 1000 + k END"


# state column -> {packet type: SQL over pd}
WIDE = {
    "ltp": {1: R(F32("v")), 5: R(F32("v"))},
    "open": {3: R(F32("v")), 5: R(F32("v - 1"))},
    "high": {3: R(F32("v + 2")), 5: R(F32("v + 2"))},
    "low": {3: R(F32("v - 1")), 5: R(F32("v - 2"))},
    "close": {3: R(F32("v + 1"))},
    "prev_close": {5: R(F32("CASE WHEN k = 0 THEN 0 ELSE v + 1 END")), 32: R(F32("CASE WHEN k = 0 THEN 0 ELSE v END"))},
    "volume": {1: "event_id"},
    "average_price": {1: R(F32("v"))},
    "open_interest": {1: _oi_default(), 37: "1000 + 2 * k"},
    "prev_open_interest": {32: R(F32("k * 10"))},
    "last_traded_qty": {1: "k"},
    "last_trade_time": {1: TS("s"), 5: TS("s")},
    "last_updated_time": {1: TS("s")},
    "best_ask_price": {6: R(F32("v + 0.05"))},
    "best_ask_qty": {6: "k + 2"},
    "best_bid_price": {6: R(F32("v"))},
    "best_bid_qty": {6: "k + 1"},
    "total_ask_qty": {6: "k"},
    "total_bid_qty": {6: "CASE WHEN k = 0 THEN 0 ELSE 2 * k END"},
    "total_bid_ask_qty": {6: "k + CASE WHEN k = 0 THEN 0 ELSE 2 * k END"},
    "total_bid_qty_prcnt": {6: "CASE WHEN k = 0 THEN 0.0 ELSE " + R("CAST(2 * k AS DOUBLE) / (3 * k) * 100") + " END"},
    "total_ask_qty_prcnt": {6: "CASE WHEN k = 0 THEN 0.0 ELSE " + R("CAST(k AS DOUBLE) / (3 * k) * 100") + " END"},
    "week52_high": {36: R(F32("v + 10"))},
    "week52_low": {36: R(F32("v - 10"))},
    "lower_circuit": {33: R(F32("v - 10"))},
    "upper_circuit": {33: R(F32("v + 10"))},
    # the last depth packet's k and v give every value of both sides
    "dk": {2: "k"},
    "dv": {2: "v"},
    "src": {2: "1"},
}
DEPTH_SOURCE = ["dk", "dv", "src"]
STATE_DEFAULT = {c: ("NULL" if c.endswith("_time") else ("0.0" if any(x in c for x in (
    "price", "ltp", "open", "high", "low", "close", "prcnt", "week52", "circuit", "prev_"))
    and c not in ("open_interest",) else "0")) for c in WIDE}
STATE_DEFAULT["prev_open_interest"] = "0.0"
STATE_DEFAULT["open_interest"] = "0"
STATE_DEFAULT |= {"dk": "NULL", "dv": "NULL", "src": "0"}
STATE_ONLY = [c for c in WIDE if c not in DEPTH_SOURCE]


def _case(col: str) -> str:
    arms = " ".join(f"WHEN {t} THEN {e}" for t, e in WIDE[col].items())
    return f"CASE packet_type {arms} END AS {col}"


WIDE_CTE = ("wide AS (SELECT instrument_key, dp, recv_ts, frame_id, packet_seq, packet_type, 0 AS is_reset, "
            + ", ".join(_case(c) for c in WIDE) + " FROM pd)")

CONTROL_CTE = """ctl AS (
  SELECT CAST(e.ts AS TIMESTAMP) AS ts, m.instrument_key FROM events e JOIN master m ON m.security_id = e.user_id
  WHERE e.event_type IN ('signup', 'error'))"""

RESET_TS = "TIMESTAMP '1900-01-01 00:00:00'"   # oracle-only marker: "reset to empty"
RESET_CTE = ("resets AS (SELECT c.instrument_key, d.dp, c.ts AS recv_ts, -1 AS frame_id, -1 AS packet_seq, "
             "NULL AS packet_type, 1 AS is_reset, "
             + ", ".join(f"{RESET_TS if c.endswith('_time') else STATE_DEFAULT[c]} AS {c}" for c in WIDE)
             + " FROM ctl c JOIN (SELECT DISTINCT instrument_key, dp FROM pd) d USING (instrument_key))")

_W = ("OVER (PARTITION BY instrument_key ORDER BY recv_ts, frame_id, packet_seq "
      "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")


def _running(src: str, window: str = _W) -> str:
    cols = [f"NULLIF(last_value({c} IGNORE NULLS) {window}, {RESET_TS}) AS {c}" if c.endswith("_time")
            else f"COALESCE(last_value({c} IGNORE NULLS) {window}, {STATE_DEFAULT[c]}) AS {c}" for c in WIDE]
    return (f"run AS (SELECT instrument_key, dp AS decimals, recv_ts, frame_id, packet_seq, packet_type, is_reset, "
            f"sum(is_reset) {_W} AS epoch, count(*) {_W} AS n, " + ", ".join(cols) + f" FROM {src})")


DERIVED = ("CASE WHEN prev_close <= 0 THEN 0.0 ELSE " + R("ltp - prev_close").replace("dp", "decimals")
           + " END AS change, "
           "CASE WHEN prev_close <= 0 THEN 0.0 ELSE " + R("100 * ((" + R("ltp - prev_close").replace("dp", "decimals")
                                                             + ") / prev_close)").replace("dp", "decimals")
           + " END AS change_prcnt, "
           "CASE WHEN prev_open_interest <= 0 THEN 0 ELSE CAST(trunc("
           + R("open_interest - prev_open_interest").replace("dp", "decimals") + ") AS BIGINT) END AS open_interest_chg, "
           "CASE WHEN prev_open_interest <= 0 THEN 0 ELSE CAST(trunc("
           + R("100 * ((" + R("open_interest - prev_open_interest").replace("dp", "decimals")
               + ") / prev_open_interest)").replace("dp", "decimals") + ") AS BIGINT) END AS open_interest_chg_prcnt")

# all five depth levels: the last depth packet's k and v give every value of both sides
_DEPTH_SIDES = {"buy": ("dk + {i}", "dv - {i}", 1), "sell": ("dk + 2 * {i}", "dv + {i}", 2)}
DEPTH_SELECT = ", ".join(
    f"CASE WHEN src = 1 THEN {e} END AS depth_{side}_{what}{i}"
    for side, (qty, price, first) in _DEPTH_SIDES.items() for i in range(5)
    for what, e in (("qty", qty.format(i=i)), ("price", F32(price.format(i=i))), ("orders", f"CAST({i + first} AS INTEGER)")))
STATE_SELECT = ", ".join(STATE_ONLY) + ", " + DEPTH_SELECT

ORACLE["tick_snapshots"] = _pq(",\n".join([
    WIDE_CTE, CONTROL_CTE, RESET_CTE, "allrows AS (SELECT * FROM wide UNION ALL BY NAME SELECT * FROM resets)",
    _running("allrows")]),
    f"SELECT instrument_key, decimals, recv_ts, frame_id, packet_seq, packet_type, CAST(epoch AS BIGINT) AS epoch, "
    f"{STATE_SELECT}, {DERIVED} FROM run WHERE is_reset = 0")

ORACLE["tick_epochs"] = _pq(",\n".join([
    WIDE_CTE, CONTROL_CTE, RESET_CTE, "allrows AS (SELECT * FROM wide UNION ALL BY NAME SELECT * FROM resets)",
    _running("allrows")]),
    "SELECT frame_id, packet_seq, instrument_key, CAST(epoch AS BIGINT) AS epoch FROM run WHERE is_reset = 0")

ORACLE["tick_latest"] = _pq(",\n".join([WIDE_CTE, _running("wide"),
                                        "fin AS (SELECT *, row_number() OVER (PARTITION BY instrument_key ORDER BY "
                                        "recv_ts DESC, frame_id DESC, packet_seq DESC) AS rn FROM run)"]),
                            f"SELECT instrument_key, decimals, n AS packets, recv_ts AS last_recv_ts, {STATE_SELECT}, "
                            f"{DERIVED} FROM fin WHERE rn = 1")

DEPTH_CTE = ("dep AS (SELECT instrument_key, recv_ts, frame_id, packet_seq, 0 AS is_reset, CASE packet_type WHEN 2 THEN k END AS dk, "
             "CASE packet_type WHEN 2 THEN v END AS dv, CASE packet_type WHEN 2 THEN 1 END AS src FROM pd)")
DEPTH_RESETS = ("dep_resets AS (SELECT DISTINCT c.instrument_key, c.ts AS recv_ts, -1 AS frame_id, -1 AS packet_seq, 1 AS is_reset, "
                "NULL AS dk, NULL AS dv, 0 AS src FROM ctl c), "
                "dep_all AS (SELECT * FROM dep UNION ALL BY NAME SELECT * FROM dep_resets)")


def _depth_running(src: str) -> str:
    last = ", ".join(f"last_value({c} IGNORE NULLS) {_W} AS {c}" for c in ("dk", "dv", "src"))
    return f"dep_run AS (SELECT instrument_key, recv_ts, frame_id, packet_seq, is_reset, {last} FROM {src})"


ORACLE["tick_snapshots_depth"] = _pq(",\n".join([DEPTH_CTE, CONTROL_CTE, DEPTH_RESETS, _depth_running("dep_all")]),
                                     f"SELECT instrument_key, frame_id, packet_seq, {DEPTH_SELECT} FROM dep_run WHERE is_reset = 0")

ORACLE["tick_latest_depth"] = _pq(",\n".join([DEPTH_CTE, _depth_running("dep"),
                                              "dep_fin AS (SELECT *, row_number() OVER (PARTITION BY instrument_key ORDER BY "
                                              "recv_ts DESC, frame_id DESC, packet_seq DESC) AS rn FROM dep_run)"]),
                                  f"SELECT instrument_key, {DEPTH_SELECT} FROM dep_fin WHERE rn = 1")

# reconnects reset every key: their number as of a row (g) splits the key's timeline
RECONNECT_CTE = """rc AS (SELECT CAST(ts AS TIMESTAMP) AS ts FROM events
  WHERE event_type = 'error' AND CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 = 0)"""
ALL_RESETS_CTE = RESET_CTE[:RESET_CTE.rindex(" FROM ctl")].replace("d.dp", "CAST(NULL AS INTEGER) AS dp") + " FROM ctl c)"
_AS_OF = "(SELECT count(*) FROM rc WHERE rc.ts <= r.recv_ts) AS g"
_W_G = _W.replace("PARTITION BY instrument_key", "PARTITION BY instrument_key, g")
EPOCHS_CTE = ",\n".join([
    WIDE_CTE, CONTROL_CTE, ALL_RESETS_CTE, RECONNECT_CTE,
    f"allrows AS (SELECT *, {_AS_OF} FROM (SELECT * FROM wide UNION ALL BY NAME SELECT * FROM resets) r)"])

ORACLE["tick_epochs_reconnect"] = _pq(EPOCHS_CTE + ",\n" + _running("allrows", _W_G).replace("is_reset, sum", "is_reset, g, sum"),
    f"SELECT instrument_key, decimals, recv_ts, frame_id, packet_seq, packet_type, CAST(epoch + g AS BIGINT) AS epoch, "
    f"{STATE_SELECT}, {DERIVED} FROM run WHERE is_reset = 0")

# one row per key after everything else shows the final state
ORACLE["tick_latest_reset"] = _pq(EPOCHS_CTE + """,
keys AS (SELECT instrument_key, max(dp) AS dp, count(packet_type) AS packets, max(CASE WHEN is_reset = 0 THEN recv_ts END) AS last_recv_ts
         FROM allrows GROUP BY instrument_key),
ended AS (SELECT * FROM allrows UNION ALL BY NAME
          SELECT instrument_key, TIMESTAMP '2199-01-01' AS recv_ts, 0 AS frame_id, 0 AS packet_seq, 2 AS is_end, 0 AS is_reset,
                 (SELECT count(*) FROM rc) AS g FROM keys),
""" + _running("ended", _W_G).replace("is_reset, sum", "is_reset, is_end, g, sum") + """,
fin AS (SELECT run.* EXCLUDE (decimals), k.dp AS decimals, k.packets, k.last_recv_ts FROM run JOIN keys k USING (instrument_key) WHERE is_end = 2)""",
    f"SELECT instrument_key, decimals, packets, last_recv_ts, CAST(epoch + g AS BIGINT) AS epoch, {STATE_SELECT}, {DERIVED} FROM fin")

ORACLE["market_status"] = _pq(f"""
st AS (SELECT recv_ts, frame_id, packet_seq, 'OK' AS msg, {STATUS_VALUE} AS value FROM pd WHERE packet_type = 29),
last AS (SELECT *, row_number() OVER (ORDER BY recv_ts DESC, frame_id DESC, packet_seq DESC) AS rn,
                count(*) OVER () AS status_packets FROM st)""",
                              """SELECT msg, value, CASE CAST(floor(value) AS INTEGER) WHEN 1 THEN 'PREOPEN' WHEN 3 THEN 'OPEN'
  WHEN 5 THEN 'POSTCLOSE' WHEN 6 THEN 'CLOSE' END AS market_status, status_packets FROM last WHERE rn = 1""")

ORACLE["quarantine"] = _q("", """
SELECT reason, count(*) AS packets FROM (
  SELECT CASE e.event_id % 6 WHEN 0 THEN 'truncated' WHEN 1 THEN 'bad_length' WHEN 2 THEN 'short_frame'
              WHEN 4 THEN 'unknown_segment' WHEN 5 THEN 'unknown_instrument' END AS reason
  FROM events e JOIN master m ON m.security_id = e.user_id) WHERE reason IS NOT NULL GROUP BY reason""")

ORACLE["unknown_type_ticks"] = _q("", """
SELECT count(*) AS packets, count(DISTINCT m.instrument_key) AS instruments
FROM events e JOIN master m ON m.security_id = e.user_id WHERE e.event_id % 6 = 3""")


# ---------------------------------------------------------------------------
# orders
# ---------------------------------------------------------------------------

ORDERS_CTE = """
od AS (
  SELECT o.o_orderkey // 2 AS frame_id, CAST(o.o_orderkey % 2 AS INTEGER) AS packet_seq,
         max(o.o_orderdate) OVER (PARTITION BY o.o_orderkey // 2) AS recv_ts,
         m.exchange, m.segment, CAST(o.o_orderkey % 150 AS VARCHAR) AS security_id,
         CAST(o.o_orderkey % 150 AS BIGINT) AS security_id_num,
         CAST(o.o_orderkey AS VARCHAR) AS exch_order_no, CAST(o.o_orderkey AS VARCHAR) AS order_no,
         CAST(o.o_orderkey AS BIGINT) AS order_no_num,
         split_part(o.o_orderpriority, ' ', 1) AS order_type, '' AS validity,
         CAST(100 + o.o_orderkey % 500 AS INTEGER) AS quantity,
         CAST((100 + o.o_orderkey % 500) // 2 AS INTEGER) AS traded_qty,
         CAST((100 + o.o_orderkey % 500) - (100 + o.o_orderkey % 500) // 2 AS INTEGER) AS remaining_quantity,
         o.o_totalprice AS price, o.o_totalprice AS avg_traded_price, 0.0::DOUBLE AS trigger_price,
         CAST(CASE WHEN o.o_orderkey % 5 = 0 THEN 1 ELSE o.o_orderkey % 5 END AS INTEGER) AS lot_size,
         5.0 / 100 AS tick_size,
         strftime(o.o_orderdate, '%Y-%m-%dT%H:%M:%S') AS order_date_time,
         strftime(o.o_orderdate, '%Y-%m-%dT%H:%M:%S') AS exch_order_time,
         strftime(o.o_orderdate, '%Y-%m-%dT%H:%M:%S') AS last_updated_time,
         o.o_orderstatus AS status,
         ['BSKT1','STRGBSK','FOVR','SIP','TV_TERMINAL','IBERG','WEB'][(o.o_orderkey % 7) + 1] AS splatform,
         CAST(1008 AS INTEGER) AS msg_len, true AS utf8_valid, o.o_orderkey AS okey
  FROM orders o JOIN master m ON m.security_id = o.o_orderkey % 150
),
ov AS (
  SELECT *, splatform AS remarks_1,
    CASE WHEN splatform LIKE '%BSKT%' OR splatform LIKE '%STRGBSK%' THEN 'Basket'
         WHEN splatform LIKE '%FOVR%' THEN 'Forever' WHEN splatform LIKE '%SIP%' THEN 'SIP'
         WHEN splatform LIKE '%TV_TERMINAL%' THEN 'TV' WHEN splatform LIKE '%IBERG%' THEN 'Iceberg' ELSE '' END
      AS order_label,
    CAST(floor(quantity / lot_size) AS BIGINT) AS disp_quantity,
    CAST(floor(traded_qty / lot_size) AS BIGINT) AS disp_traded_qty,
    CAST(floor(remaining_quantity / lot_size) AS BIGINT) AS disp_remaining_quantity,
    CAST(security_id_num AS VARCHAR) || '-' || segment || '-' || exchange AS instrument_key
  FROM od
)"""

ORDER_VIEW_SQL = ("frame_id, packet_seq, recv_ts, instrument_key, msg_len, exchange, segment, security_id, "
                  "security_id_num, exch_order_no, order_no, order_no_num, order_type, validity, quantity, "
                  "traded_qty, remaining_quantity, price, avg_traded_price, trigger_price, lot_size, tick_size, "
                  "order_date_time, exch_order_time, last_updated_time, status, splatform, remarks_1, "
                  "order_label, disp_quantity, disp_traded_qty, disp_remaining_quantity, utf8_valid")


def _oq(body_ctes: str, select: str) -> str:
    return "WITH " + MASTER_CTE + ",\n" + ORDERS_CTE + (",\n" + body_ctes if body_ctes else "") + "\n" + select


ORACLE["orders_decoded"] = _oq("", f"SELECT {ORDER_VIEW_SQL} FROM ov")



def _whole_orders() -> str:
    """All fields of the record: those of ``ov`` and, by key and offset, the others; the number of every all-digit text."""
    known = set(ORDER_VIEW_SQL.split(", ")) - {"validity", "trigger_price"}
    rules = {
        "i16": "CAST((okey * ({o} + 1)) % 65536 - 32768 AS INTEGER)",
        "i32": "CAST((okey * 7919 + {o} * 104729) % 4294967296 - 2147483648 AS INTEGER)",
        "f64": "CAST((okey % 100003) * 0.25 + {o} AS DOUBLE) * CASE WHEN okey % 2 = 1 THEN -1 ELSE 1 END",
        "c": "chr(CAST(48 + (okey + {o}) % 43 AS INTEGER))",
    }
    text = "left(CASE WHEN (okey + {o}) % 2 = 0 THEN CAST(okey AS VARCHAR) ELSE '{o}-' || CAST(okey AS VARCHAR) END, {w})"
    fields = [n if n in known else rules.get(k, text).format(o=off, w=k[1:]) + f" AS {n}" for n, off, k in ORDER_LAYOUT]
    derived = [c for c in ORDER_VIEW_SQL.split(", ") if c not in {n for n, _, _ in ORDER_LAYOUT} and not c.endswith("_num")]
    twins = [f"CASE WHEN regexp_full_match({n}, '[0-9]+') THEN TRY_CAST({n} AS BIGINT) END AS {n}_num"
             for n, _, k in ORDER_LAYOUT if k == "c" or k.startswith("s")]
    return _oq(f"whole AS (SELECT {', '.join(derived + fields)} FROM ov)", f"SELECT *, {', '.join(twins)} FROM whole")


ORACLE["orders_decoded_whole"] = _whole_orders()

ORACLE["orders_enriched"] = _oq("", "SELECT " + ", ".join(f"ov.{c}" for c in ORDER_VIEW_SQL.split(", ")) + """,
  m.trading_symbol AS inst_trading_symbol, m.display_name AS inst_display_name,
  m.instrument_type AS inst_type, m.lot_units AS inst_lot_units
FROM ov LEFT JOIN master m ON m.instrument_key = ov.instrument_key""")

ORACLE["orders_by_frame"] = _oq("", """SELECT frame_id, min(recv_ts) AS recv_ts, count(*) AS n_orders,
  string_agg(order_no, ',' ORDER BY packet_seq) AS order_nos FROM ov GROUP BY frame_id""")

ORACLE["orders_by_frame_enriched"] = ORACLE["orders_by_frame"]

ORACLE["orders_latest"] = _oq("""
lo AS (SELECT *, row_number() OVER (PARTITION BY instrument_key ORDER BY recv_ts DESC, frame_id DESC,
                                    packet_seq DESC) AS rn,
              count(*) OVER (PARTITION BY instrument_key) AS orders_seen FROM ov)""",
                              f"SELECT orders_seen, {ORDER_VIEW_SQL} FROM lo WHERE rn = 1")

_RESETS_OF_ORDERS = """gap AS (SELECT date_diff('second', (SELECT min(CAST(ts AS TIMESTAMP)) FROM events),
                                         (SELECT min(CAST(o_orderdate AS TIMESTAMP)) FROM orders)) AS s),
rst AS (SELECT e.ts + to_seconds(gap.s) AS ts, m.instrument_key FROM events e JOIN master m ON m.security_id = e.user_id, gap
        WHERE e.event_type IN ('signup', 'error')
        UNION ALL SELECT e.ts + to_seconds(gap.s), NULL FROM events e, gap
        WHERE e.event_type = 'error' AND CAST(json_extract_string(e.props, '$.k') AS BIGINT) % 10 = 0)"""
ORACLE["orders_latest_reset"] = _oq(_RESETS_OF_ORDERS + """,
lo AS (SELECT *, row_number() OVER (PARTITION BY instrument_key ORDER BY recv_ts DESC, frame_id DESC,
                                    packet_seq DESC) AS rn,
              count(*) OVER (PARTITION BY instrument_key) AS orders_seen FROM ov),
lr AS (SELECT *, EXISTS (SELECT 1 FROM rst WHERE rst.ts > lo.recv_ts AND (rst.instrument_key IS NULL OR rst.instrument_key = lo.instrument_key))
              AS gone FROM lo WHERE rn = 1)""",
    "SELECT instrument_key, orders_seen, "
    + ", ".join(f"CASE WHEN NOT gone THEN {c} END AS {c}" for c in ORDER_VIEW_SQL.split(", ") if c != "instrument_key") + " FROM lr")

ORACLE["order_quarantine"] = _q("", """
SELECT reason, count(*) AS packets FROM (
  SELECT CASE o.o_orderkey % 4 WHEN 0 THEN 'bad_length' WHEN 1 THEN 'bad_length' WHEN 2 THEN 'truncated'
              WHEN 3 THEN 'invalid_utf8' END AS reason
  FROM orders o JOIN master m ON m.security_id = o.o_orderkey % 150) GROUP BY reason""")


# ---------------------------------------------------------------------------
# lookups, code tables, subscriptions
# ---------------------------------------------------------------------------

ORACLE["instrument_lookup"] = _q("", f"""SELECT {INSTRUMENT_COLS} FROM master WHERE exchange = 'NSE'
  AND trading_symbol = 'U0-Jan2024-100-CE' AND instrument_type = 'OPTIDX' AND expiry_date_str = '2024-01-04'
  AND strike_price = 100.0 AND option_type = 'CE'""")

ORACLE["instrument_lookup_equity"] = _q("", f"""SELECT {INSTRUMENT_COLS} FROM master WHERE exchange = 'NSE'
  AND trading_symbol = 'U3' AND instrument_type = 'EQUITY'""")

ORACLE["instruments_batch_lookup"] = _q("""
req AS (SELECT exchange || ':' || instrument_type AS batch_id, exchange, instrument_type, trading_symbol AS sym,
               expiry_date_str AS e, CASE WHEN instrument_type LIKE 'OPT%' THEN strike_price END AS s,
               CASE WHEN instrument_type LIKE 'OPT%' THEN option_type END AS o
        FROM master WHERE instrument_type LIKE 'OPT%' OR instrument_type LIKE 'FUT%'),
hit AS (SELECT DISTINCT r.batch_id, m.* FROM master m JOIN req r
        ON r.exchange = m.exchange AND r.instrument_type = m.instrument_type AND r.sym = m.trading_symbol)""",
                                         f"""SELECT batch_id, {INSTRUMENT_COLS} FROM hit h
WHERE (NOT EXISTS (SELECT 1 FROM req r WHERE r.batch_id = h.batch_id AND r.e IS NOT NULL)
       OR EXISTS (SELECT 1 FROM req r WHERE r.batch_id = h.batch_id AND r.e = h.expiry_date_str))
  AND (NOT EXISTS (SELECT 1 FROM req r WHERE r.batch_id = h.batch_id AND r.s IS NOT NULL)
       OR EXISTS (SELECT 1 FROM req r WHERE r.batch_id = h.batch_id AND r.s = h.strike_price))
  AND (NOT EXISTS (SELECT 1 FROM req r WHERE r.batch_id = h.batch_id AND r.o IS NOT NULL)
       OR EXISTS (SELECT 1 FROM req r WHERE r.batch_id = h.batch_id AND r.o = h.option_type))""")

ORACLE["trading_symbols"] = _q("", """SELECT instrument_key, instrument_type AS resolved_type,
  trading_symbol AS built_symbol, true AS matches FROM master""")

UNDERLYINGS_CTE = """und AS (SELECT DISTINCT split_part(trading_symbol, '-', 1) AS underlying, exchange FROM master
                     WHERE expiry_date_str IS NOT NULL)"""

for _name, _shape in (("expiry_dates_opt", OPTION_SHAPE), ("expiry_dates_fut", FUTURE_SHAPE)):
    ORACLE[_name] = _q(UNDERLYINGS_CTE, f"""SELECT u.underlying, u.exchange, m.expiry_date_str, m.expiry_type,
  min(m.expiry_date) AS expiry_date
FROM master m JOIN und u ON m.exchange = u.exchange AND starts_with(m.trading_symbol, upper(u.underlying) || '-')
WHERE {_shape} GROUP BY u.underlying, u.exchange, m.expiry_date_str, m.expiry_type""")

ORACLE["nearest_expiry"] = _q(UNDERLYINGS_CTE, f"""SELECT u.underlying, u.exchange,
  arg_min(m.expiry_date_str, m.expiry_date) AS nearest_expiry
FROM master m JOIN und u ON m.exchange = u.exchange AND starts_with(m.trading_symbol, upper(u.underlying) || '-')
WHERE {OPTION_SHAPE} GROUP BY u.underlying, u.exchange""")

ORACLE["resolve_keys"] = _q(CONTROL_CTE, f"""SELECT {INSTRUMENT_COLS}, 0.0::DOUBLE AS ltp, CAST(0 AS BIGINT) AS volume,
  true AS no_order_update FROM master WHERE instrument_key IN (SELECT instrument_key FROM ctl)""")

ORACLE["drop_empty_columns"] = _q("", """SELECT exchange, segment, security_id, instrument_type, trading_symbol,
  display_name, instrument_key, lot_units, tick_size, expiry_date_str, expiry_type FROM master
WHERE exchange = 'NSE' AND trading_symbol = 'U4-Jan2024-FUT' AND instrument_type = 'FUTIDX'
  AND expiry_date_str = '2024-01-18'""")

ORACLE["drop_empty_columns_futures"] = _q("", """SELECT exchange, segment, security_id, instrument_type, trading_symbol,
  display_name, instrument_key, lot_units, tick_size, expiry_date_str, expiry_type FROM master WHERE instrument_type LIKE 'FUT%'""")

ORACLE["vertical_view"] = _q("""
eq AS (SELECT instrument_key, exchange, segment, CAST(security_id AS VARCHAR) AS security_id, instrument_type,
              trading_symbol, display_name, CAST(lot_units AS VARCHAR) AS lot_units,
              CAST(strike_price AS VARCHAR) AS strike_price, option_type, CAST(tick_size AS VARCHAR) AS tick_size,
              expiry_date_str, expiry_type
       FROM master)""",
                               """SELECT instrument_key, variable, value FROM eq UNPIVOT INCLUDE NULLS (value FOR variable IN (exchange,
  segment, security_id, instrument_type, trading_symbol, display_name, lot_units, strike_price, option_type,
  tick_size, expiry_date_str, expiry_type))""")

ORACLE["segment_codes"] = _q(f"""
sc AS (SELECT instrument_key, security_id, expiry_date, {SEG_CODE_SQL} AS seg_code FROM master)""",
                              """SELECT instrument_key, seg_code, CASE WHEN seg_code IN (3, 7, 8) THEN 4 ELSE 2 END AS decimals,
  CASE seg_code WHEN 1 THEN 'NSE' WHEN 2 THEN 'NSE' WHEN 3 THEN 'NSE' WHEN 4 THEN 'BSE' WHEN 5 THEN 'MCX'
    WHEN 6 THEN 'NCDEX' WHEN 7 THEN 'BSE' WHEN 8 THEN 'BSE' WHEN 9 THEN 'BSE' WHEN 10 THEN 'NSE'
    WHEN 11 THEN 'ICEX' END AS code_exchange,
  CASE WHEN seg_code = 0 THEN 'I' WHEN seg_code IN (1, 4) THEN 'E' WHEN seg_code IN (2, 8) THEN 'D'
    WHEN seg_code IN (3, 7) THEN 'C' WHEN seg_code IN (5, 6, 9, 10, 11) THEN 'M' END AS code_segment,
  CASE WHEN seg_code = 0 THEN CAST(security_id AS VARCHAR) || '-I-IDX'
       WHEN seg_code < 0 THEN ''
       ELSE CAST(security_id AS VARCHAR) || '-' ||
         CASE WHEN seg_code IN (1, 4) THEN 'E' WHEN seg_code IN (2, 8) THEN 'D' WHEN seg_code IN (3, 7) THEN 'C'
              ELSE 'M' END || '-' ||
         CASE seg_code WHEN 1 THEN 'NSE' WHEN 2 THEN 'NSE' WHEN 3 THEN 'NSE' WHEN 4 THEN 'BSE' WHEN 5 THEN 'MCX'
              WHEN 6 THEN 'NCDEX' WHEN 7 THEN 'BSE' WHEN 8 THEN 'BSE' WHEN 9 THEN 'BSE' WHEN 10 THEN 'NSE'
              WHEN 11 THEN 'ICEX' END END AS wire_key,
  CAST(date_diff('day', DATE '1980-01-01', expiry_date) AS BIGINT) * 86400 - 19800 AS expiry_wire_seconds
FROM sc""")

SUBLOG_CTE = """slog AS (
  SELECT e.event_id, CAST(e.ts AS TIMESTAMP) AS ts, m.instrument_key, m.segment,
         CASE WHEN e.event_type = 'signup' THEN 'SUBSCRIBE' ELSE 'UNSUBSCRIBE' END AS action,
         CASE WHEN CAST(json_extract_string(e.props, '$.k') AS BIGINT) % 2 = 0 THEN 'FULL' ELSE 'QUOTE' END AS mode,
         """ + SEG_CODE_SQL.replace("segment", "m.segment").replace("exchange", "m.exchange") + """ AS seg_code
  FROM events e JOIN master m ON m.security_id = e.user_id WHERE e.event_type IN ('signup', 'error'))"""


def _code(action: str, mode: str) -> str:
    return (f"CASE WHEN {action} = 'SUBSCRIBE' AND {mode} = 'QUOTE' THEN CASE WHEN segment = 'I' THEN 24 ELSE 12 END "
            f"WHEN {action} = 'UNSUBSCRIBE' AND {mode} = 'QUOTE' THEN 13 "
            f"WHEN {action} = 'SUBSCRIBE' AND {mode} = 'FULL' THEN 23 "
            f"WHEN {action} = 'UNSUBSCRIBE' AND {mode} = 'FULL' THEN 25 ELSE 12 END")


ORACLE["subscription_plan"] = _q(SUBLOG_CTE, f"""
SELECT event_id, instrument_key, action, mode, seg_code, 0 AS request_seq, {_code('action', "'QUOTE'")} AS request_code
FROM slog
UNION ALL
SELECT event_id, instrument_key, action, mode, seg_code, 1 AS request_seq, {_code('action', "'FULL'")} AS request_code
FROM slog WHERE mode = 'FULL'""")

REGISTRY_CTE = SUBLOG_CTE + """,
lastact AS (SELECT *, row_number() OVER (PARTITION BY instrument_key ORDER BY ts DESC, event_id DESC) AS rn FROM slog),
reg AS (SELECT instrument_key, mode, ts AS since_ts, segment, seg_code FROM lastact WHERE rn = 1 AND action = 'SUBSCRIBE')"""

ORACLE["registry_current"] = _q(REGISTRY_CTE, "SELECT instrument_key, mode, since_ts FROM reg")

ORACLE["unsubscribe_all_plan"] = _q(REGISTRY_CTE, f"""
SELECT CASE WHEN mode = 'QUOTE' THEN 0 ELSE 1 END AS "group", instrument_key, mode, seg_code, 0 AS request_seq,
       {_code("'UNSUBSCRIBE'", "'QUOTE'")} AS request_code FROM reg
UNION ALL
SELECT 1 AS "group", instrument_key, mode, seg_code, 1 AS request_seq, {_code("'UNSUBSCRIBE'", "'FULL'")} AS request_code
FROM reg WHERE mode = 'FULL'""")

ORACLE["stream_tick_latest"] = ORACLE["tick_latest"]
ORACLE["stream_tick_snapshots"] = ORACLE["tick_snapshots"]
ORACLE["stream_tick_latest_depth"] = ORACLE["tick_latest_depth"]
ORACLE["stream_tick_snapshots_depth"] = ORACLE["tick_snapshots_depth"]
ORACLE["stream_tick_latest_reset"] = ORACLE["tick_latest_reset"]
ORACLE["stream_tick_epochs_reconnect"] = ORACLE["tick_epochs_reconnect"]
ORACLE["stream_orders"] = ORACLE["orders_enriched"]
ORACLE["stream_quarantine"] = _pq("", """
SELECT frame_id, packet_seq, NULL AS reason FROM pd
UNION ALL
SELECT e.event_id, 0, CASE e.event_id % 6 WHEN 0 THEN 'truncated' WHEN 1 THEN 'bad_length' WHEN 2 THEN 'short_frame'
              WHEN 4 THEN 'unknown_segment' WHEN 5 THEN 'unknown_instrument' END
FROM events e JOIN master m ON m.security_id = e.user_id""")
ORACLE["stream_order_quarantine"] = _oq("", """
SELECT frame_id, packet_seq, NULL AS reason FROM ov
UNION ALL
SELECT okey, 0, CASE okey % 4 WHEN 0 THEN 'bad_length' WHEN 1 THEN 'bad_length' WHEN 2 THEN 'truncated' END FROM ov""")


# ---------------------------------------------------------------------------
# more coverage
# ---------------------------------------------------------------------------

_REC_COLS = ["exchange", "segment", "security_id", "instrument_type", "trading_symbol", "display_name",
             "instrument_key", "lot_units", "strike_price", "option_type", "tick_size", "expiry_date_str",
             "expiry_type"]
ORACLE["records_export"] = _q("", "SELECT '{' || concat_ws(',', " + ", ".join(
    f"'\"{c}\":' || coalesce(CAST(to_json({c}) AS VARCHAR), 'null')" for c in _REC_COLS)
    + ") || '}' AS record FROM master")

ORACLE["nearest_expiry_fut"] = _q(UNDERLYINGS_CTE, f"""SELECT u.underlying, u.exchange,
  arg_min(m.expiry_date_str, m.expiry_date) AS nearest_expiry
FROM master m JOIN und u ON m.exchange = u.exchange AND starts_with(m.trading_symbol, upper(u.underlying) || '-')
WHERE {FUTURE_SHAPE} GROUP BY u.underlying, u.exchange""")

def _of_log(twentieths: int) -> str:
    return f"(SELECT make_timestamp(min(epoch_us(ts)) + (max(epoch_us(ts)) - min(epoch_us(ts))) * {twentieths} // 20) FROM slog)"


_MID = _of_log(10)


def _reg_split(mid: str) -> str:
    return SUBLOG_CTE + f""",
early AS (SELECT *, row_number() OVER (PARTITION BY instrument_key ORDER BY ts DESC, event_id DESC) AS rn
          FROM slog WHERE ts < {mid}),
reg0 AS (SELECT instrument_key, mode, ts AS since_ts FROM early WHERE rn = 1 AND action = 'SUBSCRIBE'),
later AS (SELECT * FROM slog WHERE ts >= {mid})"""


REG_SPLIT_CTE = _reg_split(_MID)

ORACLE["registry_registered_unsubs"] = _q(REG_SPLIT_CTE, """SELECT event_id, instrument_key, ts FROM later
WHERE action = 'UNSUBSCRIBE' AND instrument_key IN (SELECT instrument_key FROM reg0)""")

ORACLE["registry_after_unsubscribe"] = _q(_reg_split(_of_log(19)), """SELECT instrument_key, mode, since_ts FROM reg0
WHERE instrument_key NOT IN (SELECT instrument_key FROM later WHERE action = 'UNSUBSCRIBE')""")

ORACLE["registry_after_upsert"] = _q(REG_SPLIT_CTE + """,
subs AS (SELECT *, row_number() OVER (PARTITION BY instrument_key ORDER BY ts DESC, event_id DESC) AS rn
         FROM later WHERE action = 'SUBSCRIBE'),
fresh AS (SELECT instrument_key, mode, ts AS since_ts FROM subs WHERE rn = 1)""",
                                     """SELECT * FROM reg0 WHERE instrument_key NOT IN (SELECT instrument_key FROM fresh)
UNION ALL SELECT * FROM fresh""")

ORACLE["stream_orders_latest"] = ORACLE["orders_latest"]

ORACLE["registered_ticks"] = _pq(REGISTRY_CTE.replace("WITH ", ""), """SELECT frame_id, packet_seq, instrument_key,
  packet_type FROM pd WHERE instrument_key IN (SELECT instrument_key FROM reg)""")

_PQ_LOG = REGISTRY_CTE.replace("WITH ", "")
ORACLE["registry_with_auto"] = _pq(_PQ_LOG + """,
final AS (SELECT instrument_key, action, mode, ts FROM lastact WHERE rn = 1)""", """
SELECT instrument_key, mode, ts AS since_ts FROM final WHERE action = 'SUBSCRIBE'
UNION ALL
SELECT pd.instrument_key, NULL, min(pd.recv_ts) FROM pd LEFT JOIN final USING (instrument_key)
WHERE final.action IS NULL OR (final.action = 'UNSUBSCRIBE' AND pd.recv_ts >= final.ts) GROUP BY pd.instrument_key""")

ORACLE["registered_ticks_asof"] = _pq(_PQ_LOG + """,
found AS (SELECT pd.frame_id, pd.packet_seq, pd.instrument_key, pd.recv_ts, slog.action, slog.mode, slog.ts
          FROM pd ASOF LEFT JOIN slog ON pd.instrument_key = slog.instrument_key AND pd.recv_ts >= slog.ts)""", """
SELECT frame_id, packet_seq, instrument_key, recv_ts, CASE WHEN action = 'SUBSCRIBE' THEN mode END AS mode,
  CASE WHEN action = 'SUBSCRIBE' THEN ts ELSE min(recv_ts) OVER (PARTITION BY instrument_key, ts) END AS since_ts,
  action IS DISTINCT FROM 'SUBSCRIBE' AS auto FROM found""")

ORACLE["master_needs_refresh"] = """SELECT CAST(d.day AS INTEGER) AS day, c.clock, d.day = 1 AS stale
FROM (VALUES (-1), (1)) d(day), (VALUES ('07:00:00'), ('08:30:00'), ('09:00:00')) c(clock)
WHERE (SELECT count(*) FROM part) > 0"""

ORACLE["master_bad_values"] = """SELECT count(*) AS rows, count(*) FILTER (p_partkey % 10 = 0) AS bad_dates,
  count(*) FILTER (p_partkey % 7 = 0 AND p_partkey % 10 <> 0) AS bad_times, count(*) FILTER (p_partkey % 11 = 0) AS bad_lines FROM part"""

ORACLE["stream_order_callback"] = ORACLE["orders_by_frame"]

ORACLE["master_scan_current"] = _q("", "SELECT " + MASTER_COLS.replace(
    "lot_units,", "lot_units * 3 AS lot_units,") + ", DATE '2024-01-03' AS snapshot_date FROM master")
