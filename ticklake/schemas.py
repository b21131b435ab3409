"""Schemas and fixed values.

Everything under a "FIXED VALUES" comment must equal what the feed and the
instrument master use on the wire or in their files; it is stated here once,
plainly, and every module reads it from here.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES — instrument master file
# ---------------------------------------------------------------------------

# Raw CSV header names and the canonical column each one becomes.  The raw
# segment header really starts with a space.
RAW_MASTER_COLUMNS = {
    "SEM_EXM_EXCH_ID": "exchange",
    " SEM_SEGMENT": "segment",
    "SEM_SMST_SECURITY_ID": "security_id",
    "SEM_INSTRUMENT_NAME": "instrument_type",
    "SEM_EXPIRY_CODE": "expiry_code",
    "SEM_TRADING_SYMBOL": "trading_symbol",
    "SEM_LOT_UNITS": "lot_units",
    "SEM_CUSTOM_SYMBOL": "display_name",
    "SEM_EXPIRY_DATE": "expiry_raw",
    "SEM_STRIKE_PRICE": "strike_price",
    "SEM_OPTION_TYPE": "option_type",
    "SEM_TICK_SIZE": "tick_size",
    "SEM_EXPIRY_FLAG": "expiry_type",
}

# Instrument kinds in resolver precedence order (first true flag wins).
INSTRUMENT_TYPES = [
    "INDEX", "EQUITY", "FUTIDX", "FUTSTK", "FUTCUR",
    "FUTCOM", "OPTIDX", "OPTSTK", "OPTCUR", "OPTFUT",
]
FUTURE_TYPES = ["FUTIDX", "FUTSTK", "FUTCOM", "FUTCUR"]
OPTION_TYPES = ["OPTIDX", "OPTSTK", "OPTCUR", "OPTFUT"]
# Kinds whose trading symbol carries the day of expiry on BSE / MCX.
DAY_EXPIRY_TYPES = ["FUTCUR", "OPTCUR", "OPTFUT", "FUTCOM"]
DAY_EXPIRY_EXCHANGES = ["BSE", "MCX"]

# Output projection of an instrument lookup, in order.
INSTRUMENT_COLUMNS = [
    "exchange", "segment", "security_id", "instrument_type", "trading_symbol",
    "display_name", "instrument_key", "lot_units", "strike_price",
    "option_type", "tick_size", "expiry_date_str", "expiry_type",
]
# Output projection of an option chain, in order.
OPTION_CHAIN_COLUMNS = [
    "trading_symbol", "security_id", "strike_price", "option_type", "lot_units",
    "tick_size", "expiry_date_str", "expiry_type", "exchange", "segment",
    "instrument_type", "display_name", "instrument_key",
]

# ---------------------------------------------------------------------------
# FIXED VALUES — feed segment codes
# (exchange, segment) -> code used on the wire.  Segment I is code 0 on any
# exchange and is tested first.
# ---------------------------------------------------------------------------
SEGMENT_CODES = [
    ("NSE", "E", 1), ("NSE", "D", 2), ("NSE", "C", 3), ("NSE", "M", 10),
    ("BSE", "E", 4), ("BSE", "C", 7), ("BSE", "D", 8), ("BSE", "M", 9),
    ("MCX", "M", 5), ("NCDEX", "M", 6), ("ICEX", "M", 11),
]
INDEX_SEGMENT_CODE = 0

# code -> (exchange, segment, decimals) for decoding.  Code 0 is an index on
# an exchange the wire does not name (resolved against the master, D1);
# codes 9-11 are our symmetric completion of the table.
SEGMENT_BY_CODE = [
    (0, None, "I", 2),
    (1, "NSE", "E", 2),
    (2, "NSE", "D", 2),
    (3, "NSE", "C", 4),
    (4, "BSE", "E", 2),
    (5, "MCX", "M", 2),
    (6, "NCDEX", "M", 2),
    (7, "BSE", "C", 4),
    (8, "BSE", "D", 4),
    (9, "BSE", "M", 2),
    (10, "NSE", "M", 2),
    (11, "ICEX", "M", 2),
]

# ---------------------------------------------------------------------------
# FIXED VALUES — price packets
# ---------------------------------------------------------------------------
HEADER_LEN = 11                       # u8 code, u32 ignored, u32 id, u8 len, u8 type
# body bytes per packet type
BODY_LEN = {1: 26, 2: 100, 3: 16, 5: 24, 6: 24, 29: 7, 32: 8, 33: 8, 36: 8, 37: 4}
OI_SENTINEL = 4294967295              # "no open interest" on trade packets
MARKET_STATUS = {1: "PREOPEN", 3: "OPEN", 5: "POSTCLOSE", 6: "CLOSE"}
WIRE_EPOCH = "1980-01-01 05:30:00"    # wire seconds count from this local time
HEARTBEAT_TYPE = 14
MARKET_STATUS_TYPE = 29
DEPTH_LEVELS = 5

# ---------------------------------------------------------------------------
# FIXED VALUES — subscription request codes
# ---------------------------------------------------------------------------
SUBSCRIBE, UNSUBSCRIBE = "SUBSCRIBE", "UNSUBSCRIBE"
QUOTE, FULL = "QUOTE", "FULL"
REQUEST_CODE_SUB_QUOTE_INDEX = 24
REQUEST_CODE_SUB_QUOTE = 12
REQUEST_CODE_UNSUB_QUOTE = 13
REQUEST_CODE_SUB_FULL = 23
REQUEST_CODE_UNSUB_FULL = 25
REQUEST_CODE_OTHER = 12

# ---------------------------------------------------------------------------
# FIXED VALUES — order update packet (little-endian, 1,008 bytes)
# (name, byte offset, kind) with kind one of i16, i32, f64, c (1 char) or sN.
# ---------------------------------------------------------------------------
ORDER_PACKET_LEN = 1008
ORDER_LAYOUT = [
    ("msg_code", 0, "i16"), ("msg_len", 2, "i16"), ("exchange", 4, "s6"),
    ("segment", 10, "c"), ("source", 11, "c"), ("security_id", 12, "s12"),
    ("client_id", 24, "s30"), ("exch_order_no", 54, "s30"), ("order_no", 84, "s30"),
    ("product", 114, "c"), ("txn_type", 115, "c"), ("order_type", 116, "s10"),
    ("validity", 126, "s5"), ("disc_quantity", 132, "i32"), ("dq_qty_rem", 136, "i32"),
    ("remaining_quantity", 140, "i32"), ("quantity", 144, "i32"), ("traded_qty", 148, "i32"),
    ("price", 152, "f64"), ("trigger_price", 160, "f64"), ("serial_no", 168, "i16"),
    ("traded_price", 172, "f64"), ("avg_traded_price", 180, "f64"), ("algo_ord_no", 188, "f64"),
    ("strategy_id", 196, "i16"), ("off_mkt_flag", 198, "c"),
    ("order_date_time", 199, "s20"), ("exch_order_time", 219, "s20"),
    ("last_updated_time", 239, "s20"), ("remarks", 259, "s24"), ("mkt_type", 283, "s4"),
    ("reason_description", 287, "s300"),
    ("leg_no", 588, "i16"), ("mkt_pro_flag", 590, "c"), ("mkt_pro_value", 592, "f64"),
    ("participant_type", 600, "c"), ("settlor", 601, "s30"), ("gtcflag", 631, "c"),
    ("encash_flag", 632, "c"), ("pan_no", 633, "s12"), ("group_id", 648, "i32"),
    ("instrument", 652, "s10"), ("symbol", 662, "s15"), ("product_name", 677, "s20"),
    ("status", 697, "s15"), ("lot_size", 712, "i32"), ("fsltrail", 716, "f64"),
    ("fsltickvalue", 724, "f64"), ("fprtickvalue", 732, "f64"), ("strike_price", 740, "f64"),
    ("expiry_date", 748, "s20"), ("opt_type", 768, "s5"), ("display_name", 773, "s40"),
    ("isin", 813, "s15"), ("series", 828, "s3"), ("good_till_days_date", 831, "s20"),
    ("sintrumenttype", 851, "s50"), ("ref_ltp", 904, "f64"), ("tick_size", 912, "f64"),
    ("algo_id", 920, "s20"), ("splatform", 940, "s20"), ("schannel", 970, "s20"),
    ("multiplier", 1000, "f64"),
]
# Personal-data fields left out of default order projections.
ORDER_PERSONAL_FIELDS = ["client_id", "pan_no"]
# Platform text -> order label, first match wins.
ORDER_LABELS = [
    (["BSKT", "STRGBSK"], "Basket"),
    (["FOVR"], "Forever"),
    (["SIP"], "SIP"),
    (["TV_TERMINAL"], "TV"),
    (["IBERG"], "Iceberg"),
]

# ---------------------------------------------------------------------------
# Spark schemas
# ---------------------------------------------------------------------------

RAW_MASTER_SCHEMA = T.StructType([
    T.StructField("SEM_EXM_EXCH_ID", T.StringType()),
    T.StructField(" SEM_SEGMENT", T.StringType()),
    T.StructField("SEM_SMST_SECURITY_ID", T.LongType()),
    T.StructField("SEM_INSTRUMENT_NAME", T.StringType()),
    T.StructField("SEM_EXPIRY_CODE", T.IntegerType()),
    T.StructField("SEM_TRADING_SYMBOL", T.StringType()),
    T.StructField("SEM_LOT_UNITS", T.DoubleType()),
    T.StructField("SEM_CUSTOM_SYMBOL", T.StringType()),
    T.StructField("SEM_EXPIRY_DATE", T.StringType()),
    T.StructField("SEM_STRIKE_PRICE", T.DoubleType()),
    T.StructField("SEM_OPTION_TYPE", T.StringType()),
    T.StructField("SEM_TICK_SIZE", T.DoubleType()),
    T.StructField("SEM_EXPIRY_FLAG", T.StringType()),
])

DEPTH_LEVEL = T.StructType([
    T.StructField("quantity", T.LongType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("orders", T.IntegerType()),
])

# Tick state: column -> (Spark type, default).  Order follows the feed's
# declared record.
TICK_FIELDS = [
    ("ltp", T.DoubleType(), 0.0),
    ("open", T.DoubleType(), 0.0),
    ("high", T.DoubleType(), 0.0),
    ("low", T.DoubleType(), 0.0),
    ("close", T.DoubleType(), 0.0),
    ("prev_close", T.DoubleType(), 0.0),
    ("volume", T.LongType(), 0),
    ("average_price", T.DoubleType(), 0.0),
    ("open_interest", T.LongType(), 0),
    ("prev_open_interest", T.DoubleType(), 0.0),
    ("last_traded_qty", T.LongType(), 0),
    ("last_trade_time", T.StringType(), ""),
    ("last_updated_time", T.StringType(), ""),
    ("best_ask_price", T.DoubleType(), 0.0),
    ("best_ask_qty", T.LongType(), 0),
    ("best_bid_price", T.DoubleType(), 0.0),
    ("best_bid_qty", T.LongType(), 0),
    ("total_ask_qty", T.LongType(), 0),
    ("total_bid_qty", T.LongType(), 0),
    ("total_bid_ask_qty", T.LongType(), 0),
    ("total_bid_qty_prcnt", T.DoubleType(), 0.0),
    ("total_ask_qty_prcnt", T.DoubleType(), 0.0),
    ("week52_high", T.DoubleType(), 0.0),
    ("week52_low", T.DoubleType(), 0.0),
    ("lower_circuit", T.DoubleType(), 0.0),
    ("upper_circuit", T.DoubleType(), 0.0),
]
# Fields derived from state (never stored): change, change_prcnt,
# open_interest_chg, open_interest_chg_prcnt.
DEPTH_FIELDS = ["depth_buy", "depth_sell"]
