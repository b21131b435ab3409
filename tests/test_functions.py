import math
import struct

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.functions import codes, numeric, symbols, text, wire


def _one(spark, rows, schema, *cols):
    return spark.createDataFrame(rows, schema).select(*cols).collect()


def test_little_endian_readers_match_struct(spark):
    rng = np.random.default_rng(7)
    specials = [0.0, -0.0, 1.5, -2.25, 1e-45, -1e-40, 3.4e38, float("inf"), float("-inf"), 6.55, 0.05]
    rows = []
    for i in range(300):
        f = specials[i] if i < len(specials) else float(np.float32(rng.normal() * 10.0 ** int(rng.integers(-8, 8))))
        d = float(rng.normal() * 10.0 ** int(rng.integers(-300, 300))) if i % 3 else [0.0, -1.0, 5e-324, 1e308][i % 4]
        b = (bytes([int(rng.integers(0, 256))]) + struct.pack("<H", int(rng.integers(0, 65536)))
             + struct.pack("<I", int(rng.integers(0, 2 ** 32))) + struct.pack("<h", int(rng.integers(-32768, 32768)))
             + struct.pack("<i", int(rng.integers(-2 ** 31, 2 ** 31))) + struct.pack("<f", f) + struct.pack("<d", d))
        rows.append((i, bytearray(b)))
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("b", T.BinaryType())])
    got = _one(spark, rows, schema, "i", "b", wire.u8("b", 0).alias("u8"), wire.u16("b", 1).alias("u16"),
               wire.u32("b", 3).alias("u32"), wire.i16("b", 7).alias("i16"), wire.i32("b", 9).alias("i32"),
               wire.f32("b", 13).alias("f32"), wire.f64("b", 17).alias("f64"))
    for r in got:
        exp = struct.unpack("<BHIhifd", bytes(r["b"]))
        assert (r["u8"], r["u16"], r["u32"], r["i16"], r["i32"]) == exp[:5]
        for g, e in ((r["f32"], exp[5]), (r["f64"], exp[6])):
            assert (math.isnan(g) and math.isnan(e)) or g == e, (r["i"], g, e)


def _py_strip(s: str) -> str:
    # expected behaviour: NULs off both ends, then blanks, then inner NULs
    return s.strip("\x00").strip().replace("\x00", "")


def test_strip_nul_matches_expected(spark):
    samples = ["AB\x00\x00", "\x00 AB \x00", "A\x00B", "  x\t\n", "\x00\x00", "", "OK\x00", "NSE\x00\x00\x00"]
    got = _one(spark, [(s,) for s in samples], "s string", text.strip_nul("s").alias("o"))
    assert [r["o"] for r in got] == [_py_strip(s) for s in samples]


def test_trading_symbol_and_strike_text(spark):
    rows = [("nifty", "NSE", "OPTIDX", "2023-12-14", 20000.0, "CE"),
            ("usdinr", "BSE", "OPTCUR", "2023-12-08", 82.5, "CE"),
            ("crude", "MCX", "FUTCOM", "2024-01-19", None, None),
            ("banknifty", "NSE", "FUTIDX", "2023-12-28", None, None),
            ("RELIANCE", "BSE", "EQUITY", None, None, None),
            ("x", "NSE", "OPTSTK", None, 10.0, "PE")]
    schema = "u string, x string, k string, d string, s double, o string"
    got = _one(spark, rows, schema, symbols.trading_symbol("u", "x", "k", F.col("d").cast("date"), "s", "o").alias("t"))
    assert [r["t"] for r in got] == ["NIFTY-Dec2023-20000-CE", "USDINR-08Dec2023-82.5-CE", "CRUDE-19Jan2024-FUT",
                                     "BANKNIFTY-Dec2023-FUT", "RELIANCE", None]


def test_instrument_type_precedence():
    assert symbols.instrument_type(is_futcom=True, is_futcur=True) == "FUTCUR"
    assert symbols.instrument_type(is_optidx=True, is_index=True) == "INDEX"
    assert symbols.instrument_type() == ""


def test_segment_codes_roundtrip(spark):
    rows = [("NSE", "E"), ("NSE", "D"), ("NSE", "C"), ("BSE", "E"), ("MCX", "M"), ("NCDEX", "M"), ("BSE", "C"),
            ("BSE", "D"), ("BSE", "M"), ("NSE", "M"), ("ICEX", "M"), ("IDX", "I"), ("NSE", "I"), ("NSE", ""),
            ("XYZ", "E")]
    got = _one(spark, rows, "x string, s string", "x", "s", codes.segment_code("x", "s").alias("c"))
    c = [r["c"] for r in got]
    assert c == [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 0, 0, -1, -1]
    back = _one(spark, [(i, 42) for i in range(13)], "c int, id long", codes.code_decimals("c").alias("dp"),
                codes.wire_key("c", "id").alias("k"))
    assert [r["dp"] for r in back][:9] == [2, 2, 2, 4, 2, 2, 2, 4, 4]
    assert back[0]["k"] == "42-I-IDX" and back[5]["k"] == "42-M-MCX" and back[12]["k"] == ""


def test_market_status_and_request_codes(spark):
    got = _one(spark, [(1.0,), (3.0,), (5.0,), (6.0,), (9.0,)], "v double",
               codes.market_status_text("v").alias("s"))
    assert [r["s"] for r in got] == ["PREOPEN", "OPEN", "POSTCLOSE", "CLOSE", None]
    rows = [("SUBSCRIBE", "QUOTE", "I"), ("SUBSCRIBE", "QUOTE", "E"), ("UNSUBSCRIBE", "QUOTE", "I"),
            ("SUBSCRIBE", "FULL", "I"), ("UNSUBSCRIBE", "FULL", "D"), ("OTHER", "FULL", "D")]
    got = _one(spark, rows, "a string, m string, s string", codes.request_code("a", "m", "s").alias("c"))
    assert [r["c"] for r in got] == [24, 12, 13, 23, 25, 12]


def test_order_label_first_match(spark):
    rows = [("BSKT1",), ("STRGBSK",), ("FOVR",), ("SIP",), ("TV_TERMINAL",), ("IBERG",), ("WEB",), ("SIPFOVR",)]
    got = _one(spark, rows, "p string", codes.order_label("p").alias("l"))
    assert [r["l"] for r in got] == ["Basket", "Basket", "Forever", "SIP", "TV", "Iceberg", "", "Forever"]


def test_changes_and_shares(spark):
    rows = [(101.25, 100.0, 2, 1500, 1000.0), (5.0, 0.0, 2, 7, 0.0), (1.2345, 1.2, 4, 90, 100.0),
            (99.0, 100.0, 2, 1000, 1500.0)]
    df = spark.createDataFrame(rows, "cur double, prev double, dp int, oi long, poi double")
    chg, pct = numeric.price_change("cur", "prev", F.col("dp"))
    oic, oip = numeric.oi_change("oi", "poi", F.col("dp"))
    got = df.select(chg.alias("c"), pct.alias("p"), oic.alias("oc"), oip.alias("op")).collect()
    assert (got[0]["c"], got[0]["p"], got[0]["oc"], got[0]["op"]) == (1.25, 1.25, 500, 50)
    assert (got[1]["c"], got[1]["p"], got[1]["oc"], got[1]["op"]) == (0.0, 0.0, 0, 0)
    assert (got[2]["c"], got[2]["p"]) == (0.0345, 2.875)
    assert (got[3]["oc"], got[3]["op"]) == (-500, -33)          # truncation toward zero
    tot, b, a = numeric.book_shares(F.lit(2), F.lit(1), F.lit(2))
    r = spark.range(1).select(tot.alias("t"), b.alias("b"), a.alias("a")).first()
    assert (r["t"], r["b"], r["a"]) == (3, 66.67, 33.33)


def test_wire_time(spark):
    r = spark.range(1).select(wire.wire_seconds_to_ts(F.lit(100)).alias("t"),
                              wire.date_to_wire_seconds(F.lit("1980-01-02")).alias("s")).first()
    assert str(r["t"]) == "1980-01-01 05:31:40" and r["s"] == 86400 - 19800


def test_rounding_equals_python_on_the_exact_binary_value(spark):
    import random

    from pyspark.sql import functions as F

    from ticklake.functions.numeric import round_dp
    rng = random.Random(4)
    values = [1.005, 2.675, 0.125, 0.375, 1e15 + 0.5, -1.005, -0.125, 0.0, 1e-9, 123456.785, float("inf"), None]
    values += [k / 20000 * 100 for k in range(1, 20000, 7)] + [rng.randrange(10**7) / 1000 for _ in range(2000)]
    values += [rng.uniform(-1e6, 1e6) for _ in range(500)] + [(2 * rng.randrange(10**6) + 1) / 8 for _ in range(500)]
    df = spark.createDataFrame([(v, dp) for v in values for dp in (2, 4)], "x double, dp int")
    for r in df.select("x", "dp", round_dp("x", F.col("dp")).alias("y")).collect():
        assert r.y == (None if r.x is None else round(r.x, r.dp) if abs(r.x) < 1e300 else r.x), (r.x, r.dp)


def test_upsert_takes_the_last_change_of_a_key(spark):
    from ticklake.operators.subscriptions import upsert
    reg = spark.createDataFrame([("a", "QUOTE", 1), ("b", "FULL", 1)], "instrument_key string, mode string, since_ts int")
    new = spark.createDataFrame([("a", "FULL", 5), ("a", "QUOTE", 7), ("c", "FULL", 2)], "instrument_key string, mode string, since_ts int")
    assert sorted(map(tuple, upsert(reg, new).collect())) == [("a", "QUOTE", 7), ("b", "FULL", 1), ("c", "FULL", 2)]


def test_records_keep_null_fields(spark):
    from ticklake.operators.display import to_records
    assert to_records(spark.createDataFrame([(1, None)], "a int, b string")).first().record == '{"a":1,"b":null}'


def test_registry_keeps_an_unknown_mode(spark):
    import datetime as dt

    from ticklake.operators.subscriptions import current_registry
    t = dt.datetime(2024, 1, 1)
    log = spark.createDataFrame([("a", "SUBSCRIBE", None, t, 1), ("b", "SUBSCRIBE", "FULL", t, 2), ("b", "UNSUBSCRIBE", None, t, 3),
                                 ("c", "SUBSCRIBE", "QUOTE", t, 4)], "instrument_key string, action string, mode string, ts timestamp, event_id long")
    assert sorted((r.instrument_key, r.mode) for r in current_registry(log).collect()) == [("a", None), ("c", "QUOTE")]


def test_a_cluster_without_a_shared_folder_is_an_error():
    from types import SimpleNamespace

    import pytest

    from ticklake.session import ensure_checkpoint_dir
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="share"):
        ensure_checkpoint_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: None), sparkContext=sc))


def test_rounding_of_32_bit_values_and_staged_columns_equal_python(spark):
    import random
    import struct

    from ticklake.functions.numeric import round_f32, with_book_shares, with_change
    rng = random.Random(9)
    single = [struct.unpack("<f", struct.pack("<f", v))[0] for v in
              [1.005, 2.675, 0.125, 0.375, -0.125, 16777217.5, 3e38, 0.0] + [(2 * rng.randrange(10**5) + 1) / 8 for _ in range(300)]
              + [rng.uniform(-1e5, 1e5) for _ in range(1000)]]
    df = spark.createDataFrame([(v, dp) for v in single for dp in (2, 4)], "x double, dp int")
    for r in df.select("x", "dp", round_f32("x", F.col("dp")).alias("y")).collect():
        assert r.y == round(r.x, r.dp), r
    pairs = [(rng.choice(single), rng.choice(single), rng.choice([2, 4])) for _ in range(800)]
    pairs = [(round(a, d), round(b, d), d) for a, b, d in pairs if abs(a) < 1e6 and abs(b) < 1e6] + [(1.0, 0.0, 2), (1.0, -1.0, 4)]
    df = spark.createDataFrame(pairs, "a double, b double, dp int")
    for r in with_change(df, "a", "b", "dp", "c", "p").collect():
        c = round(r.a - r.b, r.dp)
        assert (r.c, r.p) == ((0.0, 0.0) if r.b <= 0 else (c, round(100.0 * (c / r.b), r.dp))), r
    df = spark.createDataFrame([(rng.randrange(10**6), rng.randrange(1000), 2) for _ in range(500)] + [(0, 0, 2)], "b long, s long, dp int")
    for r in with_book_shares(df, "b", "s", "dp", "t", "x", "y").collect():
        assert r.t == r.b + r.s and (r.x, r.y) == ((0.0, 0.0) if not r.t else (round(r.b / r.t * 100, 2), round(r.s / r.t * 100, 2))), r


def test_sorted_count_is_a_bisection(spark):
    import bisect

    from ticklake.functions.numeric import sorted_count
    arrays = [[], [5], [1, 2, 2, 2, 9], list(range(0, 300, 3)), None]
    df = spark.createDataFrame([(a, v) for a in arrays for v in (-1, 0, 1, 2, 5, 8, 9, 150, 400)], "a array<long>, v long")
    for r in df.withColumn("n", sorted_count("a", F.col("v"))).collect():
        assert r.n == (None if r.a is None else bisect.bisect_right(r.a, r.v)), r
