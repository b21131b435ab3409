import os
import tempfile

from pyspark.sql import functions as F

from ticklake.operators import display, lookup
from ticklake.sources.master import ingest_master, read_master_csv, scan_master, write_snapshot

HEADER = ("SEM_EXM_EXCH_ID, SEM_SEGMENT,SEM_SMST_SECURITY_ID,SEM_INSTRUMENT_NAME,SEM_EXPIRY_CODE,"
          "SEM_TRADING_SYMBOL,SEM_LOT_UNITS,SEM_CUSTOM_SYMBOL,SEM_EXPIRY_DATE,SEM_STRIKE_PRICE,"
          "SEM_OPTION_TYPE,SEM_TICK_SIZE,SEM_EXPIRY_FLAG")
ROWS = [
    # ordinary option
    "NSE,D,35001,OPTIDX,0,NIFTY-Dec2023-20000-CE,50.0,NIFTY 14 DEC 20000 CALL,2023-12-14 14:30:00,20000.0,CE,5.0,W",
    # ragged line: two surplus tokens
    "BSE,C,1100,OPTCUR,0,USDINR-08Dec2023-82.5-CE,1.0,USDINR 08 DEC 82.5 CALL,2023-12-08 12:00:00,82.5,CE,0.25,W,x,y",
    # unparsable expiry text
    "NSE,D,35002,FUTIDX,1,NIFTY-Dec2023-FUT,50.0,NIFTY DEC FUT,2023-13-45 99:00:00,,NA,5.0,M",
    # symbol containing NA
    "NSE,E,2885,EQUITY,0,NATIONALUM,1.0,NATIONALUM,,,,5.0,",
    # index row with exchange IDX
    "IDX,I,13,INDEX,0,NIFTY,1.0,NIFTY 50,,,,0.0,",
]


def _csv(rows):
    d = tempfile.mkdtemp(prefix="master-csv-")
    with open(os.path.join(d, "m.csv"), "w") as f:
        f.write(HEADER + "\n" + "\n".join(rows) + "\n")
    return d


def test_csv_ingest_edge_rows(spark):
    m = ingest_master(read_master_csv(spark, _csv(ROWS)))
    rows = {r["security_id"]: r for r in m.collect()}
    assert len(rows) == 5
    assert rows[35001]["instrument_key"] == "35001-D-NSE"
    assert str(rows[35001]["expiry_date"]) == "2023-12-14" and rows[35001]["expiry_time_s"] == 52200
    assert rows[1100]["strike_price"] == 82.5 and rows[1100]["expiry_type"] == "W"     # surplus tokens dropped
    assert rows[35002]["expiry_date_str"] == "2023-13-45" and rows[35002]["expiry_date"] is None
    assert rows[35002]["expiry_time_s"] is None                                       # D11: null, not a failure
    assert rows[13]["instrument_key"] == "13-I-IDX" and rows[2885]["expiry_date_str"] is None


def test_lookup_and_na_column_pruning(spark):
    m = ingest_master(read_master_csv(spark, _csv(ROWS)))
    eq = lookup.instrument_lookup(m, "NATIONALUM", "nse", "EQUITY")
    kept = display.drop_empty_columns(eq).columns
    # the reference rule drops a column whose every value contains "NA" —
    # including the symbol of an instrument whose name merely contains NA
    assert "trading_symbol" not in kept and "strike_price" not in kept and "exchange" in kept
    assert "trading_symbol" in display.drop_empty_columns(eq, substring=False).columns
    assert lookup.instrument_lookup(m, "NIFTY", "NSE", "") is None
    empty = display.drop_empty_columns(lookup.instrument_lookup(m, "NOPE", "NSE", "EQUITY"))
    assert empty.columns == []


def test_snapshots_choose_newest_and_prune(spark):
    m = ingest_master(read_master_csv(spark, _csv(ROWS)))
    path = tempfile.mkdtemp(prefix="snap-") + "/master"
    write_snapshot(m, path, "2024-01-02 08:00:00")
    write_snapshot(m.withColumn("lot_units", F.col("lot_units") * 2), path, "2024-01-02 09:00:00")
    cur = scan_master(spark, path)
    got = cur.select("snapshot_date", "lot_units").where("security_id = 35001").collect()
    assert [(str(r[0]), r[1]) for r in got] == [("2024-01-02", 100.0)]


def test_option_chain_fallback_and_empty(spark):
    m = ingest_master(read_master_csv(spark, _csv(ROWS)))
    ch = lookup.option_chain(m, "nifty", "nse", "2030-01-01").collect()
    assert [r["security_id"] for r in ch] == [35001]
    assert lookup.option_chain(m, "NOPE", "NSE").count() == 0                        # D5
    ex = lookup.expiry_dates(m, "NIFTY", "NSE").collect()
    assert [(r[0], r[1]) for r in ex] == [("2023-12-14", "W")]


def test_request_lists_require_equal_lengths(spark):
    import pytest
    m = ingest_master(read_master_csv(spark, _csv(ROWS)))
    req = lookup.requests_from_lists(spark, ["NIFTY"], "nse", "OPTIDX", expiry_dates=["2023-12-14"],
                                     strikes=[20000], option_types=["CE"])
    assert [r["security_id"] for r in lookup.instruments_lookup(m, req).collect()] == [35001]
    with pytest.raises(ValueError):
        lookup.requests_from_lists(spark, ["A", "B"], "NSE", "OPTIDX", expiry_dates=["2023-12-14"])


def test_needs_refresh(spark):
    from ticklake.sources.master import needs_refresh
    m = ingest_master(read_master_csv(spark, _csv(ROWS)))
    path = tempfile.mkdtemp(prefix="snap-") + "/master"
    write_snapshot(m, path, "2024-01-02 09:00:00")
    snaps = spark.read.parquet(path)
    assert needs_refresh(snaps, "2024-01-03 08:00:00").first()["stale"] is False   # before 08:30: same day
    assert needs_refresh(snaps, "2024-01-03 08:45:00").first()["stale"] is True


def test_records_json_and_url_form(spark):
    import json
    from urllib.parse import unquote_plus
    m = ingest_master(read_master_csv(spark, _csv(ROWS)))
    eq = lookup.instrument_lookup(m, "NIFTY", "NSE", "OPTIDX", expiry_date="2023-12-14", strike=20000,
                                  option_type="CE")
    rec = display.to_records(eq).first()["record"]
    assert json.loads(rec)["instrument_key"] == "35001-D-NSE" and " " not in rec.split('"display_name"')[0]
    url = display.to_records(eq, url_encoded=True).first()["record"]
    assert json.loads(unquote_plus(url)) == json.loads(rec)
    vv = display.vertical_view(eq, ["instrument_key"]).collect()
    assert {r["variable"] for r in vv} == {c for c in eq.columns if c != "instrument_key"}


def test_master_columns_are_matched_by_name(spark, tmp_path):
    from ticklake.schemas import RAW_MASTER_SCHEMA
    from ticklake.sources.master import ingest_master, read_master_csv
    names = [f.name for f in RAW_MASTER_SCHEMA.fields]
    value = {n: "7" for n in names} | {"SEM_EXM_EXCH_ID": "NSE", "SEM_TRADING_SYMBOL": "ABC", "EXTRA": "kept"}
    order = ["EXTRA", *reversed(names)]
    path = tmp_path / "m.csv"
    path.write_text(",".join(order) + "\n" + ",".join(value[n] for n in order) + "\n")
    row = ingest_master(read_master_csv(spark, str(path))).first()
    assert (row.exchange, row.trading_symbol, row.security_id, row.EXTRA) == ("NSE", "ABC", 7, "kept")
    path.write_text("EXTRA\nx\n")
    import pytest
    with pytest.raises(ValueError, match="lacks"):
        read_master_csv(spark, str(path))


def test_files_are_stale_by_their_time(spark):
    """08:30 of the day decides, also when it is not yet 08:30."""
    import datetime as dt
    import os

    from ticklake.sources.master import files_need_refresh
    path = tempfile.mkdtemp(prefix="stale-") + "/master"
    ingest_master(read_master_csv(spark, _csv(ROWS))).coalesce(1).write.parquet(path)
    def stale(written):
        t = dt.datetime.fromisoformat(written).replace(tzinfo=dt.timezone.utc).timestamp()
        for f in os.listdir(path):
            os.utime(f"{path}/{f}", (t, t))
        now = spark.createDataFrame([(dt.datetime(2024, 1, 2, h, m),) for h, m in ((7, 0), (8, 30), (9, 0))], "now_ts timestamp_ntz")
        return [r.stale for r in files_need_refresh(spark, path, now).orderBy("now_ts").collect()]
    assert stale("2024-01-02T06:59:00") == [True, True, True]     # the rule of the client: even at 07:00
    assert stale("2024-01-02T08:30:00") == [True, True, True]
    assert stale("2024-01-02T08:30:01") == [False, False, False]
    assert stale("2024-01-01T20:00:00") == [True, True, True]


def test_each_file_has_its_own_header(spark):
    a = _csv(ROWS)
    folder = tempfile.mkdtemp(prefix="headers-")
    raw = spark.read.option("header", True).csv(a)
    raw.coalesce(1).write.option("header", True).mode("append").csv(folder)
    raw.select(*[F.col(f"`{c}`") for c in reversed(raw.columns)], F.lit("x").alias("NEW")).coalesce(1).write.option("header", True).mode("append").csv(folder)
    one = ingest_master(read_master_csv(spark, a)).select("instrument_key", "lot_units", "expiry_date").collect()
    both = ingest_master(read_master_csv(spark, folder)).select("instrument_key", "lot_units", "expiry_date").collect()
    assert sorted(map(str, both)) == sorted(map(str, one + one))


def test_unparsable_values_are_counted(spark):
    from pyspark.sql import Observation
    counts = Observation()
    m = ingest_master(read_master_csv(spark, _csv(ROWS), "_bad"), counts, "_bad")
    rows = m.collect()
    assert "_bad" not in m.columns and counts.get["rows"] == len(rows)
    bad = [r for r in rows if r.expiry_date_str and r.expiry_date is None]
    assert counts.get["bad_dates"] == len(bad) > 0


def test_keys_resolve_from_lists_records_and_rows(spark):
    m = ingest_master(read_master_csv(spark, _csv(ROWS)))
    keys = [r.instrument_key for r in m.select("instrument_key").limit(2).collect()]
    def got(x):
        out = lookup.resolve_keys(m, x).collect()
        assert all(r.price_updates.ltp == 0.0 and r.order_updates is None for r in out)
        return sorted(r.instrument_key for r in out)
    assert got([*keys, keys[0], "no-such-key", 5]) == sorted(keys)
    assert got([{"instrument_key": keys[0]}, "ignored"]) == keys[:1]
    assert got(spark.createDataFrame([(k,) for k in keys], "instrument_key string")) == sorted(keys)
    assert got([]) == []
    made_up = m.limit(1).withColumn("instrument_key", F.lit("made-up"))
    assert got(made_up) == ["made-up"]           # whole rows pass through


def test_batch_lookup_equals_a_scan(spark):
    """Every batch against a plain scan: restrictions of other requests, repeated master rows, a null batch, -0.0."""
    import random

    from ticklake.functions.symbols import trading_symbol
    from ticklake.schemas import INSTRUMENT_COLUMNS
    rng = random.Random(5)
    req = [(rng.choice([1, 1, 1, 2, 3, None]), rng.choice("AB"), rng.choice(["nse", "BSE"]), rng.choice(["OPTIDX", "FUTIDX", "EQUITY"]),
            rng.choice(["2024-01-04", "2024-01-11", None]), rng.choice([100.0, 0.0, -0.0, None]), rng.choice(["CE", "PE", None])) for _ in range(60)]
    requests = spark.createDataFrame(req, "batch_id long, instrument string, exchange string, instrument_type string, "
                                          "expiry_date string, strike double, option_type string")
    named = [r.asDict() for r in requests.withColumn("symbol", trading_symbol(
        "instrument", "exchange", "instrument_type", F.col("expiry_date").cast("date"), "strike", "option_type")).collect()]
    symbols = sorted({r["symbol"] for r in named if r["symbol"]})
    rows = []
    for i in range(400):
        row = dict.fromkeys(INSTRUMENT_COLUMNS)
        row.update(exchange=rng.choice(["NSE", "BSE"]), instrument_type=rng.choice(["OPTIDX", "FUTIDX", "EQUITY"]),
                   trading_symbol=rng.choice(symbols), security_id=i // 2, strike_price=rng.choice([100.0, 0.0, -0.0, None]),
                   option_type=rng.choice(["CE", "PE", None]), expiry_date_str=rng.choice(["2024-01-04", "2024-01-11", None]))
        rows += [tuple(row.values())] * rng.choice([1, 1, 2])
    types = {"security_id": "long", "lot_units": "double", "strike_price": "double", "tick_size": "double"}
    master = spark.createDataFrame(rows, ", ".join(f"{c} {types.get(c, 'string')}" for c in INSTRUMENT_COLUMNS))

    want = []
    for batch in {r["batch_id"] for r in named}:
        asked = [r for r in named if r["batch_id"] == batch]
        keys = {(r["exchange"].upper(), r["instrument_type"], r["symbol"]) for r in asked}
        sets = {m: {r[c] for r in asked if r[c] is not None} for c, m in lookup.RESTRICTIONS}
        for values in rows:
            row = dict(zip(INSTRUMENT_COLUMNS, values, strict=True))
            if (row["exchange"], row["instrument_type"], row["trading_symbol"]) in keys and all(not s or row[m] in s for m, s in sets.items()):
                want.append((batch, *values))
    found = lookup.instruments_lookup(master, requests)
    order = lambda r: tuple(map(str, ((x or 0.0) if isinstance(x, float) else x for x in r)))
    assert len(want) > 20 and sorted(map(tuple, found.collect()), key=order) == sorted(want, key=order)
    plan = lookup.instruments_lookup(master, requests)._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    keyed = [line for line in plan.splitlines() if "hashpartitioning(_batch" in line or "hashpartitioning(_b#" in line]
    assert plan.count("Join") == 2 and all("_kind" in k or "_k#" in k or "trading_symbol" in k or "_sym" in k for k in keyed)
