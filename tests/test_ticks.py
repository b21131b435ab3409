"""W1 / A4 against a brute-force scan on a small fixture with a hot key
holding a third of all packets."""

from pyspark.sql import functions as F

from tests.conftest import SF001
from ticklake.operators import decode, ticks
from ticklake.sources import fixtures as fx

STATE = ticks.STATE_COLS


def _good_with_hot_key(spark):
    m = fx.fixture_master(spark, SF001)
    good = decode.good(decode.price_packets(fx.fixture_price_frames(spark, SF001, m), m))
    hot = F.when(F.col("frame_id") % 3 == 0, F.lit("HOT-D-NSE")).otherwise(F.col("instrument_key"))
    return good.withColumn("instrument_key", hot).withColumn(
        "decimals", F.when(F.col("instrument_key") == "HOT-D-NSE", F.lit(2)).otherwise(F.col("decimals")))


def _brute(rows):
    state, out = {}, {}
    for r in sorted(rows, key=lambda r: (r["instrument_key"], r["recv_ts"], r["frame_id"], r["packet_seq"])):
        st = state.setdefault(r["instrument_key"], {})
        for c in STATE + ["depth_buy", "depth_sell"]:
            if c in ("depth_buy", "depth_sell"):
                if r["depth_buy"] is not None:
                    st[c] = r[c]
            elif r[c] is not None:
                st[c] = r[c]
        out[(r["frame_id"], r["packet_seq"])] = dict(st)
    return out


def test_snapshots_match_brute_force_under_skew(spark):
    good = _good_with_hot_key(spark).cache()
    rows = good.collect()
    expected = _brute(rows)
    hot_share = sum(r["instrument_key"] == "HOT-D-NSE" for r in rows) / len(rows)
    assert hot_share > 0.3
    for fine, coarse, target in ((60, 3600, None), (600, 86400, None), (None, 86400, 20), (None, 3600, 3),
                                 (86400, 86400 * 1000, None)):
        bucket = (fine, coarse, target)
        kw = {"rows_per_bucket": target} if target else {}
        snaps = ticks.tick_snapshots(good, fine_seconds=fine, coarse_seconds=coarse, **kw).collect()
        assert len(snaps) == len(rows)
        for s in snaps:
            e = expected[(s["frame_id"], s["packet_seq"])]
            for c in STATE:
                want = e.get(c, None if c in ticks.TIME_COLS else ticks.DEFAULTS[c])
                assert s[c] == want, (bucket, c, s["frame_id"], s[c], want)
            assert s["depth_buy"] == e.get("depth_buy")


def test_latest_equals_last_snapshot(spark):
    good = _good_with_hot_key(spark)
    latest = {r["instrument_key"]: r for r in ticks.latest_state(good).collect()}
    snaps = ticks.tick_snapshots(good, fine_seconds=900, coarse_seconds=7200)
    last = snaps.groupBy("instrument_key").agg(
        F.max_by(F.struct(*snaps.columns), F.struct("recv_ts", "frame_id", "packet_seq")).alias("l")).collect()
    assert len(last) == len(latest)
    for r in last:
        l, a = r["l"], latest[r["instrument_key"]]
        for c in STATE + ["change", "change_prcnt", "open_interest_chg", "open_interest_chg_prcnt"]:
            assert l[c] == a[c], (r["instrument_key"], c)


def test_packets_without_a_place_in_the_order_are_quarantined(spark):
    """Null and out-of-bounds ids are rejected by the decoders instead of failing the job."""
    import datetime as dt

    from pyspark.sql import types as T

    from ticklake.operators.decode import order_error
    schema = T.StructType([T.StructField("recv_ts", T.TimestampNTZType()), T.StructField("frame_id", T.LongType()),
                           T.StructField("packet_seq", T.IntegerType())])
    t = dt.datetime(2024, 1, 1)
    rows = [(t, 5, 1), (t, 2 ** 56 - 1, 65535), (t, 2 ** 56, 1), (t, -1, 1), (t, 5, 65536), (None, 5, 1), (t, None, 1)]
    df = spark.createDataFrame(rows, schema)
    got = df.select(order_error().alias("e"), ticks.arrival_order().alias("o")).collect()
    assert [r.e for r in got] == [None, None] + ["bad_arrival_order"] * 5
    assert 0 < got[0].o < got[1].o


def _control(spark, packets, with_reconnects=True):
    """Resets of some keys at times of packets, and reconnects (no key) that hit all."""
    times = packets.select("recv_ts", "instrument_key", "frame_id").distinct()
    own = times.where(F.col("frame_id") % 7 == 0).select(F.col("recv_ts").alias("ts"), "instrument_key")
    if not with_reconnects:
        return own
    lost = times.where(F.col("frame_id") % 41 == 5).select(F.col("recv_ts").alias("ts"), F.lit(None).cast("string").alias("instrument_key"))
    return own.unionAll(lost)


def _brute_with_resets(rows, control):
    """State after each packet, key by key, resets before the packets of their time."""
    keys = {r["instrument_key"] for r in rows}
    events = [((r["recv_ts"], r["frame_id"], r["packet_seq"]), r["instrument_key"], r) for r in rows]
    events += [((c["ts"], -1, -1), k, None) for c in control for k in (keys if c["instrument_key"] is None else {c["instrument_key"]})]
    state, epoch, out = {}, {}, {}
    for _, key, r in sorted(events, key=lambda e: e[0]):
        if r is None:
            state[key], epoch[key] = {}, epoch.get(key, 0) + 1
            continue
        st = state.setdefault(key, {})
        st.update({c: r[c] for c in [*STATE, "depth_buy", "depth_sell"] if r[c] is not None})
        out[(r["frame_id"], r["packet_seq"])] = (epoch.get(key, 0), dict(st))
    return out, state, epoch


def _same_state(got, want):
    for c in STATE:
        assert got[c] == want.get(c, None if c in ticks.TIME_COLS else ticks.DEFAULTS[c]), (c, got, want)
    assert got["depth_buy"] == want.get("depth_buy") and got["depth_sell"] == want.get("depth_sell")


def test_resets_and_reconnects_match_brute_force(spark):
    good = _good_with_hot_key(spark).cache()
    rows = good.collect()
    log = _control(spark, good).cache()
    want, state, epoch = _brute_with_resets(rows, log.collect())
    assert all(n > 0 for n in epoch.values())
    for target in (50_000, 15):
        snaps = ticks.tick_snapshots(good, log, rows_per_bucket=target).collect()
        assert len(snaps) == len(rows)
        for s in snaps:
            e, st = want[(s["frame_id"], s["packet_seq"])]
            assert s["epoch"] == e
            _same_state(s, st)
    for r in ticks.latest_state(good, log).collect():
        assert r["epoch"] == epoch[r["instrument_key"]]
        _same_state(r, state[r["instrument_key"]])


def test_state_goes_on_from_seeds(spark):
    """Rows cut in three at arbitrary times: snapshots of each part, started from the state of the parts before."""
    good = _good_with_hot_key(spark).cache()
    log = _control(spark, good).cache()
    want, _, _ = _brute_with_resets(good.collect(), log.collect())
    times = sorted({r["recv_ts"] for r in good.select("recv_ts").collect()})
    cuts = [times[0], times[len(times) // 3], times[len(times) // 2], None]
    earlier, seen, n = None, 0, 0
    for a, b in zip(cuts, cuts[1:]):
        def part(df, c):
            out = df.where(F.col(c) >= F.lit(a))
            return out if b is None else out.where(F.col(c) < F.lit(b))
        g, c = part(good, "recv_ts"), part(log, "ts")
        for s in ticks.tick_snapshots(g, c, seeds=earlier, reconnects=seen, rows_per_bucket=40).collect():
            e, st = want[(s["frame_id"], s["packet_seq"])]
            assert s["epoch"] == e
            _same_state(s, st)
            n += 1
        earlier = ticks.state_seeds(g, c, earlier, seen).checkpoint()
        seen += c.where(F.col("instrument_key").isNull()).count()
    assert n == len(want)


def test_bursts_and_gaps_keep_buckets_even(spark):
    """2,000,000 rows in an hour after one stray row ten years back; a quiet key has no cuts."""
    hour = 1_400_000_000
    rows = spark.range(2_000_000).selectExpr("'hot' AS instrument_key", f"{hour} + int(pow(id / 2000000.0, 3) * 3600) AS _s")
    rows = rows.unionAll(spark.createDataFrame([("hot", hour - 10 * 365 * 86400)] + [("quiet", hour + i) for i in range(100)],
                                               "instrument_key string, _s long"))
    cuts = ticks.balanced_cuts(rows, 50_000)
    assert [r.instrument_key for r in cuts.collect()] == ["hot"]
    sizes = [r["count"] for r in rows.join(cuts, "instrument_key").groupBy(ticks.sorted_count("_starts", F.col("_s"))).count().collect()]
    second = rows.groupBy("instrument_key", "_s").count().agg(F.max("count")).first()[0]
    assert sum(sizes) == 2_000_001 and max(sizes) <= 62_500 + second and len(sizes) >= 20


def test_snapshots_make_one_wide_shuffle(spark):
    import contextlib
    import io
    good = _good_with_hot_key(spark).cache()
    good.count()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = ticks.tick_snapshots(good, _control(spark, good, False), rows_per_bucket=100)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    body = buf.getvalue().split("\n\n")
    exchanges = [b for b in body if ") Exchange" in b and "_g_trade" in b and "_g_depth" in b and "packet_type" in b]
    assert len(exchanges) == 1, len(exchanges)


def test_as_of_reconnects(spark):
    import bisect
    import datetime as dt
    import random
    rng = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    lost = sorted(base + dt.timedelta(seconds=rng.choice([rng.randrange(9000), rng.randrange(40 * 3600, 41 * 3600)])) for _ in range(200))
    seen = [base + dt.timedelta(seconds=rng.randrange(-7200, 60 * 3600), microseconds=rng.randrange(10**6)) for _ in range(800)] + lost[:50]
    rows = spark.createDataFrame([(t,) for t in seen], "recv_ts timestamp_ntz")
    log = spark.createDataFrame([(t, None) for t in lost] + [(lost[0], "a")], "ts timestamp_ntz, instrument_key string")
    assert all(r._global == bisect.bisect_right(lost, r.recv_ts) for r in ticks.with_reconnects(rows, log).collect())
    none = log.where("instrument_key = 'a'")
    assert {r._global for r in ticks.with_reconnects(rows, none).collect()} == {0}


def test_times_far_away_are_quarantined(spark):
    import datetime as dt
    good = _good_with_hot_key(spark)
    far = good.limit(5).withColumn("recv_ts", F.lit(dt.datetime(3000, 1, 1)).cast("timestamp_ntz"))
    from ticklake.operators.decode import order_error
    assert {r.e for r in far.select(order_error().alias("e")).collect()} == {"bad_arrival_order"}
    log = spark.createDataFrame([(dt.datetime(3000, 1, 1), "x"), (None, "x")], "ts timestamp_ntz, instrument_key string")
    assert ticks.latest_state(good, log).where("epoch > 0").count() == 0
