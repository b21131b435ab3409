"""Orders: latest order of frames that landed twice, resets."""

import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import SF0001
from ticklake.operators import decode, orders
from ticklake.sources import fixtures as fx


def _orders(spark, times=1):
    frames = fx.fixture_order_frames(spark, SF0001, fx.fixture_master(spark, SF0001))
    for _ in range(times - 1):
        frames = frames.unionAll(fx.fixture_order_frames(spark, SF0001, fx.fixture_master(spark, SF0001)))
    return decode.good(orders.order_updates(frames))


def test_frames_landed_twice_show_once(spark):
    once, twice = ({r.instrument_key: r for r in orders.latest_orders(_orders(spark, n)).collect()} for n in (1, 2))
    assert len(twice) == len(once)
    for key, r in twice.items():
        assert r.orders_seen == 2 * once[key].orders_seen
        assert {**r.asDict(), "orders_seen": 0} == {**once[key].asDict(), "orders_seen": 0}


def test_order_record_is_what_the_decoder_returns(spark):
    found = _orders(spark).schema
    record = orders.order_record_type()
    assert [(f.name, f.dataType) for f in record] == [(f.name, f.dataType) for f in found if f.name not in (*orders.ORD, "error")]


def test_twins_of_all_text_fields(spark):
    df = spark.createDataFrame([("7", "0042", "4 2", 1), ("", None, "x9", 2)], "series string, remarks string, symbol string, quantity int")
    got = [(r.series_num, r.remarks_num, r.symbol_num) for r in orders.numeric_twins(df).orderBy("quantity").collect()]
    assert got == [(7, 42, None), (None, None, None)]
    kept = orders.numeric_twins(_orders(spark).limit(1))
    assert len(set(kept.columns)) == len(kept.columns)


def test_a_later_reset_leaves_no_order(spark):
    found = _orders(spark)
    last = orders.latest_orders(found).collect()
    one = last[0]
    same, after = one.recv_ts, one.recv_ts + dt.timedelta(seconds=1)
    schema = "ts timestamp_ntz, instrument_key string"
    key = one.instrument_key
    gone = {r.instrument_key: r.order_no is None for r in orders.latest_orders(found, spark.createDataFrame([(after, key), (None, None)], schema)).collect()}
    assert gone.pop(key) and not any(gone.values())
    kept = orders.latest_orders(found, spark.createDataFrame([(same, key)], schema)).where(F.col("instrument_key") == key).first()
    assert kept.order_no == one.order_no
    all_gone = orders.latest_orders(found, spark.createDataFrame([(dt.datetime(2400, 1, 1), None)], schema))
    assert all_gone.where("order_no IS NOT NULL").count() == 0 and all_gone.count() == len(last)


def test_membership_as_of_packets_matches_brute_force(spark):
    import random

    from ticklake.operators.subscriptions import membership_asof, registry_with_auto
    rng = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    def at():
        return base + dt.timedelta(seconds=rng.randrange(400))
    log = [(i, at(), rng.choice("abc"), rng.choice(["SUBSCRIBE", "UNSUBSCRIBE"]), rng.choice(["QUOTE", "FULL", None])) for i in range(40)]
    packets = [(i, 0, rng.choice("aaabcd"), at()) for i in range(300)]
    want, state = {}, {}
    events = [((t, 0, i), k, (a, m), None) for i, t, k, a, m in log] + [((t, 1, i), k, None, i) for i, _, k, t in packets]
    for (t, _, _), k, action, packet in sorted(events):
        if action:
            state[k] = (action[1], t, False) if action[0] == "SUBSCRIBE" else None
            continue
        state[k] = state.get(k) or (None, t, True)
        want[packet] = state[k]
    df = spark.createDataFrame(packets, "frame_id long, packet_seq int, instrument_key string, recv_ts timestamp_ntz")
    lf = spark.createDataFrame(log, "event_id long, ts timestamp_ntz, instrument_key string, action string, mode string")
    got = {r.frame_id: (r.mode, r.since_ts, r.auto) for r in membership_asof(df, lf).collect()}
    assert got == want
    last = {r.instrument_key: (r.mode, r.since_ts) for r in registry_with_auto(lf, df).collect()}
    assert last == {k: v[:2] for k, v in state.items() if v}
