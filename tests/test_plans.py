"""Plan shape: filters reach the Parquet scan, dimension joins broadcast,
aggregations are partial before the shuffle, decoders stay in codegen."""

import contextlib
import io
import tempfile

from tests.conftest import SF001
from ticklake.operators import decode, lookup, ticks
from ticklake.sources import fixtures as fx


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _master_parquet(spark):
    path = tempfile.mkdtemp(prefix="plan-master-") + "/m"
    fx.fixture_master(spark, SF001).write.parquet(path)
    return spark.read.parquet(path)


def test_lookup_pushes_filters_into_scan(spark):
    m = _master_parquet(spark)
    plan = _plan(lookup.instrument_lookup(m, "U0", "NSE", "OPTIDX", expiry_date="2024-01-04"))
    assert "PushedFilters" in plan and "EqualTo(exchange,NSE)" in plan and "EqualTo(instrument_type,OPTIDX)" in plan
    chain = _plan(lookup.option_chain(m, "U0", "NSE"))
    assert "StringStartsWith(trading_symbol,U0-)" in chain


def test_decode_joins_broadcast_and_aggregates_partially(spark):
    m = _master_parquet(spark)
    frames = fx.fixture_price_frames(spark, SF001, m)
    p = decode.price_packets(frames, m)
    assert "BroadcastHashJoin" in _plan(p)
    latest = _plan(ticks.latest_state(decode.good(p)))
    assert "partial_max_by" in latest
    # fixed-width buffers: the state aggregate is hash-based, not sort-based
    state_aggs = [ln for ln in latest.splitlines() if ln.startswith("(") and "Aggregate" in ln][-2:]
    assert all("HashAggregate" in ln and "Object" not in ln for ln in state_aggs), state_aggs


def test_decoder_stays_in_whole_stage_codegen(spark):
    m = _master_parquet(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = decode.price_packets(fx.fixture_price_frames(spark, SF001, m), m)
        plan = _plan(p)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # the projections right above the splitter (MapInArrow) decode the packet
    # (words -> floats -> typed columns): they must all be codegen stages
    ops = [ln for ln in plan.splitlines() if ln.startswith("(")]
    gen = max(i for i, ln in enumerate(ops) if ") MapInArrow" in ln)
    decode_ops = []
    for ln in ops[gen + 1:]:
        if ") Project" not in ln:
            break
        decode_ops.append(ln)
    assert len(decode_ops) >= 3 and all("codegen id" in ln for ln in decode_ops), decode_ops


def test_generated_code_of_the_decoders_compiles(spark):
    """Without the fallback, code that does not compile fails the query instead of running interpreted."""
    from ticklake.operators import orders
    m = _master_parquet(spark)
    price = fx.fixture_price_frames(spark, SF001, m)
    order = fx.fixture_order_frames(spark, SF001, m)
    spark.conf.set("spark.sql.codegen.fallback", "false")
    spark.conf.set("spark.sql.codegen.factoryMode", "CODEGEN_ONLY")
    try:
        packets = decode.price_packets(price, m)
        for df in (packets, ticks.latest_state(decode.good(packets)), ticks.market_status(decode.good(packets)),
                   ticks.tick_snapshots(decode.good(packets)), orders.order_updates(order)):
            df.write.format("noop").mode("overwrite").save()
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")
        spark.conf.unset("spark.sql.codegen.factoryMode")


def test_current_master_prunes_snapshot_partitions(spark):
    from ticklake.sources.master import scan_master, write_snapshot
    m = fx.fixture_master(spark, SF001)
    path = tempfile.mkdtemp(prefix="plan-snap-") + "/m"
    for ts in ("2024-01-01 09:00:00", "2024-01-02 09:00:00"):
        write_snapshot(m, path, ts)
    plan = _plan(scan_master(spark, path))
    assert "(snapshot_date" in plan and "= 2024-01-02)" in plan
