"""Subscriptions as tables.

The feed client keeps an in-memory registry and sends request frames; here
the same facts are a change log ``(ts, instrument_key, action, mode)`` and
derived tables: the request plan and the current registry.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import request_code, segment_code
from ..functions.numeric import sorted_count
from ..schemas import FULL, QUOTE, SUBSCRIBE, UNSUBSCRIBE
from .joins import sized_side


def request_plan(requests: DataFrame, master: DataFrame) -> DataFrame:
    """``requests(instrument_key, action, mode, ...)`` -> one row per
    request frame.  Every instrument gets its quote-mode request; FULL adds
    the full-mode request right after it (``request_seq`` 0 then 1)."""
    inst = sized_side(master.select("instrument_key", "security_id", "exchange", "segment"))
    r = requests.join(inst, "instrument_key", "inner")
    codes = F.when(F.col("mode") == FULL,
                   F.array(request_code("action", F.lit(QUOTE), "segment"),
                           request_code("action", F.lit(FULL), "segment"))) \
        .otherwise(F.array(request_code("action", F.lit(QUOTE), "segment")))
    keep = [c for c in requests.columns if c not in ("action", "mode")]
    return r.select(*keep, "action", "mode", "security_id",
                    segment_code("exchange", "segment").alias("seg_code"),
                    F.posexplode(codes).alias("request_seq", "request_code"))


def unsubscribe_all(registry: DataFrame, master: DataFrame) -> DataFrame:
    """Unsubscribe every registered instrument — the quote-mode group
    first, then the full-mode group."""
    req = registry.select("instrument_key", F.lit(UNSUBSCRIBE).alias("action"), "mode")
    plan = request_plan(req, master)
    return plan.withColumn("group", F.when(F.col("mode") == QUOTE, 0).otherwise(1))


def current_registry(log: DataFrame) -> DataFrame:
    """Last action per key wins; keys whose last action is a
    subscribe are registered (with that mode, null if none is known).

    ``max_by`` partial-aggregates, so a hot key does not pile up in one
    task; every aggregation buffer is fixed-width (action and mode as small
    codes, arrival order ``(ts, event_id)`` packed into one DECIMAL(38,0),
    the time as µs), so Spark hash-aggregates instead of sorting."""
    us = F.unix_micros(F.col("ts").cast("timestamp_ntz").cast("timestamp"))
    # (ts µs, event_id) -> ts_us * 2^64 + (event_id + 2^63): strictly monotone
    two64 = F.lit(str(2 ** 64)).cast("decimal(38,0)")
    two63 = F.lit(str(2 ** 63)).cast("decimal(38,0)")
    order = us.cast("decimal(38,0)") * two64 + (F.col("event_id").cast("decimal(38,0)") + two63)
    mode = F.when(F.col("mode").isNull(), F.lit(2)).when(F.col("mode") == FULL, F.lit(1)).otherwise(F.lit(0))
    code = F.when(F.col("action") == SUBSCRIBE, F.lit(2) + mode).otherwise(F.lit(0))
    last = log.groupBy("instrument_key").agg(
        F.max_by(code, order).alias("_code"), F.max_by(us, order).alias("_us"))
    return (last.where(F.col("_code") >= 2)
            .select("instrument_key",
                    F.when(F.col("_code") == 3, F.lit(FULL)).when(F.col("_code") == 2, F.lit(QUOTE)).alias("mode"),
                    F.timestamp_micros("_us").cast("timestamp_ntz").alias("since_ts")))


def _actions(log: DataFrame) -> DataFrame:
    """``(instrument_key, _times, _actions)``: each key's subscribe and
    unsubscribe actions in order, times (µs) apart for the look-up.  One row per
    instrument, as long as its log."""
    us = F.unix_micros(F.col("ts").cast("timestamp_ntz").cast("timestamp"))
    rows = log.where(F.col("ts").isNotNull() & F.col("instrument_key").isNotNull() & F.col("action").isin(SUBSCRIBE, UNSUBSCRIBE))
    listed = rows.groupBy("instrument_key").agg(
        F.sort_array(F.collect_list(F.struct(us.alias("us"), "event_id", "action", "mode"))).alias("_actions"))
    return listed.select("instrument_key", F.transform("_actions", lambda a: a["us"]).alias("_times"), "_actions")


def membership_asof(packets: DataFrame, log: DataFrame) -> DataFrame:
    """T6 for each packet: whether and since when its instrument was registered
    as the packet came in.

    An instrument is registered from a subscribe to the next unsubscribe.  A
    packet of an instrument that is not registers it, without a mode (D10),
    until the next action of the log; ``auto`` marks such spans and ``since_ts``
    is then their first packet.  The last action before a packet is found by
    binary search in the key's action times; a control row comes before the
    packets of its time.  ``packets``: instrument_key, recv_ts and more."""
    us = F.unix_micros(F.col("recv_ts").cast("timestamp"))
    found = packets.join(sized_side(_actions(log)), "instrument_key", "left")
    found = found.withColumn("_span", F.coalesce(sorted_count("_times", us), F.lit(0)))
    last = F.get(F.col("_actions"), F.col("_span") - 1)
    found = found.withColumn("_last", F.when(F.col("_span") > 0, last)).drop("_times", "_actions")
    found = found.withColumn("auto", F.coalesce(F.col("_last.action") != SUBSCRIBE, F.lit(True)))
    # first packets of auto-registered spans: at most one row per log row and key
    first = (found.where("auto").groupBy("instrument_key", "_span").agg(F.min("recv_ts").alias("_first"))
             .select(F.col("instrument_key").alias("_key"), F.col("_span").alias("_at"), "_first"))
    out = found.join(sized_side(first), (F.col("instrument_key") == F.col("_key")) & (F.col("_span") == F.col("_at")) & F.col("auto"), "left")
    since = F.when(F.col("auto"), F.col("_first")).otherwise(F.timestamp_micros("_last.us").cast("timestamp_ntz"))
    return out.select(*packets.columns, F.when(~F.col("auto"), F.col("_last.mode")).alias("mode"), since.alias("since_ts"), "auto")


def registry_with_auto(log: DataFrame, packets: DataFrame) -> DataFrame:
    """T6 after all of the log and all packets: subscribed keys, and keys that a
    packet registered after their last unsubscribe, or without any action
    (``mode`` null, since the first such packet)."""
    us = F.unix_micros(F.col("recv_ts").cast("timestamp"))
    last = _actions(log).select(F.col("instrument_key").alias("_key"), F.element_at("_actions", -1).alias("_last"))
    own = last.where(F.col("_last.action") == SUBSCRIBE).select(
        F.col("_key").alias("instrument_key"), F.col("_last.mode").alias("mode"),
        F.timestamp_micros("_last.us").cast("timestamp_ntz").alias("since_ts"))
    later = packets.select("instrument_key", "recv_ts").join(sized_side(last), F.col("instrument_key") == F.col("_key"), "left")
    free = F.col("_key").isNull() | ((F.col("_last.action") != SUBSCRIBE) & (us >= F.col("_last.us")))
    auto = later.where(free).groupBy("instrument_key").agg(F.min("recv_ts").alias("since_ts"))
    return own.unionByName(auto.withColumn("mode", F.lit(None).cast("string")))


def registered(keys: DataFrame, registry: DataFrame) -> DataFrame:
    """The requested keys that are registered (left-semi join)."""
    return keys.join(registry.select("instrument_key"), "instrument_key", "left_semi")


def unregister(registry: DataFrame, keys: DataFrame) -> DataFrame:
    """Registry without the given keys (mode not compared)."""
    return registry.join(keys.select("instrument_key"), "instrument_key", "left_anti")


def upsert(registry: DataFrame, changes: DataFrame, order: str = "since_ts") -> DataFrame:
    """New entries replace old ones for the same key; of several changes
    of a key the last one (by ``order``) counts."""
    others = [c for c in changes.columns if c != "instrument_key"]
    last = (changes.groupBy("instrument_key").agg(F.max_by(F.struct(*others), F.col(order)).alias("_c"))
            .select("instrument_key", "_c.*"))
    kept = registry.join(last.select("instrument_key"), "instrument_key", "left_anti")
    return kept.unionByName(last, allowMissingColumns=True)
