"""Tick state over decoded packets.

Input: the wide decoded rows of ``operators.decode`` (one per good packet,
each state column non-null only where the packet writes it), ordered by
``ord = (recv_ts, frame_id, packet_seq)`` - unique, so "last" is exact.

A control log restarts state: a row with an instrument key resets that
instrument (re-subscription), a row without a key resets all of them
(reconnect).  Rows of one field group (``GROUPS``) are always written together,
so state is kept and carried by group.

* ``latest_state`` (A4, conflated): per key, the last value of every column and
  the order of each group's last write; a later reset wins over the write.
  Everything is associative and fixed-width: partial hash aggregation on the
  map side, one small partial row per task for a hot instrument.
* ``tick_snapshots`` (W1 + W3 + T7, one row per packet): the state right after
  each packet, in one wide shuffle.  Keys with many packets are cut in time at
  equal numbers of rows (``balanced_cuts``); what a bucket starts from is an
  exclusive scan of per-bucket aggregates, fed in as the bucket's first row.
* Reconnects are looked up as of each row (``with_reconnects``) and never
  expanded to all keys: a write carries their number, and a value written under
  an earlier one is no longer there.
* Change / percent-change columns are pure functions of the current state
  (T4) and are computed after the scan, never stored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import sorted_count, with_change
from ..schemas import TICK_FIELDS, WIRE_EPOCH

STATE_COLS = [name for name, _, _ in TICK_FIELDS]
TYPES = {name: t for name, t, _ in TICK_FIELDS}
DEFAULTS = {name: d for name, _, d in TICK_FIELDS}
# time fields are kept as TIMESTAMP_NTZ; their "empty" default is null
TIME_COLS = ["last_trade_time", "last_updated_time"]
ORD = ["recv_ts", "frame_id", "packet_seq"]


def _default(name: str) -> Column:
    if name in TIME_COLS:
        return F.lit(None).cast("timestamp_ntz")
    return F.lit(DEFAULTS[name]).cast(TYPES[name])


def default_state_struct() -> Column:
    """Zeroed tick state as one struct (J1's attached record)."""
    return F.struct(*[_default(c).alias(c) for c in STATE_COLS],
                    F.lit(None).cast("array<struct<quantity:bigint,price:double,orders:int>>").alias("depth_buy"),
                    F.lit(None).cast("array<struct<quantity:bigint,price:double,orders:int>>").alias("depth_sell"))


def derived_columns(df: DataFrame) -> DataFrame:
    """T4: change and open-interest change from the current state."""
    out = with_change(df, "ltp", "prev_close", "decimals", "change", "change_prcnt")
    return with_change(out, "open_interest", "prev_open_interest", "decimals",
                       "open_interest_chg", "open_interest_chg_prcnt", whole=True)


# ---------------------------------------------------------------------------
# A4 / A5
# ---------------------------------------------------------------------------

# Fixed-width aggregation (A4/T3).  ``max_by`` over struct or string values
# or orderings forces a sort-based aggregate (every map partition sorted);
# with every buffer fixed-width Spark uses a hash aggregate instead:
#   * arrival order packed into one DECIMAL(38,0):
#       ((recv_ts µs since the wire epoch) * 2^56 + frame_id) * 2^16 + packet_seq
#     (frame ids below 2^56, at most 65,536 packets per frame; the decoders
#     quarantine packets outside, see ``decode.order_error``);
#   * time fields as µs since the wire epoch (BIGINT);
#   * the depth book as 30 scalar level fields, rebuilt after aggregating.
_EPOCH_NTZ = f"timestamp_ntz'{WIRE_EPOCH}'"
_LEVEL_FIELDS = [("quantity", "long"), ("price", "double"), ("orders", "int")]


def arrival_order() -> Column:
    """``(recv_ts, frame_id, packet_seq)`` as one number."""
    us = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), F.col("recv_ts")).cast("decimal(20,0)")
    frame = F.lit(str(2 ** 72)).cast("decimal(22,0)")
    return ((us * frame).cast("decimal(38,0)") + F.col("frame_id").cast("decimal(20,0)") * F.lit(2 ** 16).cast("decimal(6,0)")
            + F.col("packet_seq").cast("decimal(10,0)")).cast("decimal(38,0)")


def arrival_bounds() -> Column:
    """Times that ``arrival_order`` can hold with room to spare."""
    return F.col("recv_ts").between(F.expr("timestamp_ntz'1900-01-01'"), F.expr("timestamp_ntz'2500-01-01'"))


DEPTH_SCALARS = [f"_d_{side}{i}_{f}" for side in ("buy", "sell") for i in range(5) for f, _ in _LEVEL_FIELDS]
#: Fields that the same packets write, so that one write order and one carried value stand for all of them.
GROUPS = {
    "trade": ["last_traded_qty", "volume", "average_price", "last_updated_time"],
    "last": ["ltp", "last_trade_time"],
    "interest": ["open_interest"],
    "range": ["open", "high", "low"],
    "close": ["close"],
    "prev": ["prev_close"],
    "prev_interest": ["prev_open_interest"],
    "book": ["best_ask_price", "best_ask_qty", "best_bid_price", "best_bid_qty", "total_ask_qty", "total_bid_qty",
             "total_bid_ask_qty", "total_bid_qty_prcnt", "total_ask_qty_prcnt"],
    "circuit": ["lower_circuit", "upper_circuit"],
    "week52": ["week52_high", "week52_low"],
    "depth": DEPTH_SCALARS,
}
FLAT = [c for fields in GROUPS.values() for c in fields]
_KIND = {**{c: TYPES[c].simpleString() for c in STATE_COLS}, **dict.fromkeys(TIME_COLS, "bigint"),
         **{c: "bigint" if c.endswith("quantity") else "double" if c.endswith("price") else "int" for c in DEPTH_SCALARS}}


def _flat_default(c: str) -> Column:
    """What a field holds after a reset; null is the empty time or depth."""
    return F.lit(None if c in TIME_COLS or c in DEPTH_SCALARS else DEFAULTS[c]).cast(_KIND[c])


def flat_rows(good: DataFrame) -> DataFrame:
    """Decoded rows with fixed-width columns only: times as µs since the wire
    epoch, the depth book as 30 level fields, ``is_reset`` 0."""
    values = {c: F.col(c).cast(_KIND[c]) for c in STATE_COLS if c not in TIME_COLS}
    values |= {c: F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), F.col(c).cast("timestamp_ntz")) for c in TIME_COLS}
    values |= {f"_d_{side}{i}_{f}": F.col(f"depth_{side}")[i][f].cast(_KIND[f"_d_{side}{i}_{f}"])
               for side in ("buy", "sell") for i in range(5) for f, _ in _LEVEL_FIELDS}
    return good.select(F.coalesce("instrument_key", F.lit("")).alias("instrument_key"), F.col("decimals").cast("int").alias("decimals"),
                       *ORD, F.col("packet_type").cast("int").alias("packet_type"), F.lit(0).alias("is_reset"),
                       *(values[c].alias(c) for c in FLAT))


def reset_rows(control: DataFrame) -> DataFrame:
    """Control rows ``(ts, instrument_key)`` in the columns of ``flat_rows``,
    placed before all packets of their time; rows without a usable time are
    left out.  A null key stands for all instruments."""
    none = F.lit(None).cast("int")
    rows = control.select("instrument_key", none.alias("decimals"), F.col("ts").cast("timestamp_ntz").alias("recv_ts"),
                          F.lit(-1).cast("long").alias("frame_id"), F.lit(-1).alias("packet_seq"), none.alias("packet_type"),
                          F.lit(1).alias("is_reset"), *(F.lit(None).cast(_KIND[c]).alias(c) for c in FLAT))
    return rows.where(F.coalesce(arrival_bounds(), F.lit(False)))


def _any(fields: list[str]) -> Column:
    return reduce(Column.__or__, [F.col(c).isNotNull() for c in fields])


def _aggregates() -> list[Column]:
    """Last value of every field, order of each group's last write, last reset and number of resets."""
    order = F.col("_ord")

    def last(c: str) -> Column:
        there = F.col(c).isNotNull()
        return F.max_by(F.when(there, F.col(c)), F.when(there, order)).alias(c)

    return [F.max("decimals").alias("decimals"),
            F.max(F.when(F.col("is_reset") == 0, F.col("recv_ts"))).alias("last_recv_ts"),
            F.sum(1 - F.col("is_reset")).cast("long").alias("packets"),
            F.sum("is_reset").cast("long").alias("resets"), F.max(F.when(F.col("is_reset") == 1, order)).alias("_reset"),
            *(F.max(F.when(_any(fields), order)).alias(f"_at_{g}") for g, fields in GROUPS.items()),
            *(last(c) for c in FLAT)]


def latest_aggregate(good: DataFrame, control: DataFrame | None = None) -> DataFrame:
    """The hash-aggregatable core of A4/T3 (batch and streaming): one row per
    key; with a control log also one with a null key for the reconnects."""
    rows = flat_rows(good)
    if control is not None:
        rows = rows.unionByName(reset_rows(control))
    return rows.withColumn("_ord", arrival_order()).groupBy("instrument_key").agg(*_aggregates())


def _shown(value) -> list[Column]:
    """State columns and depth arrays from flat ones: ``value(c)`` gives the column of field c, null where it is empty."""
    def depth(side: str) -> Column:
        levels = [F.struct(*[value(f"_d_{side}{i}_{f}").cast(t).alias(f) for f, t in _LEVEL_FIELDS]) for i in range(5)]
        return F.when(value(f"_d_{side}0_quantity").isNotNull(), F.array(*levels))

    return [*(F.timestamp_add("MICROSECOND", value(c), F.expr(_EPOCH_NTZ)).alias(c) if c in TIME_COLS
              else F.coalesce(value(c), _flat_default(c)).alias(c) for c in STATE_COLS),
            depth("buy").alias("depth_buy"), depth("sell").alias("depth_sell")]


def finish_latest(agg: DataFrame, resets: bool = False) -> DataFrame:
    """Later of write and reset, defaults, times, depth arrays and derived
    columns after aggregating.  ``resets`` adds the number of resets as
    ``epoch`` and shows keys that have not ticked yet."""
    keyed = agg.where(F.col("instrument_key").isNotNull())
    if resets:
        # one row by construction: the aggregate of the rows with a null key
        shared = agg.where(F.col("instrument_key").isNull()).agg(F.max("_reset").alias("at"), F.coalesce(F.sum("resets"), F.lit(0)).alias("n"))
        keyed = keyed.withColumns({"_reset": F.greatest(F.col("_reset"), shared.select("at").scalar()),
                                   "epoch": F.col("resets") + shared.select("n").scalar()})
    group_of = {c: g for g, fields in GROUPS.items() for c in fields}

    def value(c: str) -> Column:
        return F.when(F.col("_reset").isNull() | (F.col(f"_at_{group_of[c]}") > F.col("_reset")), F.col(c))

    return derived_columns(keyed.select("instrument_key", "decimals", "packets", "last_recv_ts", *(["epoch"] if resets else []),
                                        *_shown(value)))


def latest_state(good: DataFrame, control: DataFrame | None = None) -> DataFrame:
    """A4: one row per instrument with its conflated state (T3 batch twin);
    with a control log also ``epoch``, the state being that after the last
    packet or reset, whichever came later."""
    return finish_latest(latest_aggregate(good, control), control is not None)


def market_status(decoded_good: DataFrame) -> DataFrame:
    """A5: the global market status = the last type-29 packet (one row)."""
    st = decoded_good.where(F.col("status_msg").isNotNull())
    return st.agg(F.max_by(F.struct("status_msg", "status_value", "market_status"), F.struct(*ORD)).alias("s"),
                  F.count(F.lit(1)).alias("status_packets")).select(
        F.col("s.status_msg").alias("msg"), F.col("s.status_value").alias("value"),
        F.col("s.market_status").alias("market_status"), "status_packets")


# ---------------------------------------------------------------------------
# W1 / W3 / T7
# ---------------------------------------------------------------------------

DEFAULT_COARSE_SECONDS = 3600
DEFAULT_ROWS_PER_BUCKET = 50_000
#: All cuts together; more rows make larger buckets, so that the table of cuts stays small enough to broadcast.
MAX_CUTS = 200_000


def _secs() -> Column:
    return F.timestamp_diff("SECOND", F.expr(_EPOCH_NTZ), F.col("recv_ts"))


def with_reconnects(rows: DataFrame, control: DataFrame | None) -> DataFrame:
    """``rows`` with ``_global``: the number of reconnects (control rows without
    a key) up to their time.  An as-of lookup: reconnect times lie sorted in an
    array per hour, with the number before it; quiet hours between carry the
    count alone."""
    if control is None:
        return rows.withColumn("_global", F.lit(0).cast("long"))
    times = reset_rows(control.where(F.col("instrument_key").isNull())).select(
        F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), F.col("recv_ts")).alias("us"))
    hour_us = 3_600_000_000
    hours = (times.groupBy(F.floor(F.col("us") / hour_us).alias("_hour")).agg(F.sort_array(F.collect_list("us")).alias("_times")))
    by_hour = Window.orderBy("_hour")  # one row per hour with a reconnect
    hours = hours.withColumns({
        "_before": F.coalesce(F.sum(F.size("_times")).over(by_hour.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_until": F.coalesce(F.lead("_hour").over(by_hour) - 1, F.col("_hour"))})
    hours = hours.select(F.explode(F.sequence("_hour", "_until")).alias("_at_hour"), "_hour", "_times", "_before").select(
        "_at_hour", F.when(F.col("_at_hour") == F.col("_hour"), F.col("_times")).alias("_times"),
        (F.col("_before") + F.when(F.col("_at_hour") == F.col("_hour"), 0).otherwise(F.size("_times"))).alias("_before"))
    ends = times.agg(F.floor(F.max("us") / hour_us).alias("last"), F.count("us").alias("n"))
    us = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), F.col("recv_ts"))
    out = rows.withColumn("_own_hour", F.floor(us / hour_us)).join(hours, F.col("_own_hour") == F.col("_at_hour"), "left")
    inside = F.col("_before") + F.when(F.col("_times").isNull(), 0).otherwise(sorted_count("_times", us))
    after = F.when(F.col("_own_hour") > ends.select("last").scalar(), ends.select("n").scalar())
    return out.withColumn("_global", F.coalesce(inside, after, F.lit(0)).cast("long")).drop("_own_hour", "_at_hour", "_times", "_before")


def balanced_cuts(times: DataFrame, rows_per_bucket: int, coarse_seconds: int = DEFAULT_COARSE_SECONDS,
                  materialize: bool = True) -> DataFrame:
    """``(instrument_key, _starts)`` for keys of more than ``rows_per_bucket``
    rows: sorted first seconds of buckets that hold about as many rows each.

    ``times``: (instrument_key, _s).  Rows are counted per key and hour; hours
    with more than a quarter bucket again per second.  Cumulative counts (hours
    of a key, then seconds of an hour) number the buckets, so neither bursts nor
    long gaps change their size.  A bucket exceeds its target by a quarter, or by
    a single second's rows, at most."""
    from ..session import cut_lineage
    keep = cut_lineage if materialize else (lambda df: df)
    coarse = F.floor(F.col("_s") / coarse_seconds).cast("long")
    hours = keep(times.groupBy("instrument_key", coarse.alias("_h")).agg(F.count(F.lit(1)).alias("_n")))
    target = F.greatest(F.lit(rows_per_bucket), F.ceil(hours.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).scalar() / MAX_CUTS))
    key = Window.partitionBy("instrument_key")
    hours = (hours.withColumn("_all", F.sum("_n").over(key)).withColumn("_target", target)
             .where(F.col("_all") > F.col("_target"))
             .withColumn("_before", F.coalesce(F.sum("_n").over(key.orderBy("_h").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    hours = keep(hours)
    busy = F.col("_n") > F.col("_target") / 4
    seconds = (times.withColumn("_h", coarse).join(hours.where(busy).select("instrument_key", "_h", "_before", "_target"), ["instrument_key", "_h"])
               .groupBy("instrument_key", "_h", "_s", "_before", "_target").agg(F.count(F.lit(1)).alias("_n")))
    hour = Window.partitionBy("instrument_key", "_h").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    seconds = seconds.withColumn("_before", F.col("_before") + F.coalesce(F.sum("_n").over(hour), F.lit(0)))
    quiet = hours.where(~busy).withColumn("_s", F.col("_h") * coarse_seconds)
    columns = ["instrument_key", "_s", "_before", "_target"]
    number = F.floor(F.col("_before") / F.col("_target"))
    return (quiet.select(*columns).unionAll(seconds.select(*columns))
            .groupBy("instrument_key", number.alias("_number")).agg(F.min("_s").alias("_s"))
            .groupBy("instrument_key").agg(F.sort_array(F.collect_list("_s")).alias("_starts")))


def _written(reset: Column, value, global_: Column) -> list[Column]:
    """A struct per group, null where the row (or bucket) leaves the group alone: the reconnects seen, and its values."""
    return [F.when(reset, F.struct(global_.alias("_e"), *(_flat_default(c).alias(c) for c in fields)))
            .when(value(g), F.struct(global_.alias("_e"), *fields)).alias(f"_g_{g}") for g, fields in GROUPS.items()]


_CARRIED = [f"_g_{g}" for g in GROUPS]


def _summary(rows: DataFrame) -> DataFrame:
    """What the rows of each (key, bucket) leave behind: resets, and the last write or reset of every group."""
    seen = [F.max(F.when(_any(fields), F.col("_global"))).alias(f"_e_{g}") for g, fields in GROUPS.items()]
    last = F.max(F.when(F.col("is_reset") == 1, F.col("_global"))).alias("_e_reset")
    found = rows.withColumn("_ord", arrival_order()).groupBy("instrument_key", "bucket").agg(*_aggregates(), *seen, last)
    state = []
    for g, fields in GROUPS.items():
        at, reset = F.col(f"_at_{g}"), F.col("_reset")
        state.append(F.when(at.isNotNull() & (reset.isNull() | (at > reset)), F.struct(F.col(f"_e_{g}").alias("_e"), *fields))
                     .when(reset.isNotNull(), F.struct(F.col("_e_reset").alias("_e"), *(_flat_default(c).alias(c) for c in fields)))
                     .alias(f"_g_{g}"))
    return found.select("instrument_key", "bucket", F.col("resets").alias("is_reset"), *state)


def _bucket_starts(rows: DataFrame, seeds: DataFrame | None) -> DataFrame:
    """What each bucket starts from, as its first row: an exclusive scan over
    the summaries of the key's buckets (one row each)."""
    summary = _summary(rows)
    if seeds is not None:
        summary = summary.unionByName(seeds)
    before = Window.partitionBy("instrument_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return (summary.select("instrument_key", "bucket", F.coalesce(F.sum("is_reset").over(before), F.lit(0)).alias("is_reset"),
                           *(F.last(c, ignorenulls=True).over(before).alias(c) for c in _CARRIED))
            .where(F.col("bucket") > 0))


def _packets_and_resets(good: DataFrame, control: DataFrame | None, reconnects: int) -> DataFrame:
    rows = flat_rows(good)
    if control is not None:
        rows = rows.unionByName(reset_rows(control.where(F.col("instrument_key").isNotNull())))
    return with_reconnects(rows, control).withColumn("_global", F.col("_global") + F.lit(reconnects).cast("long"))


def tick_snapshots(good: DataFrame, control: DataFrame | None = None,
                   fine_seconds: int | None = None, coarse_seconds: int = DEFAULT_COARSE_SECONDS,
                   rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET, materialize: bool = True,
                   seeds: DataFrame | None = None, reconnects: int = 0) -> DataFrame:
    """W1 (+W3 and T7 when ``control`` is given): one row per packet with the
    full state after it, ``epoch`` = resets seen so far (the key's own and
    reconnects).

    The packets are shuffled once, by (key, bucket), together with one row per
    bucket that holds what it starts from; a window pass inside the bucket then
    gives the running state.  Buckets come from ``balanced_cuts`` (only keys of
    more than ``rows_per_bucket`` rows have several), or have ``fine_seconds``
    each.  Their aggregates are a second, narrow pass over the packets of keys
    with cuts.  ``seeds`` (see ``state_seeds``) and ``reconnects`` continue an
    earlier state."""
    if fine_seconds is not None and coarse_seconds % fine_seconds:
        raise ValueError("coarse_seconds must be a multiple of fine_seconds")
    rows = _packets_and_resets(good, control, reconnects).withColumn("_s", F.coalesce(_secs(), F.lit(0).cast("long")))
    if fine_seconds is None:
        from ..session import cut_lineage
        cuts = balanced_cuts(rows.select("instrument_key", "_s"), rows_per_bucket, coarse_seconds, materialize)
        # at most MAX_CUTS starts (twice as many where seconds are cut): bounded, whatever the packets
        cuts = cut_lineage(cuts) if materialize else cuts
        several = not (materialize and cuts.isEmpty())
        cuts = F.broadcast(cuts)
        rows = rows.join(cuts, "instrument_key", "left").withColumn("bucket", F.coalesce(sorted_count("_starts", F.col("_s")), F.lit(0)).cast("long"))
        if seeds is not None:
            seeds = seeds.join(cuts, "instrument_key", "left").withColumn("_cut", F.col("_starts").isNotNull()).drop("_starts")
    else:
        # buckets of a fixed time: from 1 on, 0 is the earlier state's place
        several = True
        rows = rows.withColumn("bucket", F.floor(F.col("_s") / fine_seconds).cast("long") + F.lit(2**40))
        if seeds is not None:
            seeds = seeds.withColumn("_cut", F.lit(True))
    parts = []
    if several:
        far = seeds.where("_cut").drop("_cut") if seeds is not None else None
        parts.append(_bucket_starts(rows.where(F.col("bucket") > 0), far))
    if seeds is not None:
        parts.append(seeds.where(~F.col("_cut")).drop("_cut"))
    wide = rows.select("instrument_key", "bucket", "decimals", *ORD, "packet_type", F.col("is_reset").cast("long").alias("is_reset"), "_global",
                       *_written(F.col("is_reset") == 1, lambda g: _any(GROUPS[g]), F.col("_global")))
    for starts in parts:
        missing = [c for c in wide.columns if c not in starts.columns]
        wide = wide.unionByName(starts.select("*", *(F.lit(None).cast(wide.schema[c].dataType).alias(c) for c in missing)))
    order = [F.col("packet_seq").isNotNull(), *ORD]
    upto = Window.partitionBy("instrument_key", "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    run = wide.select("instrument_key", "decimals", *ORD, "packet_type", "_global", F.sum("is_reset").over(upto).alias("_resets"),
                      *(F.last(c, ignorenulls=True).over(upto).alias(c) for c in _CARRIED))
    group_of = {c: g for g, fields in GROUPS.items() for c in fields}

    def value(c: str) -> Column:
        g = F.col(f"_g_{group_of[c]}")
        return F.when(g["_e"] == F.col("_global"), g[c])

    snap = run.where(F.col("packet_type").isNotNull()).select(
        "instrument_key", "decimals", *ORD, "packet_type", (F.col("_resets") + F.col("_global")).alias("epoch"), *_shown(value))
    return derived_columns(snap)


def state_seeds(good: DataFrame, control: DataFrame | None = None, earlier: DataFrame | None = None, reconnects: int = 0) -> DataFrame:
    """The state of every key after ``good`` and ``control``, over ``earlier``:
    the ``seeds`` of the next call of ``tick_snapshots``.  One row per key
    (bucket 0): its resets so far, and each group's last write with the number
    of reconnects it saw.  ``reconnects`` counts those before these rows."""
    found = _summary(_packets_and_resets(good, control, reconnects).withColumn("bucket", F.lit(1).cast("long")))
    if earlier is not None:
        found = found.unionByName(earlier)
    return found.groupBy("instrument_key").agg(
        F.sum("is_reset").alias("is_reset"),
        *(F.max_by(c, F.when(F.col(c).isNotNull(), F.col("bucket"))).alias(c) for c in _CARRIED)).select(
        "instrument_key", F.lit(0).cast("long").alias("bucket"), "is_reset", *_CARRIED)
