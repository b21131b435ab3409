"""Reference-data queries on the instrument master (P5-P11, A1-A3, L1-L4,
J1, J3).

Two forms of every query:

* the *call* form takes Python literals (one instrument, one exchange) and
  compiles to a single filter that Catalyst pushes into the Parquet scan;
* the *set* form takes a request DataFrame and answers all requests in one
  job with equi-joins — no driver loop, no per-request scan.

Prefix predicates ("symbol starts with ``INST-``") become equi-joins in the
set form by exploding each symbol into its ``-``-delimited prefixes (a
bounded fan-out: the number of dashes in a symbol).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.symbols import trading_symbol
from ..schemas import INSTRUMENT_COLUMNS, OPTION_CHAIN_COLUMNS


def _and(conds) -> Column:
    return reduce(lambda a, b: a & b, conds)


# ---------------------------------------------------------------------------
# predicates
# ---------------------------------------------------------------------------

def _contract_shape(kind: str) -> Column:
    sym, disp = F.col("trading_symbol"), F.col("display_name")
    if kind == "option":
        return (F.col("instrument_type").startswith("OPT")
                & (sym.endswith("-CE") | sym.endswith("-PE"))
                & (disp.endswith("CALL") | disp.endswith("PUT"))
                & F.col("option_type").isin("CE", "PE"))
    return (F.col("instrument_type").startswith("FUT") & sym.endswith("-FUT")
            & disp.endswith("FUT"))


def option_predicate(instrument: str, exchange: str) -> Column:
    """Option contracts of one underlying on one exchange."""
    return ((F.col("exchange") == exchange.upper())
            & F.col("trading_symbol").startswith(f"{instrument.upper()}-")
            & _contract_shape("option"))


def future_predicate(instrument: str, exchange: str) -> Column:
    """P10: futures contracts of one underlying on one exchange."""
    return ((F.col("exchange") == exchange.upper())
            & F.col("trading_symbol").startswith(f"{instrument.upper()}-")
            & _contract_shape("future"))


def _symbol_prefixes(master: DataFrame) -> DataFrame:
    """Each row once per ``-``-delimited prefix of its symbol (``prefix``)."""
    parts = F.split(F.col("trading_symbol"), "-")
    prefixes = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))),
                           lambda i: F.array_join(F.slice(parts, 1, i), "-"))
    return (master.where(F.size(parts) > 1)
            .withColumn("prefix", F.explode(prefixes)))


# ---------------------------------------------------------------------------
# instrument lookups
# ---------------------------------------------------------------------------

def instrument_lookup(master: DataFrame, instrument: str, exchange: str, instrument_type: str,
                      expiry_date: str | None = None, strike: float | None = None,
                      option_type: str | None = None) -> DataFrame | None:
    """P5: one instrument.  ``None`` when no instrument type is given (as the
    feed's helper does for no type flag)."""
    if len(instrument_type or "") < 5:
        return None
    sym = trading_symbol(F.lit(instrument), F.lit(exchange), F.lit(instrument_type),
                         F.lit(expiry_date).cast("date"),
                         F.lit(strike).cast("double") if strike is not None else None,
                         F.lit(option_type).cast("string") if option_type is not None else None)
    conds = [F.col("exchange") == exchange.upper(), F.col("trading_symbol") == sym,
             F.col("instrument_type") == instrument_type]
    if expiry_date is not None:
        conds.append(F.col("expiry_date_str") == expiry_date)
    if strike is not None:
        conds.append(F.col("strike_price") == float(strike))
    if option_type is not None:
        conds.append(F.col("option_type") == option_type)
    return master.where(_and(conds)).select(*INSTRUMENT_COLUMNS)


# kinds of values that a batch may restrict: request column, master column (bit i for the i-th)
RESTRICTIONS = (("expiry_date", "expiry_date_str"), ("strike", "strike_price"), ("option_type", "option_type"))
SALTS = 16  # copies of what a batch restricts, so that a batch with most hits is read in as many places


def _value_text(name: str) -> Column:
    """Text under which equal values are equal (-0.0 as 0.0)."""
    c = F.col(name)
    return (c.cast("double") + F.lit(0.0)).cast("string") if name in ("strike", "strike_price") else c.cast("string")


def _requested_values(req: DataFrame, batch_col: str) -> DataFrame:
    """(batch, kind, value, met, asked): a row per value of a batch with its kind's
    bit in ``met``, and under kind -1 the bits of all kinds that it restricts (``asked``)."""
    asked = reduce(lambda a, b: a.bitwiseOR(b), (
        F.when(F.col(c).isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, (c, _) in enumerate(RESTRICTIONS)))

    def row(kind, value, met, asked):
        return F.struct(F.lit(kind).alias("_kind"), value.alias("_value"), met.alias("_met"), asked.alias("_asked"))

    rows = F.array(*(row(i, _value_text(c), F.lit(1 << i), F.lit(0)) for i, (c, _) in enumerate(RESTRICTIONS)),
                   *(row(-1, F.lit(str(s)), F.lit(0), asked) for s in range(SALTS)))
    return (req.select(F.col(batch_col).alias("_batch"), F.inline(rows)).where(F.col("_value").isNotNull())
            .groupBy("_batch", "_kind", "_value").agg(F.bit_or("_met").alias("_met"), F.bit_or("_asked").alias("_asked")))


def instruments_lookup(master: DataFrame, requests: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """P6/P7/J3 set form.

    ``requests``: (batch_id, instrument, exchange, instrument_type,
    expiry_date, strike, option_type).  A batch is one call of the feed's
    batch lookup: a row of the master matches when its (exchange, type,
    symbol) equals a symbol built from one request of the batch, and —
    independently — its expiry / strike / option type is in the batch's set
    of requested values (each set applied only if the batch gave any value).

    Two joins: the symbols find the rows, then each row asks once per value it
    has, and once for the kinds its batch restricts, in one table of requested
    values; the bits met must hold all bits asked.  No step is keyed by the
    batch alone.  Rows that the master holds twice come twice; requests of a
    null batch are one batch.
    """
    req = requests.withColumn("_sym", trading_symbol(
        "instrument", "exchange", "instrument_type", F.col("expiry_date").cast("date"),
        "strike", "option_type"))
    syms = req.select(F.col(batch_col).alias("_batch"), F.upper("exchange").alias("_x"), F.col("instrument_type").alias("_t"),
                      "_sym").where(F.col("_sym").isNotNull()).distinct()
    hit = (master.join(syms, (master.exchange == syms._x) & (master.instrument_type == syms._t)
                       & (master.trading_symbol == syms._sym), "inner").select("_batch", *INSTRUMENT_COLUMNS))
    salt = F.pmod(F.xxhash64(*INSTRUMENT_COLUMNS), F.lit(SALTS)).cast("string")
    asks = F.array(*(F.struct(F.lit(i).alias("_kind"), _value_text(m).alias("_value")) for i, (_, m) in enumerate(RESTRICTIONS)),
                   F.struct(F.lit(-1).alias("_kind"), salt.alias("_value")))
    wanted = _requested_values(req, batch_col).withColumnsRenamed({"_batch": "_b", "_kind": "_k", "_value": "_v"})
    found = (hit.select("*", F.inline(asks)).where(F.col("_value").isNotNull())
             .join(wanted, F.col("_batch").eqNullSafe(F.col("_b")) & (F.col("_kind") == F.col("_k")) & (F.col("_value") == F.col("_v")), "left")
             .groupBy("_batch", *INSTRUMENT_COLUMNS)
             .agg(F.bit_or("_met").alias("_met"), F.bit_or("_asked").alias("_asked"),
                  F.count_if(F.col("_kind") == -1).cast("int").alias("_copies")))
    allowed = F.coalesce("_asked", F.lit(0)).bitwiseAND(F.bitwise_not(F.coalesce("_met", F.lit(0)))) == 0
    return (found.where(allowed).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
            .select(F.col("_batch").alias(batch_col), *INSTRUMENT_COLUMNS))


# ---------------------------------------------------------------------------
# expiries (A1-A3) and option chains (L4)
# ---------------------------------------------------------------------------

def _ordered_expiries(contracts: DataFrame, keys: list[str]) -> DataFrame:
    """A1: distinct (date text, expiry type), ordered by parsed date."""
    return (contracts.groupBy(*keys, "expiry_date_str", "expiry_type")
            .agg(F.min("expiry_date").alias("expiry_date")))


def expiry_dates(master: DataFrame, instrument: str, exchange: str, of_fut: bool = False) -> DataFrame:
    """A2: (expiry_date_str, expiry_type) ascending; past expiries stay."""
    pred = future_predicate(instrument, exchange) if of_fut else option_predicate(instrument, exchange)
    return (_ordered_expiries(master.where(pred), [])
            .orderBy("expiry_date", "expiry_type").select("expiry_date_str", "expiry_type"))


def _contracts_by_underlying(master: DataFrame, underlyings: DataFrame, kind: str) -> DataFrame:
    u = underlyings.select(F.upper("underlying").alias("_u"), F.upper("exchange").alias("_ux"),
                           "underlying").distinct()
    contracts = _symbol_prefixes(master.where(_contract_shape(kind)))
    return contracts.join(u, (contracts.prefix == u._u) & (contracts.exchange == u._ux), "inner")


def expiry_dates_all(master: DataFrame, underlyings: DataFrame, of_fut: bool = False) -> DataFrame:
    """A2 set form: expiries of every (underlying, exchange) in one job."""
    c = _contracts_by_underlying(master, underlyings, "future" if of_fut else "option")
    return (_ordered_expiries(c, ["underlying", "exchange"])
            .select("underlying", "exchange", "expiry_date_str", "expiry_type", "expiry_date"))


def nearest_expiry(master: DataFrame, underlyings: DataFrame, of_fut: bool = False) -> DataFrame:
    """A3: first listed expiry per (underlying, exchange)."""
    c = _contracts_by_underlying(master, underlyings, "future" if of_fut else "option")
    return c.groupBy("underlying", "exchange").agg(
        F.min_by("expiry_date_str", F.struct("expiry_date", "expiry_date_str")).alias("nearest_expiry"))


def option_chain(master: DataFrame, instrument: str, exchange: str,
                 expiry_date: str | None = None) -> DataFrame:
    """L4: the chain of the requested expiry if listed, else of the nearest.

    One plan: the options are filtered once; a one-row aggregate (listed?
    nearest?) is broadcast back.  No options -> empty frame (D5).
    """
    opts = master.where(option_predicate(instrument, exchange))
    req = F.lit(expiry_date).cast("string")
    choice = opts.agg(
        F.max(F.when(F.col("expiry_date_str") == req, F.lit(1))).alias("_listed"),
        F.min_by("expiry_date_str", F.struct("expiry_date", "expiry_date_str")).alias("_nearest"))
    choice = choice.select(F.when(F.col("_listed") == 1, req).otherwise(F.col("_nearest")).alias("_chosen"))
    return (opts.join(F.broadcast(choice), opts.expiry_date_str == choice._chosen, "left_semi")
            .select(*OPTION_CHAIN_COLUMNS)
            .orderBy("strike_price", "option_type", "security_id"))


def option_chains(master: DataFrame, requests: DataFrame) -> DataFrame:
    """L4 set form: ``requests(underlying, exchange, expiry_date)`` -> one
    chain per request, all in one job (partial aggregation per request, then
    an equi-join back on the chosen expiry)."""
    req = requests.select("underlying", F.upper("exchange").alias("exchange"),
                          F.col("expiry_date").alias("requested_expiry")).distinct()
    opts = _contracts_by_underlying(master, req.select("underlying", "exchange"), "option")
    # per (underlying, exchange): listed expiries and the nearest one
    listed = opts.select("underlying", "exchange", F.col("expiry_date_str").alias("requested_expiry")).distinct()
    nearest = opts.groupBy("underlying", "exchange").agg(
        F.min_by("expiry_date_str", F.struct("expiry_date", "expiry_date_str")).alias("nearest"))
    chosen = (req.join(nearest, ["underlying", "exchange"], "inner")
              .join(listed.withColumn("_is_listed", F.lit(True)),
                    ["underlying", "exchange", "requested_expiry"], "left")
              .select("underlying", "exchange", "requested_expiry",
                      F.when(F.col("_is_listed"), F.col("requested_expiry"))
                      .otherwise(F.col("nearest")).alias("chosen_expiry")))
    chosen = chosen.select(F.col("underlying").alias("_cu"), F.col("exchange").alias("_cx"),
                           "requested_expiry", "chosen_expiry")
    out = opts.join(chosen, (opts.underlying == chosen._cu) & (opts.exchange == chosen._cx)
                    & (opts.expiry_date_str == chosen.chosen_expiry), "inner")
    return out.select("underlying", "requested_expiry", *OPTION_CHAIN_COLUMNS)


# ---------------------------------------------------------------------------
# key resolution
# ---------------------------------------------------------------------------

def resolve_keys(master: DataFrame, keys: DataFrame | list[str] | list[dict], key_col: str = "instrument_key") -> DataFrame:
    """Distinct keys -> master rows + zeroed tick state and an order record
    that is null until an order comes.  Unknown keys drop out (as the feed's
    filter does).

    ``keys``: a table with the key column, a list of keys, a list of records
    with an ``instrument_key`` (a list takes the form of its first entry, others
    are ignored), or a table of whole instrument rows, which pass through
    without a look-up."""
    from .orders import order_record_type
    from .ticks import default_state_struct
    if isinstance(keys, list):
        kind = type(keys[0]) if keys else str
        named = [k["instrument_key"] if kind is dict else k for k in keys if isinstance(k, kind)]
        keys = master.sparkSession.createDataFrame([(k,) for k in named], "instrument_key string")
        key_col = "instrument_key"
    if set(INSTRUMENT_COLUMNS) <= set(keys.columns):
        found = keys
    else:
        k = keys.select(F.col(key_col).alias("instrument_key")).distinct()
        found = master.join(k, "instrument_key", "left_semi")
    return (found.withColumn("price_updates", default_state_struct())
            .withColumn("order_updates", F.lit(None).cast(order_record_type())))


def requests_from_lists(spark, instruments: list[str], exchange: str, instrument_type: str,
                        expiry_dates: list[str] | None = None, strikes: list[float] | None = None,
                        option_types: list[str] | None = None, batch_id: int = 0) -> DataFrame:
    """J3 call form: positional request lists -> a request DataFrame for
    ``instruments_lookup``.  Lists given must all have the instruments'
    length (D3: the feed's chained check almost never fired)."""
    n = len(instruments)
    for name, values in (("expiry_dates", expiry_dates), ("strikes", strikes), ("option_types", option_types)):
        if values is not None and len(values) != n:
            raise ValueError(f"`{name}` must have one entry per instrument ({len(values)} != {n})")
    rows = [(batch_id, inst, exchange.upper(), instrument_type,
             expiry_dates[i] if expiry_dates is not None else None,
             float(strikes[i]) if strikes is not None else None,
             option_types[i] if option_types is not None else None) for i, inst in enumerate(instruments)]
    schema = ("batch_id long, instrument string, exchange string, instrument_type string, "
              "expiry_date string, strike double, option_type string")
    return spark.createDataFrame(rows, schema)
