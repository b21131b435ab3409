"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import OI_SENTINEL


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _scale(dp: Column) -> Column:
    return F.when(dp == 4, F.lit(10000.0)).otherwise(F.lit(100.0))


def _tie(v: Column, scale: Column) -> Column:
    """The whole number of ``v * scale`` for a product that ends in exactly one half.

    The exact product is ``p + e``: v is split into two halves of at most 26
    bits whose products with the scale are exact, and the sign of e tells on
    which side of the half the exact value lies; a true tie goes to the even
    number."""
    p = v * scale
    big = v * F.lit(134217729.0)  # 2**27 + 1
    high = big - (big - v)
    e = (high * scale - p) + (v - high) * scale
    return F.when(e > 0, F.ceil(p).cast("double")).when(e < 0, F.floor(p).cast("double")).otherwise(F.rint(p))


def round_dp(x, dp) -> Column:
    """Half-even rounding of the exact binary value to the instrument's 2 or 4
    decimals (``bround`` works on the printed decimal, so 1.005 would count as
    a tie).

    ``rint`` of the product decides except where the product, itself rounded,
    ends in one half (rounding to double never crosses a half): only then
    ``_tie`` looks at the product's error.  From 2**52 units on the product has
    no fraction left.  The input is repeated: pass a column, not a long
    expression, in plans that must stay in generated code."""
    x, dp = _c(x).cast("double"), _c(dp)
    scale = _scale(dp)
    p = x * scale
    whole = F.rint(p)
    return (F.when(F.abs(p) >= F.lit(2.0 ** 52), F.when(dp == 4, F.bround(x, 4)).otherwise(F.bround(x, 2)))
            .otherwise(F.when(F.abs(p - whole) == F.lit(0.5), _tie(x, scale)).otherwise(whole) / scale) + F.lit(0.0))


def round_f32(x, dp) -> Column:
    """``round_dp`` of a value that fits 32-bit float: its product with the
    scale has at most 38 bits, so it is exact and ``rint`` alone is right."""
    scale = _scale(_c(dp))
    return F.rint(_c(x).cast("double") * scale) / scale + F.lit(0.0)


def _bound(x: Column, body) -> Column:
    """``body`` of x, bound to a lambda variable so that x is not repeated."""
    return F.get(F.transform(F.array(x), body), F.lit(0))


def _percent(change: Column, base: Column, dp) -> Column:
    """Rounded percentage of an already rounded change."""
    return _bound(F.lit(100.0) * (change / base), lambda v: round_dp(v, dp))


def with_change(df: DataFrame, current: str, prev: str, dp: str, change: str, percent: str, whole: bool = False) -> DataFrame:
    """F15 / F16 as columns of ``df``, staged so that each step reads a plain
    column and the whole stays in generated code; ``whole`` truncates both
    values (open interest).  0 where the previous value is not positive."""
    cur, prv = F.col(current).cast("double"), F.col(prev).cast("double")
    out = df.withColumn("_raw", cur - prv)
    out = out.withColumn("_change", round_dp("_raw", dp))
    out = out.withColumn("_raw", F.lit(100.0) * (F.col("_change") / F.nullif(prv, F.lit(0.0))))
    out = out.withColumn("_percent", round_dp("_raw", dp))
    zero, kind = (F.lit(0).cast("long"), "long") if whole else (F.lit(0.0), "double")
    return out.withColumns({change: F.when(prv <= 0, zero).otherwise(F.col("_change").cast(kind)),
                            percent: F.when(prv <= 0, zero).otherwise(F.col("_percent").cast(kind))}).drop("_raw", "_change", "_percent")


def price_change(current, prev, dp) -> tuple[Column, Column]:
    """(change, percent) for float inputs: 0 when prev <= 0, else the rounded
    difference and the rounded percentage of the *rounded* change."""
    cur, prv = _c(current), _c(prev)
    chg = _bound(cur - prv, lambda v: round_dp(v, dp))
    pct = _percent(chg, prv, dp)
    return (F.when(prv <= 0, F.lit(0.0)).otherwise(chg),
            F.when(prv <= 0, F.lit(0.0)).otherwise(pct))


def oi_change(current, prev, dp) -> tuple[Column, Column]:
    """Integer branch for open interest: same formula, then both values
    truncated toward zero."""
    cur, prv = _c(current).cast("double"), _c(prev).cast("double")
    chg = _bound(cur - prv, lambda v: round_dp(v, dp))
    pct = _percent(chg, prv, dp)
    return (F.when(prv <= 0, F.lit(0)).otherwise(chg.cast("long")),
            F.when(prv <= 0, F.lit(0)).otherwise(pct.cast("long")))


def book_shares(total_bid, total_ask, dp) -> tuple[Column, Column, Column]:
    """(total, bid %, ask %), shares 0 when the total is 0."""
    tb, ta = _c(total_bid), _c(total_ask)
    tot = tb + ta
    bid = F.when(tot == 0, F.lit(0.0)).otherwise(_bound(tb / tot * 100, lambda v: round_dp(v, dp)))
    ask = F.when(tot == 0, F.lit(0.0)).otherwise(_bound(ta / tot * 100, lambda v: round_dp(v, dp)))
    return tot, bid, ask


def with_book_shares(df: DataFrame, total_bid: str, total_ask: str, dp: str, total: str, bid: str, ask: str) -> DataFrame:
    """F17 as columns of ``df``, staged like ``with_change``."""
    tb, ta = F.col(total_bid), F.col(total_ask)
    out = df.withColumn(total, tb + ta)
    out = out.withColumns({c: x / F.nullif(F.col(total), F.lit(0)) * 100 for c, x in (("_bid_share", tb), ("_ask_share", ta))})
    shares = {bid: "_bid_share", ask: "_ask_share"}
    return out.withColumns({c: F.when(F.col(total) == 0, F.lit(0.0)).otherwise(round_dp(raw, dp)) for c, raw in shares.items()}
                           ).drop(*shares.values())


def oi_sentinel(oi) -> Column:
    return F.when(_c(oi) == OI_SENTINEL, F.lit(0).cast("long")).otherwise(_c(oi))


def lots(quantity, lot_size) -> Column:
    """Floor division by the lot size; 0/null lot treated as 1."""
    lot = F.coalesce(F.nullif(_c(lot_size), F.lit(0)), F.lit(1))
    return F.floor(_c(quantity) / lot).cast("long")


def tick_scale(tick_size) -> Column:
    return _c(tick_size) / 100


def sorted_count(array, value) -> Column:
    """How many elements of an ascending array are at most ``value``, by binary
    search; null for a null array."""
    a, v = _c(array), _c(value)
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(a) + 1)).cast("int"))

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        below = F.get(a, middle) <= v
        return (F.when(s["lo"] >= s["hi"], s)
                .when(below, F.struct((middle + 1).alias("lo"), s["hi"].alias("hi")))
                .otherwise(F.struct(s["lo"].alias("lo"), middle.alias("hi"))))

    return F.when(a.isNotNull(), F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.size(a).alias("hi")), halve, lambda s: s["lo"]))
