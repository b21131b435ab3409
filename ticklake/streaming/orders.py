"""Continuous order pipeline (T5): frames -> order records -> enriched
updates (append) and the last order per instrument (update mode).

A frame is one input row, so all orders of a frame arrive in the same
micro-batch: ``operators.orders.orders_by_frame`` applied to a
``foreachBatch`` batch gives exactly the per-frame lists the feed's order
callback received (S8)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import orders
from ..operators.decode import good


def order_stream(frames: DataFrame, master: DataFrame) -> DataFrame:
    """Stateless: split, decode, enrich with the (broadcast) master."""
    return orders.enrich_orders(good(orders.order_updates(frames)), master)


def latest_order_stream(frames: DataFrame) -> DataFrame:
    """A7 as a streaming aggregate (update mode): one row per touched instrument."""
    return orders.latest_orders(good(orders.order_updates(frames)))
