"""Demand, supply and their balance per zone (table ``demand_supply_health``).

Distinct ids are counted by de-duplicating (window, zone, id) and then counting: two aggregations
with map-side combine, so a zone that holds a third of all events is still spread over the ids.
The same definition runs on a stream, where the de-duplication state is spread the same way and
expires with the watermark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonepulse.config import DEFAULTS, MetricConfig
from zonepulse.functions.expressions import approx_distinct, health_ratio, health_status
from zonepulse.functions.windows import EVENT_TIME, ensure_watermark, flatten_window, tumbling
from zonepulse.model import PENDING_STATES


def _pending(orders: DataFrame, cfg: MetricConfig) -> DataFrame:
    return ensure_watermark(orders, cfg.orders_watermark).filter(
        F.col("status").isin(*PENDING_STATES))


def _idle(couriers: DataFrame, cfg: MetricConfig) -> DataFrame:
    return ensure_watermark(couriers, cfg.couriers_watermark).filter(
        F.col("status") == "ONLINE_IDLE")


def _count(events: DataFrame, size: int, counted: Column) -> DataFrame:
    return flatten_window(events.groupBy(tumbling(size), "zone_id").agg(counted))


def _distinct(events: DataFrame, size: int, id_column: str, name: str) -> DataFrame:
    ids = events.select(tumbling(size), "zone_id", id_column).filter(F.col(id_column).isNotNull())
    return flatten_window(
        ids.dropDuplicates(["window", "zone_id", id_column])
        .groupBy("window", "zone_id").agg(F.count(F.lit(1)).alias(name))
    )


def demand_windows(orders: DataFrame, cfg: MetricConfig = DEFAULTS,
                   size: int | None = None) -> DataFrame:
    """Distinct orders with a pending state per window and zone."""
    return _distinct(_pending(orders, cfg), size or cfg.health_minutes, "order_id",
                     "pending_demand")


def supply_windows(couriers: DataFrame, cfg: MetricConfig = DEFAULTS,
                   size: int | None = None) -> DataFrame:
    """Distinct idle couriers per window and zone."""
    return _distinct(_idle(couriers, cfg), size or cfg.health_minutes, "courier_id",
                     "available_supply")


def demand_windows_approx(orders: DataFrame, cfg: MetricConfig = DEFAULTS) -> DataFrame:
    """Demand from a HyperLogLog sketch: one shuffle, constant state per window and zone."""
    return _count(_pending(orders, cfg), cfg.health_minutes,
                  approx_distinct("order_id").alias("pending_demand"))


def supply_windows_approx(couriers: DataFrame, cfg: MetricConfig = DEFAULTS) -> DataFrame:
    return _count(_idle(couriers, cfg), cfg.health_minutes,
                  approx_distinct("courier_id").alias("available_supply"))


def demand_event_windows(orders: DataFrame, cfg: MetricConfig = DEFAULTS) -> DataFrame:
    """Pending events (not orders) per window and zone."""
    return _count(_pending(orders, cfg), cfg.health_minutes,
                  F.count(F.lit(1)).alias("pending_demand"))


def supply_event_windows(couriers: DataFrame, cfg: MetricConfig = DEFAULTS) -> DataFrame:
    """Idle events (not couriers) per window and zone."""
    return _count(_idle(couriers, cfg), cfg.health_minutes,
                  F.count(F.lit(1)).alias("available_supply"))


def classify_health(df: DataFrame, cfg: MetricConfig = DEFAULTS) -> DataFrame:
    """Add ratio and class to rows with ``pending_demand`` and ``available_supply``."""
    demand = F.coalesce(F.col("pending_demand"), F.lit(0).cast("long"))
    supply = F.coalesce(F.col("available_supply"), F.lit(0).cast("long"))
    ratio = health_ratio(demand, supply)
    return df.select(
        "window_start", "window_end", "zone_id",
        demand.alias("pending_demand"), supply.alias("available_supply"),
        ratio.alias("health_ratio"), health_status(ratio, cfg).alias("health_status"),
    )


def join_health(demand: DataFrame, supply: DataFrame, cfg: MetricConfig = DEFAULTS,
                how: str = "full_outer") -> DataFrame:
    """Balance from two metric tables.

    ``full_outer`` keeps zones seen by one feed only; ``right`` keeps the rows of the supply side.
    """
    keys = ["window_start", "window_end", "zone_id"]
    return classify_health(demand.join(supply, keys, how), cfg)


def demand_supply_health(orders: DataFrame, couriers: DataFrame, cfg: MetricConfig = DEFAULTS,
                         orphans: DataFrame | None = None) -> DataFrame:
    """Balance straight from both feeds.

    ``orphans`` (``order_id, zone_id, drop_time``) are orders that lost their courier: they are
    pending again in the window and zone of the drop.

    The feeds are stacked and counted by side, which keeps zones seen by one feed only (a full
    outer join of the two counts) and, unlike a stream-stream join, works in update mode.  On a
    stream the smaller progress of the two feeds drives the watermark.
    """
    counted = both_sides(orders, couriers, cfg, cfg.health_minutes, orphans)
    return classify_health(flatten_window(counted), cfg)


def both_sides(orders: DataFrame, couriers: DataFrame, cfg: MetricConfig, size: int,
               orphans: DataFrame | None = None) -> DataFrame:
    """Pending orders and idle couriers per ``window`` of ``size`` minutes and zone."""
    def side(events: DataFrame, id_column: str, label: str) -> DataFrame:
        return events.filter(F.col(id_column).isNotNull()).select(
            tumbling(size), "zone_id",
            F.lit(label).alias("side"), F.col(id_column).alias("id"))

    both = side(_pending(orders, cfg), "order_id", "demand").unionByName(
        side(_idle(couriers, cfg), "courier_id", "supply"))
    if orphans is not None:
        again = orphans.select("order_id", "zone_id", F.col("drop_time").alias(EVENT_TIME))
        both = both.unionByName(side(again, "order_id", "demand"))
    if both.isStreaming and cfg.stream_distinct == "approx":
        def ids(label: str) -> Column:
            return approx_distinct(F.when(F.col("side") == label, F.col("id")))
        return both.groupBy("window", "zone_id").agg(
            ids("demand").alias("pending_demand"), ids("supply").alias("available_supply"))
    return both.dropDuplicates(["window", "zone_id", "side", "id"]).groupBy(
        "window", "zone_id"
    ).agg(
        F.count_if(F.col("side") == "demand").alias("pending_demand"),
        F.count_if(F.col("side") == "supply").alias("available_supply"),
    )
