"""Order KPIs and cancellation rate per zone (table ``windowed_kpis``)."""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonepulse.config import DEFAULTS, MetricConfig
from zonepulse.functions.expressions import share, sum_if
from zonepulse.functions.windows import (
    EVENT_TIME,
    covering_starts,
    ensure_watermark,
    flatten_window,
    interval,
    roll_up_panes,
    sliding,
    tumbling,
)
from zonepulse.model import METRIC_TABLES

TUMBLING = "tumbling_{0}min"
HOPPING = "hopping_{0}min_{1}slide"
_COLUMNS = METRIC_TABLES["windowed_kpis"].columns


def _status(*names: str) -> Column:
    return F.col("status").isin(*names)


def tumbling_kpis(orders: DataFrame, cfg: MetricConfig = DEFAULTS) -> DataFrame:
    """Order count, revenue and average estimated preparation time per tumbling window and zone.

    Counts and revenue come from PLACED events, the preparation estimate from CONFIRMED ones.
    Revenue is null in a window without PLACED events.
    """
    placed = _status("PLACED")
    agg = (
        ensure_watermark(orders, cfg.orders_watermark)
        .filter(_status("PLACED", "CONFIRMED"))
        .groupBy(tumbling(cfg.kpi_minutes), "zone_id")
        .agg(
            F.count_if(placed).alias("order_count"),
            sum_if(placed, F.col("order_value_eur")).alias("total_revenue"),
            F.avg("estimated_prep_minutes").alias("avg_prep_minutes"),
        )
    )
    return flatten_window(agg).select(
        "window_start", "window_end",
        F.lit(TUMBLING.format(cfg.kpi_minutes)).alias("window_type"),
        "zone_id", "order_count", "total_revenue", "avg_prep_minutes",
        F.lit(0).cast("long").alias("cancellation_count"),
        F.lit(0.0).alias("cancellation_rate"),
    )


def hopping_cancellations(orders: DataFrame, cfg: MetricConfig = DEFAULTS) -> DataFrame:
    """Cancelled share of PLACED and CANCELLED events per sliding window and zone.

    A cancelled order counts twice in ``order_count`` (once per event); that is the definition of
    the metric.  In batch each event is counted once in its slide-sized pane and the panes are
    added up; a stream keeps one state row per window.
    """
    events = ensure_watermark(orders, cfg.orders_watermark).filter(_status("PLACED", "CANCELLED"))
    counts = [
        F.count(F.lit(1)).alias("order_count"),
        F.count_if(_status("CANCELLED")).alias("cancellation_count"),
    ]
    if events.isStreaming:
        agg = flatten_window(
            events.groupBy(sliding(cfg.cancel_minutes, cfg.cancel_slide), "zone_id").agg(*counts))
    else:
        panes = events.groupBy(tumbling(cfg.cancel_slide), "zone_id").agg(*counts)
        agg = (
            roll_up_panes(panes, cfg.cancel_minutes, cfg.cancel_slide)
            .groupBy("window_start", "window_end", "zone_id")
            .agg(F.sum("order_count").alias("order_count"),
                 F.sum("cancellation_count").alias("cancellation_count"))
        )
    return agg.select(
        "window_start", "window_end",
        F.lit(HOPPING.format(cfg.cancel_minutes, cfg.cancel_slide)).alias("window_type"),
        "zone_id", "order_count",
        F.lit(0.0).alias("total_revenue"),
        F.lit(None).cast("double").alias("avg_prep_minutes"),
        "cancellation_count",
        share(F.col("cancellation_count"), F.col("order_count")).alias("cancellation_rate"),
    )


def windowed_kpis(orders: DataFrame, cfg: MetricConfig = DEFAULTS) -> DataFrame:
    """Both KPI families of a bounded feed from one scan and one shuffle of partial panes.

    Panes as long as the greatest common divisor of the windows carry every sum; each pane then
    goes to the one tumbling and the few sliding windows it belongs to.
    """
    if orders.isStreaming:
        raise ValueError("start one streaming query per KPI family instead")
    pane = gcd(cfg.kpi_minutes, cfg.cancel_slide)
    placed = _status("PLACED")
    panes = (
        orders.filter(_status("PLACED", "CONFIRMED", "CANCELLED"))
        .groupBy(tumbling(pane), "zone_id")
        .agg(
            F.count_if(placed).alias("placed"),
            F.count_if(_status("CONFIRMED")).alias("confirmed"),
            F.count_if(_status("CANCELLED")).alias("cancelled"),
            sum_if(placed, F.col("order_value_eur")).alias("revenue"),
            sum_if(_status("PLACED", "CONFIRMED"),
                   F.col("estimated_prep_minutes").cast("long")).alias("prep_sum"),
            F.count(F.when(_status("PLACED", "CONFIRMED"),
                           F.col("estimated_prep_minutes"))).alias("prep_count"),
        )
    )
    start = F.col("window.start")
    own_start = F.window(start, f"{cfg.kpi_minutes} minutes")
    tumbling_type = F.lit(TUMBLING.format(cfg.kpi_minutes))
    hopping_type = F.lit(HOPPING.format(cfg.cancel_minutes, cfg.cancel_slide))

    def part(window_start: Column, size: int, kind: Column, present: Column) -> Column:
        return F.when(present, F.struct(
            window_start.alias("window_start"),
            (window_start + interval(size)).alias("window_end"),
            kind.alias("window_type"),
        ))

    # The pane's slide-aligned start; equal to the pane when both windows share the slide.
    slide_start = F.col("slide.start")
    parts = F.concat(
        F.array(part(F.col("own.start"), cfg.kpi_minutes, tumbling_type,
                     F.col("placed") + F.col("confirmed") > 0)),
        F.transform(
            covering_starts(slide_start, cfg.cancel_minutes, cfg.cancel_slide),
            lambda s: part(s, cfg.cancel_minutes, hopping_type,
                           F.col("placed") + F.col("cancelled") > 0),
        ),
    )
    spread = (
        panes.withColumn("own", own_start)
        .withColumn("slide", F.window(start, f"{cfg.cancel_slide} minutes"))
        .withColumn("part", F.explode(parts))
        .filter(F.col("part").isNotNull())
        .select("part.*", "zone_id", "placed", "cancelled", "revenue", "prep_sum", "prep_count")
    )
    is_tumbling = F.col("window_type") == tumbling_type
    totals = spread.groupBy("window_start", "window_end", "window_type", "zone_id").agg(
        *[F.sum(c).alias(c) for c in ("placed", "cancelled", "revenue", "prep_sum", "prep_count")]
    )
    in_window = F.col("placed") + F.col("cancelled")
    return totals.select(
        "window_start", "window_end", "window_type", "zone_id",
        F.when(is_tumbling, F.col("placed")).otherwise(in_window).alias("order_count"),
        F.when(is_tumbling, F.col("revenue")).otherwise(F.lit(0.0)).alias("total_revenue"),
        F.when(is_tumbling & (F.col("prep_count") > 0), F.col("prep_sum") / F.col("prep_count"))
            .alias("avg_prep_minutes"),
        F.when(is_tumbling, F.lit(0)).otherwise(F.col("cancelled")).cast("long")
            .alias("cancellation_count"),
        F.when(is_tumbling, F.lit(0.0)).otherwise(share(F.col("cancelled"), in_window))
            .alias("cancellation_rate"),
    ).select(*_COLUMNS)


def orders_per_minute(orders: DataFrame, cfg: MetricConfig = DEFAULTS) -> DataFrame:
    """PLACED orders per zone and minute."""
    return flatten_window(
        ensure_watermark(orders, cfg.orders_watermark).filter(_status("PLACED"))
        .groupBy(tumbling(1), "zone_id")
        .agg(F.count(F.lit(1)).alias("order_count"))
    )


def revenue_per_hour(orders: DataFrame, cfg: MetricConfig = DEFAULTS) -> DataFrame:
    """Value of DELIVERED orders per hour."""
    return flatten_window(
        ensure_watermark(orders, cfg.orders_watermark).filter(_status("DELIVERED"))
        .groupBy(tumbling(60))
        .agg(F.count(F.lit(1)).alias("delivered_count"),
             F.sum("order_value_eur").alias("total_revenue"))
    )


def order_durations(orders: DataFrame) -> DataFrame:
    """Minutes between lifecycle steps per order; null where a step never arrived."""
    def first(status: str) -> Column:
        return F.min(F.when(_status(status), F.col(EVENT_TIME))).alias(status)

    def between(a: str, b: str) -> Column:
        return (F.unix_micros(b) - F.unix_micros(a)) / 60_000_000

    steps = ("PLACED", "READY_FOR_PICKUP", "PICKED_UP", "DELIVERED")
    return (
        orders.filter(_status(*steps))
        .groupBy("order_id").agg(*[first(s) for s in steps])
        .select(
            "order_id",
            between("PLACED", "DELIVERED").alias("placed_to_delivered_min"),
            between("READY_FOR_PICKUP", "PICKED_UP").alias("ready_to_pickup_min"),
            between("PICKED_UP", "DELIVERED").alias("pickup_to_delivered_min"),
        )
    )


def surge_signal(orders: DataFrame, couriers: DataFrame,
                 cfg: MetricConfig = DEFAULTS) -> DataFrame:
    """Pending orders now against the average of the preceding windows and the idle couriers, per
    zone: a surge is far more demand than just before, and more than couriers to serve it.

    The trailing average runs over a fixed number of windows and counts an empty window as zero.
    Each window's demand is sent forward to the windows that look back on it, so the work is
    spread over (window, zone) and no zone's history has to be ordered in one task.

    On a stream (append mode) the counts of a window become events of the long windows that cover
    it, and a long window is told when the watermark passes its end.
    """
    from zonepulse.operators.demand_supply import both_sides, demand_windows, supply_windows

    size, back = cfg.surge_minutes, cfg.surge_lookback_windows
    if orders.isStreaming:
        counted = both_sides(orders, couriers, cfg, size)
        span = size * (back + 1)
        current = F.col("window.end") == F.col("span.end")
        totals = (
            counted.select("window", "zone_id", "pending_demand", "available_supply", F.window(
                F.window_time("window"), f"{span} minutes", f"{size} minutes").alias("span"))
            .groupBy("span", "zone_id")
            .agg(F.sum(F.when(current, F.col("pending_demand"))).alias("pending_demand"),
                 F.sum(F.when(current, F.col("available_supply"))).alias("available_supply"),
                 (F.coalesce(F.sum(F.when(~current, F.col("pending_demand"))), F.lit(0)) / back)
                 .alias("trailing_demand"))
            .filter(F.col("pending_demand") > 0)
            .withColumn("window_start", F.col("span.end") - interval(size))
        )
        return _surge(totals, cfg)
    demand = demand_windows(orders, cfg, size=size)
    shift = F.explode(F.sequence(F.lit(0), F.lit(back))).alias("ahead")
    step = interval(size)
    totals = (
        demand.select("window_start", "zone_id", "pending_demand", shift)
        .select(
            (F.col("window_start") + F.col("ahead") * step).alias("window_start"), "zone_id",
            F.when(F.col("ahead") == 0, F.col("pending_demand")).alias("now"),
            F.when(F.col("ahead") > 0, F.col("pending_demand")).alias("before"),
        )
        .groupBy("window_start", "zone_id")
        .agg(F.sum("now").alias("pending_demand"),
             (F.coalesce(F.sum("before"), F.lit(0)) / back).alias("trailing_demand"))
        .filter(F.col("pending_demand").isNotNull())
    )
    supply = supply_windows(couriers, cfg, size=size).select(
        "window_start", "zone_id", "available_supply")
    return _surge(totals.join(supply, ["window_start", "zone_id"], "left"), cfg)


def _surge(totals: DataFrame, cfg: MetricConfig) -> DataFrame:
    ratio = F.col("pending_demand") / F.greatest(F.col("trailing_demand"), F.lit(1.0))
    available = F.coalesce(F.col("available_supply"), F.lit(0))
    return totals.select(
        "window_start", (F.col("window_start") + interval(cfg.surge_minutes)).alias("window_end"),
        "zone_id",
        "pending_demand", "trailing_demand", available.alias("available_supply"),
        ratio.alias("surge_ratio"),
        ((ratio >= cfg.surge_ratio) & (F.col("pending_demand") > available)).alias("is_surge"),
    )
