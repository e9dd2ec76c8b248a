"""Courier positions, utilisation, sessions, data quality and dropped deliveries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonepulse.config import DEFAULTS, MetricConfig
from zonepulse.functions.expressions import share
from zonepulse.functions.windows import (
    EVENT_TIME,
    ensure_watermark,
    flatten_window,
    interval,
    minutes,
    roll_up_panes,
    sliding,
    tumbling,
)
from zonepulse.model import BUSY_STATES

_POSITION = ("zone_id", "latitude", "longitude", "speed_kmh", "status", "vehicle_type")


def latest_positions(couriers: DataFrame) -> DataFrame:
    """The newest row per courier by event time; equal times are decided by the event id.

    A plain aggregate: each task keeps one row per courier before the shuffle, so a courier with
    very many rows costs no more than any other.  On a stream it runs in update mode with one
    state row per courier.
    """
    newest = F.max_by(F.struct(*_POSITION, EVENT_TIME, "event_id"),
                      F.struct(F.col(EVENT_TIME), F.col("event_id"))).alias("row")
    return couriers.groupBy("courier_id").agg(newest).select(
        "courier_id",
        *[F.col(f"row.{c}").cast("double").alias(c) if c == "speed_kmh" else F.col(f"row.{c}")
          for c in _POSITION],
        F.col(f"row.{EVENT_TIME}").alias("position_time"),
        F.col("row.event_id").alias("position_event_id"),
    )


def utilisation(couriers: DataFrame, cfg: MetricConfig = DEFAULTS) -> DataFrame:
    """Share of the couriers seen online in a sliding window that were busy in it, per zone.

    Rows collapse to one per (pane, zone, courier) before the shuffle; panes, not rows, are repeated
    for the windows that cover them.  On a stream (append mode) the couriers of a window and zone are
    kept as sets, ``cfg.utilisation_buckets`` rows of state by a hash of the courier and not one per
    courier, and a window is told when the watermark passes its end.
    """
    online = ensure_watermark(couriers, cfg.couriers_watermark).filter(
        ~F.col("status").isin("OFFLINE", "BREAK"))
    size, slide = cfg.utilisation_minutes, cfg.utilisation_slide
    busy = F.max(F.col("status").isin(*BUSY_STATES)).alias("busy")
    counts = (F.count(F.lit(1)).alias("online_couriers"),
              F.count_if(F.col("busy")).alias("busy_couriers"))
    used = share(F.col("busy_couriers"), F.col("online_couriers")).alias("utilisation")
    if online.isStreaming:
        courier, is_busy = F.col("courier_id"), F.col("status").isin(*BUSY_STATES)
        bucket = F.pmod(F.xxhash64(courier), F.lit(cfg.utilisation_buckets)).alias("bucket")

        def distinct(when: Column) -> Column:
            # A set leaves out null, which is a courier like any other.
            unnamed = F.max((when & courier.isNull()).cast("long"))
            return F.size(F.collect_set(F.when(when, courier))) + unnamed

        seen = online.groupBy(sliding(size, slide), "zone_id", bucket).agg(
            distinct(F.lit(True)).alias("online"), distinct(is_busy).alias("busy"))
        summed = seen.groupBy("window", "zone_id").agg(
            F.sum("online").alias("online_couriers"), F.sum("busy").alias("busy_couriers"))
        return flatten_window(summed).select("*", used)
    panes = (
        online.groupBy(tumbling(slide), "zone_id", "courier_id")
        .agg(busy)
    )
    per_courier = (
        roll_up_panes(panes, size, slide)
        .groupBy("window_start", "zone_id", "courier_id").agg(F.max("busy").alias("busy"))
    )
    return per_courier.groupBy("window_start", "zone_id").agg(*counts).select(
        "window_start", (F.col("window_start") + interval(size)).alias("window_end"), "zone_id",
        "online_couriers", "busy_couriers", used)


def sessions(couriers: DataFrame) -> DataFrame:
    """Shift length per session id; a session is closed once its courier went OFFLINE in it."""
    offline = F.col("status") == "OFFLINE"
    agg = (
        couriers.filter(F.col("active_session_id").isNotNull())
        .groupBy("active_session_id", "courier_id")
        .agg(
            F.min(EVENT_TIME).alias("first_seen"),
            F.max(EVENT_TIME).alias("last_seen"),
            F.min("session_start_time").alias("declared_start"),
            F.max(F.when(offline, F.col(EVENT_TIME))).alias("last_offline"),
            F.count(F.lit(1)).alias("event_count"),
        )
    )
    start = F.coalesce(F.least("declared_start", "first_seen"), F.col("first_seen"))
    return agg.select(
        "active_session_id", "courier_id", start.alias("session_start"),
        F.col("last_seen").alias("session_end"), "event_count",
        ((F.unix_micros("last_seen") - F.unix_micros(start)) / 60_000_000).alias("session_minutes"),
        F.col("last_offline").isNotNull().alias("is_closed"),
    )


def gap_sessions(couriers: DataFrame, cfg: MetricConfig = DEFAULTS) -> DataFrame:
    """Activity sessions of a courier: a silence longer than the gap starts a new one.

    On a stream this is a session window (append mode).  In batch, events are first reduced to
    (courier, gap-sized pane) with map-side combine.  Events inside one pane are never further
    apart than the gap, so panes can be chained exactly, and what is ordered per courier is
    bounded by elapsed time and not by its number of events.
    """
    gap = cfg.session_gap_minutes
    rows = ensure_watermark(couriers, cfg.couriers_watermark)
    if rows.isStreaming:
        return (
            rows.groupBy(F.session_window(EVENT_TIME, minutes(gap)).alias("window"), "courier_id")
            .agg(F.count(F.lit(1)).alias("event_count"))
            .select("courier_id", F.col("window.start").alias("session_start"),
                    F.col("window.end").alias("session_end"), "event_count")
        )
    step = interval(gap)
    panes = (
        rows.groupBy("courier_id", tumbling(gap)["start"].alias("pane_start"))
        .agg(F.min(EVENT_TIME).alias("first"), F.max(EVENT_TIME).alias("last"),
             F.count(F.lit(1)).alias("n"))
    )
    order = Window.partitionBy("courier_id").orderBy("pane_start")
    starts_new = F.col("first") > F.lag("last").over(order) + step
    chained = panes.withColumn("new", F.coalesce(starts_new, F.lit(True)).cast("long")).withColumn(
        "session", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return chained.groupBy("courier_id", "session").agg(
        F.min("first").alias("session_start"),
        (F.max("last") + step).alias("session_end"),
        F.sum("n").alias("event_count"),
    ).drop("session")


def _with_previous_battery(couriers: DataFrame) -> DataFrame:
    """Rows with ``previous_battery``, the level on the same courier's row before it.

    Rows are ordered per courier and hour, so a courier with very many rows is spread over hours;
    the first row of an hour looks up the last level of the courier's hour before it.
    """
    order = F.struct(EVENT_TIME, "event_id")
    rows = couriers.withColumn("_hour", F.date_trunc("hour", F.col(EVENT_TIME)))
    lasts = rows.groupBy("courier_id", "_hour").agg(
        F.max_by(F.struct("battery_pct"), order).alias("last"))
    before = lasts.select("courier_id", "_hour", F.lag("last").over(
        Window.partitionBy("courier_id").orderBy("_hour")).alias("hour_before"))
    in_hour = F.lag(F.struct("battery_pct")).over(
        Window.partitionBy("courier_id", "_hour").orderBy(EVENT_TIME, "event_id"))
    return (
        rows.withColumn("_in_hour", in_hour).join(before, ["courier_id", "_hour"], "left")
        .withColumn("previous_battery", F.when(F.col("_in_hour").isNotNull(), F.col(
            "_in_hour.battery_pct")).otherwise(F.col("hour_before.battery_pct")))
        .drop("_in_hour", "hour_before", "_hour")
    )


def quality_flags(couriers: DataFrame, cfg: MetricConfig = DEFAULTS) -> DataFrame:
    """Suspicious courier rows: impossible speed, poor fix, or going offline after a low battery.

    The battery is judged on the courier's row before the one that goes offline.
    """
    flags = {
        "IMPOSSIBLE_SPEED": F.col("speed_kmh") >= cfg.impossible_speed_kmh,
        "POOR_ACCURACY": F.col("location_accuracy_meters") > cfg.poor_accuracy_meters,
        "LOW_BATTERY_OFFLINE": (F.col("status") == "OFFLINE")
            & (F.col("previous_battery") <= cfg.low_battery_pct),
    }
    names = F.concat_ws(", ", *[F.when(rule, F.lit(name)) for name, rule in flags.items()])
    return _with_previous_battery(couriers).select(
        "event_id", "courier_id", "zone_id", EVENT_TIME,
        F.col("speed_kmh").cast("double").alias("speed_kmh"),
        F.col("location_accuracy_meters").cast("double").alias("location_accuracy_meters"),
        "battery_pct", names.alias("quality_flags"),
    ).filter(F.col("quality_flags") != "")


def _drops(couriers: DataFrame) -> DataFrame:
    return couriers.filter((F.col("status") == "OFFLINE")
                           & (F.col("offline_reason") == "MID_DELIVERY_DROP")
                           & F.col("order_id").isNotNull())


def orphaned_deliveries(orders: DataFrame, couriers: DataFrame, cfg: MetricConfig = DEFAULTS,
                        bounded: bool = True) -> DataFrame:
    """Orders whose courier dropped out in transit and that were not delivered afterwards.

    The rule: of an order's drops the last one counts; the order was in transit at or before it;
    and it was not delivered at or after it, both within ``cfg.orphan_hours`` if ``bounded``, which
    is as far as a stream remembers.  Drops are reduced to one row per order before the join; what
    the join finds is combined per task before it is shuffled.
    """
    drops = (
        _drops(couriers).groupBy("order_id")
        .agg(F.max_by(F.struct(F.col(EVENT_TIME).alias("drop_time"), "zone_id",
                               F.col("courier_id").alias("dropped_courier_id")),
                      F.struct(EVENT_TIME, "event_id")).alias("d"))
    )
    drop, found = F.col("d.drop_time"), _steps(orders).join(drops, "order_id")
    if bounded:
        bound = interval(60 * cfg.orphan_hours)
        found = found.filter((F.col("at") >= drop - bound) & (F.col("at") <= drop + bound))
    return (
        found.groupBy("order_id", "d").agg(*_judged(drop))
        .filter(F.col("in_transit_time").isNotNull() & ~F.col("delivered"))
        .select("order_id", "d.zone_id", "d.dropped_courier_id", "d.drop_time", "in_transit_time")
    )


def _steps(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("status").isin("IN_TRANSIT", "DELIVERED")).select(
        "order_id", F.col("status").alias("step"), F.col(EVENT_TIME).alias("at"))


def _judged(drop: Column) -> tuple[Column, Column]:
    """What an order's steps say about a drop."""
    return (
        F.max(F.when((F.col("step") == "IN_TRANSIT") & (F.col("at") <= drop), F.col("at")))
        .alias("in_transit_time"),
        F.coalesce(F.max((F.col("step") == "DELIVERED") & (F.col("at") >= drop)), F.lit(False))
        .alias("delivered"),
    )


def judged_drops(orders: DataFrame, couriers: DataFrame, cfg: MetricConfig = DEFAULTS) -> DataFrame:
    """Every drop of a stream with ``is_orphaned``, told once (append mode).

    The drops are joined with the steps of their order that lie within ``cfg.orphan_hours``, an
    outer join with a time bound, so that a drop without any step is told too; the matches of a drop
    are then combined.  A drop is told when the watermarks of both feeds have passed its bound, and
    that is also how long both sides are kept.  ``last_drops`` makes orders of drops.
    """
    steps = _steps(ensure_watermark(orders, cfg.orders_watermark)).withColumnRenamed(
        "order_id", "step_order_id")
    drops = _drops(ensure_watermark(couriers, cfg.couriers_watermark)).select(
        "order_id", F.col(EVENT_TIME).alias("drop_time"), F.col("event_id").alias("drop_event_id"),
        "zone_id", F.col("courier_id").alias("dropped_courier_id"))
    hours = f"INTERVAL {cfg.orphan_hours} HOURS"
    joined = drops.join(steps, F.expr(
        f"order_id = step_order_id AND at >= drop_time - {hours} AND at <= drop_time + {hours}"),
        "left_outer")
    key = ["order_id", "drop_time", "drop_event_id", "zone_id", "dropped_courier_id"]
    return joined.groupBy(*key).agg(*_judged(F.col("drop_time"))).select(
        *key, "in_transit_time",
        (F.col("in_transit_time").isNotNull() & ~F.col("delivered")).alias("is_orphaned"))


def last_drops(judged: DataFrame) -> DataFrame:
    """The orders that are orphaned, going by the last drop of each that ``judged_drops`` told."""
    values = ("zone_id", "dropped_courier_id", "drop_time", "in_transit_time", "is_orphaned")
    last = F.max_by(F.struct(*values), F.struct("drop_time", "drop_event_id")).alias("last")
    return (judged.groupBy("order_id").agg(last).select("order_id", "last.*")
            .filter("is_orphaned").drop("is_orphaned"))
