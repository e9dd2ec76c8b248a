"""Delivery-time statistics and outliers (table ``delivery_anomalies``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.config import DEFAULTS, MetricConfig
from zonepulse.functions.windows import (
    EVENT_TIME,
    ensure_watermark,
    flatten_window,
    interval,
    roll_up_panes,
    sliding,
    tumbling,
)
from zonepulse.model import METRIC_TABLES

_VALUE = "actual_delivery_minutes"


def delivered_with_time(orders: DataFrame) -> DataFrame:
    return orders.filter((F.col("status") == "DELIVERED") & F.col(_VALUE).isNotNull())


def _counts(cfg: MetricConfig):
    return [
        F.count(F.lit(1)).alias("delivery_count"),
        F.count_if(F.col(_VALUE) > cfg.anomaly_minutes_limit).alias("anomaly_count"),
        F.count_if(F.coalesce(F.col("is_late"), F.lit(False))).alias("late_event_count"),
    ]


def delivery_anomalies(orders: DataFrame, cfg: MetricConfig = DEFAULTS,
                       size: int | None = None, slide: int | None = None) -> DataFrame:
    """Mean, sample deviation and threshold of the delivery minutes per sliding window and zone.

    In batch an event is aggregated once, in its slide-sized pane, and the panes' moments are
    added up per window.  Minutes are whole numbers, so both moments are exact.
    """
    size, slide = size or cfg.anomaly_minutes, slide or cfg.anomaly_slide
    rows = delivered_with_time(ensure_watermark(orders, cfg.orders_watermark))
    if rows.isStreaming:
        agg = flatten_window(
            rows.groupBy(sliding(size, slide), "zone_id").agg(
                *_counts(cfg),
                F.avg(_VALUE).alias("mean_delivery_min"),
                F.stddev_samp(_VALUE).alias("stddev_delivery_min"),
            ))
    else:
        value = F.col(_VALUE).cast("double")
        panes = rows.groupBy(tumbling(slide), "zone_id").agg(
            *_counts(cfg), F.sum(value).alias("s1"), F.sum(value * value).alias("s2"))
        n, s1, s2 = F.col("delivery_count"), F.col("s1"), F.col("s2")
        variance = F.greatest((n * s2 - s1 * s1) / (n * (n - 1)), F.lit(0.0))
        agg = (
            roll_up_panes(panes, size, slide)
            .groupBy("window_start", "window_end", "zone_id")
            .agg(*[F.sum(c).alias(c) for c in
                   ("delivery_count", "anomaly_count", "late_event_count", "s1", "s2")])
            .withColumn("mean_delivery_min", s1 / n)
            .withColumn("stddev_delivery_min", F.when(n > 1, F.sqrt(variance)))
        )
    threshold = F.col("mean_delivery_min") + cfg.anomaly_sigmas * F.col("stddev_delivery_min")
    return agg.withColumn("anomaly_threshold", threshold).select(
        *METRIC_TABLES["delivery_anomalies"].columns)


def impossible_deliveries(orders: DataFrame, cfg: MetricConfig = DEFAULTS) -> DataFrame:
    """Deliveries that took next to no time, or hours: one row each, without a shuffle.

    No window is needed to tell them, so a window with few deliveries hides none.
    """
    rows = delivered_with_time(ensure_watermark(orders, cfg.orders_watermark))
    kind = (F.when(F.col(_VALUE) < cfg.shortest_delivery_minutes, "TOO_SHORT")
            .when(F.col(_VALUE) > cfg.longest_delivery_minutes, "TOO_LONG"))
    return rows.select("event_id", "order_id", "zone_id", EVENT_TIME,
                       F.col(_VALUE).cast("long").alias(_VALUE), kind.alias("kind")).filter(
        F.col("kind").isNotNull())


def flag_deliveries(orders: DataFrame, cfg: MetricConfig = DEFAULTS) -> DataFrame:
    """Deliveries above the threshold of a window that covers them, one row per such window.

    The windows' thresholds are gathered per slide-sized pane, so a delivery meets all its windows
    in one lookup and only flagged rows are multiplied.  The lookup table holds one row per pane
    and zone; Spark chooses the join from the bytes it measures.
    """
    size, slide = cfg.anomaly_minutes, cfg.anomaly_slide
    windows = delivery_anomalies(orders, cfg).filter(F.col("anomaly_threshold").isNotNull())
    step = interval(slide)
    lookup = (
        windows.select(
            "zone_id",
            F.explode(F.transform(
                F.sequence(F.lit(0), F.lit(size // slide - 1)),
                lambda i: F.col("window_start") + i * step)).alias("pane_start"),
            F.struct("window_start", "window_end", "mean_delivery_min", "stddev_delivery_min",
                     "anomaly_threshold").alias("w"),
        )
        # At most size / slide windows per pane.
        .groupBy("pane_start", "zone_id")
        .agg(F.collect_list("w").alias("ws"), F.min("w.anomaly_threshold").alias("lowest"))
    )
    rows = delivered_with_time(orders).select(
        tumbling(slide), "event_id", "order_id", "zone_id", EVENT_TIME, _VALUE,
    ).withColumn("pane_start", F.col("window.start")).drop("window")
    return (
        rows.join(lookup, ["pane_start", "zone_id"])
        .filter(F.col(_VALUE) > F.col("lowest"))
        .select("event_id", "order_id", "zone_id", EVENT_TIME, _VALUE, F.explode("ws").alias("w"))
        .filter(F.col(_VALUE) > F.col("w.anomaly_threshold"))
        .select(
            "event_id", "order_id", "zone_id", EVENT_TIME, _VALUE,
            "w.window_start", "w.window_end", "w.anomaly_threshold",
            ((F.col(_VALUE) - F.col("w.mean_delivery_min")) / F.col("w.stddev_delivery_min"))
            .alias("z_score"),
        )
    )
