"""Restaurant preparation-time percentiles and SLA breaches (table ``restaurant_sla``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.config import DEFAULTS, MetricConfig
from zonepulse.functions.expressions import sla_breached
from zonepulse.functions.percentiles import discrete_percentiles
from zonepulse.functions.windows import ensure_watermark, flatten_window, tumbling
from zonepulse.model import METRIC_TABLES

PERCENTS = {"p50_prep": 50, "p95_prep": 95, "p99_prep": 99}


def enrich(events: DataFrame, restaurants: DataFrame, how: str = "left") -> DataFrame:
    """Join of events with the restaurant dimension (its own zone is dropped).

    Without a hint: Spark broadcasts the dimension if the bytes it measures are few, and else splits
    the partitions of busy restaurants.
    """
    return events.join(restaurants.drop("zone_id"), "restaurant_id", how)


def delivered_with_prep(orders: DataFrame) -> DataFrame:
    return orders.filter(
        (F.col("status") == "DELIVERED") & F.col("actual_prep_minutes").isNotNull())


def restaurant_sla(orders: DataFrame, restaurants: DataFrame, cfg: MetricConfig = DEFAULTS,
                   size: int | None = None) -> DataFrame:
    """p50/p95/p99 of the actual preparation time per window, restaurant and zone.

    The dimension is joined after the aggregation, to one row per group instead of one per
    delivery.  Batch percentiles are exact; a stream keeps one percentile sketch per group.
    """
    keys = ["window", "restaurant_id", "zone_id"]
    rows = delivered_with_prep(ensure_watermark(orders, cfg.orders_watermark)).select(
        tumbling(size or cfg.sla_minutes), "restaurant_id", "zone_id", "actual_prep_minutes")
    if rows.isStreaming:
        sketch = F.percentile_approx(
            "actual_prep_minutes", [p / 100 for p in PERCENTS.values()])
        agg = rows.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("order_count"), sketch.alias("p")
        ).select(*keys, "order_count",
                 *[F.col("p")[i].alias(name) for i, name in enumerate(PERCENTS)])
    else:
        agg = discrete_percentiles(rows, keys, "actual_prep_minutes", PERCENTS, "order_count")
    return _describe(agg, restaurants, cfg).select(*METRIC_TABLES["restaurant_sla"].columns)


def _describe(agg: DataFrame, restaurants: DataFrame, cfg: MetricConfig) -> DataFrame:
    """Add the restaurant's attributes and the verdict to aggregated groups.

    One row per group is left here, so Spark may choose the join from the sizes it sees.
    """
    named = flatten_window(agg).join(restaurants.drop("zone_id"), "restaurant_id", "left")
    breached = sla_breached(F.col("sla_tier"), F.col("p95_prep"), cfg)
    return named.withColumnsRenamed({"cuisine_type": "cuisine"}).withColumns({
        **{p: F.col(p).cast("double") for p in PERCENTS}, "sla_breached": breached})


def prep_estimate_error(orders: DataFrame, restaurants: DataFrame, cfg: MetricConfig = DEFAULTS,
                        size: int = 30) -> DataFrame:
    """SLA view of a bounded feed with the mean of actual minus estimated preparation time."""
    keys = ["window", "restaurant_id", "zone_id"]
    error = F.col("actual_prep_minutes") - F.col("estimated_prep_minutes")
    rows = delivered_with_prep(orders).select(
        tumbling(size), "restaurant_id", "zone_id", "actual_prep_minutes",
        error.cast("long").alias("error"))
    agg = discrete_percentiles(
        rows, keys, "actual_prep_minutes", PERCENTS, "order_count",
        totals={"error_sum": F.sum("error"), "error_count": F.count("error")})
    mean = F.when(F.col("error_count") > 0, F.col("error_sum") / F.col("error_count"))
    return _describe(agg, restaurants, cfg).withColumn("avg_prep_error", mean).select(
        *METRIC_TABLES["restaurant_sla"].columns, "avg_prep_error")
