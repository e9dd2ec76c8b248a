"""Device fraud heuristics (table ``fraud_alerts``)."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.config import DEFAULTS, MetricConfig
from zonepulse.functions.expressions import approx_distinct, fraud_flags, fraud_rules
from zonepulse.functions.windows import ensure_watermark, flatten_window, tumbling
from zonepulse.model import METRIC_TABLES


def _device_rows(orders: DataFrame, cfg: MetricConfig) -> DataFrame:
    return (
        ensure_watermark(orders, cfg.orders_watermark)
        .filter(F.col("device_id").isNotNull())
        .select(tumbling(cfg.fraud_minutes), "device_id", "customer_id", "status",
                "order_value_eur")
    )


def _measures():
    return [
        F.count_if(F.col("status") == "PLACED").alias("placed_count"),
        F.count_if(F.col("status") == "CANCELLED").alias("cancellation_count"),
        F.count_if(F.col("status") == "REFUNDED").alias("refund_count"),
        F.sum("order_value_eur").alias("total_order_value"),
    ]


def device_activity(orders: DataFrame, cfg: MetricConfig = DEFAULTS,
                    distinct: str | None = None) -> DataFrame:
    """Distinct customers, cancellations, refunds and value per window and device.

    The value is summed over all events of an order, as the metric is defined.

    ``distinct`` is ``exact`` or ``approx`` (HyperLogLog).  Exact counts never hold a device's
    customers in one place: batch aggregates per (window, device, customer) first; a stream
    de-duplicates those triples with watermarked state and counts the survivors as markers.
    """
    rows = _device_rows(orders, cfg)
    keys = ["window", "device_id"]
    mode = distinct or (cfg.stream_distinct if rows.isStreaming else "exact")
    if mode == "approx":
        agg = rows.groupBy(*keys).agg(
            approx_distinct("customer_id").alias("distinct_customer_ids"), *_measures())
    elif rows.isStreaming:
        markers = (
            rows.filter(F.col("customer_id").isNotNull()).select(*keys, "customer_id")
            .dropDuplicates([*keys, "customer_id"])
            .select(*keys, F.lit(1).alias("marker"), F.lit(None).cast("string").alias("status"),
                    F.lit(None).cast("double").alias("order_value_eur"))
        )
        events = rows.select(*keys, F.lit(0).alias("marker"), "status", "order_value_eur")
        agg = events.unionByName(markers).groupBy(*keys).agg(
            F.count_if(F.col("marker") == 1).alias("distinct_customer_ids"), *_measures())
    else:
        agg = rows.groupBy(*keys).agg(
            F.count_distinct("customer_id").alias("distinct_customer_ids"), *_measures())
    return flatten_window(agg)


def fraud_alerts(orders: DataFrame, cfg: MetricConfig = DEFAULTS,
                 distinct: str | None = None) -> DataFrame:
    """Devices with at least one rule broken in the window, tested on the whole window."""
    return (
        device_activity(orders, cfg, distinct)
        .filter(reduce(or_, fraud_rules(cfg).values()))
        .withColumn("fraud_flags", fraud_flags(cfg))
        .select(*METRIC_TABLES["fraud_alerts"].columns)
    )


def multi_account_devices(orders: DataFrame, cfg: MetricConfig = DEFAULTS) -> DataFrame:
    """Devices used by many customers that also have most of their orders cancelled."""
    rate = F.col("cancellation_count") / F.greatest(F.col("placed_count"), F.lit(1))
    return (
        device_activity(orders, cfg)
        .filter((F.col("distinct_customer_ids") > cfg.multi_account_customers)
                & (rate >= cfg.multi_account_cancel_rate))
        .select(
            "window_start", "window_end", "device_id", "distinct_customer_ids",
            "placed_count", "cancellation_count", rate.alias("cancellation_rate"),
        )
    )
