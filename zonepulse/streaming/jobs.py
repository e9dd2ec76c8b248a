"""Streaming form of every metric: the batch definition plus output mode, checkpoint and sink."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from zonepulse.config import DEFAULTS, MetricConfig
from zonepulse.functions.windows import ensure_watermark
from zonepulse.model import LIVE_TABLES, METRIC_TABLES, MetricTable
from zonepulse.operators import anomaly, couriers, demand_supply, fraud, kpis, lifecycles, quality, sla
from zonepulse.sinks.changelog import ChangelogTable


@dataclass(frozen=True)
class Feeds:
    """Cleaned inputs of the metrics; ``restaurants`` is static, the feeds may be streams."""

    orders: DataFrame | None = None
    couriers: DataFrame | None = None
    restaurants: DataFrame | None = None


@dataclass(frozen=True)
class MetricJob:
    """A metric as a streaming query.

    ``order_columns`` and ``courier_columns`` name what the metric reads from each feed.
    """

    name: str
    build: Callable[[Feeds, MetricConfig], DataFrame]
    table: MetricTable
    order_columns: tuple[str, ...] = ()
    courier_columns: tuple[str, ...] = ()
    output_mode: str = "update"


def _job(name: str, table: str, build: Callable[[Feeds, MetricConfig], DataFrame],
         orders: tuple[str, ...] = (), couriers: tuple[str, ...] = (),
         output_mode: str = "update") -> MetricJob:
    return MetricJob(name, build, {**METRIC_TABLES, **LIVE_TABLES}[table], orders, couriers,
                     output_mode)


JOBS: dict[str, MetricJob] = {j.name: j for j in (
    _job("kpi_tumbling", "windowed_kpis", lambda f, c: kpis.tumbling_kpis(f.orders, c),
         ("zone_id", "status", "order_value_eur", "estimated_prep_minutes")),
    _job("kpi_hopping", "windowed_kpis", lambda f, c: kpis.hopping_cancellations(f.orders, c),
         ("zone_id", "status")),
    _job("demand_supply", "demand_supply_health",
         lambda f, c: demand_supply.demand_supply_health(f.orders, f.couriers, c),
         ("zone_id", "status", "order_id"), ("zone_id", "status", "courier_id")),
    _job("restaurant_sla", "restaurant_sla",
         lambda f, c: sla.restaurant_sla(f.orders, f.restaurants, c),
         ("zone_id", "status", "restaurant_id", "actual_prep_minutes")),
    _job("delivery_anomalies", "delivery_anomalies",
         lambda f, c: anomaly.delivery_anomalies(f.orders, c),
         ("zone_id", "status", "actual_delivery_minutes", "is_late")),
    _job("fraud_alerts", "fraud_alerts", lambda f, c: fraud.fraud_alerts(f.orders, c),
         ("device_id", "customer_id", "status", "order_value_eur")),
    _job("courier_positions", "courier_positions",
         lambda f, c: couriers.latest_positions(f.couriers).withColumn(
             "updated_at", F.current_timestamp()),
         (), ("courier_id", "zone_id", "latitude", "longitude", "speed_kmh", "status",
              "vehicle_type")),
    _job("orders_per_minute", "orders_per_minute", lambda f, c: kpis.orders_per_minute(f.orders, c),
         ("zone_id", "status")),
    _job("revenue_per_hour", "revenue_per_hour", lambda f, c: kpis.revenue_per_hour(f.orders, c),
         ("status", "order_value_eur")),
    # Sessions that have ended only: a session is told once, when the watermark is past its gap.
    _job("courier_sessions", "courier_sessions", lambda f, c: couriers.gap_sessions(f.couriers, c),
         (), ("courier_id",), "append"),
    _job("impossible_deliveries", "impossible_deliveries",
         lambda f, c: anomaly.impossible_deliveries(f.orders, c),
         ("order_id", "zone_id", "status", "actual_delivery_minutes"), (), "append"),
    _job("fraud_multi_account", "fraud_multi_account",
         lambda f, c: fraud.multi_account_devices(f.orders, c),
         ("device_id", "customer_id", "status", "order_value_eur")),
    _job("courier_utilisation", "courier_utilisation",
         lambda f, c: couriers.utilisation(f.couriers, c),
         (), ("courier_id", "zone_id", "status"), "append"),
    _job("shift_sessions", "shift_sessions", lambda f, c: lifecycles.shift_sessions(f.couriers, c),
         (), ("courier_id", "active_session_id", "session_start_time", "status")),
    _job("courier_quality_flags", "courier_quality_flags",
         lambda f, c: lifecycles.quality_flags(f.couriers, c),
         (), ("courier_id", "zone_id", "speed_kmh", "location_accuracy_meters", "battery_pct",
              "status"), "append"),
    _job("order_durations", "order_durations", lambda f, c: lifecycles.order_durations(f.orders, c),
         ("order_id", "status"), (), "append"),
    _job("surge_signal", "surge_signal", lambda f, c: kpis.surge_signal(f.orders, f.couriers, c),
         ("zone_id", "status", "order_id"), ("zone_id", "status", "courier_id"), "append"),
    _job("judged_drops", "judged_drops",
         lambda f, c: couriers.judged_drops(f.orders, f.couriers, c),
         ("status", "order_id"),
         ("status", "order_id", "zone_id", "courier_id", "offline_reason"), "append"),
)}


def clean_stream(raw: DataFrame, delay: str, by_key: bool = False) -> DataFrame:
    """Validate and watermark a stream, and drop copies: by the producer's mark, or by event id.

    Only the event id needs state, for as long as the watermark ``delay``.
    """
    valid = ensure_watermark(quality.with_event_timestamp(quality.validate(raw)), delay)
    return quality.dedup_by_key(valid) if by_key else quality.dedup_by_flag(valid)


def start_metric(job: MetricJob, feeds: Feeds, root: str, checkpoint_root: str,
                 cfg: MetricConfig = DEFAULTS, available_now: bool = False,
                 interval: str = "30 seconds",
                 write_batch: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Start one metric; its changelog lies in ``root/<name>``.

    ``write_batch`` puts another sink in place of the changelog; it must tolerate a repeated batch.

    Failures of a batch end the query and leave the checkpoint untouched, so a restart repeats the
    batch and overwrites what it had written.
    """
    write = write_batch or ChangelogTable.of(job.table, f"{root}/{job.name}").write_batch
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return (
        job.build(feeds, cfg).writeStream
        .outputMode(job.output_mode)
        .queryName(job.name)
        .option("checkpointLocation", f"{checkpoint_root}/{job.name}")
        .foreachBatch(write)
        .trigger(**trigger)
        .start()
    )
