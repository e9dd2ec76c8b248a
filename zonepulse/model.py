"""Schemas: the two feeds, the restaurant dimension and the keyed metric tables.

Each feed is declared once as a tuple of fields.  The Spark schema, the JSON wire schema and the
Avro reader schema are all derived from that declaration.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import types as T

# States and categories of the feeds, in wire (enum) order.
ORDER_STATES = (
    "PLACED", "CONFIRMED", "PREPARING", "READY_FOR_PICKUP", "PICKED_UP", "IN_TRANSIT",
    "DELIVERED", "CANCELLED", "REFUNDED",
)
COURIER_STATES = (
    "ONLINE_IDLE", "ONLINE_ASSIGNED", "HEADING_TO_RESTAURANT", "AT_RESTAURANT",
    "HEADING_TO_CUSTOMER", "COMPLETED_DELIVERY", "OFFLINE", "BREAK",
)
PAYMENT_METHODS = ("CARD", "CASH", "WALLET", "VOUCHER")
PLATFORMS = ("IOS", "ANDROID", "WEB")
VEHICLES = ("BICYCLE", "SCOOTER", "MOTORCYCLE", "CAR", "WALKING")
CANCELLATION_REASONS = (
    "CUSTOMER_REQUEST", "RESTAURANT_UNAVAILABLE", "NO_COURIER", "FRAUD_SUSPECTED", "TIMEOUT",
)
OFFLINE_REASONS = ("VOLUNTARY", "BATTERY_DEAD", "APP_CRASH", "MID_DELIVERY_DROP", "SHIFT_END")

PENDING_STATES = ("PLACED", "CONFIRMED", "PREPARING", "READY_FOR_PICKUP")
BUSY_STATES = (
    "ONLINE_ASSIGNED", "HEADING_TO_RESTAURANT", "AT_RESTAURANT", "HEADING_TO_CUSTOMER",
    "COMPLETED_DELIVERY",
)


# Fixed value: namespace of both feeds' Avro records and enums.
AVRO_NAMESPACE = "com.fooddelivery.streams.v1"


@dataclass(frozen=True)
class FeedField:
    name: str
    kind: str  # string, int, double, float, boolean, millis, map
    optional: bool = False
    symbols: tuple[str, ...] | None = None
    enum: str | None = None
    default: object = None  # on the wire; an optional field's default is null


_SPARK_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "boolean": T.BooleanType(),
    "millis": T.TimestampType(),
    "map": T.MapType(T.StringType(), T.StringType()),
}


@dataclass(frozen=True)
class Feed:
    name: str
    fields: tuple[FeedField, ...]

    @property
    def schema(self) -> T.StructType:
        """Spark schema after decoding: event times are timestamps, all columns nullable."""
        return T.StructType([T.StructField(f.name, _SPARK_TYPES[f.kind]) for f in self.fields])

    @property
    def json_schema(self) -> T.StructType:
        """JSON wire schema: times are epoch milliseconds."""
        return T.StructType([
            T.StructField(f.name, T.LongType() if f.kind == "millis" else _SPARK_TYPES[f.kind])
            for f in self.fields
        ])

    @property
    def time_columns(self) -> list[str]:
        return [f.name for f in self.fields if f.kind == "millis"]

    def avro_schema(self) -> str:
        """Avro reader schema as JSON text for ``from_avro``."""
        return json.dumps({
            "type": "record",
            "name": self.name,
            "namespace": AVRO_NAMESPACE,
            "fields": [_avro_field(f) for f in self.fields],
        })


def _avro_field(f: FeedField) -> dict:
    if f.symbols:
        kind: object = {"type": "enum", "name": f.enum, "symbols": list(f.symbols)}
    elif f.kind == "millis":
        kind = {"type": "long", "logicalType": "timestamp-millis"}
    elif f.kind == "map":
        kind = {"type": "map", "values": "string"}
    else:
        kind = f.kind
    if f.optional:
        return {"name": f.name, "type": ["null", kind], "default": None}
    if f.default is not None:
        return {"name": f.name, "type": kind, "default": f.default}
    return {"name": f.name, "type": kind}


# Names, field order, types, optionality and defaults of the order feed on the wire.
ORDERS = Feed("OrderLifecycleEvent", (
    FeedField("schema_version", "string", default="1.0.0"),
    FeedField("event_id", "string"),
    FeedField("order_id", "string"),
    FeedField("customer_id", "string"),
    FeedField("restaurant_id", "string"),
    FeedField("courier_id", "string", optional=True),
    FeedField("zone_id", "string"),
    FeedField("status", "string", symbols=ORDER_STATES, enum="OrderStatus"),
    FeedField("event_time", "millis"),
    FeedField("ingestion_time", "millis"),
    FeedField("order_value_eur", "double"),
    FeedField("item_count", "int"),
    FeedField("is_promo", "boolean", default=False),
    FeedField("promo_code", "string", optional=True),
    FeedField("payment_method", "string", symbols=PAYMENT_METHODS, enum="PaymentMethod"),
    FeedField("estimated_prep_minutes", "int", optional=True),
    FeedField("actual_prep_minutes", "int", optional=True),
    FeedField("estimated_delivery_minutes", "int", optional=True),
    FeedField("actual_delivery_minutes", "int", optional=True),
    FeedField("cancellation_reason", "string", optional=True, symbols=CANCELLATION_REASONS,
              enum="CancellationReason"),
    FeedField("device_id", "string", optional=True),
    FeedField("platform", "string", symbols=PLATFORMS, enum="Platform"),
    FeedField("is_duplicate", "boolean", default=False),
    FeedField("is_late", "boolean", default=False),
    FeedField("metadata", "map", default={}),
))

# Names, field order, types, optionality and defaults of the courier feed on the wire.
COURIERS = Feed("CourierStatusEvent", (
    FeedField("schema_version", "string", default="1.0.0"),
    FeedField("event_id", "string"),
    FeedField("courier_id", "string"),
    FeedField("order_id", "string", optional=True),
    FeedField("zone_id", "string"),
    FeedField("status", "string", symbols=COURIER_STATES, enum="CourierStatus"),
    FeedField("event_time", "millis"),
    FeedField("ingestion_time", "millis"),
    FeedField("latitude", "double"),
    FeedField("longitude", "double"),
    FeedField("location_accuracy_meters", "float", optional=True),
    FeedField("speed_kmh", "float", optional=True),
    FeedField("battery_pct", "int", optional=True),
    FeedField("vehicle_type", "string", symbols=VEHICLES, enum="VehicleType"),
    FeedField("active_session_id", "string", optional=True),
    FeedField("session_start_time", "millis", optional=True),
    FeedField("deliveries_completed_this_session", "int", default=0),
    FeedField("is_heartbeat", "boolean", default=False),
    FeedField("is_duplicate", "boolean", default=False),
    FeedField("is_late", "boolean", default=False),
    FeedField("offline_reason", "string", optional=True, symbols=OFFLINE_REASONS,
              enum="OfflineReason"),
    FeedField("metadata", "map", default={}),
))

RESTAURANT_SCHEMA = T.StructType([
    T.StructField("restaurant_id", T.StringType(), False),
    T.StructField("restaurant_name", T.StringType()),
    T.StructField("zone_id", T.StringType()),
    T.StructField("cuisine_type", T.StringType()),
    T.StructField("sla_tier", T.StringType()),
    T.StructField("avg_prep_mean", T.DoubleType()),
])


@dataclass(frozen=True)
class MetricTable:
    """Contract of one metric table: primary key and typed columns in output order."""

    name: str
    keys: tuple[str, ...]
    schema: T.StructType
    defaults: dict[str, object]

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def values(self) -> list[str]:
        return [c for c in self.columns if c not in self.keys]


def _table(name: str, keys: tuple[str, ...], columns: str,
           defaults: dict[str, object] | None = None) -> MetricTable:
    """``columns`` is Spark DDL."""
    fields = []
    for column in columns.split(","):
        field, kind = column.split()
        fields.append(T.StructField(field, _DDL_TYPES[kind]))
    return MetricTable(name, keys, T.StructType(fields), defaults or {})


_DDL_TYPES = {
    "TIMESTAMP": T.TimestampType(), "STRING": T.StringType(), "BIGINT": T.LongType(),
    "INT": T.IntegerType(), "DOUBLE": T.DoubleType(), "BOOLEAN": T.BooleanType(),
}

# Keys, columns, types and defaults of the metric tables.
METRIC_TABLES: dict[str, MetricTable] = {t.name: t for t in (
    _table(
        "windowed_kpis", ("window_start", "window_end", "window_type", "zone_id"),
        """window_start TIMESTAMP, window_end TIMESTAMP, window_type STRING, zone_id STRING,
           order_count BIGINT, total_revenue DOUBLE, avg_prep_minutes DOUBLE,
           cancellation_count BIGINT, cancellation_rate DOUBLE""",
        {"order_count": 0, "total_revenue": 0, "cancellation_count": 0, "cancellation_rate": 0},
    ),
    _table(
        "_demand_staging", ("window_start", "window_end", "zone_id"),
        """window_start TIMESTAMP, window_end TIMESTAMP, zone_id STRING, pending_demand BIGINT""",
        {"pending_demand": 0},
    ),
    _table(
        "demand_supply_health", ("window_start", "window_end", "zone_id"),
        """window_start TIMESTAMP, window_end TIMESTAMP, zone_id STRING, pending_demand BIGINT,
           available_supply BIGINT, health_ratio DOUBLE, health_status STRING""",
        {"pending_demand": 0, "available_supply": 0, "health_ratio": 0},
    ),
    _table(
        # zone_id is part of the key: one restaurant may deliver into several zones.  A database
        # made with the key below needs RESTAURANT_SLA_BY_RESTAURANT instead.
        "restaurant_sla", ("window_start", "window_end", "restaurant_id", "zone_id"),
        """window_start TIMESTAMP, window_end TIMESTAMP, restaurant_id STRING,
           restaurant_name STRING, zone_id STRING, cuisine STRING, sla_tier STRING,
           order_count BIGINT, p50_prep DOUBLE, p95_prep DOUBLE, p99_prep DOUBLE,
           sla_breached BOOLEAN""",
        {"order_count": 0, "sla_breached": False},
    ),
    _table(
        "delivery_anomalies", ("window_start", "window_end", "zone_id"),
        """window_start TIMESTAMP, window_end TIMESTAMP, zone_id STRING, delivery_count BIGINT,
           mean_delivery_min DOUBLE, stddev_delivery_min DOUBLE, anomaly_threshold DOUBLE,
           anomaly_count BIGINT, late_event_count BIGINT""",
        {"delivery_count": 0, "anomaly_count": 0, "late_event_count": 0},
    ),
    _table(
        "fraud_alerts", ("window_start", "window_end", "device_id"),
        """window_start TIMESTAMP, window_end TIMESTAMP, device_id STRING,
           distinct_customer_ids BIGINT, cancellation_count BIGINT, refund_count BIGINT,
           total_order_value DOUBLE, fraud_flags STRING""",
        {"distinct_customer_ids": 0, "cancellation_count": 0, "refund_count": 0,
         "total_order_value": 0},
    ),
    _table(
        "courier_positions", ("courier_id",),
        """courier_id STRING, zone_id STRING, latitude DOUBLE, longitude DOUBLE, speed_kmh DOUBLE,
           status STRING, vehicle_type STRING, position_time TIMESTAMP, position_event_id STRING,
           updated_at TIMESTAMP""",
    ),
)}

# The key without the zone, for databases that have it: an upsert then keeps the last zone.
RESTAURANT_SLA_BY_RESTAURANT = MetricTable(
    "restaurant_sla", ("window_start", "window_end", "restaurant_id"),
    METRIC_TABLES["restaurant_sla"].schema, METRIC_TABLES["restaurant_sla"].defaults)

# Tables of further live metrics.
LIVE_TABLES: dict[str, MetricTable] = {t.name: t for t in (
    _table("orders_per_minute", ("window_start", "window_end", "zone_id"),
           "window_start TIMESTAMP, window_end TIMESTAMP, zone_id STRING, order_count BIGINT"),
    _table("revenue_per_hour", ("window_start", "window_end"),
           "window_start TIMESTAMP, window_end TIMESTAMP, delivered_count BIGINT, "
           "total_revenue DOUBLE"),
    _table("courier_sessions", ("courier_id", "session_start"),
           "courier_id STRING, session_start TIMESTAMP, session_end TIMESTAMP, "
           "event_count BIGINT"),
    _table("impossible_deliveries", ("event_id",),
           "event_id STRING, order_id STRING, zone_id STRING, event_timestamp TIMESTAMP, "
           "actual_delivery_minutes BIGINT, kind STRING"),
    _table("fraud_multi_account", ("window_start", "window_end", "device_id"),
           "window_start TIMESTAMP, window_end TIMESTAMP, device_id STRING, "
           "distinct_customer_ids BIGINT, placed_count BIGINT, cancellation_count BIGINT, "
           "cancellation_rate DOUBLE"),
    _table("courier_utilisation", ("window_start", "window_end", "zone_id"),
           "window_start TIMESTAMP, window_end TIMESTAMP, zone_id STRING, online_couriers BIGINT, "
           "busy_couriers BIGINT, utilisation DOUBLE"),
    _table("shift_sessions", ("active_session_id", "courier_id"),
           "active_session_id STRING, courier_id STRING, session_start TIMESTAMP, "
           "session_end TIMESTAMP, event_count BIGINT, session_minutes DOUBLE, is_closed BOOLEAN, "
           "is_over BOOLEAN"),
    _table("courier_quality_flags", ("event_id",),
           "event_id STRING, courier_id STRING, zone_id STRING, event_timestamp TIMESTAMP, "
           "speed_kmh DOUBLE, location_accuracy_meters DOUBLE, battery_pct INT, "
           "quality_flags STRING"),
    _table("order_durations", ("order_id",),
           "order_id STRING, placed_to_delivered_min DOUBLE, ready_to_pickup_min DOUBLE, "
           "pickup_to_delivered_min DOUBLE"),
    _table("surge_signal", ("window_start", "window_end", "zone_id"),
           "window_start TIMESTAMP, window_end TIMESTAMP, zone_id STRING, pending_demand BIGINT, "
           "trailing_demand DOUBLE, available_supply BIGINT, surge_ratio DOUBLE, "
           "is_surge BOOLEAN"),
    _table("judged_drops", ("order_id", "drop_time", "drop_event_id"),
           "order_id STRING, drop_time TIMESTAMP, drop_event_id STRING, zone_id STRING, "
           "dropped_courier_id STRING, in_transit_time TIMESTAMP, is_orphaned BOOLEAN"),
)}
