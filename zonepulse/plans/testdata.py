"""Derive the two feeds and the restaurant dimension from the benchmark tables.

Each row of ``events`` is one order; its lifecycle is spelled out by integer arithmetic, so the
same feed can be written down independently in SQL.  One scan of ``events`` feeds an explode per
feed; nothing is shuffled unless the feed is asked to be ``spread``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zonepulse.model import COURIERS, ORDERS, VEHICLES

# Fixed values of the derivation.
_EPOCH = 1_704_067_200_000_000  # 2024-01-01 in microseconds
_ZONES = ("CENTRO", "SALAMANCA", "CHAMBERI", "RETIRO", "LATINA", "MONCLOA", "TETUAN",
          "ARGANZUELA", "CHAMARTIN", "MALASANA")
_CUISINES = ("SPANISH", "ITALIAN", "JAPANESE", "AMERICAN", "MEXICAN", "CHINESE", "INDIAN",
             "MIDDLE_EASTERN", "THAI", "HEALTHY", "DESSERT")
_SHIFT_MICROS = 14_400_000_000


def _pick(values: tuple[str, ...], index: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({listed}), CAST({index} AS INT) + 1)"


def _restaurant_id(number: str) -> str:
    return f"concat('R', IF({number} < 10000, lpad({number}, 4, '0'), CAST({number} AS STRING)))"


_BASE = (
    "event_id AS k", "user_id AS u", "value", "event_type = 'error' AS canc",
    f"{_EPOCH} + (unix_micros(CAST(ts AS TIMESTAMP)) - {_EPOCH}) div 30 AS t0",
    "5 + (event_id * 7) % 40 AS prep",
    "10 + CAST(floor(value / 4) AS BIGINT) AS deliv",
    f"{_pick(_ZONES, 'user_id % 10')} AS zone_id",
)


def _base(spark: SparkSession, sf_dir: str, spread: bool) -> DataFrame:
    """The orders; ``spread`` deals their narrow rows to all cores, however few files hold them."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    if spread:
        events = events.repartition(4 * spark.sparkContext.defaultParallelism)
    return events.selectExpr(*_BASE)


# Lifecycle steps: sequence number, status, seconds after placement, condition.
_STEPS = (
    (0, "PLACED", "0", "true"),
    (1, "CANCELLED", "60", "canc"),
    (2, "REFUNDED", "300", "canc AND k % 3 = 0"),
    (1, "CONFIRMED", "30", "NOT canc"),
    (2, "PREPARING", "35", "NOT canc"),
    (3, "READY_FOR_PICKUP", "35 + prep * 60", "NOT canc"),
    (4, "PICKED_UP", "95 + prep * 60", "NOT canc AND k % 100 <> 0"),
    (5, "IN_TRANSIT", "105 + prep * 60", "NOT canc"),
    (6, "DELIVERED", "105 + (prep + deliv) * 60", "NOT canc AND k % 24 <> 15"),
    # Of the orders whose courier dropped out, some get another courier and some of those arrive.
    (7, "IN_TRANSIT", "705 + prep * 60", "NOT canc AND k % 120 IN (39, 87)"),
    (8, "DELIVERED", "1305 + prep * 60", "NOT canc AND k % 120 = 39"),
)
_EXPLODED_STEPS = "explode(array({})) AS step".format(", ".join(
    f"IF({condition}, named_struct('seq', {seq}, 'status', '{status}', "
    f"'off', CAST({offset} AS BIGINT)), NULL)"
    for seq, status, offset, condition in _STEPS))

_ARRIVAL = "t0 + step.off * 1000000"
_ORDER_COLUMNS = {
    "schema_version": "'1.0.0'",
    "event_id": "concat('E', k, '-', step.seq)",
    "order_id": "concat('O', k)",
    "customer_id": "concat('U', u)",
    "restaurant_id": _restaurant_id("(k % 120 + 1)"),
    "courier_id": "IF(step.seq >= 4, concat('C', u * 10), NULL)",
    "zone_id": "zone_id",
    "status": "step.status",
    "event_time": f"timestamp_micros({_ARRIVAL} - "
                  "IF((k + step.seq) % 20 = 0, (60 + k % 241) * 1000000, 0))",
    "ingestion_time": f"timestamp_micros({_ARRIVAL})",
    "order_value_eur": "round(value + 5, 2)",
    "item_count": "1",
    "is_promo": "false",
    "promo_code": "CAST(NULL AS STRING)",
    "payment_method": "'CARD'",
    "estimated_prep_minutes": "IF(NOT canc AND step.seq >= 1, CAST(prep + k % 3 AS INT), NULL)",
    "actual_prep_minutes": "IF(NOT canc AND step.seq >= 3, CAST(prep AS INT), NULL)",
    "estimated_delivery_minutes": "CAST(NULL AS INT)",
    "actual_delivery_minutes": "CAST(CASE WHEN step.seq = 6 AND k % 125 IN (3, 4) THEN (k % 125 - 3) * 150 "
                               "WHEN step.seq = 6 THEN deliv WHEN step.seq = 8 THEN 20 END AS INT)",
    "cancellation_reason": "IF(step.status = 'CANCELLED', 'CUSTOMER_REQUEST', NULL)",
    "device_id": "CASE WHEN k % 37 = 0 THEN NULL WHEN u < 12 THEN concat('DEV-FRAUD-', u div 4) "
                 "ELSE concat('DEV-', u) END",
    "platform": "'ANDROID'",
    "is_duplicate": "is_duplicate",
    "is_late": "(k + step.seq) % 20 = 0",
    "metadata": "CAST(map() AS MAP<STRING, STRING>)",
}

# Drops number 1 and 2 follow the order's way into transit by two and three minutes.
_AT = "t0 + IF(d > 0, 165 + prep * 60 + d * 60, 0) * 1000000"
_DROPS = ("explode(CASE WHEN c > 0 OR canc OR k % 24 <> 15 THEN array(0) WHEN k % 48 = 15 "
          "THEN array(0, 1, 2) ELSE array(0, 1) END) AS d")

_COURIER_COLUMNS = {
    "schema_version": "'1.0.0'",
    "event_id": "concat('CE', k, '-', c, IF(d > 0, concat('-d', d), ''))",
    "courier_id": "concat('C', u * 10 + c)",
    "order_id": "IF(k % 8 >= 6 AND c = 0, concat('O', k), NULL)",
    "zone_id": "zone_id",
    "status": "CASE WHEN d > 0 THEN 'OFFLINE' WHEN k % 8 < 5 THEN 'ONLINE_IDLE' WHEN k % 8 = 5 THEN 'HEADING_TO_RESTAURANT' "
              "WHEN k % 8 = 6 THEN 'HEADING_TO_CUSTOMER' ELSE 'OFFLINE' END",
    "event_time": f"timestamp_micros({_AT})",
    "ingestion_time": f"timestamp_micros({_AT})",
    "latitude": "round(40.4168D + CAST(k % 41 - 20 AS DOUBLE) / 1000, 6)",
    "longitude": "round(-3.7038D + CAST(k % 37 - 18 AS DOUBLE) / 1000, 6)",
    "location_accuracy_meters": "CAST(IF(k % 60 = 0, 120, 3 + k % 23) AS FLOAT)",
    "speed_kmh": "CAST(IF(k % 200 = 0, 250, k % 45) AS FLOAT)",
    "battery_pct": "CAST(5 + k % 96 AS INT)",
    "vehicle_type": _pick(VEHICLES, "u % 5"),
    "active_session_id": f"concat('S', u * 10 + c, '-', (t0 - {_EPOCH}) div {_SHIFT_MICROS})",
    "session_start_time": f"timestamp_micros(t0 - (t0 - {_EPOCH}) % {_SHIFT_MICROS})",
    "deliveries_completed_this_session": "0",
    "is_heartbeat": "false",
    "is_duplicate": "false",
    "is_late": "false",
    "offline_reason": "IF(d > 0 OR k % 8 = 7, IF(d > 0 OR k % 3 = 0, 'MID_DELIVERY_DROP', 'SHIFT_END'), NULL)",
    "metadata": "CAST(map() AS MAP<STRING, STRING>)",
}


def orders_feed(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Order lifecycle events with late rows and flagged duplicates, in the declared schema."""
    return (
        _base(spark, sf_dir, spread)
        .selectExpr("*", _EXPLODED_STEPS)
        .where("step IS NOT NULL")
        .selectExpr("*", "explode(IF((k + step.seq) % 50 = 0, array(false, true), array(false))) "
                         "AS is_duplicate")
        .selectExpr(*[f"{_ORDER_COLUMNS[f.name]} AS {f.name}" for f in ORDERS.fields])
    )


def couriers_feed(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Courier status events in the declared schema: ``u % 10 + 1`` couriers per event row, and
    the drops of couriers who had an order in transit."""
    return (
        _base(spark, sf_dir, spread)
        .selectExpr("*", "explode(sequence(0L, u % 10)) AS c")
        .selectExpr("*", _DROPS)
        .selectExpr(*[f"{_COURIER_COLUMNS[f.name]} AS {f.name}" for f in COURIERS.fields])
    )


def restaurants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Restaurant dimension from ``supplier``."""
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").selectExpr(
        f"{_restaurant_id('s_suppkey')} AS restaurant_id",
        "s_name AS restaurant_name",
        f"{_pick(_ZONES, 's_suppkey % 10')} AS zone_id",
        f"{_pick(_CUISINES, 's_suppkey % 11')} AS cuisine_type",
        "CASE WHEN s_suppkey % 10 < 2 THEN 'GOLD' WHEN s_suppkey % 10 < 7 THEN 'SILVER' "
        "ELSE 'BRONZE' END AS sla_tier",
        "CAST(8 + s_suppkey % 18 AS DOUBLE) AS avg_prep_mean",
    )
