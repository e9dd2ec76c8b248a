"""Independent SQL for every query with an exact answer (DuckDB dialect).

The first text derives the feeds; each answer below is prefixed with it.
"""

from __future__ import annotations

FEEDS = """
WITH b AS (
  SELECT event_id AS k, user_id AS u, value, event_type = 'error' AS canc,
         1704067200000000 + (epoch_us(ts) - 1704067200000000) // 30 AS t0,
         5 + (event_id * 7) % 40 AS prep,
         10 + CAST(floor(value / 4) AS BIGINT) AS deliv,
         ['CENTRO','SALAMANCA','CHAMBERI','RETIRO','LATINA','MONCLOA','TETUAN','ARGANZUELA','CHAMARTIN','MALASANA'][user_id % 10 + 1] AS zone_id
  FROM events),
s AS (
  SELECT *, 0 AS seq, 'PLACED' AS status, 0 AS off FROM b
  UNION ALL SELECT *, 1, 'CANCELLED', 60 FROM b WHERE canc
  UNION ALL SELECT *, 2, 'REFUNDED', 300 FROM b WHERE canc AND k % 3 = 0
  UNION ALL SELECT *, 1, 'CONFIRMED', 30 FROM b WHERE NOT canc
  UNION ALL SELECT *, 2, 'PREPARING', 35 FROM b WHERE NOT canc
  UNION ALL SELECT *, 3, 'READY_FOR_PICKUP', 35 + prep * 60 FROM b WHERE NOT canc
  UNION ALL SELECT *, 4, 'PICKED_UP', 95 + prep * 60 FROM b WHERE NOT canc AND k % 100 <> 0
  UNION ALL SELECT *, 5, 'IN_TRANSIT', 105 + prep * 60 FROM b WHERE NOT canc
  UNION ALL SELECT *, 6, 'DELIVERED', 105 + (prep + deliv) * 60 FROM b WHERE NOT canc AND k % 24 <> 15
  UNION ALL SELECT *, 7, 'IN_TRANSIT', 705 + prep * 60 FROM b WHERE NOT canc AND k % 120 IN (39, 87)
  UNION ALL SELECT *, 8, 'DELIVERED', 1305 + prep * 60 FROM b WHERE NOT canc AND k % 120 = 39),
orders_raw AS (
  SELECT concat('E', CAST(k AS STRING), '-', CAST(seq AS STRING)) AS event_id,
         concat('O', CAST(k AS STRING)) AS order_id,
         concat('U', CAST(u AS STRING)) AS customer_id,
         concat('R', lpad(CAST(k % 120 + 1 AS STRING), 4, '0')) AS restaurant_id,
         zone_id, status,
         make_timestamp(t0 + off * 1000000 - CASE WHEN (k + seq) % 20 = 0 THEN (60 + k % 241) * 1000000 ELSE 0 END) AS event_time,
         make_timestamp(t0 + off * 1000000) AS ingestion_time,
         round(value + 5, 2) AS order_value_eur,
         CASE WHEN NOT canc AND seq >= 1 THEN prep + k % 3 END AS estimated_prep_minutes,
         CASE WHEN NOT canc AND seq >= 3 THEN prep END AS actual_prep_minutes,
         CASE WHEN seq = 6 AND k % 125 = 3 THEN 0 WHEN seq = 6 AND k % 125 = 4 THEN 150
              WHEN seq = 6 THEN deliv WHEN seq = 8 THEN 20 END AS actual_delivery_minutes,
         CASE WHEN k % 37 = 0 THEN NULL
              WHEN u < 12 THEN concat('DEV-FRAUD-', CAST(u // 4 AS STRING))
              ELSE concat('DEV-', CAST(u AS STRING)) END AS device_id,
         (k + seq) % 20 = 0 AS is_late, (k + seq) % 50 = 0 AS has_copy
  FROM s),
orders_feed AS (
  SELECT *, false AS is_duplicate FROM orders_raw
  UNION ALL SELECT *, true FROM orders_raw WHERE has_copy),
o AS (SELECT * FROM orders_feed WHERE NOT is_duplicate),
seen AS (
  SELECT *, t0 AS seen_us FROM b CROSS JOIN (VALUES (0),(1),(2),(3),(4),(5),(6),(7),(8),(9)) AS r(c)
  CROSS JOIN (VALUES (0)) AS x(d) WHERE c <= u % 10
  UNION ALL
  SELECT *, t0 + (165 + prep * 60 + d * 60) * 1000000 FROM b CROSS JOIN (VALUES (0)) AS r(c)
  CROSS JOIN (VALUES (1), (2)) AS x(d)
  WHERE NOT canc AND k % 24 = 15 AND (d = 1 OR k % 48 = 15)),
c AS (
  SELECT concat('CE', CAST(k AS STRING), '-', CAST(c AS STRING), CASE WHEN d > 0 THEN concat('-d', CAST(d AS STRING)) ELSE '' END) AS event_id,
         concat('C', CAST(u * 10 + c AS STRING)) AS courier_id, zone_id,
         CASE WHEN k % 8 >= 6 AND c = 0 THEN concat('O', CAST(k AS STRING)) END AS order_id,
         CASE WHEN d > 0 THEN 'OFFLINE' WHEN k % 8 < 5 THEN 'ONLINE_IDLE' WHEN k % 8 = 5 THEN 'HEADING_TO_RESTAURANT'
              WHEN k % 8 = 6 THEN 'HEADING_TO_CUSTOMER' ELSE 'OFFLINE' END AS status,
         make_timestamp(seen_us) AS event_time, make_timestamp(seen_us) AS ingestion_time,
         round(CAST(40.4168 AS DOUBLE) + CAST(k % 41 - 20 AS DOUBLE) / 1000, 6) AS latitude,
         round(CAST(-3.7038 AS DOUBLE) + CAST(k % 37 - 18 AS DOUBLE) / 1000, 6) AS longitude,
         CASE WHEN k % 60 = 0 THEN CAST(120 AS DOUBLE) ELSE CAST(3 + k % 23 AS DOUBLE) END AS location_accuracy_meters,
         CASE WHEN k % 200 = 0 THEN CAST(250 AS DOUBLE) ELSE CAST(k % 45 AS DOUBLE) END AS speed_kmh,
         5 + k % 96 AS battery_pct,
         ['BICYCLE','SCOOTER','MOTORCYCLE','CAR','WALKING'][u % 5 + 1] AS vehicle_type,
         concat('S', CAST(u * 10 + c AS STRING), '-', CAST((t0 - 1704067200000000) // 14400000000 AS STRING)) AS active_session_id,
         make_timestamp(t0 - (t0 - 1704067200000000) % 14400000000) AS session_start_time,
         CASE WHEN d > 0 OR k % 24 = 15 THEN 'MID_DELIVERY_DROP' WHEN k % 8 = 7 THEN 'SHIFT_END' END AS offline_reason
  FROM seen),
dim AS (
  SELECT concat('R', CASE WHEN s_suppkey < 10000 THEN lpad(CAST(s_suppkey AS STRING), 4, '0') ELSE CAST(s_suppkey AS STRING) END) AS restaurant_id,
         s_name AS restaurant_name,
         ['CENTRO','SALAMANCA','CHAMBERI','RETIRO','LATINA','MONCLOA','TETUAN','ARGANZUELA','CHAMARTIN','MALASANA'][s_suppkey % 10 + 1] AS zone_id,
         ['SPANISH','ITALIAN','JAPANESE','AMERICAN','MEXICAN','CHINESE','INDIAN','MIDDLE_EASTERN','THAI','HEALTHY','DESSERT'][s_suppkey % 11 + 1] AS cuisine_type,
         CASE WHEN s_suppkey % 10 < 2 THEN 'GOLD' WHEN s_suppkey % 10 < 7 THEN 'SILVER' ELSE 'BRONZE' END AS sla_tier,
         CAST(8 + s_suppkey % 18 AS DOUBLE) AS avg_prep_mean
  FROM supplier)
"""


def _tumbling(size: int) -> str:
    return (f"time_bucket(INTERVAL {size} MINUTE, event_time) AS window_start, "
            f"time_bucket(INTERVAL {size} MINUTE, event_time) + INTERVAL {size} MINUTE AS window_end")


def _sliding(source: str, size: int, slide: int, where: str = "true") -> str:
    """Rows repeated once per sliding window that covers them."""
    return (f"SELECT *, time_bucket(INTERVAL {slide} MINUTE, event_time) - w * INTERVAL {slide} MINUTE AS window_start, "
            f"time_bucket(INTERVAL {slide} MINUTE, event_time) - w * INTERVAL {slide} MINUTE + INTERVAL {size} MINUTE AS window_end "
            f"FROM {source}, range({size // slide}) AS r(w) WHERE {where}")


# --- metrics, each as a SELECT over a cleaned feed -------------------------------------------


def kpi_tumbling(o: str = "o") -> str:
    return f"""
SELECT {_tumbling(5)}, 'tumbling_5min' AS window_type, zone_id,
       count(*) FILTER (status = 'PLACED') AS order_count,
       sum(order_value_eur) FILTER (status = 'PLACED') AS total_revenue,
       avg(estimated_prep_minutes) AS avg_prep_minutes,
       CAST(0 AS BIGINT) AS cancellation_count, CAST(0 AS DOUBLE) AS cancellation_rate
FROM {o} WHERE status IN ('PLACED', 'CONFIRMED') GROUP BY ALL"""


def kpi_hopping(o: str = "o") -> str:
    rows = _sliding(o, 15, 5, "status IN ('PLACED', 'CANCELLED')")
    return f"""
SELECT window_start, window_end, 'hopping_15min_5slide' AS window_type, zone_id,
       count(*) AS order_count, CAST(0 AS DOUBLE) AS total_revenue,
       CAST(NULL AS DOUBLE) AS avg_prep_minutes,
       count(*) FILTER (status = 'CANCELLED') AS cancellation_count,
       count(*) FILTER (status = 'CANCELLED') / count(*) AS cancellation_rate
FROM ({rows}) GROUP BY window_start, window_end, zone_id"""


def kpis_all(o: str = "o") -> str:
    return f"{kpi_tumbling(o)} UNION ALL {kpi_hopping(o)}"


def demand(o: str = "o", counted: str = "count(DISTINCT order_id)") -> str:
    return f"""
SELECT {_tumbling(5)}, zone_id, {counted} AS pending_demand
FROM {o} WHERE status IN ('PLACED', 'CONFIRMED', 'PREPARING', 'READY_FOR_PICKUP') GROUP BY ALL"""


def supply(c: str = "c", counted: str = "count(DISTINCT courier_id)") -> str:
    return f"""
SELECT {_tumbling(5)}, zone_id, {counted} AS available_supply
FROM {c} WHERE status = 'ONLINE_IDLE' GROUP BY ALL"""


def health(o: str = "o", c: str = "c", join: str = "FULL JOIN") -> str:
    return f"""
SELECT window_start, window_end, zone_id, pending_demand, available_supply, health_ratio,
       CASE WHEN health_ratio < 1 THEN 'healthy' WHEN health_ratio < 2 THEN 'moderate'
            WHEN health_ratio < 4 THEN 'stressed' ELSE 'critical' END AS health_status
FROM (SELECT window_start, window_end, zone_id,
             coalesce(pending_demand, 0) AS pending_demand,
             coalesce(available_supply, 0) AS available_supply,
             CAST(coalesce(pending_demand, 0) AS DOUBLE) / greatest(coalesce(available_supply, 0), 1) AS health_ratio
      FROM ({demand(o)}) {join} ({supply(c)}) USING (window_start, window_end, zone_id))"""


_BREACH = """coalesce(p95_prep > CASE sla_tier WHEN 'GOLD' THEN 15 WHEN 'SILVER' THEN 25
                                                  WHEN 'BRONZE' THEN 35 END, false)"""


def sla(o: str = "o", size: int = 15, extra: str = "") -> str:
    return f"""
SELECT *, {_BREACH} AS sla_breached
FROM (SELECT {_tumbling(size)}, restaurant_id, restaurant_name, d.zone_id, cuisine_type AS cuisine,
             sla_tier, count(*) AS order_count,
             CAST(quantile_disc(actual_prep_minutes, 0.50) AS DOUBLE) AS p50_prep,
             CAST(quantile_disc(actual_prep_minutes, 0.95) AS DOUBLE) AS p95_prep,
             CAST(quantile_disc(actual_prep_minutes, 0.99) AS DOUBLE) AS p99_prep{extra}
      FROM {o} d LEFT JOIN (SELECT * EXCLUDE (zone_id) FROM dim) USING (restaurant_id)
      WHERE status = 'DELIVERED' AND actual_prep_minutes IS NOT NULL GROUP BY ALL)"""


def anomalies(o: str = "o", size: int = 30, slide: int = 5) -> str:
    rows = _sliding(o, size, slide, "status = 'DELIVERED' AND actual_delivery_minutes IS NOT NULL")
    return f"""
SELECT window_start, window_end, zone_id, count(*) AS delivery_count,
       avg(actual_delivery_minutes) AS mean_delivery_min,
       stddev_samp(actual_delivery_minutes) AS stddev_delivery_min,
       avg(actual_delivery_minutes) + 2 * stddev_samp(actual_delivery_minutes) AS anomaly_threshold,
       count(*) FILTER (actual_delivery_minutes > 60) AS anomaly_count,
       count(*) FILTER (is_late) AS late_event_count
FROM ({rows}) GROUP BY window_start, window_end, zone_id"""


def devices(o: str = "o") -> str:
    return f"""
SELECT {_tumbling(60)}, device_id, count(DISTINCT customer_id) AS distinct_customer_ids,
       count(*) FILTER (status = 'PLACED') AS placed_count,
       count(*) FILTER (status = 'CANCELLED') AS cancellation_count,
       count(*) FILTER (status = 'REFUNDED') AS refund_count,
       sum(order_value_eur) AS total_order_value
FROM {o} WHERE device_id IS NOT NULL GROUP BY ALL"""


def fraud(o: str = "o") -> str:
    return f"""
SELECT * EXCLUDE (placed_count),
       concat_ws(', ', CASE WHEN cancellation_count >= 3 THEN 'HIGH_CANCELLATION' END,
                       CASE WHEN distinct_customer_ids >= 2 THEN 'ACCOUNT_HOPPING' END,
                       CASE WHEN refund_count >= 2 THEN 'HIGH_REFUNDS' END) AS fraud_flags
FROM ({devices(o)})
WHERE cancellation_count >= 3 OR distinct_customer_ids >= 2 OR refund_count >= 2"""


def positions(c: str = "c") -> str:
    return f"""
SELECT courier_id, zone_id, latitude, longitude, speed_kmh, status, vehicle_type,
       event_time AS position_time, event_id AS position_event_id
FROM {c} QUALIFY row_number() OVER (PARTITION BY courier_id ORDER BY event_time DESC, event_id DESC) = 1"""


def _gap_sessions(closed_only: bool) -> str:
    closed = ("WHERE session_end <= (SELECT date_trunc('millisecond', max(event_time)) - INTERVAL 3 MINUTE FROM c)"
              if closed_only else "")
    return f"""
SELECT * FROM (
  SELECT courier_id, min(event_time) AS session_start,
         max(event_time) + INTERVAL 30 MINUTE AS session_end, count(*) AS event_count
  FROM (SELECT *, sum(fresh) OVER (PARTITION BY courier_id ORDER BY event_time, event_id
                                   ROWS UNBOUNDED PRECEDING) AS session
        FROM (SELECT *, CASE WHEN event_time <= lag(event_time) OVER (PARTITION BY courier_id ORDER BY event_time, event_id)
                                                + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM c))
  GROUP BY courier_id, session) {closed}"""


_EVEN, _ODD = ("(SELECT * FROM {0} WHERE minute(ingestion_time) % 2 = 0)",
               "(SELECT * FROM {0} WHERE minute(ingestion_time) % 2 = 1)")


def _merged(metric, keys: tuple[str, ...], columns: dict[str, str], feeds: str = "o") -> str:
    """Full join of the two halves: one side alone is kept, both follow the rule per column."""
    def half(text: str) -> str:
        return metric(*[text.format(f) for f in feeds])

    on = " AND ".join(f"p.{k} = n.{k}" for k in keys)
    key_columns = ", ".join(f"coalesce(p.{k}, n.{k}) AS {k}" for k in keys)
    probe = keys[0]
    values = ", ".join(
        f"CASE WHEN n.{probe} IS NULL THEN p.{c} WHEN p.{probe} IS NULL THEN n.{c} ELSE {rule} END AS {c}"
        for c, rule in columns.items())
    return f"SELECT {key_columns}, {values} FROM ({half(_EVEN)}) p FULL JOIN ({half(_ODD)}) n ON {on}"


def _plus(*columns: str) -> dict[str, str]:
    return {c: f"p.{c} + n.{c}" for c in columns}


def _new(*columns: str) -> dict[str, str]:
    return {c: f"n.{c}" for c in columns}


def _old(*columns: str) -> dict[str, str]:
    return {c: f"p.{c}" for c in columns}


_KPI_KEYS = ("window_start", "window_end", "window_type", "zone_id")
_ZONE_KEYS = ("window_start", "window_end", "zone_id")
_KPI_VALUES = ("order_count", "total_revenue", "avg_prep_minutes", "cancellation_count",
               "cancellation_rate")

_ARCHIVE = """
SELECT year(event_time) AS year, month(event_time) AS month, day(event_time) AS day,
       hour(event_time) AS hour, count(*) AS event_count, sum(order_value_eur) AS order_value
FROM o GROUP BY ALL"""



def _orphans(drops: str = "true", within: str | None = "2 HOUR") -> str:
    """Of an order's drops the last one counts; in transit at or before it, not delivered at or after
    it, both within two hours or, without a bound, ever."""
    since = f"AND t.event_time >= d.event_time - INTERVAL {within}" if within else ""
    until = f"AND v.event_time <= _q.event_time + INTERVAL {within}" if within else ""
    return f"""
SELECT order_id, zone_id, courier_id AS dropped_courier_id, event_time AS drop_time, in_transit_time
FROM (SELECT d.*, (SELECT max(t.event_time) FROM o t WHERE t.order_id = d.order_id
                   AND t.status = 'IN_TRANSIT' AND t.event_time <= d.event_time {since}) AS in_transit_time
      FROM (SELECT * FROM c WHERE status = 'OFFLINE' AND offline_reason = 'MID_DELIVERY_DROP'
                              AND order_id IS NOT NULL AND {drops}
            QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY event_time DESC, event_id DESC) = 1) d) _q
WHERE in_transit_time IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM o v WHERE v.order_id = _q.order_id AND v.status = 'DELIVERED'
                                       AND v.event_time >= _q.event_time {until})"""


def _both_newest(orders: str, couriers: str) -> str:
    """The watermark that a query over both feeds ends with.

    The feeds arrive in drops of eight hours and the query starts again for each: only a drop with
    rows of both feeds moves the watermark, to where the slower of the two is.
    """
    def drops(feed: str, delay: int, where: str) -> str:
        return (f"SELECT epoch_us(ingestion_time) // 28800000000 AS drop_no, "
                f"date_trunc('millisecond', max(event_time)) - INTERVAL {delay} MINUTE AS newest "
                f"FROM {feed} WHERE {where} GROUP BY 1")

    return (f"(SELECT max(least(x.newest, y.newest)) FROM ({drops('o', 5, orders)}) x "
            f"JOIN ({drops('c', 3, couriers)}) y USING (drop_no))")


# The drops whose two hours are over when the streams have read all.
_TOLD_DROPS = f"""event_time + INTERVAL 2 HOUR < {_both_newest(
    "status IN ('IN_TRANSIT', 'DELIVERED')",
    "offline_reason = 'MID_DELIVERY_DROP' AND order_id IS NOT NULL")}"""


def _newest(feed: str, delay: int, where: str = "true") -> str:
    """The watermark that a stream of these rows ends with."""
    return (f"(SELECT date_trunc('millisecond', max(event_time)) - INTERVAL {delay} MINUTE "
            f"FROM {feed} WHERE {where})")


_SESSIONS = """
SELECT active_session_id, courier_id, least(min(session_start_time), min(event_time)) AS session_start,
       max(event_time) AS session_end, count(*) AS event_count,
       (epoch_us(max(event_time)) - epoch_us(least(min(session_start_time), min(event_time)))) / 60000000 AS session_minutes,
       count(*) FILTER (status = 'OFFLINE') > 0 AS is_closed
FROM c GROUP BY active_session_id, courier_id"""

_QUALITY_FLAGS = """
SELECT * FROM (
  SELECT event_id, courier_id, zone_id, event_time AS event_timestamp, speed_kmh,
         location_accuracy_meters, battery_pct,
         concat_ws(', ', CASE WHEN speed_kmh >= 200 THEN 'IMPOSSIBLE_SPEED' END,
                         CASE WHEN location_accuracy_meters > 100 THEN 'POOR_ACCURACY' END,
                         CASE WHEN status = 'OFFLINE' AND before <= 10 THEN 'LOW_BATTERY_OFFLINE' END) AS quality_flags
  FROM (SELECT *, lag(battery_pct) OVER (PARTITION BY courier_id ORDER BY event_time, event_id) AS before
        FROM c)) WHERE quality_flags <> ''"""

_IMPOSSIBLE = """
SELECT event_id, order_id, zone_id, event_time AS event_timestamp, actual_delivery_minutes,
       CASE WHEN actual_delivery_minutes < 1 THEN 'TOO_SHORT' ELSE 'TOO_LONG' END AS kind
FROM o WHERE status = 'DELIVERED' AND (actual_delivery_minutes < 1 OR actual_delivery_minutes > 120)"""

_LIFE_STEPS = "status IN ('PLACED', 'READY_FOR_PICKUP', 'PICKED_UP', 'DELIVERED')"


def _durations(over: str = "") -> str:
    return f"""
SELECT order_id, (epoch_us(d) - epoch_us(p)) / 60000000 AS placed_to_delivered_min,
       (epoch_us(u) - epoch_us(r)) / 60000000 AS ready_to_pickup_min,
       (epoch_us(d) - epoch_us(u)) / 60000000 AS pickup_to_delivered_min
FROM (SELECT order_id, min(event_time) FILTER (status = 'PLACED') AS p,
             min(event_time) FILTER (status = 'READY_FOR_PICKUP') AS r,
             min(event_time) FILTER (status = 'PICKED_UP') AS u,
             min(event_time) FILTER (status = 'DELIVERED') AS d
      FROM o WHERE {_LIFE_STEPS} GROUP BY order_id {over})"""


def _multi_account() -> str:
    return f"""
SELECT window_start, window_end, device_id, distinct_customer_ids, placed_count, cancellation_count,
       cancellation_count / greatest(placed_count, 1) AS cancellation_rate
FROM ({devices()})
WHERE distinct_customer_ids > 3 AND cancellation_count / greatest(placed_count, 1) >= 0.5"""


def _utilisation() -> str:
    return f"""
SELECT window_start, window_end, zone_id, count(DISTINCT courier_id) AS online_couriers,
       count(DISTINCT courier_id) FILTER (status <> 'ONLINE_IDLE') AS busy_couriers,
       count(DISTINCT courier_id) FILTER (status <> 'ONLINE_IDLE') / count(DISTINCT courier_id) AS utilisation
FROM ({_sliding('c', 15, 5, "status NOT IN ('OFFLINE', 'BREAK')")}) GROUP BY ALL"""


def _surge() -> str:
    return f"""
SELECT * EXCLUDE (available_supply), coalesce(available_supply, 0) AS available_supply,
       pending_demand / greatest(trailing_demand, 1) AS surge_ratio,
       pending_demand / greatest(trailing_demand, 1) >= 1.5
         AND pending_demand > coalesce(available_supply, 0) AS is_surge
FROM (SELECT window_start, window_end, zone_id, pending_demand,
             coalesce(sum(pending_demand) OVER (PARTITION BY zone_id ORDER BY window_start
                      RANGE BETWEEN INTERVAL 30 MINUTE PRECEDING AND INTERVAL 5 MINUTE PRECEDING), 0) / 6 AS trailing_demand
      FROM ({demand()})) LEFT JOIN ({supply()}) USING (window_start, window_end, zone_id)"""


# Rows whose 5-minute window the watermark had not passed: hourly drops, one second of delay; the
# watermark of a drop follows from the drops before it.
_IN_TIME = """(
  SELECT o.* FROM (SELECT *, (epoch_us(ingestion_time) + 150000000) // 3600000000 AS drop_no FROM o) o
  JOIN (SELECT drop_no, max(newest) OVER (ORDER BY drop_no ROWS BETWEEN UNBOUNDED PRECEDING
                                          AND 1 PRECEDING) - INTERVAL 1 SECOND AS watermark
        FROM (SELECT (epoch_us(ingestion_time) + 150000000) // 3600000000 AS drop_no,
                     date_trunc('millisecond', max(event_time)) AS newest FROM o
              WHERE status IN ('PLACED', 'CONFIRMED') GROUP BY 1)) w
  ON o.drop_no = w.drop_no
  WHERE w.watermark IS NULL
     OR time_bucket(INTERVAL 5 MINUTE, event_time) + INTERVAL 5 MINUTE > w.watermark)"""

# Message text of the events that carry no order: JSON without an id, and no JSON at all.
_REJECTS = """
SELECT props AS raw_value FROM events UNION ALL SELECT url FROM pages"""

_TEXTS: dict[str, str] = {
    # Wire times have millisecond resolution.
    "decode_json_orders": """
SELECT event_id, order_id, zone_id, status, date_trunc('millisecond', event_time) AS event_timestamp,
       date_trunc('millisecond', ingestion_time) AS ingestion_time, order_value_eur,
       estimated_prep_minutes, device_id, is_late FROM orders_feed""",
    "scan_json_files": """
SELECT event_id, status, date_trunc('millisecond', event_time) AS event_time, order_value_eur,
       actual_prep_minutes, is_duplicate FROM orders_feed""",
    "dim_restaurant": "SELECT * FROM dim",
    "validate_orders": """
SELECT event_id, order_id, status, date_trunc('millisecond', event_time) AS event_time FROM orders_feed""",
    "dead_letters": f"""
SELECT raw_value, CASE WHEN NOT json_valid(raw_value) THEN 'malformed' ELSE 'missing_event_id' END AS reason,
       count(*) AS message_count FROM ({_REJECTS}) GROUP BY ALL""",
    "dedup_by_flag": "SELECT event_id, status, event_time FROM o",
    "dedup_by_key": "SELECT DISTINCT event_id, status, event_time FROM orders_feed",
    "lateness_buckets": """
SELECT CASE WHEN d < 60 THEN 'on_time' WHEN d < 120 THEN '1_min' WHEN d < 180 THEN '2_min'
            WHEN d < 240 THEN '3_min' WHEN d < 300 THEN '4_min' ELSE '5_min_or_more' END AS lateness_bucket,
       count(*) AS event_count, count(*) FILTER (is_late) AS flagged_late_count,
       count(*) / (SELECT count(*) FROM o) AS event_share
FROM (SELECT is_late, (epoch_us(ingestion_time) - epoch_us(event_time)) / 1000000 AS d FROM o)
GROUP BY 1""",
    "raw_partition_columns": f"SELECT * EXCLUDE (order_value) FROM ({_ARCHIVE})",
    "kpi_tumbling": kpi_tumbling(),
    "kpi_hopping": kpi_hopping(),
    "windowed_kpis_all": kpis_all(),
    "demand_windows": demand(),
    "demand_event_windows": demand(counted="count(*)"),
    "supply_windows": supply(),
    "supply_event_windows": supply(counted="count(*)"),
    "demand_supply_health": health(),
    "demand_supply_health_resurfaced": health(f"""(
SELECT order_id, zone_id, event_time, status FROM o
UNION ALL SELECT order_id, zone_id, drop_time, 'PLACED' FROM ({_orphans()}))"""),
    "health_from_supply_side": health(join="RIGHT JOIN"),
    "enrich_orders": """
SELECT event_id, restaurant_id, restaurant_name, x.zone_id, cuisine_type, sla_tier, actual_prep_minutes
FROM o x LEFT JOIN (SELECT * EXCLUDE (zone_id) FROM dim) USING (restaurant_id)
WHERE status = 'DELIVERED' AND actual_prep_minutes IS NOT NULL""",
    "enrich_orders_right": """
SELECT d.restaurant_id, restaurant_name, event_id, actual_prep_minutes
FROM (SELECT * FROM o WHERE status = 'DELIVERED' AND actual_prep_minutes IS NOT NULL) x
RIGHT JOIN dim d ON d.restaurant_id = x.restaurant_id""",
    "demand_windows_approx": f"SELECT *, true AS within_error FROM ({demand()})",
    "supply_windows_approx": f"SELECT *, true AS within_error FROM ({supply()})",
    "fraud_windows_approx": f"SELECT *, true AS within_error FROM ({devices()})",
    "sla_windows": sla(),
    "sla_30min": sla(size=30, extra=", avg(actual_prep_minutes - estimated_prep_minutes) AS avg_prep_error"),
    "anomaly_windows": anomalies(),
    "anomaly_10_2": anomalies(size=10, slide=2),
    "anomaly_flagged_deliveries": f"""
SELECT event_id, order_id, x.zone_id, event_time AS event_timestamp, actual_delivery_minutes,
       window_start, window_end, anomaly_threshold,
       (actual_delivery_minutes - mean_delivery_min) / stddev_delivery_min AS z_score
FROM o x JOIN ({anomalies()}) a
  ON a.zone_id = x.zone_id AND event_time >= window_start AND event_time < window_end
WHERE status = 'DELIVERED' AND actual_delivery_minutes > anomaly_threshold""",
    "impossible_deliveries": _IMPOSSIBLE, "stream_impossible_deliveries": _IMPOSSIBLE,
    "fraud_windows": fraud(),
    "fraud_multi_account": _multi_account(),
    "stream_fraud_multi_account": _multi_account(),
    "courier_latest_position": positions(),
    "courier_utilisation": _utilisation(),
    "stream_courier_utilisation": f"""
SELECT * FROM ({_utilisation()}) WHERE window_end <= {_newest('c', 3, "status NOT IN ('OFFLINE', 'BREAK')")}""",
    "courier_sessions": _SESSIONS,
    "stream_shift_sessions": _SESSIONS,
    "courier_gap_sessions": _gap_sessions(False),
    "stream_courier_sessions": _gap_sessions(True),
    "courier_quality_flags": _QUALITY_FLAGS,
    "stream_courier_quality_flags": f"SELECT * FROM ({_QUALITY_FLAGS}) WHERE event_timestamp < {_newest('c', 3)}",
    "orphaned_deliveries": _orphans(within=None),
    "stream_orphaned_deliveries": _orphans(_TOLD_DROPS),
    "stream_orders_per_minute": f"""
SELECT {_tumbling(1)}, zone_id, count(*) AS order_count FROM o WHERE status = 'PLACED' GROUP BY ALL""",
    "stream_revenue_per_hour": f"""
SELECT {_tumbling(60)}, count(*) AS delivered_count, sum(order_value_eur) AS total_revenue
FROM o WHERE status = 'DELIVERED' GROUP BY ALL""",
    "orders_per_minute": f"""
SELECT {_tumbling(1)}, zone_id, count(*) AS order_count FROM o WHERE status = 'PLACED' GROUP BY ALL""",
    "revenue_per_hour": f"""
SELECT {_tumbling(60)}, count(*) AS delivered_count, sum(order_value_eur) AS total_revenue
FROM o WHERE status = 'DELIVERED' GROUP BY ALL""",
    "order_durations": _durations(),
    # Orders that were delivered, or had been silent for six hours, when the feed ended.
    "stream_order_durations": _durations(f"""
HAVING coalesce(min(event_time) FILTER (status = 'DELIVERED'), max(event_time) + INTERVAL 6 HOUR)
       < {_newest('o', 5, _LIFE_STEPS)}"""),
    "surge_signal": _surge(),
    "stream_surge_signal": f"""
SELECT * FROM ({_surge()}) WHERE window_end <= {_both_newest(
    "status IN ('PLACED', 'CONFIRMED', 'PREPARING', 'READY_FOR_PICKUP')", "status = 'ONLINE_IDLE'")}""",
    "merge_windowed_kpis": _merged(kpis_all, _KPI_KEYS, {
        **_plus("order_count", "cancellation_count"),
        "total_revenue": "coalesce(p.total_revenue, 0) + coalesce(n.total_revenue, 0)",
        "avg_prep_minutes": "coalesce(n.avg_prep_minutes, p.avg_prep_minutes)",
        "cancellation_rate": "(p.cancellation_count + n.cancellation_count) / greatest(p.order_count + n.order_count, 1)",
    }),
    "merge_demand": _merged(demand, _ZONE_KEYS, _plus("pending_demand")),
    "merge_restaurant_sla": _merged(sla, ("window_start", "window_end", "restaurant_id", "zone_id"), {
        **_old("restaurant_name", "cuisine", "sla_tier"), **_plus("order_count"),
        **_new("p50_prep", "p95_prep", "p99_prep", "sla_breached")}),
    "merge_delivery_anomalies": _merged(anomalies, _ZONE_KEYS, {
        **_plus("delivery_count", "anomaly_count", "late_event_count"),
        **_new("mean_delivery_min", "stddev_delivery_min", "anomaly_threshold")}),
    "merge_fraud_alerts": _merged(fraud, ("window_start", "window_end", "device_id"), {
        "distinct_customer_ids": "greatest(p.distinct_customer_ids, n.distinct_customer_ids)",
        **_plus("cancellation_count", "refund_count", "total_order_value"), **_new("fraud_flags")}),
    # Halves that were merged by sketches and moments agree with the whole feed.
    "merge_sla_parts": sla(), "merge_device_parts": fraud(), "merge_demand_parts": demand(),
    "merge_delivery_parts": anomalies(),
    "merge_courier_positions": positions(),
    "merge_health": _merged(health, _ZONE_KEYS, _new(
        "pending_demand", "available_supply", "health_ratio", "health_status"), feeds="oc"),
    "merge_replace": _merged(lambda o: demand(o, "count(*)"), _ZONE_KEYS, _new("pending_demand")),
    "nan_to_null": """
SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN sqrt(c_acctbal) END AS root FROM customer""",
    "raw_archive_roundtrip": _ARCHIVE,
    "archive_after_compaction": _ARCHIVE,
    "stream_archive": _ARCHIVE,
    "agg_archive_roundtrip": f"""
SELECT *, year(window_start) AS year, month(window_start) AS month, day(window_start) AS day
FROM ({kpis_all()})""",
    "upsert_latest_view": _merged(kpis_all, _KPI_KEYS, _new(*_KPI_VALUES)),
    "upsert_after_restart": _merged(kpis_all, _KPI_KEYS, _new(*_KPI_VALUES)),
    "publish_frame": """
SELECT zone_id AS "key", count(*) AS message_count, count(*) FILTER (status = 'PLACED') AS placed_count
FROM o GROUP BY zone_id""",
    "serve_stat_cards": f"""
SELECT 'total_orders' AS card, CAST(sum(order_count) AS DOUBLE) AS value FROM ({kpi_tumbling()})
UNION ALL SELECT 'total_revenue', sum(total_revenue) FROM ({kpi_tumbling()})
UNION ALL SELECT 'avg_prep_minutes', avg(avg_prep_minutes) FROM ({kpi_tumbling()})
UNION ALL SELECT 'cancellation_rate', sum(cancellation_count) / sum(order_count) FROM ({kpi_hopping()})
UNION ALL SELECT 'sla_breaches', CAST(count(*) FILTER (sla_breached) AS DOUBLE) FROM ({sla()})
UNION ALL SELECT 'fraud_alerts', CAST(count(*) AS DOUBLE) FROM ({fraud()})""",
    "serve_orders_by_zone": f"""
SELECT window_start, zone_id, order_count, total_revenue FROM ({kpi_tumbling()})
WHERE zone_id IN ('CENTRO', 'RETIRO', 'TETUAN')""",
    "serve_current_by_zone": f"""
SELECT * FROM (
  SELECT zone_id, window_end AS rate_window_end, cancellation_rate FROM ({kpi_hopping()})
  QUALIFY row_number() OVER (PARTITION BY zone_id ORDER BY window_end DESC) = 1)
FULL JOIN (
  SELECT zone_id, window_end AS health_window_end, health_ratio, health_status FROM ({health()})
  QUALIFY row_number() OVER (PARTITION BY zone_id ORDER BY window_end DESC) = 1) USING (zone_id)""",
    "serve_worst_restaurants": f"""
SELECT restaurant_id, restaurant_name, sla_tier, max(p95_prep) AS worst_p95_prep,
       count(*) FILTER (sla_breached) AS breached_windows
FROM ({sla()}) GROUP BY ALL ORDER BY worst_p95_prep DESC, restaurant_id LIMIT 10""",
    "serve_anomaly_series": f"""
SELECT window_start, zone_id, mean_delivery_min, anomaly_threshold, anomaly_count, late_event_count
FROM ({anomalies()})""",
    "serve_fraud_table": f"""
SELECT window_start, device_id, distinct_customer_ids, cancellation_count, refund_count, fraud_flags
FROM ({fraud()})""",
    "stream_kpi_tumbling": kpi_tumbling(),
    "stream_kpi_hopping": kpi_hopping(),
    "stream_demand_supply": health(),
    "stream_sla": sla(),
    "stream_anomaly": anomalies(),
    "stream_fraud": fraud(),
    "stream_courier_latest": positions(),
    "stream_dedup": kpi_tumbling(),
    "stream_fraud_short_drops": fraud(),
    "stream_kpi_late_rows": kpi_tumbling(_IN_TIME),
    "stream_rows_set_aside": f"""
SELECT event_id, status, event_time FROM o WHERE status IN ('PLACED', 'CONFIRMED')
  AND event_id NOT IN (SELECT event_id FROM {_IN_TIME})""",
}

# Columns compared to six decimals, and whole numbers compared as BIGINT.
_ROUNDED = (
    "order_value_eur", "avg_prep_mean", "event_share", "total_revenue", "avg_prep_minutes",
    "cancellation_rate", "health_ratio", "p50_prep", "p95_prep", "p99_prep", "avg_prep_error",
    "mean_delivery_min", "stddev_delivery_min", "anomaly_threshold", "z_score",
    "total_order_value", "latitude", "longitude", "speed_kmh", "location_accuracy_meters",
    "utilisation", "session_minutes", "placed_to_delivered_min", "ready_to_pickup_min",
    "pickup_to_delivered_min", "trailing_demand", "surge_ratio", "root", "order_value", "value",
    "worst_p95_prep",
)
_WHOLE = (
    "order_count", "cancellation_count", "pending_demand", "available_supply",
    "distinct_customer_ids", "placed_count", "refund_count", "event_count", "flagged_late_count",
    "delivery_count", "anomaly_count", "late_event_count", "estimated_prep_minutes",
    "actual_prep_minutes", "actual_delivery_minutes", "battery_pct", "online_couriers",
    "busy_couriers", "delivered_count", "year", "month", "day", "hour", "message_count",
    "breached_windows", "c_custkey",
)


# Result columns per query.
_KPI = (*_KPI_KEYS, *_KPI_VALUES)
_DEMAND = (*_ZONE_KEYS, "pending_demand")
_SUPPLY = (*_ZONE_KEYS, "available_supply")
_HEALTH = (*_ZONE_KEYS, "pending_demand", "available_supply", "health_ratio", "health_status")
_SLA = ("window_start", "window_end", "restaurant_id", "restaurant_name", "zone_id", "cuisine",
        "sla_tier", "order_count", "p50_prep", "p95_prep", "p99_prep", "sla_breached")
_ANOMALY = (*_ZONE_KEYS, "delivery_count", "mean_delivery_min", "stddev_delivery_min",
            "anomaly_threshold", "anomaly_count", "late_event_count")
_FRAUD = ("window_start", "window_end", "device_id", "distinct_customer_ids",
          "cancellation_count", "refund_count", "total_order_value", "fraud_flags")
_POSITION = ("courier_id", "zone_id", "latitude", "longitude", "speed_kmh", "status",
             "vehicle_type", "position_time", "position_event_id")
_SESSION = ("courier_id", "session_start", "session_end", "event_count")
_HOURLY = ("year", "month", "day", "hour", "event_count")

_COLUMNS: dict[str, tuple[str, ...]] = {
    "impossible_deliveries": ("event_id", "order_id", "zone_id", "event_timestamp",
        "actual_delivery_minutes", "kind"),
    "stream_impossible_deliveries": ("event_id", "order_id", "zone_id", "event_timestamp",
        "actual_delivery_minutes", "kind"),
    "stream_rows_set_aside": ("event_id", "status", "event_time"),
    "stream_fraud_multi_account": ("window_start", "window_end", "device_id",
        "distinct_customer_ids", "placed_count", "cancellation_count", "cancellation_rate"),
    "stream_courier_utilisation": (*_ZONE_KEYS, "online_couriers", "busy_couriers", "utilisation"),
    "stream_shift_sessions": ("active_session_id", "courier_id", "session_start", "session_end",
        "event_count", "session_minutes", "is_closed"),
    "stream_courier_quality_flags": ("event_id", "courier_id", "zone_id", "event_timestamp",
        "speed_kmh", "location_accuracy_meters", "battery_pct", "quality_flags"),
    "stream_order_durations": ("order_id", "placed_to_delivered_min", "ready_to_pickup_min",
        "pickup_to_delivered_min"),
    "stream_surge_signal": (*_ZONE_KEYS, "pending_demand", "trailing_demand", "available_supply",
        "surge_ratio", "is_surge"),
    "merge_sla_parts": _SLA, "merge_device_parts": _FRAUD, "merge_demand_parts": _DEMAND,
    "merge_delivery_parts": _ANOMALY,
    "decode_json_orders": ("event_id", "order_id", "zone_id", "status", "event_timestamp",
        "ingestion_time", "order_value_eur", "estimated_prep_minutes", "device_id", "is_late"),
    "scan_json_files": ("event_id", "status", "event_time", "order_value_eur",
        "actual_prep_minutes", "is_duplicate"),
    "dim_restaurant": ("restaurant_id", "restaurant_name", "zone_id", "cuisine_type", "sla_tier",
        "avg_prep_mean"),
    "validate_orders": ("event_id", "order_id", "status", "event_time"),
    "dead_letters": ("raw_value", "reason", "message_count"),
    "dedup_by_flag": ("event_id", "status", "event_time"),
    "dedup_by_key": ("event_id", "status", "event_time"),
    "lateness_buckets": ("lateness_bucket", "event_count", "flagged_late_count", "event_share"),
    "raw_partition_columns": _HOURLY,
    "kpi_tumbling": _KPI,
    "kpi_hopping": _KPI,
    "windowed_kpis_all": _KPI,
    "demand_windows": _DEMAND,
    "demand_event_windows": _DEMAND,
    "supply_windows": _SUPPLY,
    "supply_event_windows": _SUPPLY,
    "demand_supply_health": _HEALTH, "demand_supply_health_resurfaced": _HEALTH,
    "health_from_supply_side": _HEALTH,
    "enrich_orders": ("event_id", "restaurant_id", "restaurant_name", "zone_id", "cuisine_type",
        "sla_tier", "actual_prep_minutes"),
    "sla_windows": _SLA,
    "sla_30min": (*_SLA, "avg_prep_error"),
    "anomaly_windows": _ANOMALY,
    "anomaly_10_2": _ANOMALY,
    "anomaly_flagged_deliveries": ("event_id", "order_id", "zone_id", "event_timestamp",
        "actual_delivery_minutes", "window_start", "window_end", "anomaly_threshold", "z_score"),
    "fraud_windows": _FRAUD,
    "fraud_multi_account": ("window_start", "window_end", "device_id", "distinct_customer_ids",
        "placed_count", "cancellation_count", "cancellation_rate"),
    "courier_latest_position": _POSITION,
    "courier_utilisation": (*_ZONE_KEYS, "online_couriers", "busy_couriers", "utilisation"),
    "courier_sessions": ("active_session_id", "courier_id", "session_start", "session_end",
        "event_count", "session_minutes", "is_closed"),
    "courier_gap_sessions": _SESSION,
    "stream_courier_sessions": _SESSION,
    "courier_quality_flags": ("event_id", "courier_id", "zone_id", "event_timestamp",
        "speed_kmh", "location_accuracy_meters", "battery_pct", "quality_flags"),
    "orphaned_deliveries": ("order_id", "zone_id", "dropped_courier_id", "drop_time",
        "in_transit_time"),
    "stream_orphaned_deliveries": ("order_id", "zone_id", "dropped_courier_id", "drop_time",
        "in_transit_time"),
    "stream_orders_per_minute": (*_ZONE_KEYS, "order_count"),
    "stream_revenue_per_hour": ("window_start", "window_end", "delivered_count", "total_revenue"),
    "enrich_orders_right": ("restaurant_id", "restaurant_name", "event_id", "actual_prep_minutes"),
    "demand_windows_approx": (*_DEMAND, "within_error"),
    "supply_windows_approx": (*_SUPPLY, "within_error"),
    "fraud_windows_approx": ("window_start", "window_end", "device_id", "distinct_customer_ids",
        "placed_count", "cancellation_count", "refund_count", "total_order_value", "within_error"),
    "upsert_after_restart": _KPI,
    "orders_per_minute": (*_ZONE_KEYS, "order_count"),
    "revenue_per_hour": ("window_start", "window_end", "delivered_count", "total_revenue"),
    "order_durations": ("order_id", "placed_to_delivered_min", "ready_to_pickup_min",
        "pickup_to_delivered_min"),
    "surge_signal": (*_DEMAND, "trailing_demand", "available_supply", "surge_ratio", "is_surge"),
    "merge_windowed_kpis": _KPI,
    "merge_demand": _DEMAND,
    "merge_restaurant_sla": _SLA,
    "merge_delivery_anomalies": _ANOMALY,
    "merge_fraud_alerts": _FRAUD,
    "merge_courier_positions": _POSITION,
    "merge_health": _HEALTH,
    "merge_replace": _DEMAND,
    "nan_to_null": ("c_custkey", "root"),
    "archive_after_compaction": (*_HOURLY, "order_value"),
    "raw_archive_roundtrip": (*_HOURLY, "order_value"),
    "stream_archive": (*_HOURLY, "order_value"),
    "agg_archive_roundtrip": (*_KPI, "year", "month", "day"),
    "upsert_latest_view": _KPI,
    "publish_frame": ("key", "message_count", "placed_count"),
    "serve_stat_cards": ("card", "value"),
    "serve_orders_by_zone": ("window_start", "zone_id", "order_count", "total_revenue"),
    "serve_current_by_zone": ("zone_id", "rate_window_end", "cancellation_rate",
        "health_window_end", "health_ratio", "health_status"),
    "serve_worst_restaurants": ("restaurant_id", "restaurant_name", "sla_tier", "worst_p95_prep",
        "breached_windows"),
    "serve_anomaly_series": ("window_start", "zone_id", "mean_delivery_min", "anomaly_threshold",
        "anomaly_count", "late_event_count"),
    "serve_fraud_table": ("window_start", "device_id", "distinct_customer_ids",
        "cancellation_count", "refund_count", "fraud_flags"),
    "stream_kpi_tumbling": _KPI,
    "stream_kpi_hopping": _KPI,
    "stream_demand_supply": _HEALTH,
    "stream_sla": _SLA,
    "stream_anomaly": _ANOMALY,
    "stream_fraud": _FRAUD,
    "stream_courier_latest": _POSITION,
    "stream_dedup": _KPI,
    "stream_fraud_short_drops": _FRAUD,
    "stream_kpi_late_rows": _KPI,
}


def _finish(name: str, text: str) -> str:
    """Wrap an answer: feeds in front, result columns by name, one numeric form."""
    def form(c: str) -> str:
        if c in _ROUNDED:
            return f"round({c}, 6) AS {c}"
        return f"CAST({c} AS BIGINT) AS {c}" if c in _WHOLE else f'"{c}"'

    columns = ", ".join(form(c) for c in _COLUMNS[name])
    return f"{FEEDS}, answer AS ({text})\nSELECT {columns} FROM answer"


ORACLE_SQL: dict[str, str] = {name: _finish(name, text) for name, text in _TEXTS.items()}
