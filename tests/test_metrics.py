"""Edge rows of the metrics, made by hand."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import at
from zonepulse import MetricConfig
from zonepulse.functions.percentiles import discrete_percentiles
from zonepulse.operators import anomaly, demand_supply, fraud, kpis, sla
from zonepulse.operators import couriers as fleet
from zonepulse.model import METRIC_TABLES
from zonepulse.session import RECOMMENDED_CONF, sized_conf
from zonepulse.streaming.jobs import JOBS, Feeds


def test_only_confirmed(orders):
    row = kpis.tumbling_kpis(orders({"status": "CONFIRMED", "estimated_prep_minutes": 12})).first()
    assert (row.order_count, row.total_revenue, row.avg_prep_minutes) == (0, None, 12.0)


def test_window_edge_is_half_open(orders):
    rows = kpis.tumbling_kpis(orders({"event_time": at(5)})).collect()
    assert [(r.window_start.minute, r.window_end.minute) for r in rows] == [(5, 10)]


def test_cancelled_order_counts_twice(orders):
    df = orders({"event_time": at(16)}, {"status": "CANCELLED", "event_time": at(17)})
    rows = kpis.hopping_cancellations(df).collect()
    assert len(rows) == 3
    assert {(r.order_count, r.cancellation_count, r.cancellation_rate) for r in rows} == {(2, 1, 0.5)}


def test_combined_kpis_equal_both_families(orders):
    df = orders(
        {"event_time": at(1)}, {"event_time": at(2), "status": "CONFIRMED", "estimated_prep_minutes": 7},
        {"event_time": at(8), "status": "CANCELLED"}, {"event_time": at(21), "zone_id": "Z2"},
        {"event_time": at(33), "status": "CONFIRMED", "estimated_prep_minutes": None})
    for cfg in (MetricConfig(), MetricConfig(kpi_minutes=10, cancel_minutes=20, cancel_slide=4)):
        apart = kpis.tumbling_kpis(df, cfg).unionByName(kpis.hopping_cancellations(df, cfg))
        both = kpis.windowed_kpis(df, cfg)
        assert both.exceptAll(apart).count() == 0
        assert apart.exceptAll(both).count() == 0


@pytest.mark.parametrize("demand, status", [(0, "healthy"), (1, "moderate"), (2, "stressed"),
                                            (3, "stressed"), (4, "critical")])
def test_health_bounds(orders, couriers, demand, status):
    pending = [{"order_id": f"o{i}"} for i in range(demand)] or [{"status": "DELIVERED"}]
    row = demand_supply.demand_supply_health(orders(*pending), couriers({})).first()
    assert (row.pending_demand, row.available_supply) == (demand, 1)
    assert (row.health_ratio, row.health_status) == (float(demand), status)


def test_one_sided_zones(orders, couriers):
    o = orders(*[{"order_id": f"o{i}", "zone_id": "A"} for i in range(3)])
    c = couriers({"courier_id": "c1", "zone_id": "B"}, {"courier_id": "c2", "zone_id": "B"})
    rows = {r.zone_id: r for r in demand_supply.demand_supply_health(o, c).collect()}
    assert (rows["A"].available_supply, rows["A"].health_ratio, rows["A"].health_status) == (
        0, 3.0, "stressed")
    assert (rows["B"].pending_demand, rows["B"].health_status) == (0, "healthy")
    joined = demand_supply.join_health(demand_supply.demand_windows(o), demand_supply.supply_windows(c))
    assert {tuple(r) for r in joined.collect()} == {tuple(r) for r in rows.values()}
    right = demand_supply.join_health(
        demand_supply.demand_windows(o), demand_supply.supply_windows(c), how="right")
    assert [r.zone_id for r in right.collect()] == ["B"]


def test_demand_counts_orders_not_events(orders):
    df = orders({"status": "PLACED"}, {"status": "CONFIRMED"}, {"status": "PREPARING", "order_id": "o2"})
    assert demand_supply.demand_windows(df).first().pending_demand == 2
    assert demand_supply.demand_event_windows(df).first().pending_demand == 3


@pytest.mark.parametrize("restaurant, minutes, breached", [
    ("R1", 15, False), ("R1", 16, True), ("R2", 25, False), ("R2", 26, True),
    ("R3", 35, False), ("R3", 36, True), ("R9", 90, False)])
def test_sla_limits(orders, restaurants, restaurant, minutes, breached):
    df = orders({"status": "DELIVERED", "actual_prep_minutes": minutes, "restaurant_id": restaurant})
    row = sla.restaurant_sla(df, restaurants).first()
    assert row.sla_breached is breached
    assert row.p50_prep == row.p95_prep == row.p99_prep == float(minutes)
    assert row.zone_id == "Z1"
    assert (row.sla_tier is None) == (restaurant == "R9")


def test_percentiles_are_nearest_rank(spark):
    df = spark.range(1, 201).select((F.col("id") % 100 + 1).alias("v"), F.lit("k").alias("k"))
    row = discrete_percentiles(df, ["k"], "v", {"a": 50, "b": 95, "c": 99}, "n").first()
    assert (row.a, row.b, row.c, row.n) == (50, 95, 99, 200)
    sketch = df.groupBy("k").agg(F.percentile_approx("v", [0.5, 0.95, 0.99]).alias("p")).first()
    assert list(sketch.p) == [50, 95, 99]


def test_single_delivery_has_no_deviation(orders):
    rows = anomaly.delivery_anomalies(
        orders({"status": "DELIVERED", "actual_delivery_minutes": 20})).collect()
    assert len(rows) == 6
    assert all(r.stddev_delivery_min is None and r.anomaly_threshold is None for r in rows)
    assert all(r.anomaly_count == 0 and r.mean_delivery_min == 20.0 for r in rows)


def test_equal_deliveries_have_zero_deviation(orders):
    df = orders(*[{"status": "DELIVERED", "actual_delivery_minutes": 61} for _ in range(7)])
    row = anomaly.delivery_anomalies(df).first()
    assert (row.stddev_delivery_min, row.anomaly_threshold, row.anomaly_count) == (0.0, 61.0, 7)


def _flagged(orders, cfg):
    normal = [{"status": "DELIVERED", "actual_delivery_minutes": 20 + i % 3, "event_time": at(31),
               "event_id": f"n{i}"} for i in range(20)]
    slow = {"status": "DELIVERED", "actual_delivery_minutes": 90, "event_time": at(32), "event_id": "slow"}
    return anomaly.flag_deliveries(orders(*normal, slow), cfg)


def test_slow_delivery_is_flagged_in_all_its_windows(orders):
    rows = _flagged(orders, MetricConfig()).collect()
    assert {r.event_id for r in rows} == {"slow"}
    assert len({r.window_start for r in rows}) == 6


@pytest.mark.parametrize("how", ["inner", "left", "right", "full_outer"])
def test_lookups_do_not_depend_on_the_kind_of_join(spark, orders, restaurants, how):
    def rows():
        events = orders(*[{"restaurant_id": r, "event_id": f"e{i}"}
                          for i, r in enumerate(["R1", "R1", "R2", "RX"])])
        flagged = _flagged(orders, MetricConfig())
        return (sorted(map(str, sla.enrich(events, restaurants, how).collect())),
                sorted(map(str, flagged.collect())))

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    small = rows()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows() == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(small[0]) == {"inner": 3, "left": 4, "right": 4, "full_outer": 5}[how]


def test_all_fraud_rules(orders):
    df = orders(*[{"status": "CANCELLED"} for _ in range(3)], {"customer_id": "u2"},
                {"status": "REFUNDED"}, {"status": "REFUNDED"})
    row = fraud.fraud_alerts(df).first()
    assert row.fraud_flags == "HIGH_CANCELLATION, ACCOUNT_HOPPING, HIGH_REFUNDS"
    assert (row.distinct_customer_ids, row.cancellation_count, row.refund_count) == (2, 3, 2)
    assert row.total_order_value == 60.0


def test_unflagged_and_deviceless_rows_are_no_alerts(orders):
    df = orders({"device_id": None, "status": "CANCELLED"}, {"device_id": None, "customer_id": "u2"},
                {"device_id": None, "status": "CANCELLED"}, {"device_id": None, "status": "CANCELLED"},
                {"status": "CANCELLED"}, {"status": "CANCELLED"})
    assert fraud.fraud_alerts(df).count() == 0


def test_multi_account_rate(orders):
    df = orders(*[{"customer_id": f"u{i}"} for i in range(4)],
                *[{"customer_id": f"u{i}", "status": "CANCELLED"} for i in range(2)])
    row = fraud.multi_account_devices(df).first()
    assert row.cancellation_rate == 0.5


def test_latest_position_ignores_row_order(couriers):
    df = couriers({"event_time": at(2), "latitude": 2.0, "event_id": "a"},
                  {"event_time": at(1), "latitude": 1.0, "event_id": "z"},
                  {"event_time": at(2), "latitude": 3.0, "event_id": "b"})
    assert [r.latitude for r in fleet.latest_positions(df).collect()] == [3.0]


def test_utilisation(couriers):
    df = couriers({"courier_id": "a"}, {"courier_id": "a", "status": "HEADING_TO_CUSTOMER"},
                  {"courier_id": "b"}, {"courier_id": "c", "status": "OFFLINE"})
    rows = fleet.utilisation(df).collect()
    assert len(rows) == 3
    assert {(r.online_couriers, r.busy_couriers, r.utilisation) for r in rows} == {(2, 1, 0.5)}


def test_gap_sessions(couriers):
    times = (0, 10, 29, 59, 90, 121)
    df = couriers(*[{"event_time": at(t)} for t in times])
    rows = sorted(fleet.gap_sessions(df).collect(), key=lambda r: r.session_start)
    assert [r.event_count for r in rows] == [4, 1, 1]
    assert rows[0].session_end.replace(tzinfo=None) == at(89).replace(tzinfo=None)
    native = df.groupBy(F.session_window("event_timestamp", "30 minutes"), "courier_id").count()
    assert sorted(r["count"] for r in native.collect()) == [1, 1, 4]


def test_session_length(couriers):
    df = couriers({"event_time": at(5)}, {"event_time": at(20), "status": "OFFLINE"},
                  {"event_time": at(1), "active_session_id": "s2", "session_start_time": at(0)})
    rows = {r.active_session_id: r for r in fleet.sessions(df).collect()}
    assert (rows["s1"].session_minutes, rows["s1"].is_closed) == (15.0, True)
    assert (rows["s2"].session_minutes, rows["s2"].is_closed) == (1.0, False)


def test_quality_flags(couriers):
    df = couriers({"event_id": "fast", "speed_kmh": 250.0}, {"event_id": "ok", "speed_kmh": 30.0},
                  {"event_id": "blank", "battery_pct": 5, "event_time": at(50)},
                  {"event_id": "dead", "status": "OFFLINE", "battery_pct": 90,
                   "location_accuracy_meters": 500.0, "event_time": at(200)},
                  {"event_id": "off", "status": "OFFLINE", "battery_pct": 1, "event_time": at(201)})
    assert {r.event_id: r.quality_flags for r in fleet.quality_flags(df).collect()} == {
        "fast": "IMPOSSIBLE_SPEED", "dead": "POOR_ACCURACY, LOW_BATTERY_OFFLINE"}


def test_orphaned_deliveries(orders, couriers):
    drop = {"status": "OFFLINE", "offline_reason": "MID_DELIVERY_DROP", "event_time": at(10)}
    o = orders(
        *[{"order_id": i, "status": "IN_TRANSIT", "event_time": at(5)} for i in ("lost", "saved", "done", "calm")],
        {"order_id": "saved", "status": "DELIVERED", "event_time": at(30)},
        {"order_id": "done", "status": "DELIVERED", "event_time": at(9)})
    c = couriers(*[{**drop, "order_id": i} for i in ("lost", "saved", "done", "never_picked_up")],
                 {"status": "OFFLINE", "offline_reason": "SHIFT_END", "order_id": "calm"})
    assert {r.order_id for r in fleet.orphaned_deliveries(o, c).collect()} == {"lost", "done"}


def test_orphaned_deliveries_however_far_from_the_drop(spark, orders, couriers, monkeypatch):
    from zonepulse.plans import catalog

    def step(order, status, minute):
        return {"order_id": order, "status": status, "event_time": at(minute)}

    o = orders(step("saved", "IN_TRANSIT", 5), step("saved", "DELIVERED", 400),
               step("slow", "IN_TRANSIT", 1), step("lost", "IN_TRANSIT", 190))
    c = couriers(*[{"order_id": i, "status": "OFFLINE", "offline_reason": "MID_DELIVERY_DROP",
                    "event_time": at(200)} for i in ("saved", "slow", "lost")])
    monkeypatch.setattr(catalog, "_orders", lambda *_: o)
    monkeypatch.setattr(catalog, "_couriers", lambda *_: c)
    got = catalog.QUERIES["orphaned_deliveries"](spark, "")
    assert {r.order_id for r in got.collect()} == {"slow", "lost"}
    assert {r.order_id for r in fleet.orphaned_deliveries(o, c).collect()} == {"lost"}


def test_utilisation_repeats_panes_not_rows(couriers):
    df = fleet.utilisation(couriers({"status": "ONLINE_IDLE"}))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("Scan") and plan.rindex("HashAggregate") > plan.index("Generate")


def test_order_durations_with_missing_step(orders):
    df = orders({"event_time": at(0)}, {"status": "READY_FOR_PICKUP", "event_time": at(10)},
                {"status": "DELIVERED", "event_time": at(40)})
    row = kpis.order_durations(df).first()
    assert (row.placed_to_delivered_min, row.ready_to_pickup_min, row.pickup_to_delivered_min) == (
        40.0, None, None)


def test_surge(orders, couriers):
    calm = [{"order_id": f"c{w}", "event_time": at(5 * w)} for w in range(6)]
    rush = [{"order_id": f"r{i}", "event_time": at(31)} for i in range(3)]

    def signal(idle):
        fleet = couriers(*[{"courier_id": f"k{i}", "event_time": at(32)} for i in range(idle)])
        return {r.window_start.minute: r for r in kpis.surge_signal(
            orders(*calm, *rush), fleet).collect()}

    rows = signal(2)
    assert (rows[30].pending_demand, rows[30].trailing_demand, rows[30].available_supply,
            rows[30].is_surge) == (3, 1.0, 2, True)
    assert rows[25].is_surge is False
    assert signal(3)[30].is_surge is False


def test_config(tmp_path):
    path = tmp_path / "c.json"
    path.write_text('{"anomaly_minutes_limit": 45, "health_bounds": [["calm", 2]]}')
    cfg = MetricConfig.from_json(path)
    assert (cfg.anomaly_minutes_limit, cfg.health_bounds) == (45, (("calm", 2.0),))
    path.write_text('{"nonsense": 1}')
    with pytest.raises(ValueError):
        MetricConfig.from_json(path)
    with pytest.raises(ValueError):
        MetricConfig(cancel_minutes=7, cancel_slide=5)
    assert RECOMMENDED_CONF["spark.sql.adaptive.enabled"] == "true"


def test_impossible_deliveries(orders):
    rows = [{"status": "DELIVERED", "actual_delivery_minutes": m, "event_id": f"d{m}"}
            for m in (0, 1, 60, 120, 121, None)] + [{"status": "PLACED", "actual_delivery_minutes": 0}]
    assert {r.event_id: r.kind for r in anomaly.impossible_deliveries(orders(*rows)).collect()} == {
        "d0": "TOO_SHORT", "d121": "TOO_LONG"}


def test_outputs_follow_the_table_contracts(orders, couriers, restaurants):
    """Names, order and types: a sink may bind by position."""
    feeds = Feeds(orders({}), couriers({}), restaurants)
    for job in JOBS.values():
        got = [(f.name, f.dataType) for f in job.build(feeds, MetricConfig()).schema.fields]
        assert got == [(f.name, f.dataType) for f in job.table.schema.fields], job.name
    both = kpis.windowed_kpis(feeds.orders)
    assert both.columns == METRIC_TABLES["windowed_kpis"].columns


def test_shuffle_sizing():
    assert sized_conf(12 << 40, 8000)[
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "98304"
    assert sized_conf(1, 8)["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "16"
