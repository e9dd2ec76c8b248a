from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import at
from zonepulse.model import METRIC_TABLES, RESTAURANT_SLA_BY_RESTAURANT
from zonepulse.operators import kpis, merge


def _rows(spark, table, *rows):
    names = METRIC_TABLES[table].columns
    base = {"window_start": at(0), "window_end": at(5), "zone_id": "Z1", "device_id": "d",
            "restaurant_id": "R1", "window_type": "t"}
    return spark.createDataFrame([tuple({**base, **r}.get(n) for n in names) for r in rows],
                                 METRIC_TABLES[table].schema)


def test_kpis(spark):
    old = _rows(spark, "windowed_kpis",
                {"order_count": 4, "total_revenue": None, "avg_prep_minutes": 5.0,
                 "cancellation_count": 1, "cancellation_rate": 0.25})
    new = _rows(spark, "windowed_kpis",
                {"order_count": 4, "total_revenue": 2.0, "avg_prep_minutes": float("nan"),
                 "cancellation_count": 3, "cancellation_rate": 0.75},
                {"zone_id": "Z2", "order_count": 0, "total_revenue": None,
                 "cancellation_count": 0, "cancellation_rate": 0.0})
    rows = {r.zone_id: r for r in merge.merge_windowed_kpis(old, new).collect()}
    assert (rows["Z1"].order_count, rows["Z1"].total_revenue, rows["Z1"].avg_prep_minutes) == (8, 2.0, 5.0)
    assert rows["Z1"].cancellation_rate == 0.5
    assert rows["Z2"].total_revenue is None


def test_sla_keeps_first_descriptions(spark):
    old = _rows(spark, "restaurant_sla", {"restaurant_name": "A", "sla_tier": "GOLD",
                                          "order_count": 1, "p95_prep": 10.0, "sla_breached": False})
    new = _rows(spark, "restaurant_sla", {"restaurant_name": "B", "sla_tier": "BRONZE",
                                          "order_count": 2, "p95_prep": 20.0, "sla_breached": True})
    row = merge.merge_restaurant_sla(old, new).first()
    assert (row.restaurant_name, row.sla_tier, row.order_count, row.p95_prep, row.sla_breached) == (
        "A", "GOLD", 3, 20.0, True)


def test_anomaly_statistics_are_replaced_by_null(spark):
    old = _rows(spark, "delivery_anomalies", {"delivery_count": 5, "anomaly_count": 1,
                                              "late_event_count": 0, "stddev_delivery_min": 3.0})
    new = _rows(spark, "delivery_anomalies", {"delivery_count": 1, "anomaly_count": 0,
                                              "late_event_count": 1, "stddev_delivery_min": None})
    row = merge.merge_delivery_anomalies(old, new).first()
    assert (row.delivery_count, row.late_event_count, row.stddev_delivery_min) == (6, 1, None)


def test_fraud(spark):
    old = _rows(spark, "fraud_alerts", {"distinct_customer_ids": 3, "cancellation_count": 1,
                                        "refund_count": 0, "total_order_value": None, "fraud_flags": "a"})
    new = _rows(spark, "fraud_alerts", {"distinct_customer_ids": 2, "cancellation_count": 4,
                                        "refund_count": 2, "total_order_value": 5.0, "fraud_flags": "b"})
    row = merge.merge_fraud_alerts(old, new).first()
    assert (row.distinct_customer_ids, row.cancellation_count, row.total_order_value, row.fraud_flags) == (
        3, 5, None, "b")


def test_positions_take_the_newer(spark):
    schema = "courier_id string, latitude double, position_time timestamp, position_event_id string"
    old = spark.createDataFrame([("a", 1.0, at(5), "e1"), ("b", 9.0, at(1), "e1")], schema)
    new = spark.createDataFrame([("a", 2.0, at(4), "e2"), ("b", 2.0, at(1), "e2"),
                                 ("c", 2.0, at(0), "e3")], schema)
    for pair in ((old, new), (new, old)):
        assert {r.courier_id: r.latitude for r in merge.merge_courier_positions(*pair).collect()} == {
            "a": 1.0, "b": 2.0, "c": 2.0}


def test_sla_by_restaurant_alone(spark):
    rows = [_rows(spark, "restaurant_sla", {"zone_id": z, "order_count": n, "p95_prep": p})
            for z, n, p in (("Z1", 2, 10.0), ("Z2", 3, 20.0))]
    apart = merge.merge_restaurant_sla(*rows).collect()
    assert sorted((r.zone_id, r.order_count) for r in apart) == [("Z1", 2), ("Z2", 3)]
    (one,) = merge.merge_restaurant_sla(*rows, contract=RESTAURANT_SLA_BY_RESTAURANT).collect()
    assert (one.zone_id, one.order_count, one.p95_prep) == ("Z1", 5, 20.0)


def test_replace(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    new = spark.createDataFrame([("b", None), ("c", 3)], "k string, v int")
    assert dict(map(tuple, merge.merge_replace(old, new, ["k"]).collect())) == {
        "a": 1, "b": None, "c": 3}


event = st.fixed_dictionaries({
    "event_time": st.integers(0, 40).map(at),
    "zone_id": st.sampled_from(["Z1", "Z2"]),
    "status": st.sampled_from(["PLACED", "CONFIRMED", "CANCELLED"]),
    "order_value_eur": st.integers(0, 50).map(float),
})


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(event, min_size=2, max_size=20), st.integers(1, 19))
def test_merging_two_parts_gives_the_whole(orders, rows, cut):
    """For the additive columns; averages are replaced by design."""
    cut = min(cut, len(rows) - 1)
    additive = [c for c in METRIC_TABLES["windowed_kpis"].columns if c != "avg_prep_minutes"]
    parts = merge.merge_windowed_kpis(kpis.windowed_kpis(orders(*rows[:cut])),
                                      kpis.windowed_kpis(orders(*rows[cut:])))

    def as_set(df):
        return {tuple(0.0 if c == "total_revenue" and r[c] is None else r[c] for c in additive)
                for r in df.collect()}

    assert as_set(parts) == as_set(kpis.windowed_kpis(orders(*rows)))
