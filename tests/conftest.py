from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest

from zonepulse.model import COURIERS, ORDERS
from zonepulse.operators import quality
from zonepulse.session import build_session

DAY = datetime(2024, 1, 1, tzinfo=timezone.utc)


def at(minutes: float) -> datetime:
    return DAY + timedelta(minutes=minutes)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("zonepulse-tests", master="local[8]", conf={
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "6g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def _frame(spark, feed, defaults, rows):
    names = feed.schema.fieldNames()
    data = []
    for i, row in enumerate(rows):
        full = {"event_id": f"e{i}", "zone_id": "Z1", "is_duplicate": False, "is_late": False,
                **defaults, **row}
        full.setdefault("event_time", DAY)
        full.setdefault("ingestion_time", full["event_time"])
        data.append(tuple(full.get(n) for n in names))
    return spark.createDataFrame(data, feed.schema)


@pytest.fixture
def raw_orders(spark):
    defaults = {"order_id": "o1", "customer_id": "u1", "restaurant_id": "R1", "status": "PLACED",
                "order_value_eur": 10.0, "device_id": "d1"}
    return lambda *rows: _frame(spark, ORDERS, defaults, rows)


@pytest.fixture
def raw_couriers(spark):
    defaults = {"courier_id": "c1", "status": "ONLINE_IDLE", "active_session_id": "s1"}
    return lambda *rows: _frame(spark, COURIERS, defaults, rows)


@pytest.fixture
def orders(raw_orders):
    return lambda *rows: quality.clean(raw_orders(*rows))


@pytest.fixture
def couriers(raw_couriers):
    return lambda *rows: quality.clean(raw_couriers(*rows))


@pytest.fixture
def restaurants(spark):
    from zonepulse.model import RESTAURANT_SCHEMA
    return spark.createDataFrame([
        ("R1", "One", "Z9", "THAI", "GOLD", 10.0),
        ("R2", "Two", "Z9", "THAI", "SILVER", 10.0),
        ("R3", "Three", "Z9", "THAI", "BRONZE", 10.0),
    ], RESTAURANT_SCHEMA)
