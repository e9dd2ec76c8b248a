import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import at
from zonepulse.model import COURIERS, METRIC_TABLES, ORDERS
from zonepulse.operators import quality
from zonepulse.sources import files, kafka
from zonepulse.sources.decode import decode_json, encode_json


def _raw(spark, *texts):
    return spark.createDataFrame([(t.encode() if t is not None else None,) for t in texts],
                                 "value binary")


GOOD = {"event_id": "e1", "event_time": 1704067200123, "ingestion_time": 1704067201000,
        "order_id": "o", "zone_id": "Z", "status": "PLACED", "order_value_eur": 9.5,
        "metadata": {"a": "b"}}


def test_decode_and_dead_letters(spark):
    no_id = {k: v for k, v in GOOD.items() if k != "event_id"}
    no_time = {k: v for k, v in GOOD.items() if k != "event_time"}
    decoded = decode_json(
        _raw(spark, json.dumps(GOOD), "{oops", json.dumps(no_id), json.dumps(no_time), None),
        ORDERS, keep_raw=True)
    assert {r.reason for r in quality.dead_letters(decoded).collect()} == {
        "malformed", "missing_event_id", "missing_event_time", "null_value"}
    kept = quality.validate(decoded).collect()
    assert [r.event_id for r in kept] == ["e1"]
    assert kept[0].event_time.microsecond == 123000
    assert kept[0].metadata == {"a": "b"}


def test_decode_of_some_fields(spark):
    decoded = decode_json(_raw(spark, json.dumps(GOOD), "{oops"), ORDERS,
                          columns=["event_id", "event_time"])
    assert decoded.columns == ["event_id", "event_time"]
    assert [r.event_id for r in quality.validate(decoded).collect()] == ["e1"]


def test_one_bad_field_does_not_reject_the_event(spark):
    bad = {**GOOD, "item_count": "many"}
    decoded = decode_json(_raw(spark, json.dumps(bad)), ORDERS, keep_raw=True)
    assert quality.validate(decoded).first().item_count is None
    assert quality.dead_letters(decoded).count() == 0


@pytest.mark.parametrize("feed", [ORDERS, COURIERS])
def test_json_round_trip(spark, raw_orders, raw_couriers, feed):
    df = (raw_orders if feed is ORDERS else raw_couriers)({"event_time": at(3)}, {"event_time": at(4)})
    back = decode_json(df.select(encode_json(df, feed).cast("binary").alias("value")), feed)
    assert back.schema.fieldNames() == feed.schema.fieldNames()
    plain = [c for c in df.columns if c != "metadata"]
    assert back.select(plain).exceptAll(df.select(plain)).count() == 0


def test_sample_files_as_array_and_as_lines(spark, tmp_path):
    (tmp_path / "array.json").write_text(json.dumps([GOOD, {**GOOD, "event_id": "e2"}], indent=2))
    (tmp_path / "lines.json").write_text("\n".join(
        json.dumps({**GOOD, "event_id": f"e{i}"}) for i in range(3)))
    assert files.read_json_files(spark, str(tmp_path / "array.json"), ORDERS, multiline=True).count() == 2
    lines = files.read_json_files(spark, str(tmp_path / "lines.json"), ORDERS)
    assert lines.count() == 3
    assert lines.schema["event_time"].dataType.typeName() == "timestamp"


def test_flag_dedup_keeps_unmarked(raw_orders):
    df = raw_orders({"is_duplicate": None}, {"is_duplicate": True}, {"is_duplicate": False})
    assert quality.dedup_by_flag(df).count() == 2


def test_key_dedup(raw_orders):
    df = raw_orders({"event_id": "a"}, {"event_id": "a", "is_duplicate": True}, {"event_id": "b"})
    assert quality.dedup_by_key(df).count() == 2


def test_event_timestamp_sources(spark):
    for text in ("1704067200000L", "TIMESTAMP '2024-01-01 00:00:00'",
                 "TIMESTAMP_NTZ '2024-01-01 00:00:00'"):
        df = quality.with_event_timestamp(spark.sql(f"SELECT {text} AS event_time"))
        assert df.select(F.unix_seconds("event_timestamp")).first()[0] == 1704067200


def test_lateness(raw_orders):
    df = raw_orders({"ingestion_time": at(0)}, {"ingestion_time": at(1.5), "is_late": True},
                    {"ingestion_time": at(5), "is_late": True}, {"ingestion_time": at(0.5)})
    rows = {r.lateness_bucket: r for r in quality.lateness_buckets(df).collect()}
    assert {k: r.event_count for k, r in rows.items()} == {
        "on_time": 2, "1_min": 1, "5_min_or_more": 1}
    assert rows["on_time"].event_share == 0.5


# The producers' schemas: record name, and (field, type, default); "?" marks an optional field.
WIRE = {
    "OrderLifecycleEvent": (ORDERS, [
        ("schema_version", "string", "1.0.0"), ("event_id", "string"), ("order_id", "string"),
        ("customer_id", "string"), ("restaurant_id", "string"), ("courier_id", "string?"),
        ("zone_id", "string"), ("status", "OrderStatus"), ("event_time", "millis"),
        ("ingestion_time", "millis"), ("order_value_eur", "double"), ("item_count", "int"),
        ("is_promo", "boolean", False), ("promo_code", "string?"),
        ("payment_method", "PaymentMethod"), ("estimated_prep_minutes", "int?"),
        ("actual_prep_minutes", "int?"), ("estimated_delivery_minutes", "int?"),
        ("actual_delivery_minutes", "int?"), ("cancellation_reason", "CancellationReason?"),
        ("device_id", "string?"), ("platform", "Platform"), ("is_duplicate", "boolean", False),
        ("is_late", "boolean", False), ("metadata", "map", {})]),
    "CourierStatusEvent": (COURIERS, [
        ("schema_version", "string", "1.0.0"), ("event_id", "string"), ("courier_id", "string"),
        ("order_id", "string?"), ("zone_id", "string"), ("status", "CourierStatus"),
        ("event_time", "millis"), ("ingestion_time", "millis"), ("latitude", "double"),
        ("longitude", "double"), ("location_accuracy_meters", "float?"), ("speed_kmh", "float?"),
        ("battery_pct", "int?"), ("vehicle_type", "VehicleType"),
        ("active_session_id", "string?"), ("session_start_time", "millis?"),
        ("deliveries_completed_this_session", "int", 0), ("is_heartbeat", "boolean", False),
        ("is_duplicate", "boolean", False), ("is_late", "boolean", False),
        ("offline_reason", "OfflineReason?"), ("metadata", "map", {})]),
}
ENUMS = {
    "OrderStatus": ["PLACED", "CONFIRMED", "PREPARING", "READY_FOR_PICKUP", "PICKED_UP",
                    "IN_TRANSIT", "DELIVERED", "CANCELLED", "REFUNDED"],
    "PaymentMethod": ["CARD", "CASH", "WALLET", "VOUCHER"],
    "CancellationReason": ["CUSTOMER_REQUEST", "RESTAURANT_UNAVAILABLE", "NO_COURIER",
                           "FRAUD_SUSPECTED", "TIMEOUT"],
    "Platform": ["IOS", "ANDROID", "WEB"],
    "CourierStatus": ["ONLINE_IDLE", "ONLINE_ASSIGNED", "HEADING_TO_RESTAURANT", "AT_RESTAURANT",
                      "HEADING_TO_CUSTOMER", "COMPLETED_DELIVERY", "OFFLINE", "BREAK"],
    "VehicleType": ["BICYCLE", "SCOOTER", "MOTORCYCLE", "CAR", "WALKING"],
    "OfflineReason": ["VOLUNTARY", "BATTERY_DEAD", "APP_CRASH", "MID_DELIVERY_DROP", "SHIFT_END"],
}


def _wire_field(name, kind, *default):
    optional, kind = kind.endswith("?"), kind.rstrip("?")
    if kind in ENUMS:
        kind = {"type": "enum", "name": kind, "symbols": ENUMS[kind]}
    kind = {"millis": {"type": "long", "logicalType": "timestamp-millis"},
            "map": {"type": "map", "values": "string"}}.get(kind, kind) if isinstance(
                kind, str) else kind
    if optional:
        return {"name": name, "type": ["null", kind], "default": None}
    return {"name": name, "type": kind, **({"default": default[0]} if default else {})}


@pytest.mark.parametrize("name", list(WIRE))
def test_avro_schemas_are_compatible_both_ways(spark, name):
    feed, fields = WIRE[name]
    theirs = json.dumps({"type": "record", "name": name, "namespace": "com.fooddelivery.streams.v1",
                         "fields": [_wire_field(*f) for f in fields]})
    avro = spark._jvm.org.apache.avro

    def parsed(text):
        return avro.Schema.Parser().parse(text)

    def verdict(reader, writer):
        return avro.SchemaCompatibility.checkReaderWriterCompatibility(
            parsed(reader), parsed(writer)).getType().name()

    assert verdict(feed.avro_schema(), theirs) == verdict(theirs, feed.avro_schema()) == "COMPATIBLE"
    ours = {f["name"]: f.get("default", "none") for f in json.loads(feed.avro_schema())["fields"]}
    assert ours == {f["name"]: f.get("default", "none") for f in json.loads(theirs)["fields"]}


CONNECTION = "Endpoint=sb://host.example.net/;SharedAccessKeyName=reader;SharedAccessKey=abc=="


def test_kafka_options():
    options = kafka.reader_options("orders", CONNECTION, max_offsets_per_trigger=1000)
    assert options["kafka.bootstrap.servers"] == "host.example.net:9093"
    assert (options["subscribe"], options["startingOffsets"]) == ("orders", "latest")
    assert "SharedAccessKey=abc==" in options["kafka.sasl.jaas.config"]
    assert options["maxOffsetsPerTrigger"] == "1000"
    assert kafka.writer_options("orders", CONNECTION)["topic"] == "orders"


def test_publish_frame(raw_orders):
    rows = kafka.publish_frame(raw_orders({"event_time": at(1)}), ORDERS).collect()
    assert bytes(rows[0].key) == b"Z1"
    assert json.loads(bytes(rows[0].value))["event_time"] == 1704067260000


def test_table_contracts():
    for table in METRIC_TABLES.values():
        assert set(table.keys) <= set(table.columns)
        assert set(table.defaults) <= set(table.values)
