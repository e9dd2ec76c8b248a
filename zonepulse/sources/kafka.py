"""Kafka endpoints: connection options, stream scan and publishing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonepulse.model import Feed
from zonepulse.sources.decode import encode_json


def parse_connection_string(text: str) -> dict[str, str]:
    """Split ``Name=value;Name=value``; a value may itself contain ``=``."""
    pairs = (part.split("=", 1) for part in text.split(";") if "=" in part)
    return {name.strip(): value for name, value in pairs}


def _auth_options(connection_string: str) -> dict[str, str]:
    parts = parse_connection_string(connection_string)
    host = parts.get("Endpoint", "").removeprefix("sb://").rstrip("/")
    login = (f"Endpoint=sb://{host};SharedAccessKeyName={parts.get('SharedAccessKeyName', '')};"
             f"SharedAccessKey={parts.get('SharedAccessKey', '')}")
    return {
        "kafka.bootstrap.servers": f"{host}:9093",
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config":
            "org.apache.kafka.common.security.plain.PlainLoginModule required "
            f'username="$ConnectionString" password="{login}";',
    }


def reader_options(topic: str, connection_string: str, starting: str = "latest",
                   max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    """Options of the stream reader.  ``max_offsets_per_trigger`` bounds a catch-up batch."""
    options = {
        **_auth_options(connection_string),
        "subscribe": topic,
        "startingOffsets": starting,
        "kafka.request.timeout.ms": "60000",
        "kafka.session.timeout.ms": "60000",
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def writer_options(topic: str, connection_string: str) -> dict[str, str]:
    return {**_auth_options(connection_string), "topic": topic}


def read_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Streaming scan of a topic; needs the Kafka connector package."""
    return spark.readStream.format("kafka").options(**options).load()


def publish_frame(df: DataFrame, feed: Feed, key: str = "zone_id") -> DataFrame:
    """Rows as Kafka messages: ``key`` is the zone, ``value`` the encoded event."""
    return df.select(
        F.col(key).cast("binary").alias("key"), encode_json(df, feed).cast("binary").alias("value")
    )


def publish_batch(df: DataFrame, feed: Feed, options: dict[str, str]) -> None:
    publish_frame(df, feed).write.format("kafka").options(**options).save()


def publish_stream(df: DataFrame, feed: Feed, options: dict[str, str], checkpoint: str):
    return (publish_frame(df, feed).writeStream.format("kafka").options(**options)
            .option("checkpointLocation", checkpoint).start())
