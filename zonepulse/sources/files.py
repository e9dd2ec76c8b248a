"""File sources: sample files, the restaurant dimension, archives and file-fed streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonepulse.model import RESTAURANT_SCHEMA, Feed
from zonepulse.sources.decode import _normalise_times

# Ids and times hardly repeat, so a Parquet writer would build their dictionaries for nothing.
PLAIN_COLUMNS = {f"parquet.enable.dictionary#{c}": "false"
                 for c in ("event_id", "event_time", "ingestion_time")}


def read_json_files(spark: SparkSession, path: str, feed: Feed,
                    multiline: bool = False) -> DataFrame:
    """Scan JSON files of a feed with its declared schema.

    JSON Lines files are splittable; ``multiline`` reads pretty-printed arrays, one file per task.
    """
    df = spark.read.schema(feed.json_schema).json(path, multiLine=multiline)
    return _normalise_times(feed, df, [])


def read_avro_files(spark: SparkSession, path: str, feed: Feed) -> DataFrame:
    """Scan Avro container files; needs the spark-avro package."""
    return (spark.read.format("avro").option("avroSchema", feed.avro_schema()).load(path)
            .select(*feed.schema.fieldNames()))


def read_restaurants(spark: SparkSession, path: str) -> DataFrame:
    """The restaurant dimension from a stored table, so every run sees the same tiers."""
    return spark.read.schema(RESTAURANT_SCHEMA).parquet(path)


def read_archive(spark: SparkSession, path: str, start: str | None = None,
                 end: str | None = None) -> DataFrame:
    """Scan an hourly archive; ``start``/``end`` (UTC, half-open) prune its partitions."""
    df = spark.read.parquet(path)
    # Partition columns only, so the bound is evaluated while listing and no file is opened.
    hour_start = F.make_timestamp("year", "month", "day", "hour", F.lit(0), F.lit(0))
    if start:
        df = df.filter((hour_start >= F.date_trunc("hour", F.lit(start).cast("timestamp")))
                       & (F.col("event_time") >= F.lit(start).cast("timestamp")))
    if end:
        df = df.filter((hour_start < F.lit(end).cast("timestamp"))
                       & (F.col("event_time") < F.lit(end).cast("timestamp")))
    return df


def stream_parquet(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """Streaming scan of a folder that receives Parquet files."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)
