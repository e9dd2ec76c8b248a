"""Validation, de-duplication, dead letters and lateness accounting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonepulse.functions.windows import EVENT_TIME
from zonepulse.sources.decode import CORRUPT


def is_valid() -> Column:
    """A usable row has an id and an event time; decoding failures have neither."""
    return F.col("event_id").isNotNull() & F.col("event_time").isNotNull()


def validate(df: DataFrame) -> DataFrame:
    return df.filter(is_valid())


def with_event_timestamp(df: DataFrame) -> DataFrame:
    """Add the watermark column; epoch milliseconds and zone-less times are accepted too."""
    kind = df.schema["event_time"].dataType.typeName()
    source = F.col("event_time")
    ts = F.timestamp_millis(source) if kind == "long" else source.cast("timestamp")
    return df.withColumn(EVENT_TIME, ts)


def dedup_by_flag(df: DataFrame) -> DataFrame:
    """Drop rows the producer marked as copies; an absent mark keeps the row.  No shuffle."""
    return df.filter(~F.coalesce(F.col("is_duplicate"), F.lit(False)))


def dedup_by_key(df: DataFrame, keys: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """Keep one row per key without trusting any mark.

    A stream must carry a watermark, with which the state of a key expires; in batch the copies
    are dropped with map-side combine before the shuffle on the key.
    """
    if df.isStreaming:
        return df.dropDuplicatesWithinWatermark(list(keys))
    return df.dropDuplicates(list(keys))


def clean(df: DataFrame) -> DataFrame:
    """The input every metric expects: valid, unflagged, with ``event_timestamp``."""
    return with_event_timestamp(dedup_by_flag(validate(df)))


def dead_letters(decoded: DataFrame) -> DataFrame:
    """Rejected messages with their text and the reason, from a decode with ``keep_raw``."""
    reason = (
        F.when(F.col("raw_value").isNull(), "null_value")
        .when(F.col(CORRUPT).isNotNull(), "malformed")
        .when(F.col("event_id").isNull(), "missing_event_id")
        .otherwise("missing_event_time")
    )
    return decoded.filter(~is_valid()).select(
        F.col("raw_value").cast("string").alias("raw_value"), reason.alias("reason")
    )


def lateness_buckets(df: DataFrame) -> DataFrame:
    """Share of events per minute of delay between event time and arrival.

    Events more than five minutes late share one bucket: a 5-minute watermark may lose them.
    """
    delay = (F.unix_micros("ingestion_time") - F.unix_micros("event_time")) / 1_000_000
    bucket = (
        F.when(delay < 60, "on_time").when(delay < 120, "1_min").when(delay < 180, "2_min")
        .when(delay < 240, "3_min").when(delay < 300, "4_min").otherwise("5_min_or_more")
    )
    counted = df.groupBy(bucket.alias("lateness_bucket")).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_if(F.coalesce(F.col("is_late"), F.lit(False))).alias("flagged_late_count"),
    )
    # At most six rows reach this window.
    total = F.sum("event_count").over(Window.partitionBy())
    return counted.select("*", (F.col("event_count") / total).alias("event_share"))
