"""Turn binary messages into typed feed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonepulse.model import Feed

CORRUPT = "_corrupt_record"


def _normalise_times(feed: Feed, df: DataFrame, keep: list[str]) -> DataFrame:
    """Epoch milliseconds become timestamps; columns come out in feed order."""
    times, present = set(feed.time_columns), set(df.columns)
    return df.select(
        *keep,
        *[
            F.timestamp_millis(F.col(f.name)).alias(f.name) if f.name in times else F.col(f.name)
            for f in feed.fields if f.name in present
        ],
    )


def decode_json(raw: DataFrame, feed: Feed, value: str = "value", keep_raw: bool = False,
                columns: Sequence[str] | None = None) -> DataFrame:
    """Decode JSON messages; ``columns`` names the fields to parse, all by default.

    A message is parsed once: fields come out of a generator, which filters do not cross.  A
    malformed message yields a row of nulls, which ``quality.validate`` drops.  With
    ``keep_raw`` the text (``raw_value``) and Spark's corrupt-record column stay, so
    ``quality.dead_letters`` can tell why a row was rejected.
    """
    text = F.col(value).cast("string")
    fields = [f for f in feed.json_schema.fields if columns is None or f.name in columns]
    schema = T.StructType(fields + (
        [T.StructField(CORRUPT, T.StringType())] if keep_raw else []))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = raw.select(text.alias("raw_value"), F.inline(F.array(
        F.from_json(text, schema, options))))
    keep = ["raw_value", CORRUPT] if keep_raw else []
    return _normalise_times(feed, parsed, keep)


def decode_avro(raw: DataFrame, feed: Feed, value: str = "value",
                keep_raw: bool = False) -> DataFrame:
    """Decode Avro messages; needs the spark-avro package on the class path."""
    from pyspark.sql.avro.functions import from_avro

    parsed = raw.select(
        F.base64(F.col(value)).alias("raw_value"),
        F.inline(F.array(from_avro(F.col(value), feed.avro_schema(), {"mode": "PERMISSIVE"}))),
    )
    if not keep_raw:
        return parsed.drop("raw_value")
    # from_avro reports no text for a bad record; both required fields are null then.
    bad = F.col("event_id").isNull() & F.col("event_time").isNull()
    return parsed.select("raw_value", F.when(bad, F.col("raw_value")).alias(CORRUPT),
                         *feed.schema.fieldNames())


def encode_json(df: DataFrame, feed: Feed) -> Column:
    """The JSON wire text of a feed row (times as epoch milliseconds, nulls left out)."""
    times = set(feed.time_columns)
    present = set(df.columns)
    return F.to_json(F.struct(*[
        F.unix_millis(F.col(f.name)).alias(f.name) if f.name in times else F.col(f.name)
        for f in feed.fields if f.name in present
    ]))
