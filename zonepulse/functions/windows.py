"""Event-time windows as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EVENT_TIME = "event_timestamp"


def minutes(n: int) -> str:
    return f"{n} minutes"


def ensure_watermark(df: DataFrame, delay: str, ts: str = EVENT_TIME) -> DataFrame:
    """Watermark a stream that carries none yet; a second one is not allowed in a query.

    Bounded data is returned as it is.
    """
    marked = "spark.watermarkDelayMs" in df.schema[ts].metadata
    return df.withWatermark(ts, delay) if df.isStreaming and not marked else df


def tumbling(size: int, ts: str = EVENT_TIME) -> Column:
    """Epoch-aligned, half-open window of ``size`` minutes."""
    return F.window(F.col(ts), minutes(size)).alias("window")


def sliding(size: int, slide: int, ts: str = EVENT_TIME) -> Column:
    return F.window(F.col(ts), minutes(size), minutes(slide)).alias("window")


def flatten_window(df: DataFrame) -> DataFrame:
    """Replace the ``window`` struct by ``window_start`` and ``window_end``."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest
    )


def interval(n: int) -> Column:
    return F.expr(f"INTERVAL {n} MINUTES")


def covering_starts(pane_start: Column, size: int, slide: int) -> Column:
    """Array with the starts of the ``size / slide`` windows that cover a slide-sized pane."""
    return F.array(*[pane_start - interval(k * slide) for k in range(size // slide)])


def roll_up_panes(panes: DataFrame, size: int, slide: int) -> DataFrame:
    """Repeat each pane once per sliding window that covers it.

    ``panes`` carries the pane's own ``window``; the result has ``window_start`` and
    ``window_end`` of the sliding windows instead.  The repetition touches aggregated panes only,
    never raw events.
    """
    rest = [c for c in panes.columns if c != "window"]
    return panes.select(
        F.explode(covering_starts(F.col("window.start"), size, slide)).alias("window_start"), *rest
    ).select(
        "window_start", (F.col("window_start") + interval(size)).alias("window_end"), *rest
    )
