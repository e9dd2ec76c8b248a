"""Windowed analytics for a delivery marketplace, built on Spark DataFrames.

Two feeds go in (order lifecycle events and courier status events), keyed metric tables come
out.  Every metric is a function from DataFrames to a DataFrame, so the same definition runs
over an archive in batch and over a live feed with Structured Streaming.
"""

from zonepulse.config import DEFAULTS, MetricConfig

__all__ = ["DEFAULTS", "MetricConfig"]
