"""Discrete percentiles that survive hot groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def discrete_percentiles(df: DataFrame, keys: Sequence[str], value: str,
                         percents: dict[str, int], count_name: str,
                         totals: dict[str, Column] | None = None) -> DataFrame:
    """Exact nearest-rank percentiles per key, plus the row count.

    Rows are first counted per (key, value) with map-side combine, so what is shuffled and ordered
    is one row per distinct value and not one per event: a group that holds a third of all events
    still reaches its reducer as a short histogram.  The running count and the final aggregate
    share one partitioning by key.

    ``totals`` are further sums or counts over the rows of a key, from the same pass.
    """
    totals = totals or {}
    histogram = df.groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("_n"), *[c.alias(name) for name, c in totals.items()])
    by_key = Window.partitionBy(*keys)
    ranked = histogram.select(
        *keys, value, "_n", *totals,
        F.sum("_n").over(by_key.orderBy(value)).alias("_running"),
        F.sum("_n").over(by_key).alias("_total"),
    )
    # Integer arithmetic: the smallest value whose running share reaches p percent.
    return ranked.groupBy(*keys).agg(
        F.sum("_n").alias(count_name),
        *[F.sum(name).alias(name) for name in totals],
        *[
            F.min(F.when(F.col("_running") * 100 >= F.col("_total") * p, F.col(value))).alias(name)
            for name, p in percents.items()
        ],
    )
