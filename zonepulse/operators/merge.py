"""Merge rules for metric tables: combine a stored table with a newer partial result.

Each rule is a full outer join on the table's key.  A row present on one side only is kept as it
is; the rules below say what happens to each value column when both sides have the row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonepulse.functions.expressions import nan_to_null as _nan_to_null
from zonepulse.model import METRIC_TABLES, MetricTable

Rule = Callable[[Column, Column], Column]


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def add(old: Column, new: Column) -> Column:
    """Sum of both; null when either is null."""
    return old + new


def add_or_zero(old: Column, new: Column) -> Column:
    """Sum of both with null as zero."""
    return _zero(old) + _zero(new)


def add_new_or_zero(old: Column, new: Column) -> Column:
    return old + _zero(new)


def newest(old: Column, new: Column) -> Column:
    return new


def newest_known(old: Column, new: Column) -> Column:
    return F.coalesce(new, old)


def first(old: Column, new: Column) -> Column:
    return old


def larger(old: Column, new: Column) -> Column:
    return F.greatest(old, new)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Not-a-number becomes null in every floating column, so that sums stay usable."""
    floating = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    return df.select(*[_nan_to_null(c) if c in floating else F.col(c) for c in df.columns])


def merge_by_rules(current: DataFrame, delta: DataFrame, keys: Sequence[str],
                   rules: dict[str, Rule], derived: dict[str, Callable] | None = None) -> DataFrame:
    """Full outer join on ``keys`` with one rule per value column.

    ``derived`` columns are computed from both whole rows: ``f(old, new) -> Column`` where ``old``
    and ``new`` map a column name to that side's column.
    """
    values = [c for c in current.columns if c not in keys]
    left = current.select(*keys, F.struct(*values).alias("old"))
    right = delta.select(*keys, F.struct(*values).alias("new"))

    def side(prefix: str) -> Callable[[str], Column]:
        return lambda c: F.col(f"{prefix}.{c}")

    old, new = side("old"), side("new")

    def merged(c: str) -> Column:
        both = derived[c](old, new) if derived and c in derived else rules[c](old(c), new(c))
        return (F.when(F.col("new").isNull(), old(c)).when(F.col("old").isNull(), new(c))
                .otherwise(both).alias(c))

    joined = left.join(right, list(keys), "full_outer")
    order = current.columns
    out = {c: merged(c) for c in values}
    return joined.select(*[out[c] if c in out else F.col(c) for c in order])


def _merge_table(name: str, current: DataFrame, delta: DataFrame, rules: dict[str, Rule],
                 derived: dict[str, Callable] | None = None,
                 contract: MetricTable | None = None) -> DataFrame:
    table = contract or METRIC_TABLES[name]
    return merge_by_rules(nan_to_null(current), nan_to_null(delta), table.keys, rules, derived)


def merge_windowed_kpis(current: DataFrame, delta: DataFrame) -> DataFrame:
    """Counts and revenue add up; the rate follows from the summed counts."""
    def rate(old, new) -> Column:
        cancelled = add_new_or_zero(old("cancellation_count"), new("cancellation_count"))
        total = add_new_or_zero(old("order_count"), new("order_count"))
        return cancelled.cast("double") / F.greatest(total, F.lit(1))

    return _merge_table("windowed_kpis", current, delta, {
        "order_count": add_new_or_zero,
        "total_revenue": add_or_zero,
        "avg_prep_minutes": newest_known,
        "cancellation_count": add_new_or_zero,
    }, {"cancellation_rate": rate})


def merge_demand(current: DataFrame, delta: DataFrame) -> DataFrame:
    return _merge_table("_demand_staging", current, delta, {"pending_demand": add})


def merge_restaurant_sla(current: DataFrame, delta: DataFrame,
                         contract: MetricTable | None = None) -> DataFrame:
    """The order count adds up, percentiles and breach are replaced, descriptions stay, and so does
    the zone where the ``contract`` has it not in its key."""
    return _merge_table("restaurant_sla", current, delta, {
        "zone_id": first, "restaurant_name": first, "cuisine": first, "sla_tier": first,
        "order_count": add,
        "p50_prep": newest, "p95_prep": newest, "p99_prep": newest, "sla_breached": newest,
    }, contract=contract)


def merge_delivery_anomalies(current: DataFrame, delta: DataFrame) -> DataFrame:
    """Counts add up; the statistics are replaced, by null too."""
    return _merge_table("delivery_anomalies", current, delta, {
        "delivery_count": add, "anomaly_count": add, "late_event_count": add,
        "mean_delivery_min": newest, "stddev_delivery_min": newest, "anomaly_threshold": newest,
    })


def merge_fraud_alerts(current: DataFrame, delta: DataFrame) -> DataFrame:
    """Counts and value add up (a null value stays null); the larger customer count is kept."""
    return _merge_table("fraud_alerts", current, delta, {
        "distinct_customer_ids": larger,
        "cancellation_count": add, "refund_count": add, "total_order_value": add,
        "fraud_flags": newest,
    })


def merge_replace(current: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``delta`` replace rows with the same key."""
    values = [c for c in current.columns if c not in keys]
    return merge_by_rules(current, delta, keys, dict.fromkeys(values, newest))


def merge_health(current: DataFrame, delta: DataFrame) -> DataFrame:
    return merge_replace(current, delta, METRIC_TABLES["demand_supply_health"].keys)


def merge_courier_positions(current: DataFrame, delta: DataFrame) -> DataFrame:
    """The newer position of the two wins, of two with equal times the one with the greater event
    id, so that the answer does not depend on which side is the delta."""
    def pick(c: str):
        def ranked(side) -> Column:
            return F.struct(side("position_time"), side("position_event_id"))
        return lambda old, new: F.when(ranked(old) > ranked(new), old(c)).otherwise(new(c))

    values = [c for c in current.columns if c != "courier_id"]
    return merge_by_rules(current, delta, ["courier_id"], {}, {c: pick(c) for c in values})
