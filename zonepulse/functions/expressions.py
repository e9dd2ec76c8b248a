"""Column expressions shared by several metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonepulse.config import MetricConfig


def sum_if(condition: Column, value: Column) -> Column:
    """Sum over matching rows; null when none matches."""
    return F.sum(F.when(condition, value))


# Size of a distinct sketch: exact for a few hundred ids, and beyond that within HLL_ERROR, one
# standard error, of the count.
HLL_LG_K = 12
HLL_ERROR = 1.04 / 2 ** (HLL_LG_K / 2)


def approx_distinct(ids: Column | str) -> Column:
    """Number of distinct values from a sketch of constant size; nulls do not count."""
    return F.hll_sketch_estimate(F.hll_sketch_agg(ids, HLL_LG_K))


def share(part: Column, whole: Column) -> Column:
    """``part / whole`` with 0.0 for an empty whole."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def health_ratio(demand: Column, supply: Column) -> Column:
    return demand.cast("double") / F.greatest(supply, F.lit(1))


def health_status(ratio: Column, cfg: MetricConfig) -> Column:
    """First class whose exclusive upper bound is above the ratio, else ``critical``."""
    return F.coalesce(
        *[F.when(ratio < bound, F.lit(name)) for name, bound in cfg.health_bounds],
        F.lit("critical"),
    )


def sla_breached(tier: Column, p95: Column, cfg: MetricConfig) -> Column:
    """True when p95 is above the limit of the tier; an unknown tier never breaches."""
    limits = F.create_map(*[F.lit(x) for pair in cfg.sla_limits.items() for x in pair])
    return F.coalesce(p95 > F.try_element_at(limits, tier), F.lit(False))


def fraud_rules(cfg: MetricConfig) -> dict[str, Column]:
    return {
        "HIGH_CANCELLATION": F.col("cancellation_count") >= cfg.fraud_cancellations,
        "ACCOUNT_HOPPING": F.col("distinct_customer_ids") >= cfg.fraud_customers,
        "HIGH_REFUNDS": F.col("refund_count") >= cfg.fraud_refunds,
    }


def fraud_flags(cfg: MetricConfig) -> Column:
    """Names of the rules that hold, joined by a comma; empty when none does."""
    return F.concat_ws(", ", *[F.when(rule, F.lit(name)) for name, rule in fraud_rules(cfg).items()])


def nan_to_null(column: str) -> Column:
    return F.when(~F.isnan(F.col(column)), F.col(column)).alias(column)
