"""Dashboard reads over the metric tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonepulse.functions.expressions import share


def stat_cards(kpis: DataFrame, sla: DataFrame, fraud: DataFrame) -> DataFrame:
    """One row per card: orders, revenue, average preparation, cancellation rate, breaches, alerts.

    Orders, revenue and preparation come from the tumbling rows, the rate from the hopping rows.
    """
    tumbling = F.col("window_type").startswith("tumbling")
    hopping = F.col("window_type").startswith("hopping")

    def total(condition: Column, c: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(c))), F.lit(0))

    summary = kpis.agg(
        total(tumbling, "order_count").cast("double").alias("total_orders"),
        total(tumbling, "total_revenue").cast("double").alias("total_revenue"),
        F.avg(F.when(tumbling, F.col("avg_prep_minutes"))).alias("avg_prep_minutes"),
        share(total(hopping, "cancellation_count"), total(hopping, "order_count"))
            .alias("cancellation_rate"),
    )
    cards = summary.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("card"), F.col(c).alias("value")) for c in summary.columns
    ])).alias("c")).select("c.card", "c.value")
    breaches = sla.agg(F.count_if("sla_breached").cast("double").alias("value")).select(
        F.lit("sla_breaches").alias("card"), "value")
    alerts = fraud.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit("fraud_alerts").alias("card"), "value")
    return cards.unionByName(breaches).unionByName(alerts)


def _zones(df: DataFrame, zones: list[str] | None) -> DataFrame:
    return df.filter(F.col("zone_id").isin(zones)) if zones else df


def orders_by_zone(kpis: DataFrame, zones: list[str] | None = None) -> DataFrame:
    """Orders and revenue per window and zone; ``zones`` narrows the result."""
    return _zones(kpis, zones).filter(F.col("window_type").startswith("tumbling")).groupBy(
        "window_start", "zone_id"
    ).agg(F.sum("order_count").alias("order_count"), F.sum("total_revenue").alias("total_revenue"))


def _latest(df: DataFrame, columns: list[str]) -> DataFrame:
    """Newest window per zone as an aggregate, so no zone's history is gathered."""
    return df.groupBy("zone_id").agg(
        F.max_by(F.struct(*columns), F.col("window_end")).alias("row")
    ).select("zone_id", "row.*")


def current_by_zone(kpis: DataFrame, health: DataFrame) -> DataFrame:
    """Latest cancellation rate and latest demand-supply balance per zone."""
    rate = _latest(kpis.filter(F.col("window_type").startswith("hopping")), ["window_end", "cancellation_rate"])
    state = _latest(health, ["window_end", "health_ratio", "health_status"])
    return rate.withColumnRenamed("window_end", "rate_window_end").join(
        state.withColumnRenamed("window_end", "health_window_end"), "zone_id", "full_outer")


def worst_restaurants(sla: DataFrame, limit: int = 10) -> DataFrame:
    """Restaurants with the highest p95 of any window; ties go to the smaller id."""
    return (
        sla.groupBy("restaurant_id", "restaurant_name", "sla_tier")
        .agg(F.max("p95_prep").alias("worst_p95_prep"),
             F.count_if("sla_breached").alias("breached_windows"))
        .orderBy(F.desc("worst_p95_prep"), F.asc("restaurant_id"))
        .limit(limit)
    )


def anomaly_series(anomalies: DataFrame, zones: list[str] | None = None) -> DataFrame:
    """Mean against threshold, with anomaly and late counts, per window and zone."""
    return _zones(anomalies, zones).select(
        "window_start", "zone_id", "mean_delivery_min", "anomaly_threshold", "anomaly_count",
        "late_event_count")


def fraud_table(fraud: DataFrame) -> DataFrame:
    return fraud.select("window_start", "device_id", "distinct_customer_ids",
                        "cancellation_count", "refund_count", "fraud_flags")
