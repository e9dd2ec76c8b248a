"""All windows, watermarks and thresholds of the metrics in one immutable object."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields
from pathlib import Path


@dataclass(frozen=True)
class MetricConfig:
    """Settings shared by the batch and the streaming form of every metric.

    Window lengths are whole minutes.  A sliding window must be a multiple of its slide; that is
    what lets the batch form aggregate slide-sized panes once and roll them up.
    """

    orders_watermark: str = "5 minutes"
    couriers_watermark: str = "3 minutes"

    kpi_minutes: int = 5
    cancel_minutes: int = 15
    cancel_slide: int = 5
    health_minutes: int = 5
    sla_minutes: int = 15
    anomaly_minutes: int = 30
    anomaly_slide: int = 5
    fraud_minutes: int = 60
    utilisation_minutes: int = 15
    utilisation_slide: int = 5
    # Rows of state that the couriers of a window and zone are spread over on a stream.
    utilisation_buckets: int = 128
    surge_minutes: int = 5
    surge_lookback_windows: int = 6
    session_gap_minutes: int = 30
    # How long a stream remembers a shift after OFFLINE, a shift that fell silent, and an order.
    shift_linger_hours: int = 6
    shift_silence_hours: int = 16
    order_silence_hours: int = 6
    # How far from a courier's drop the steps of the order may lie.
    orphan_hours: int = 2

    # Preparation limits per tier (minutes, breached when p95 is above).
    sla_limits: dict[str, int] = field(
        default_factory=lambda: {"GOLD": 15, "SILVER": 25, "BRONZE": 35}
    )
    # Upper bounds (exclusive) of the health classes below "critical".
    health_bounds: tuple[tuple[str, float], ...] = (
        ("healthy", 1.0),
        ("moderate", 2.0),
        ("stressed", 4.0),
    )
    anomaly_minutes_limit: int = 60
    anomaly_sigmas: float = 2.0
    # Delivery times that no courier makes: below the first, above the second.
    shortest_delivery_minutes: int = 1
    longest_delivery_minutes: int = 120

    fraud_cancellations: int = 3
    fraud_customers: int = 2
    fraud_refunds: int = 2
    multi_account_customers: int = 3
    multi_account_cancel_rate: float = 0.5

    surge_ratio: float = 1.5
    impossible_speed_kmh: float = 200.0
    poor_accuracy_meters: float = 100.0
    low_battery_pct: int = 10

    # "exact" de-duplicates (window, key, id) before counting; "approx" uses a HyperLogLog sketch,
    # whose state per key is constant.
    stream_distinct: str = "exact"

    def __post_init__(self) -> None:
        for size, slide in (
            (self.cancel_minutes, self.cancel_slide),
            (self.anomaly_minutes, self.anomaly_slide),
            (self.utilisation_minutes, self.utilisation_slide),
        ):
            if slide <= 0 or size % slide:
                raise ValueError(f"window of {size} min is not a multiple of its slide {slide}")
        if self.stream_distinct not in ("exact", "approx"):
            raise ValueError("stream_distinct must be 'exact' or 'approx'")

    @classmethod
    def from_json(cls, path: str | Path) -> MetricConfig:
        """Read overrides from a JSON object; unknown keys are an error."""
        raw = json.loads(Path(path).read_text())
        unknown = set(raw) - {f.name for f in fields(cls)}
        if unknown:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        if "health_bounds" in raw:
            raw["health_bounds"] = tuple((n, float(b)) for n, b in raw["health_bounds"])
        return cls(**raw)


DEFAULTS = MetricConfig()
