"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores.  Every query is planned and run
to a no-op sink, so all of its columns are computed; the first query's start-up is not timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

from zonepulse.plans.catalog import QUERIES
from zonepulse.session import build_session

HEADLINE = [
    "kpi_tumbling", "kpi_hopping", "windowed_kpis_all", "demand_windows", "supply_windows",
    "demand_supply_health", "sla_windows", "anomaly_windows", "anomaly_flagged_deliveries",
    "fraud_windows", "courier_latest_position", "courier_utilisation", "courier_gap_sessions",
    "orphaned_deliveries", "order_durations", "surge_signal", "dedup_by_key",
    "decode_json_orders", "merge_windowed_kpis", "raw_archive_roundtrip", "serve_stat_cards",
    "stream_kpi_tumbling", "stream_demand_supply",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("zonepulse-bench", master=f"local[{cpus}]", conf={
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    QUERIES["kpi_tumbling"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")),
    }), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
