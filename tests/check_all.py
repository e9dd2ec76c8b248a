"""Run queries against their SQL: ``python -m tests.check_all [sf] [name ...]``."""

from __future__ import annotations

import sys
import time

import __spark_entry__ as entry
from tests.compare import difference
from zonepulse.session import build_session


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.001"
    sf_dir = f"/root/testdata/{sf}"
    spark = build_session(master="local[8]", conf={
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    sql, bad = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if sys.argv[2:] and not any(name.startswith(a) for a in sys.argv[2:]):
            continue
        begin = time.time()
        try:
            df = run(spark, sf_dir)
            if name in sql:
                n = "ok"
                problem = difference(df, sql[name], sf_dir)
            else:
                n, problem = f"{df.count()} rows, no SQL", ""
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem)
        print(f"{time.time() - begin:6.1f}s {name}: {problem or n}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
