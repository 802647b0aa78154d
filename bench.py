"""Headline queries on one machine; prints one JSON line.

Each query starts from the Parquet files with nothing kept from earlier ones.
``value`` is the sum over the queries of the best of BENCH_RUNS timed runs (default 1),
after one warm-up query. BENCH_QUERIES picks other registered queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from larderline import registry

HEADLINE = [
    "stg_sales",
    "scd2_prices",
    "fct_sales",
    "fct_inventory",
    "fct_purchase_orders",
    "fct_stockouts",
    "dq_suite_raw",
    "anomaly_volume",
    "weekly_demand",
    "forecast_trend",
    "forecast_backtest",
    "reorder_topdown",
    "seasonal_profile",
]


def session(cores: int) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("larderline bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # Column call sites cost a gateway round trip per expression; only error messages use them.
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark: SparkSession, name: str, folder: str) -> float:
    registry.forget()
    start = time.perf_counter()
    registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    names = os.environ.get("BENCH_QUERIES", " ".join(HEADLINE)).split()
    runs = int(os.environ.get("BENCH_RUNS", 1))
    spark = session(cores)
    timed(spark, "weekly_demand", folder)
    seconds = {}
    for name in names:
        seconds[name] = round(min(timed(spark, name, folder) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    record = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cores": cores,
        "spark": spark.version,
    }
    spark.stop()
    print(json.dumps(record))


if __name__ == "__main__":
    main()
