"""Benchmark: headline queries end to end from the raw tables.

Each query is executed in full through the ``noop`` sink (every row is
produced, nothing is collected to the driver). Every query runs once
untimed (code generation, JIT) and is then timed over BENCH_REPEAT runs
(best run kept); ``value`` is the sum of these warm times. The first, cold
run of each query is reported as well (``cold`` / ``cold_total``).
Prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_REPEAT (default 3).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# Models, computed from the raw tables.
MODELS = [
    "int_order_customer_history",
    "mart_orders",
    "mart_order_lines",
    "mart_product_summary",
]
# Downstream queries, reading the materialised marts (as reports and checks
# read the published tables).
DOWNSTREAM = [
    "ex2_orders_per_month",
    "monthly_pattern",
    "kpi_tiles",
    "month_contribution",
    "data_summary",
    "dq_check_summary",
    "metrics_orders_by_month",
    "metrics_lines_by_product",
    "top_products_by_revenue",
    "sales_forecast_all",
    "forecast_backtest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    from basketry.session import get_session
    from basketry import registry
    from basketry.registry import QUERIES

    # Local mode: a shuffle is a local-disk write, while a broadcast first
    # builds the whole small side before the probe side may start; broadcast
    # only really small sides here. (On a cluster this threshold is sized
    # from executor memory instead.)
    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(cpus, 8),
                        extra={"spark.driver.memory": "16g",
                               "spark.sql.autoBroadcastJoinThreshold": str(1 << 20)})
    spark.sparkContext.setLogLevel("ERROR")
    # warm-up: JVM, code generation, file listing
    QUERIES["ex1_orders_in_year"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    def build() -> float:
        # write intermediate models and marts to a fresh folder, then use them
        t0 = time.perf_counter()
        built = registry._marts(spark, sf_dir).materialize(spark)
        dt = time.perf_counter() - t0
        registry.set_built(spark, sf_dir, built)
        return dt

    times, cold, errors = {}, {}, {}

    def measure(name: str, fn) -> None:
        try:
            cold[name] = round(fn(), 3)
            times[name] = round(min(fn() for _ in range(max(repeat, 1))), 3)
        except Exception as exc:  # noqa: BLE001 - report, keep measuring the rest
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"

    for name in MODELS:
        measure(name, lambda name=name: run(name))
    measure("build_marts", build)
    for name in DOWNSTREAM:
        measure(name, lambda name=name: run(name))
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total_warm", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus,
                      "cold_total": round(sum(cold.values()), 3), "cold": cold,
                      **({"errors": errors} if errors else {})}))


if __name__ == "__main__":
    main()
