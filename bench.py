"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the cores, BENCH_QUERIES a comma-separated
choice of queries ("all" for every registered one).
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidelog.session import build_session
from workload.queries import REGISTRY

HEADLINE = (
    "gold_daily_revenue",
    "gold_customer_metrics",
    "latest_per_key",
    "cdc_envelope_parse",
    "changelog_unfold",
    "silver_orders",
    "silver_order_items",
    "silver_upsert",
    "status_transition_audit",
    "gold_daily_revenue_from_log",
    "bronze_kafka_events",
    "partition_layout",
    "serving_top_customers",
    "serving_recent_windows",
    "dq_suite_bronze_cdc_orders",
    "dq_suite_silver_order_items",
    "dq_gate_summary",
    "contract_orders",
    "stream_tumbling_1m",
    "batch_order_revenue_1m",
    "stream_order_revenue_1m",
    "metric_rate",
    "metric_sustained_alert",
)


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(REGISTRY) if chosen == "all" else chosen.split(",") if chosen else list(HEADLINE)
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    warm = sf_dir.rsplit("/", 1)[0] + "/sf0.001"
    for name in ("gold_daily_revenue", "silver_orders"):
        REGISTRY[name](spark, warm if os.path.isdir(warm) else sf_dir).collect()
    times = {}
    for name in names:
        start = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
