"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the number of local cores,
``BENCH_QUERIES`` optionally a comma-separated choice (``all`` for every query).
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import SparkSession

from tidemark.registry.queries import QUERIES

HEADLINE = (
    "dedup_latest clean_orders upsert_guarded upsert_overwrite insert_only_dedup surrogate_keys scd2_build "
    "scd2_apply_batch dim_product_type1 asof_orders asof_payments fact_orders fact_payments fact_returns fact_events "
    "sessions_computed fact_sessions conversion_funnel session_kpis daily_sales_cash daily_sales_accrual "
    "revenue_reconciliation recon_summary dq_run_all dq_dim_customer_scd2_no_overlap mask_analyst erase_silver "
    "erase_audit suppression_filter csv_ingest_orders json_ingest_events"
).split()


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(spark: SparkSession, name: str, folder: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    run(spark, "revenue_reconciliation", folder)  # starts the JVM's compilers; not counted
    seconds = {name: run(spark, name, folder) for name in names}
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
