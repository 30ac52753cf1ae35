"""Headline-query timings.

Runs the registered queries at ``$BENCH_SF_DIR`` (default sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.

Each query is fully executed through the ``noop`` sink (every row is
produced, nothing is collected to the driver).  One untimed warm-up run
loads the JVM classes and the Parquet footers.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "fraud_by_type_hour",
    "silver_dedup",
    "dim_account",
    "fact_transactions",
    "star_lookup",
    "orphan_keys",
    "top_accounts",
    "fraud_by_amount_band",
    "kpi_summary",
    "gate_duplicates",
    "gate_inconsistency_rate",
    "ml_features",
    "stratified_split",
    "average_precision",
    "classification_report",
    "csv_ingest_roundtrip",
    "medallion_summary",
    "stream_land",
    "model_evaluation",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    from pyspark.sql import SparkSession

    from ledgerspark.plans.catalog import QUERIES

    scratch = tempfile.mkdtemp(prefix="ledgerspark-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ledgerspark-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "3g"))
        .config("spark.sql.shuffle.partitions", os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{scratch}/ckpt")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("fraud_by_type_hour")  # warm-up
    timings = {}
    for name in only or HEADLINE:
        timings[name] = round(run(name), 3)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf.group(1)) if sf else sf_dir,
        "cpus": int(cpus),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
