"""Scale / skew probe for the core operators.

usage: python scripts/scale_probe.py [k ...] [--hot] [--eventlog]

Amplifies the sf0.1 ``events`` table k-fold inside Spark (each copy gets
fresh event ids; everything else is the given data), derives the ledger,
and times the core operators through the ``noop`` sink.  ``--hot`` sends
a third of all rows to one sender account to check that aggregations and
joins do not funnel a hot key into one task.  Prints one JSON line per k.
``--eventlog`` writes Spark's event log to a scratch folder and adds, for
the heaviest stages, task count and max / median task time (a straggler
task shows up as a large ratio).
"""

from __future__ import annotations

import functools
import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ledgerspark.operators import features, marts, metrics, star  # noqa: E402
from ledgerspark.operators.clean import silver_from_raw  # noqa: E402
from ledgerspark.plans import training  # noqa: E402
from ledgerspark.plans.catalog import SPEC, rule_score  # noqa: E402
from ledgerspark.sources.ledger import ledger_from_events, read_events  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
ID_STRIDE = 10**9


def amplified_events(spark, k: int, hot: bool):
    """k copies of the events table with fresh ids: a union of k scans, so
    the copies are read by k parallel tasks as separate input files would
    be (one ``explode`` inside a single scan task would serialise the whole
    map side)."""
    ev = read_events(spark, SF_DIR)
    out = functools.reduce(
        lambda a, b: a.unionByName(b),
        [ev.withColumn("event_id", F.col("event_id") + F.lit(i * ID_STRIDE)) for i in range(k)],
    )
    if hot:
        third = F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0
        out = out.withColumn("user_id", F.when(third, F.lit(0)).otherwise(F.col("user_id")))
    return out


def timed(build) -> float:
    """Seconds to build (eager checkpoints included) and fully run a frame."""
    t0 = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - t0, 3)


def _lines(path: str):
    """Lines of an event-log file (Spark 4 writes zstd-compressed rolling logs)."""
    if path.endswith(".zstd"):
        import io

        import zstandard

        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh, read_across_frames=True)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path) as fh:
            yield from fh


def stage_skew(log_dir: str, top: int = 6) -> list[dict]:
    """Heaviest stages in the event log: tasks, total / median / max task ms."""
    tasks: dict[int, list[int]] = {}
    for path in glob.glob(os.path.join(log_dir, "**", "events_*"), recursive=True):
        for line in _lines(path):
            if '"SparkListenerTaskEnd"' not in line:
                continue
            ev = json.loads(line)
            info = ev["Task Info"]
            tasks.setdefault(ev["Stage ID"], []).append(info["Finish Time"] - info["Launch Time"])
    stages = []
    for sid, ds in tasks.items():
        med = statistics.median(ds)
        stages.append({"stage": sid, "tasks": len(ds), "total_ms": sum(ds), "median_ms": med, "max_ms": max(ds),
                       "max_over_median": round(max(ds) / med, 2) if med else None})
    return sorted(stages, key=lambda d: -d["total_ms"])[:top]


def main():
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    hot = "--hot" in sys.argv
    ks = [int(a) for a in args] or [1, 10]
    scratch = tempfile.mkdtemp(prefix="ledgerspark-probe-")
    builder = SparkSession.builder.master("local[8]")
    if "--eventlog" in sys.argv:
        os.makedirs(f"{scratch}/events", exist_ok=True)
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", f"{scratch}/events")
    spark = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "64")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.checkpoint.dir", f"{scratch}/ckpt")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # warm-up: JIT and Parquet footers, untimed
    ledger_from_events(amplified_events(spark, 1, False)).write.format("noop").mode("overwrite").save()
    for k in ks:
        raw = ledger_from_events(amplified_events(spark, k, hot))
        silver = silver_from_raw(raw, SPEC)
        feats = features.build_features(silver, SPEC)
        t = {
            "silver_dedup": timed(lambda: silver),
            "fraud_by_type_hour": timed(lambda: marts.fraud_by_type_hour(silver, SPEC)),
            "top_accounts": timed(lambda: marts.top_accounts(silver, spec=SPEC)),
            "dim_account": timed(lambda: star.dim_account(silver)),
            "integrity_report": timed(
                lambda: star.integrity_report(
                    star.fact_transactions(silver, SPEC), star.dim_account(silver),
                    star.dim_time(silver, SPEC), star.dim_transaction_type(silver),
                )
            ),
            "stratified_split": timed(lambda: training.split(feats, SPEC)),
            "average_precision": timed(lambda: metrics.average_precision(feats.withColumn("score", rule_score()))),
        }
        n = raw.count()
        print(json.dumps({"k": k, "raw_rows": n, "hot": hot, "sec": t, "total": round(sum(t.values()), 3)}))
    spark.stop()
    if "--eventlog" in sys.argv:
        for st in stage_skew(f"{scratch}/events"):
            print(json.dumps(st))


if __name__ == "__main__":
    main()
