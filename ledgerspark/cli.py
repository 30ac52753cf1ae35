"""Run the batch chain end to end and print what was written.

usage:
  python -m ledgerspark --csv <raw csv path> --out <folder> [--serve <folder>] [--train]
  python -m ledgerspark --events <sf dir> --out <folder> [--serve <folder>] [--train]

``--csv`` ingests raw ledger CSV files (header, fixed schema; malformed
lines go to <out>/quarantine); ``--events`` uses the ledger derived from a
test-data ``events`` table.  ``--serve`` publishes the served tables to a
Parquet-folder warehouse; ``--train`` fits and evaluates both models and
writes models and metrics under <out>/ml.  A failing quality gate stops
the run with the list of violations.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .operators.quality import QualityError
from .plans import training
from .plans.medallion import load_warehouse, run_medallion
from .plans.queries.registry import SPEC
from .session import get_spark
from .sources.files import read_table
from .sources.ledger import read_ledger
from .sources.warehouse import DirectoryTarget
from .spec import LedgerSpec


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--csv", help="raw ledger CSV file or folder")
    src.add_argument("--events", help="test-data folder holding events.parquet")
    ap.add_argument("--out", required=True, help="output folder (shared file system on a cluster)")
    ap.add_argument("--serve", help="Parquet-folder warehouse to publish the served tables to")
    ap.add_argument("--train", action="store_true", help="fit and evaluate the fraud models")
    ap.add_argument("--run-id", help="name of the input; a stopped chain called with it again goes on at the stage that failed")
    ap.add_argument("--master", help="Spark master, e.g. local[8] (default: from spark-submit)")
    ap.add_argument("--shuffle-gb", type=float, help="expected size of the largest shuffle, sizes shuffle width")
    args = ap.parse_args(argv)

    shuffle_bytes = int(args.shuffle_gb * 1024**3) if args.shuffle_gb else None
    owns_session = SparkSession.getActiveSession() is None
    spark = get_spark("ledgerspark-chain", master=args.master, shuffle_bytes=shuffle_bytes)
    spark.sparkContext.setLogLevel("WARN")
    out = args.out.rstrip("/")
    try:
        if args.csv:
            summary = run_medallion(spark, args.csv, out, LedgerSpec(), run_id=args.run_id)
        else:
            summary = run_medallion(spark, read_ledger(spark, args.events), out, SPEC, "events.parquet", run_id=args.run_id)
    except QualityError as err:
        print(f"stopped: {err}", file=sys.stderr)
        return 1
    for r in summary.collect():
        print(f"{r.layer:<7} {r.table_name:<26} {r.n_rows:>12,}")
    if args.serve:
        for name, n in load_warehouse(spark, f"{out}/gold", DirectoryTarget(args.serve)).items():
            print(f"served  {name:<26} {n:>12,}")
    if args.train:
        features = read_table(spark, f"{out}/gold/ml_features")
        t = training.train(features, SPEC if args.events else LedgerSpec())
        report = training.evaluation(t)
        training.save_models(t, f"{out}/ml/models")
        training.save_metrics(report, f"{out}/ml/metrics")
        for r in report.collect():
            print(f"model   {r.model:<20} {r.metric:<18} {r.value:.6g}")
    if owns_session:
        spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
