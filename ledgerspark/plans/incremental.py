"""Silver from both origins, batch bronze and the landing zone, kept up incrementally.

The table is partitioned by the day of the ledger step, which is part of the
business key: new rows can only meet rows of their own days.  A merge reads
these days, joins them with the new rows, keeps one survivor per key, and
replaces these days alone.  The survivor is a minimum, so merging a row again,
or in another order, changes nothing: a merge that died is simply repeated.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import add_account_types, add_balance_flag, dedup, rename_columns
from ..session import scratch_path
from ..sources.files import read_table
from ..sources.sinks import write_table
from ..spec import RAW_COLUMNS, LedgerSpec
from ..streaming.land import read_landing

DAY = "ledger_day"
LINEAGE = ["ingestion_timestamp", "source_file"]
_MERGED = "batch_id long"


def _table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path) if schema else read_table(spark, path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def merge_silver(spark: SparkSession, bronze: DataFrame, silver: str, spec: LedgerSpec = LedgerSpec()) -> list[int]:
    """Merge rows with bronze columns into the silver table at ``silver``; returns the days that were rewritten.

    Rows without a step go to day -1.  The days (not rows) pass the driver:
    they name the partitions to read and to replace.
    """
    new = add_balance_flag(add_account_types(rename_columns(bronze), spec), spec)
    new = new.withColumn(DAY, F.coalesce(F.floor(F.col("step") / spec.steps_per_day), F.lit(-1)).cast("int"))
    staged = scratch_path(spark, "silver-new")
    write_table(new, staged)
    new = read_table(spark, staged)
    days = sorted(r[0] for r in new.select(DAY).distinct().collect())
    if not days:
        return []
    held = _table(spark, silver)
    both = new if held is None else held.where(F.col(DAY).isin(days)).unionByName(new)
    # A second staging table: the days are replaced from it, never from the files being replaced.
    merged = scratch_path(spark, "silver-merged")
    write_table(dedup(both, [*spec.dedup_keys, DAY], spec.dedup_order), merged)
    write_table(read_table(spark, merged), silver, partition_by=[DAY], dynamic_overwrite=True)
    return days


def refresh_silver(spark: SparkSession, silver: str, state: str, bronze: str | None = None, landing: str | None = None,
                   spec: LedgerSpec = LedgerSpec()) -> list[int]:
    """Bring ``silver`` up to date with the ``bronze`` table (given once: a first or a repeated load) and with
    the batches of the ``landing`` zone that ``state`` does not list yet; returns the days that were rewritten."""
    columns = [*RAW_COLUMNS, *LINEAGE]
    days: set[int] = set()
    if bronze:
        days.update(merge_silver(spark, read_table(spark, bronze).select(*columns), silver, spec))
    if landing:
        zone, done = read_landing(spark, landing), _table(spark, f"{state}/merged", _MERGED)
        if done is not None:
            zone = zone.join(done, "batch_id", "left_anti")
        batches = zone.select("batch_id").distinct()
        if not batches.isEmpty():
            first = scratch_path(spark, "batches")
            write_table(batches, first)  # what is merged now: batches landed meanwhile come next time
            batches = read_table(spark, first)
            days.update(merge_silver(spark, zone.join(batches, "batch_id", "left_semi").select(*columns), silver, spec))
            write_table(batches, f"{state}/merged", mode="append")
    return sorted(days)
