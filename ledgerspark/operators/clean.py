"""Bronze stamping and the silver (cleaned) layer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import account_type, balance_inconsistent
from ..spec import SILVER_RENAMES, LedgerSpec


def stamp_lineage(df: DataFrame, source: str | None = None) -> DataFrame:
    """Add ``ingestion_timestamp`` and ``source_file``.

    ``source`` is a literal lineage tag (a file name, ``kafka:<topic>``);
    without one the file each row came from is taken from ``_metadata``.
    """
    if source is not None:
        src = F.lit(source)
    else:
        try:  # only file scans expose the hidden _metadata column
            df.select(F.col("_metadata.file_name")).schema
            src = F.col("_metadata.file_name")
        except AnalysisException:
            src = F.lit(None).cast("string")
    return df.withColumn("ingestion_timestamp", F.current_timestamp()).withColumn("source_file", src)


def rename_columns(df: DataFrame, renames: Mapping[str, str] = SILVER_RENAMES) -> DataFrame:
    present = {k: v for k, v in renames.items() if k in df.columns}
    return df.withColumnsRenamed(present)


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per ``keys``; the survivor is the smallest row by ``order``
    then by the remaining columns, so it never depends on partitioning.

    Implemented as ``groupBy(keys).agg(min(struct(order..., rest...)))``:
    ``min`` is combinable, so every map task collapses its own copies
    before the shuffle -- a key holding a third of the table still ships
    one row per task.
    """
    keys = list(keys)
    missing = [c for c in [*keys, *order] if c not in df.columns]
    if missing:
        raise ValueError(f"dedup columns not in the frame: {missing}")
    order = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = order + rest
    if not packed:
        return df.select(*keys).distinct()
    survivor = F.min(F.struct(*[F.col(c) for c in packed])).alias("_survivor")
    out = df.groupBy(*keys).agg(survivor)
    return out.select(*[F.col(k) for k in keys], *[F.col(f"_survivor.{c}").alias(c) for c in packed]).select(*df.columns)


def add_account_types(df: DataFrame, spec: LedgerSpec = LedgerSpec()) -> DataFrame:
    return df.withColumns(
        {
            "orig_account_type": account_type("name_orig", spec.merchant_prefix),
            "dest_account_type": account_type("name_dest", spec.merchant_prefix),
        }
    )


def add_balance_flag(df: DataFrame, spec: LedgerSpec = LedgerSpec()) -> DataFrame:
    flag = balance_inconsistent(
        "transaction_type", "oldbalance_orig", "amount", "newbalance_orig", spec.debit_types, spec.tolerance
    )
    return df.withColumn("balance_inconsistent", flag)


def to_silver(bronze: DataFrame, spec: LedgerSpec = LedgerSpec()) -> DataFrame:
    """Bronze (raw names) -> silver: rename, dedup, account types, balance flag."""
    df = rename_columns(bronze)
    df = dedup(df, spec.dedup_keys, spec.dedup_order)
    return add_balance_flag(add_account_types(df, spec), spec)


def silver_from_raw(raw: DataFrame, spec: LedgerSpec = LedgerSpec()) -> DataFrame:
    """Silver straight from a raw ledger frame (no lineage stamping)."""
    return to_silver(raw, spec)
