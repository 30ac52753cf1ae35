"""The batch chain: bronze -> gate -> silver -> gate -> gold -> features.

Every stage hands over through a written table in the shared folder (never
an in-memory frame), which also cuts the lineage: a lost executor only
recomputes work since the last written table.  A failing gate raises
:class:`QualityError` and stops the chain before anything downstream is
written.  Row counts come from observations on the writes.
"""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators import features as feats
from ..operators import marts, quality, star
from ..operators.clean import stamp_lineage, to_silver
from ..sources.files import CORRUPT_COLUMN, read_raw_csv, read_table, split_corrupt
from ..session import scratch_path
from ..sources.sinks import write_table, write_tables
from ..spec import LedgerSpec
from .stages import Stages

SUMMARY_SCHEMA = StructType(
    [
        StructField("layer", StringType(), False),
        StructField("table_name", StringType(), False),
        StructField("n_rows", LongType(), False),
    ]
)


def ingest_bronze(
    spark: SparkSession,
    csv_path: str,
    out: str,
    quarantine: str | None = None,
    partition_by: str = "type",
) -> int:
    """Raw CSV (fixed schema) -> bronze Parquet partitioned by type.

    Each row is stamped with the ingestion time and the name of the file
    it came from.  Malformed lines, and rows without a partition value
    (which would otherwise land in a default partition), go to
    ``quarantine`` (default: ``<out>__quarantine``), as the raw line or the
    row as JSON text: bronze and quarantine rows add up to the input.
    Returns the bronze row count.

    The text is parsed once, with every column, into a staging table; both
    parts are split from that, so neither depends on the columns read later.
    """
    staging = scratch_path(spark, "ingest")
    write_table(stamp_lineage(read_raw_csv(spark, csv_path)), staging)
    clean, bad = split_corrupt(read_table(spark, staging))
    lineage = ["ingestion_timestamp", "source_file"]
    row_json = F.to_json(F.struct(*[c for c in clean.columns if c not in lineage]))
    no_key = F.col(partition_by).isNull()

    def rejected(df, reason, text):
        return df.select(text.alias("raw_value"), F.lit(reason).alias("reason"), *lineage)

    write_table(
        rejected(bad, "malformed line", F.coalesce(F.col(CORRUPT_COLUMN), row_json)).unionByName(
            rejected(clean.filter(no_key), f"no {partition_by}", row_json)
        ),
        quarantine or out.rstrip("/") + "__quarantine",
    )
    return write_table(clean.filter(~no_key), out, partition_by=[partition_by])


def build_silver(spark: SparkSession, bronze: str, out: str, spec: LedgerSpec = LedgerSpec()) -> DataFrame:
    """Bronze table -> silver table; returns the silver frame read back
    from what was written (not a recomputation)."""
    write_table(to_silver(read_table(spark, bronze), spec), out)
    return read_table(spark, out)


def build_feature_table(spark: SparkSession, silver: str, out: str, spec: LedgerSpec = LedgerSpec()) -> DataFrame:
    write_table(feats.build_features(read_table(spark, silver), spec), out)
    return read_table(spark, out)


def gold_tables(silver: DataFrame, spec: LedgerSpec = LedgerSpec()) -> dict[str, DataFrame]:
    return {
        "dim_time": star.dim_time(silver, spec),
        "dim_transaction_type": star.dim_transaction_type(silver),
        "dim_account": star.dim_account(silver),
        "fact_transactions": star.fact_transactions(silver, spec),
        "agg_fraud_by_type_hour": marts.fraud_by_type_hour(silver, spec),
        "agg_top_accounts": marts.top_accounts(silver, spec=spec),
        "agg_fraud_by_amount_band": marts.fraud_by_amount_band(silver, spec),
    }


def build_gold(silver: DataFrame, root: str, spec: LedgerSpec = LedgerSpec()) -> dict[str, int]:
    """Write every gold table under ``root``; return name -> rows written."""
    return write_tables(gold_tables(silver, spec), root)


def run_medallion(
    spark: SparkSession,
    raw: DataFrame | str,
    root: str,
    spec: LedgerSpec = LedgerSpec(),
    source_name: str | None = None,
    run_id: str | None = None,
) -> DataFrame:
    """Run the whole chain under ``root``; return (layer, table, rows).

    ``raw`` is a raw-ledger frame or the path of the raw CSV files (then
    malformed lines are quarantined under ``root/quarantine``).

    With a ``run_id``, the caller's name of the input, finished stages are
    recorded under ``root/_stages``: a chain that a gate or a lost cluster
    stopped starts again at the stage that failed when it is called with the
    same ``run_id``.  A stage runs again if a parameter that it depends on
    has changed; raised thresholds, say, repeat the silver gate and what
    follows, not silver."""
    root = root.rstrip("/")
    stages = Stages(spark, root, run_id)
    bronze, silver, gold = (f"{root}/{layer}" for layer in ("bronze", "silver", "gold"))

    def table(path):
        return read_table(spark, path)

    def ingest():
        if isinstance(raw, str):
            return [("bronze", "transactions", ingest_bronze(spark, raw, bronze, quarantine=f"{root}/quarantine"))]
        return [("bronze", "transactions", write_table(stamp_lineage(raw, source_name), bronze, partition_by=["type"]))]

    def bronze_gate():
        quality.validate_bronze(table(bronze), spec)
        return []

    def clean():
        return [("silver", "transactions", write_table(to_silver(table(bronze), spec), silver))]

    def silver_gate():
        quality.validate_silver(table(silver), spec)
        return []

    def star_and_marts():
        return [("gold", name, rows) for name, rows in build_gold(table(silver), gold, spec).items()]

    def gold_gate():
        names = ("fact_transactions", "dim_account", "dim_time", "dim_transaction_type")
        quality.validate_gold(*[table(f"{gold}/{n}") for n in names])
        return []

    def feature_table():
        return [("gold", "ml_features", write_table(feats.build_features(table(silver), spec), f"{gold}/ml_features"))]

    every = asdict(spec)

    def only(*names):
        return {n: every[n] for n in names}

    counts = stages.run("1-bronze", {"source": raw if isinstance(raw, str) else source_name}, ingest)
    counts += stages.run("2-bronze-gate", only("types", "required_columns"), bronze_gate)
    counts += stages.run("3-silver", only("dedup_keys", "dedup_order", "merchant_prefix", "debit_types", "tolerance"), clean)
    counts += stages.run("4-silver-gate", only("dedup_keys", "thresholds"), silver_gate)
    counts += stages.run("5-gold", only("steps_per_day", "band_edges", "band_labels", "top_accounts"), star_and_marts)
    counts += stages.run("6-gold-gate", {}, gold_gate)
    counts += stages.run("7-features", only("eligible_types", "indicator_types", "steps_per_day"), feature_table)
    return spark.createDataFrame(counts, SUMMARY_SCHEMA)


SERVED_TABLES = ("agg_fraud_by_type_hour", "agg_top_accounts", "agg_fraud_by_amount_band", "dim_transaction_type")


def load_warehouse(spark: SparkSession, gold_root: str, target) -> dict[str, int]:
    """Publish the served gold tables plus a one-row KPI summary computed
    from the fact table; return table -> rows loaded.  Only aggregates are
    served, never the fact or account tables."""
    from ..sources.warehouse import load_serving

    root = gold_root.rstrip("/")
    tables = {name: read_table(spark, f"{root}/{name}") for name in SERVED_TABLES}
    tables["kpi_summary"] = marts.kpi_summary(read_table(spark, f"{root}/fact_transactions"))
    return load_serving(tables, target)
