"""Sources, sinks and serving: CSV, Parquet, JSON, SQL on files, warehouse."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ...operators import metrics
from ...operators.quality import QualityError
from ...session import scratch_path
from ...sources import files, sinks, warehouse
from ...sources.ledger import read_ledger
from ...spec import FEATURE_COLUMNS, RAW_COLUMNS
from ...streaming import messages
from .. import oracle as O
from .. import analytics
from ..medallion import build_gold, gold_tables, ingest_bronze, run_medallion
from ..stages import stage_tables
from ..oracle import (
    ACCOUNT_TOTALS_CTE,
    BY_BAND_CTE,
    BY_TYPE_HOUR_CTE,
    CLASSIFICATION_REPORT_SQL,
    DIM_ACCOUNT_CTE,
    DIM_TIME_CTE,
    DIM_TYPE_CTE,
    FACT_CTE,
    FEATURES_CTE,
    RAW_ORACLE,
    RAW_SQL,
    TOP_ACCOUNTS_CTE,
)
from .inputs import (
    bronze_table,
    by_type_hour,
    counts_frame,
    features,
    raw,
    serving_tables,
    silver,
    silver_table,
)
from . import marts as _marts, star as _star  # noqa: F401  (registers the reports first)
from .registry import ORACLES, SPEC, query


GOLD_COUNTS_SQL = O.with_silver(
    """SELECT 'dim_time' AS table_name, COUNT(*) AS n_rows FROM dim_time
UNION ALL SELECT 'dim_transaction_type', COUNT(*) FROM dim_type
UNION ALL SELECT 'dim_account', COUNT(*) FROM dim_account
UNION ALL SELECT 'fact_transactions', COUNT(*) FROM fact
UNION ALL SELECT 'agg_fraud_by_type_hour', COUNT(*) FROM by_type_hour
UNION ALL SELECT 'agg_top_accounts', COUNT(*) FROM top_accounts
UNION ALL SELECT 'agg_fraud_by_amount_band', COUNT(*) FROM by_band""",
    FACT_CTE,
    DIM_TIME_CTE,
    DIM_TYPE_CTE,
    DIM_ACCOUNT_CTE,
    BY_TYPE_HOUR_CTE,
    ACCOUNT_TOTALS_CTE,
    TOP_ACCOUNTS_CTE,
    BY_BAND_CTE,
)


SERVED_COUNTS_SQL = O.with_silver(
    """SELECT 'agg_fraud_by_type_hour' AS table_name, COUNT(*) AS n_rows FROM by_type_hour
UNION ALL SELECT 'agg_top_accounts', COUNT(*) FROM top_accounts
UNION ALL SELECT 'agg_fraud_by_amount_band', COUNT(*) FROM by_band
UNION ALL SELECT 'dim_transaction_type', COUNT(*) FROM dim_type
UNION ALL SELECT 'kpi_summary', 1""",
    DIM_TYPE_CTE,
    BY_TYPE_HOUR_CTE,
    ACCOUNT_TOTALS_CTE,
    TOP_ACCOUNTS_CTE,
    BY_BAND_CTE,
)


MEDALLION_SQL = O.with_silver(
    """SELECT 'bronze' AS layer, 'transactions' AS table_name, COUNT(*) AS n_rows FROM ledger
UNION ALL SELECT 'silver', 'transactions', COUNT(*) FROM silver
UNION ALL SELECT 'gold', 'dim_time', COUNT(*) FROM dim_time
UNION ALL SELECT 'gold', 'dim_transaction_type', COUNT(*) FROM dim_type
UNION ALL SELECT 'gold', 'dim_account', COUNT(*) FROM dim_account
UNION ALL SELECT 'gold', 'fact_transactions', COUNT(*) FROM fact
UNION ALL SELECT 'gold', 'agg_fraud_by_type_hour', COUNT(*) FROM by_type_hour
UNION ALL SELECT 'gold', 'agg_top_accounts', COUNT(*) FROM top_accounts
UNION ALL SELECT 'gold', 'agg_fraud_by_amount_band', COUNT(*) FROM by_band
UNION ALL SELECT 'gold', 'ml_features', COUNT(*) FROM features""",
    FACT_CTE,
    DIM_TIME_CTE,
    DIM_TYPE_CTE,
    DIM_ACCOUNT_CTE,
    BY_TYPE_HOUR_CTE,
    ACCOUNT_TOTALS_CTE,
    TOP_ACCOUNTS_CTE,
    BY_BAND_CTE,
    FEATURES_CTE,
)


@query("csv_ingest_roundtrip", RAW_ORACLE)
def q_csv_ingest_roundtrip(spark, sf_dir):
    csv_dir = scratch_path(spark, "raw-csv")
    files.write_csv(raw(spark, sf_dir), csv_dir)
    bronze_dir = scratch_path(spark, "bronze-csv")
    ingest_bronze(spark, csv_dir, bronze_dir, quarantine=scratch_path(spark, "bronze-quarantine"))
    return files.read_table(spark, bronze_dir).select(*RAW_COLUMNS)


@query(
    "csv_corrupt_rows",
    O.with_ledger(
        """SELECT CAST(count_if(isFlaggedFraud = 0) AS BIGINT) AS n_clean,
  CAST(count_if(isFlaggedFraud = 1) AS BIGINT) AS n_corrupt,
  CAST(count_if(isFlaggedFraud = 0) AS BIGINT) AS n_amount_parsed FROM ledger"""
    ),
)
def q_csv_corrupt_rows(spark, sf_dir):
    """Rows the legacy system flagged are written with an unreadable amount;
    the reader must keep them aside, not drop or null them silently."""
    bad_amount = F.when(F.col("isFlaggedFraud") == 1, F.lit("n/a")).otherwise(F.col("amount").cast("string"))
    csv_dir = scratch_path(spark, "raw-csv-bad")
    files.write_csv(raw(spark, sf_dir).withColumn("amount", bad_amount), csv_dir)
    df = files.read_raw_csv(spark, csv_dir)
    corrupt = F.col(files.CORRUPT_COLUMN).isNotNull()
    return df.agg(
        F.count_if(~corrupt).alias("n_clean"),
        F.count_if(corrupt).alias("n_corrupt"),
        F.count("amount").alias("n_amount_parsed"),
    )


@query(
    "parquet_partition_counts",
    O.with_ledger("SELECT type, COUNT(*) AS n_rows FROM ledger GROUP BY type"),
)
def q_parquet_partition_counts(spark, sf_dir):
    bronze = files.read_table(spark, bronze_table(spark, sf_dir))
    return bronze.groupBy("type").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "ingest_stamp",
    O.with_ledger(
        "SELECT 'events.parquet' AS source_file, COUNT(*) AS n_rows, COUNT(*) AS n_stamped FROM ledger"
    ),
)
def q_ingest_stamp(spark, sf_dir):
    bronze = files.read_table(spark, bronze_table(spark, sf_dir))
    return bronze.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("ingestion_timestamp").alias("n_stamped")
    )


@query("json_roundtrip", RAW_ORACLE)
def q_json_roundtrip(spark, sf_dir):
    return messages.parse_messages(messages.to_messages(raw(spark, sf_dir))).select(*RAW_COLUMNS)


@query("kafka_payload", RAW_ORACLE)
def q_kafka_payload(spark, sf_dir):
    """Publish through the text sink used in place of a topic; read back."""
    topic_dir = scratch_path(spark, "topic")
    messages.publish_messages(messages.to_messages(raw(spark, sf_dir)), topic_dir, fmt="text")
    return messages.parse_messages(spark.read.text(topic_dir)).select(*RAW_COLUMNS)


@query(
    "bounded_replay",
    O.with_ledger(f"SELECT {RAW_SQL}, event_id FROM ledger ORDER BY event_id LIMIT 1000"),
)
def q_bounded_replay(spark, sf_dir):
    return files.replay(read_ledger(spark, sf_dir), 1000, ["event_id"])


@query(
    "column_pruned_scan",
    O.with_silver(
        "SELECT amount, hour_of_day, is_transfer, oldbalance_orig, newbalance_orig, oldbalance_dest, "
        "newbalance_dest, error_balance_orig, error_balance_dest, balance_inconsistent, label FROM features",
        FEATURES_CTE,
    ),
)
def q_column_pruned_scan(spark, sf_dir):
    path = scratch_path(spark, "features")
    sinks.write_table(features(spark, sf_dir), path)
    return files.read_columns(spark, path, [*FEATURE_COLUMNS, "label"])


@query("flat_parquet_roundtrip", O.with_silver("SELECT * FROM silver"))
def q_flat_parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "silver")
    s = silver(spark, sf_dir)
    sinks.write_table(s, path)
    sinks.write_table(s, path)  # a second overwrite must not add rows
    return files.read_table(spark, path)


@query("write_counts", GOLD_COUNTS_SQL)
def q_write_counts(spark, sf_dir):
    """Rows per gold table, as observed during the writes (no recount)."""
    return counts_frame(spark, build_gold(silver_table(spark, sf_dir), scratch_path(spark, "gold"), SPEC))


@query(
    "sql_over_files",
    O.with_silver(
        f"""SELECT transaction_type, CAST(SUM(n_transactions) AS BIGINT) AS total, CAST(SUM(n_fraud) AS BIGINT) AS frauds,
  {O.ratio('SUM(n_fraud)', 'SUM(n_transactions)', 3, 100)} AS fraud_pct
FROM by_type_hour GROUP BY transaction_type""",
        BY_TYPE_HOUR_CTE,
    ),
)
def q_sql_over_files(spark, sf_dir):
    return _sql_report(spark, sf_dir, "fraud_pct_by_type")


def _sql_report(spark, sf_dir, name):
    """Write the one gold table a report reads, then run its SQL on the file."""
    table, _ = analytics.REPORTS[name]
    root = scratch_path(spark, "gold")
    sinks.write_table(gold_tables(silver(spark, sf_dir), SPEC)[table], f"{root}/{table}")
    return analytics.report(spark, root, name)


def _register_sql_report(name):
    # Same result as the DataFrame report of the same name, so same oracle.
    @query(f"sql_{name}", ORACLES[name])
    def run(spark, sf_dir):
        return _sql_report(spark, sf_dir, name)

    return run


for _name in ("risky_hours", "band_report", "top10_accounts", "fraud_vs_inconsistency"):
    _register_sql_report(_name)


@query("warehouse_roundtrip", SERVED_COUNTS_SQL)
def q_warehouse_roundtrip(spark, sf_dir):
    """Publish the served tables twice (replace semantics), read them back."""
    target = warehouse.DirectoryTarget(scratch_path(spark, "warehouse"))
    tables = serving_tables(silver_table(spark, sf_dir))
    warehouse.load_serving(tables, target)
    warehouse.load_serving(tables, target)
    counts = {name: warehouse.read_served(spark, name, target).count() for name in tables}
    return counts_frame(spark, counts)


# Served columns with the types of the serving store.
SERVED_TYPES = {
    "agg_fraud_by_type_hour": "transaction_type string, hour_of_day bigint, n_transactions bigint, n_fraud bigint, fraud_rate double",
    "agg_top_accounts": "name_orig string, total_out double, n_transactions bigint, n_fraud bigint",
    "agg_fraud_by_amount_band": "amount_band string, n_transactions bigint, n_fraud bigint, fraud_rate double",
    "dim_transaction_type": "transaction_type string, type_key bigint",
    "kpi_summary": "n_transactions bigint, n_fraud bigint, fraud_pct double, n_balance_inconsistent bigint",
}


def _served(spark, sf_dir, names):
    """Publish the named tables twice (replace semantics) and read them back."""
    target = warehouse.DirectoryTarget(scratch_path(spark, "warehouse"))
    tables = serving_tables(silver_table(spark, sf_dir))
    for _ in range(2):
        warehouse.load_serving({n: tables[n] for n in names}, target)
    return {n: warehouse.read_served(spark, n, target) for n in names}


@query(
    "warehouse_types",
    "SELECT * FROM (VALUES "
    + ", ".join(
        "('{}', '{}', '{}')".format(name, *column.split(" "))
        for name, columns in SERVED_TYPES.items()
        for column in columns.split(", ")
    )
    + ") AS t(table_name, column_name, data_type)",
)
def q_warehouse_types(spark, sf_dir):
    """Column types of every published table, as read back."""
    served = _served(spark, sf_dir, list(SERVED_TYPES))
    rows = [(name, column, kind) for name, df in served.items() for column, kind in df.dtypes]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string")


def _register_served(name, report):
    # The published rows are those of the report of the same table, in serving types.
    sql = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}
    columns = [c.split(" ") for c in SERVED_TYPES[name].split(", ")]
    casts = ", ".join(f"CAST({c} AS {sql[kind]}) AS {c}" for c, kind in columns)

    @query(f"served_{report}", f"SELECT {casts} FROM ({ORACLES[report]})")
    def run(spark, sf_dir):
        return _served(spark, sf_dir, [name])[name]

    return run


for _name, _report in (
    ("agg_fraud_by_type_hour", "fraud_by_type_hour"),
    ("agg_top_accounts", "top_accounts"),
    ("agg_fraud_by_amount_band", "fraud_by_amount_band"),
    ("dim_transaction_type", "dim_transaction_type"),
    ("kpi_summary", "kpi_summary"),
):
    _register_served(_name, _report)


@query("metrics_json", CLASSIFICATION_REPORT_SQL)
def q_metrics_json(spark, sf_dir):
    """Persist the evaluation report as JSON and read it back."""
    report = metrics.classification_report(silver(spark, sf_dir), "is_fraud", "is_flagged_fraud")
    path = scratch_path(spark, "metrics")
    report.coalesce(1).write.mode("overwrite").json(path)
    return spark.read.schema(report.schema).json(path)


@query("medallion_summary", MEDALLION_SQL)
def q_medallion_summary(spark, sf_dir):
    return run_medallion(spark, read_ledger(spark, sf_dir), scratch_path(spark, "medallion"), SPEC, "events.parquet")


RESUME_SQL = MEDALLION_SQL.replace("SELECT 'bronze'", "SELECT CAST(1 AS BIGINT) AS attempt, 'bronze'").replace(
    "SELECT 'silver'", "SELECT 1, 'silver'"
).replace("SELECT 'gold'", "SELECT 2, 'gold'")


@query("medallion_resume", RESUME_SQL)
def q_medallion_resume(spark, sf_dir):
    """A threshold of 0 stops the chain at the silver gate; called again with
    the real thresholds it writes the gold tables only."""
    root, ledger = scratch_path(spark, "medallion"), read_ledger(spark, sf_dir)
    strict = replace(SPEC, thresholds=dict.fromkeys(SPEC.thresholds, 0.0))
    try:
        run_medallion(spark, ledger, root, strict, "events.parquet", run_id=sf_dir)
    except QualityError:
        run_medallion(spark, ledger, root, SPEC, "events.parquet", run_id=sf_dir)
    return stage_tables(spark, root)
