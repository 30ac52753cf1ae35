"""The ad-hoc analytics as Spark SQL over the written gold tables.

Each report is SQL text run in place over a Parquet table
(``parquet.`path` ``), so an analyst can run it without registering
anything.  Percentages are rounded half-up from the summed counts in
exact integer arithmetic, and every ORDER BY has a tie-break.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.files import sql_over_files


def pct(num: str, den: str, dp: int, scale: int = 100) -> str:
    """Spark SQL for round(scale * num / den, dp), half-up, exact."""
    m = 2 * scale * 10**dp
    return f"CAST(({num} * {m} + {den}) div (2 * {den}) AS DOUBLE) / CAST({10**dp} AS DOUBLE)"


# report -> (gold table it reads, SQL with {t} standing for that table)
REPORTS = {
    "fraud_pct_by_type": (
        "agg_fraud_by_type_hour",
        f"""SELECT transaction_type, SUM(n_transactions) AS total, SUM(n_fraud) AS frauds,
  {pct('SUM(n_fraud)', 'SUM(n_transactions)', 3)} AS fraud_pct
FROM {{t}} GROUP BY transaction_type ORDER BY fraud_pct DESC, transaction_type""",
    ),
    "risky_hours": (
        "agg_fraud_by_type_hour",
        f"""SELECT hour_of_day, SUM(n_fraud) AS frauds,
  {pct('SUM(n_fraud)', 'SUM(n_transactions)', 3)} AS fraud_pct
FROM {{t}} GROUP BY hour_of_day ORDER BY frauds DESC, hour_of_day LIMIT 10""",
    ),
    "band_report": (
        "agg_fraud_by_amount_band",
        f"""SELECT amount_band, n_transactions, n_fraud, {pct('n_fraud', 'n_transactions', 2)} AS fraud_pct
FROM {{t}} ORDER BY array_position(array('0-1K', '1K-10K', '10K-100K', '100K-1M', '1M+'), amount_band)""",
    ),
    "top10_accounts": (
        "agg_top_accounts",
        """SELECT name_orig, round(total_out, 2) AS total_out, n_transactions, n_fraud
FROM {t} ORDER BY total_out DESC, name_orig LIMIT 10""",
    ),
    "fraud_vs_inconsistency": (
        "fact_transactions",
        """SELECT is_fraud, balance_inconsistent, count(*) AS n
FROM {t} GROUP BY is_fraud, balance_inconsistent
ORDER BY is_fraud DESC NULLS LAST, balance_inconsistent DESC NULLS LAST""",
    ),
}


def report(spark: SparkSession, gold_root: str, name: str) -> DataFrame:
    """One analytics report over the gold tables under ``gold_root``."""
    table, sql = REPORTS[name]
    return sql_over_files(spark, sql.replace("{t}", "{tbl}"), tbl=f"{gold_root.rstrip('/')}/{table}")


def run_analytics(spark: SparkSession, gold_root: str) -> dict[str, DataFrame]:
    """All analytics reports over the gold tables under ``gold_root``."""
    return {name: report(spark, gold_root, name) for name in REPORTS}
