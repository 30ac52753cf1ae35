"""Ready-to-serve aggregates (gold marts) and the reports read from them.

Every aggregate here is a single ``groupBy`` whose functions (count, sum,
min) are combinable, so Spark runs a partial aggregate in each map task
and shuffles at most one row per group per task; skew on a key (a hot
account holding a third of the rows) is absorbed map-side.

Rates are derived from the integer counts with exact half-up rounding
(:func:`half_up_ratio`), never by averaging rates, so a roll-up of a mart
is exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import band, exact_sum, half_up_ratio, hour_of_day, ordinal
from ..spec import LedgerSpec


def _counts(fraud_col: str = "is_fraud"):
    return [
        F.count(F.lit(1)).alias("n_transactions"),
        F.sum(F.col(fraud_col).cast("long")).alias("n_fraud"),
    ]


def fraud_by_type_hour(silver: DataFrame, spec: LedgerSpec = LedgerSpec()) -> DataFrame:
    """Per (transaction type, hour of day): count, frauds, rate (4 dp)."""
    agg = silver.groupBy(
        "transaction_type", hour_of_day("step", spec.steps_per_day).alias("hour_of_day")
    ).agg(*_counts())
    return agg.withColumn("fraud_rate", half_up_ratio("n_fraud", "n_transactions", 4))


def account_totals(silver: DataFrame) -> DataFrame:
    """Outgoing volume per sender: exact money sum, count, frauds."""
    return silver.groupBy("name_orig").agg(
        exact_sum("amount").alias("total_out"),
        F.count(F.lit(1)).alias("n_transactions"),
        F.sum(F.col("is_fraud").cast("long")).alias("n_fraud"),
    )


def top_accounts(silver: DataFrame, k: int | None = None, spec: LedgerSpec = LedgerSpec()) -> DataFrame:
    """Top-k senders by outgoing volume; ties broken by account id.

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each task
    keeps its own k best rows, so memory is bounded by k, not by the
    number of accounts.
    """
    k = spec.top_accounts if k is None else k
    return account_totals(silver).orderBy(F.desc("total_out"), F.asc("name_orig")).limit(k)


def fraud_by_amount_band(silver: DataFrame, spec: LedgerSpec = LedgerSpec()) -> DataFrame:
    """Per amount band: count, frauds, rate (4 dp)."""
    agg = silver.groupBy(band("amount", spec.band_edges, spec.band_labels).alias("amount_band")).agg(*_counts())
    return agg.withColumn("fraud_rate", half_up_ratio("n_fraud", "n_transactions", 4))


def kpi_summary(fact: DataFrame) -> DataFrame:
    """One-row KPI: transactions, frauds, fraud percent (4 dp), inconsistent rows."""
    agg = fact.agg(
        F.count(F.lit(1)).alias("n_transactions"),
        F.sum(F.col("is_fraud").cast("long")).alias("n_fraud"),
        F.sum(F.col("balance_inconsistent").cast("long")).alias("n_balance_inconsistent"),
    )
    return agg.select(
        "n_transactions",
        "n_fraud",
        half_up_ratio("n_fraud", "n_transactions", 4, scale=100).alias("fraud_pct"),
        "n_balance_inconsistent",
    )


# --- reports over the marts (the ad-hoc SQL and dashboard queries) --------


def fraud_pct_by_type(by_type_hour: DataFrame) -> DataFrame:
    """Roll the type x hour mart up to type; percent from summed counts."""
    agg = by_type_hour.groupBy("transaction_type").agg(
        F.sum("n_transactions").alias("total"), F.sum("n_fraud").alias("frauds")
    )
    return agg.withColumn("fraud_pct", half_up_ratio("frauds", "total", 3, scale=100)).orderBy(
        F.desc("fraud_pct"), F.asc("transaction_type")
    )


def risky_hours(by_type_hour: DataFrame, k: int = 10) -> DataFrame:
    """The k hours with the most frauds (ties: earlier hour first)."""
    agg = by_type_hour.groupBy("hour_of_day").agg(
        F.sum("n_fraud").alias("frauds"), F.sum("n_transactions").alias("total")
    )
    return (
        agg.select("hour_of_day", "frauds", half_up_ratio("frauds", "total", 3, scale=100).alias("fraud_pct"))
        .orderBy(F.desc("frauds"), F.asc("hour_of_day"))
        .limit(k)
    )


def band_report(by_band: DataFrame, spec: LedgerSpec = LedgerSpec()) -> DataFrame:
    """Bands in their natural order with the fraud percent."""
    return by_band.select(
        "amount_band",
        "n_transactions",
        "n_fraud",
        half_up_ratio("n_fraud", "n_transactions", 2, scale=100).alias("fraud_pct"),
    ).orderBy(ordinal("amount_band", spec.band_labels).asc_nulls_last())


def top_k_accounts(top: DataFrame, k: int = 10) -> DataFrame:
    """First k rows of the top-accounts mart, total rounded to cents."""
    return (
        top.select("name_orig", F.round("total_out", 2).alias("total_out"), "n_transactions", "n_fraud")
        .orderBy(F.desc("total_out"), F.asc("name_orig"))
        .limit(k)
    )


def fraud_vs_inconsistency(fact: DataFrame) -> DataFrame:
    """Cross count of the fraud label against the balance flag."""
    return (
        fact.groupBy("is_fraud", "balance_inconsistent")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc_nulls_last("is_fraud"), F.desc_nulls_last("balance_inconsistent"))
    )


def type_report_ordered(by_type_hour: DataFrame, spec: LedgerSpec = LedgerSpec()) -> DataFrame:
    """Per type totals in the domain's display order; unknown types last."""
    agg = by_type_hour.groupBy("transaction_type").agg(
        F.sum("n_transactions").alias("n_transactions"), F.sum("n_fraud").alias("n_fraud")
    )
    return agg.withColumn("fraud_pct", half_up_ratio("n_fraud", "n_transactions", 3, scale=100)).orderBy(
        ordinal("transaction_type", spec.types).asc_nulls_last(), F.asc("transaction_type")
    )


def hour_series(by_type_hour: DataFrame) -> DataFrame:
    """Frauds per hour of day, in hour order."""
    return by_type_hour.groupBy("hour_of_day").agg(F.sum("n_fraud").alias("n_fraud")).orderBy("hour_of_day")


def first_row(df: DataFrame) -> DataFrame:
    """The first row of a (one-row) table."""
    return df.limit(1)
