"""Silver-layer queries: rename, dedup, account types, balance flag."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators.clean import rename_columns
from ...sources.ledger import read_ledger
from .. import oracle as O
from .inputs import silver
from .registry import query


RENAMED_COLUMNS_SQL = """step, type AS transaction_type, amount, nameOrig AS name_orig,
  oldbalanceOrg AS oldbalance_orig, newbalanceOrig AS newbalance_orig, nameDest AS name_dest,
  oldbalanceDest AS oldbalance_dest, newbalanceDest AS newbalance_dest,
  isFraud AS is_fraud, isFlaggedFraud AS is_flagged_fraud, event_id"""


@query("silver_rename", O.with_ledger(f"SELECT {RENAMED_COLUMNS_SQL} FROM ledger"))
def q_silver_rename(spark, sf_dir):
    return rename_columns(read_ledger(spark, sf_dir))


@query("silver_dedup", O.with_silver("SELECT * FROM silver"))
def q_silver_dedup(spark, sf_dir):
    return silver(spark, sf_dir)


@query(
    "account_type",
    O.with_silver("SELECT event_id, name_orig, orig_account_type, name_dest, dest_account_type FROM silver"),
)
def q_account_type(spark, sf_dir):
    return silver(spark, sf_dir).select("event_id", "name_orig", "orig_account_type", "name_dest", "dest_account_type")


@query("balance_flag", O.with_silver("SELECT event_id, transaction_type, balance_inconsistent FROM silver"))
def q_balance_flag(spark, sf_dir):
    return silver(spark, sf_dir).select("event_id", "transaction_type", "balance_inconsistent")


@query(
    "flag_counts",
    O.with_silver(
        """SELECT COUNT(*) AS n_rows, CAST(count_if(balance_inconsistent = 1) AS BIGINT) AS n_inconsistent,
  CAST(count_if(is_fraud = 1) AS BIGINT) AS n_fraud FROM silver"""
    ),
)
def q_flag_counts(spark, sf_dir):
    s = silver(spark, sf_dir)
    return s.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("balance_inconsistent") == 1).alias("n_inconsistent"),
        F.count_if(F.col("is_fraud") == 1).alias("n_fraud"),
    )
