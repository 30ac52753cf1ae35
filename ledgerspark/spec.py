"""Schemas, column names and business defaults for the ledger pipeline.

Every operator takes these as parameters; ``LedgerSpec()`` holds the
defaults so that a caller can override one knob (a threshold, a band
edge) without touching code.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# --- fixed values: must equal the reference for equal results -------------
# Raw ledger columns, in file order, with their types.
RAW_SCHEMA = StructType(
    [
        StructField("step", IntegerType(), False),
        StructField("type", StringType(), False),
        StructField("amount", DoubleType(), False),
        StructField("nameOrig", StringType(), False),
        StructField("oldbalanceOrg", DoubleType(), True),
        StructField("newbalanceOrig", DoubleType(), True),
        StructField("nameDest", StringType(), False),
        StructField("oldbalanceDest", DoubleType(), True),
        StructField("newbalanceDest", DoubleType(), True),
        StructField("isFraud", IntegerType(), False),
        StructField("isFlaggedFraud", IntegerType(), False),
    ]
)
RAW_COLUMNS = [f.name for f in RAW_SCHEMA.fields]

# Raw name -> cleaned (silver) name.
SILVER_RENAMES = {
    "type": "transaction_type",
    "nameOrig": "name_orig",
    "oldbalanceOrg": "oldbalance_orig",
    "newbalanceOrig": "newbalance_orig",
    "nameDest": "name_dest",
    "oldbalanceDest": "oldbalance_dest",
    "newbalanceDest": "newbalance_dest",
    "isFraud": "is_fraud",
    "isFlaggedFraud": "is_flagged_fraud",
}

# Transaction type domain, in display order.
TRANSACTION_TYPES = ("CASH_IN", "CASH_OUT", "TRANSFER", "PAYMENT", "DEBIT")
# Types where fraud occurs; the ML population.
FRAUD_ELIGIBLE_TYPES = ("TRANSFER", "CASH_OUT")
# Types marked by the feature is_transfer.
INDICATOR_TYPES = ("TRANSFER",)
# Types whose sender balance must move by the amount.
SENDER_DEBIT_TYPES = ("CASH_OUT", "TRANSFER", "DEBIT", "PAYMENT")
# Per-type ceiling on the balance-inconsistency rate (CASH_IN has none).
INCONSISTENCY_THRESHOLDS = {
    "CASH_OUT": 0.93,
    "TRANSFER": 0.97,
    "PAYMENT": 0.62,
    "DEBIT": 0.40,
}
BALANCE_TOLERANCE = 0.01
STEPS_PER_DAY = 24
DEDUP_KEYS = ("step", "transaction_type", "amount", "name_orig", "name_dest")
MERCHANT_PREFIX = "M"
ACCOUNT_TYPES = ("MERCHANT", "CUSTOMER")
# Amount band edges (left-closed, right-open) and their labels.
AMOUNT_BAND_EDGES = (1_000.0, 10_000.0, 100_000.0, 1_000_000.0)
AMOUNT_BAND_LABELS = ("0-1K", "1K-10K", "10K-100K", "100K-1M", "1M+")
TOP_ACCOUNTS = 1000
BRONZE_REQUIRED_COLUMNS = ("step", "amount", "nameOrig", "nameDest", "isFraud")
TEST_FRACTION = 0.25
SPLIT_SEED = 42
FOREST_TREES = 100
FOREST_SAMPLE = 256
MIN_CONTAMINATION = 1e-4
STREAM_BATCH_ROWS = 200
# Silver column order (bronze lineage columns are carried when present).
SILVER_COLUMNS = [
    "step",
    "transaction_type",
    "amount",
    "name_orig",
    "orig_account_type",
    "name_dest",
    "dest_account_type",
    "oldbalance_orig",
    "newbalance_orig",
    "oldbalance_dest",
    "newbalance_dest",
    "is_fraud",
    "is_flagged_fraud",
    "balance_inconsistent",
]
# Model inputs, in vector order.
FEATURE_COLUMNS = [
    "amount",
    "hour_of_day",
    "is_transfer",
    "oldbalance_orig",
    "newbalance_orig",
    "oldbalance_dest",
    "newbalance_dest",
    "error_balance_orig",
    "error_balance_dest",
    "balance_inconsistent",
]
# Columns of the feature table.
FEATURE_TABLE_COLUMNS = [
    "step",
    "name_orig",
    "name_dest",
    "amount",
    "hour_of_day",
    "is_transfer",
    "oldbalance_orig",
    "newbalance_orig",
    "oldbalance_dest",
    "newbalance_dest",
    "error_balance_orig",
    "error_balance_dest",
    "balance_inconsistent",
    "label",
]
# --- end of fixed values ---------------------------------------------------


@dataclass(frozen=True)
class LedgerSpec:
    """Parameters of the whole pipeline; defaults are the business values."""

    dedup_keys: tuple[str, ...] = DEDUP_KEYS
    # Survivor order for dedup: smallest value wins; remaining columns
    # break any tie so the survivor never depends on partitioning.
    dedup_order: tuple[str, ...] = ()
    merchant_prefix: str = MERCHANT_PREFIX
    debit_types: tuple[str, ...] = SENDER_DEBIT_TYPES
    tolerance: float = BALANCE_TOLERANCE
    steps_per_day: int = STEPS_PER_DAY
    types: tuple[str, ...] = TRANSACTION_TYPES
    eligible_types: tuple[str, ...] = FRAUD_ELIGIBLE_TYPES
    indicator_types: tuple[str, ...] = INDICATOR_TYPES
    thresholds: dict = field(default_factory=lambda: dict(INCONSISTENCY_THRESHOLDS))
    band_edges: tuple[float, ...] = AMOUNT_BAND_EDGES
    band_labels: tuple[str, ...] = AMOUNT_BAND_LABELS
    top_accounts: int = TOP_ACCOUNTS
    required_columns: tuple[str, ...] = BRONZE_REQUIRED_COLUMNS
    test_fraction: float = TEST_FRACTION
    seed: int = SPLIT_SEED
