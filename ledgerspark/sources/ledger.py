"""Raw ledger derived from the driver's ``events`` table.

The test data has no payment ledger, so one is derived from ``events``
(one transaction per event, see FIXTURES.md section G).  The result has
the raw ledger schema plus ``event_id``; 2 % of the events are emitted
twice so that deduplication has work to do.  It is a pure projection of
one scan (the copies come from ``explode``, not from a second scan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: the ledger mapping of FIXTURES.md section G ------------
EPOCH = "2024-01-01 00:00:00"  # step 1 starts here
EVENT_TO_TYPE = {
    "view": "CASH_IN",
    "click": "CASH_OUT",
    "purchase": "TRANSFER",
    "signup": "PAYMENT",
}
OTHER_TYPE = "DEBIT"
MERCHANT_EVENT = "signup"
AMOUNT_MULTIPLIER = (1, 10, 100, 1000, 10000)  # by event_id % 5
INCONSISTENT_PCT = {"CASH_OUT": 90, "TRANSFER": 95, "PAYMENT": 55, "DEBIT": 30}
DUPLICATE_EVERY = 50
FRAUD_EVERY = 37
FLAG_TYPE = "TRANSFER"
FLAG_AMOUNT = 200000
SENDER_SPREAD = 1000
DEST_SPREAD = 500
# --- end of fixed values ---------------------------------------------------


def _case(col, mapping: dict, default):
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v)))
    return expr.otherwise(F.lit(default))


def ledger_from_events(events: DataFrame) -> DataFrame:
    """Raw ledger (``RAW_SCHEMA`` + ``event_id``) from an events frame."""
    eid = F.col("event_id")
    # Whole hours since EPOCH, computed on the naive timestamp (date and
    # hour-of-day fields), so no session time zone can shift it.
    ts = F.col("ts").cast("timestamp_ntz")
    hours = F.datediff(F.to_date(ts), F.to_date(F.lit(EPOCH))) * 24 + F.hour(ts)
    step = (hours + 1).cast("int")
    txn_type = _case(F.col("event_type"), EVENT_TO_TYPE, OTHER_TYPE)
    multiplier = F.element_at(F.array(*[F.lit(m) for m in AMOUNT_MULTIPLIER]), (eid % 5 + 1).cast("int"))
    amount = (F.col("value").cast("decimal(18,2)") * multiplier).cast("double")
    dest_prefix = F.when(F.col("event_type") == MERCHANT_EVENT, F.lit("M")).otherwise(F.lit("C"))

    base = events.select(
        eid.alias("event_id"),
        step.alias("step"),
        txn_type.alias("type"),
        amount.alias("amount"),
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("nameOrig"),
        F.concat(dest_prefix, F.get_json_object("props", "$.k")).alias("nameDest"),
    )
    old_orig = F.col("amount") + (eid % SENDER_SPREAD)
    pct = _case(F.col("type"), INCONSISTENT_PCT, 0)
    merchant_dest = F.col("nameDest").startswith("M")
    ledger = base.select(
        "step",
        "type",
        "amount",
        "nameOrig",
        old_orig.alias("oldbalanceOrg"),
        F.when(eid % 100 < pct, old_orig).otherwise(old_orig - F.col("amount")).alias("newbalanceOrig"),
        "nameDest",
        F.when(merchant_dest, F.lit(0.0)).otherwise((eid % DEST_SPREAD).cast("double")).alias("oldbalanceDest"),
        F.when(merchant_dest, F.lit(0.0)).otherwise((eid % DEST_SPREAD) + F.col("amount")).alias("newbalanceDest"),
        F.when(F.col("type").isin("TRANSFER", "CASH_OUT") & (eid % FRAUD_EVERY == 0), F.lit(1)).otherwise(F.lit(0)).alias("isFraud"),
        F.when((F.col("type") == FLAG_TYPE) & (F.col("amount") > FLAG_AMOUNT), F.lit(1)).otherwise(F.lit(0)).alias("isFlaggedFraud"),
        "event_id",
    )
    copies = F.when(eid % DUPLICATE_EVERY == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return ledger.withColumn("_copy", F.explode(copies)).drop("_copy")


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def read_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw ledger over ``{sf_dir}/events.parquet``."""
    return ledger_from_events(read_events(spark, sf_dir))
