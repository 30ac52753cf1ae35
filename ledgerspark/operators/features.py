"""Feature table for fraud scoring: one projection over silver, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import balance_residual, hour_of_day, known_amount
from ..spec import FEATURE_TABLE_COLUMNS, LedgerSpec

#: How the amount moves the balance of each side of a transaction.
FLOWS = {"orig": -1.0, "dest": 1.0}


def feature_expressions(spec: LedgerSpec = LedgerSpec()) -> dict[str, Column]:
    """The derived columns of the feature table, by name; unknown amounts count as 0."""
    amount = known_amount("amount")
    derived = {
        "amount": amount,
        "hour_of_day": hour_of_day("step", spec.steps_per_day),
        "is_transfer": F.col("transaction_type").isin(*spec.indicator_types).cast("int"),
        "label": F.col("is_fraud"),
    }
    for side, sign in FLOWS.items():
        before, after = (known_amount(f"{when}balance_{side}") for when in ("old", "new"))
        derived[f"oldbalance_{side}"], derived[f"newbalance_{side}"] = before, after
        derived[f"error_balance_{side}"] = balance_residual(before, F.lit(sign) * amount, after)
    return derived


def build_features(silver: DataFrame, spec: LedgerSpec = LedgerSpec()) -> DataFrame:
    """One row per silver row of an eligible type: its context, balances, what
    the balances do not explain, and the label.

    Population and indicator come from ``spec``; the type filter reaches the
    Parquet scan.  ``balance_inconsistent`` stays null where unknown.
    """
    derived = feature_expressions(spec)
    population = silver.where(F.col("transaction_type").isin(*spec.eligible_types))
    return population.select(*[derived.get(c, F.col(c)).alias(c) for c in FEATURE_TABLE_COLUMNS])
