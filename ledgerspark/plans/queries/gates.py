"""Quality gates as report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import quality
from ...operators.clean import rename_columns, silver_from_raw
from ...session import stored
from ...sources.ledger import read_ledger
from ...spec import LedgerSpec
from .. import oracle as O
from .inputs import silver
from .registry import SPEC, query


@query(
    "gate_required_columns",
    O.with_ledger(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, TRUE AS present, CAST(count_if({c} IS NULL) AS BIGINT) AS n_null FROM ledger"
            for c in SPEC.required_columns
        )
    ),
)
def q_gate_required_columns(spark, sf_dir):
    return quality.required_columns_report(read_ledger(spark, sf_dir), SPEC.required_columns)


@query(
    "gate_negative_amounts",
    O.with_ledger(
        """SELECT COUNT(*) AS n_rows, CAST(count_if(amount < 0) AS BIGINT) AS n_negative,
  CAST(count_if(amount IS NULL) AS BIGINT) AS n_null_amount FROM ledger"""
    ),
)
def q_gate_negative_amounts(spark, sf_dir):
    return quality.amount_report(read_ledger(spark, sf_dir))


@query(
    "gate_domain",
    O.with_ledger(
        """SELECT type AS value, COUNT(*) AS n_rows,
  coalesce(type IN ('CASH_IN','CASH_OUT','TRANSFER','PAYMENT','DEBIT'), FALSE) AS in_domain
FROM ledger GROUP BY type"""
    ),
)
def q_gate_domain(spark, sf_dir):
    return quality.domain_report(read_ledger(spark, sf_dir), "type", SPEC.types)


@query("gate_nonempty", O.with_silver("SELECT COUNT(*) AS n_rows, COUNT(*) > 0 AS non_empty FROM silver"))
def q_gate_nonempty(spark, sf_dir):
    return quality.volume_report(silver(spark, sf_dir))


@query(
    "gate_duplicates",
    O.with_silver(
        """SELECT 'bronze' AS layer, CAST(SUM(n) AS BIGINT) AS n_rows, COUNT(*) AS n_keys,
  CAST(SUM(n) - COUNT(*) AS BIGINT) AS n_duplicates
FROM (SELECT COUNT(*) AS n FROM ledger GROUP BY step, type, amount, nameOrig, nameDest)
UNION ALL
SELECT 'silver', CAST(SUM(n) AS BIGINT), COUNT(*), CAST(SUM(n) - COUNT(*) AS BIGINT)
FROM (SELECT COUNT(*) AS n FROM silver GROUP BY step, transaction_type, amount, name_orig, name_dest)"""
    ),
)
def q_gate_duplicates(spark, sf_dir):
    keys = list(SPEC.dedup_keys)
    bronze = quality.duplicates_report(rename_columns(read_ledger(spark, sf_dir)), keys)
    clean = quality.duplicates_report(silver(spark, sf_dir), keys)
    return bronze.select(F.lit("bronze").alias("layer"), "*").unionByName(clean.select(F.lit("silver").alias("layer"), "*"))


@query(
    "gate_inconsistency_rate",
    O.with_silver(
        """SELECT transaction_type, COUNT(*) AS n_rows,
  CAST(coalesce(SUM(balance_inconsistent), 0) AS BIGINT) AS n_inconsistent,
  CAST(count_if(balance_inconsistent IS NULL) AS BIGINT) AS n_unknown,
  CAST(coalesce(SUM(balance_inconsistent), 0) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS rate,
  CASE transaction_type WHEN 'CASH_OUT' THEN CAST(0.93 AS DOUBLE) WHEN 'TRANSFER' THEN CAST(0.97 AS DOUBLE)
    WHEN 'PAYMENT' THEN CAST(0.62 AS DOUBLE) WHEN 'DEBIT' THEN CAST(0.40 AS DOUBLE) END AS threshold,
  coalesce(CAST(coalesce(SUM(balance_inconsistent), 0) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) >
    CASE transaction_type WHEN 'CASH_OUT' THEN CAST(0.93 AS DOUBLE) WHEN 'TRANSFER' THEN CAST(0.97 AS DOUBLE)
    WHEN 'PAYMENT' THEN CAST(0.62 AS DOUBLE) WHEN 'DEBIT' THEN CAST(0.40 AS DOUBLE) END, FALSE) AS violated
FROM silver GROUP BY transaction_type"""
    ),
)
def q_gate_inconsistency_rate(spark, sf_dir):
    return quality.inconsistency_report(silver(spark, sf_dir), SPEC.thresholds)


# --- gates on a ledger that breaks them -----------------------------------

#: Types outside the domain; more than an error message names.
ALIEN_TYPES = tuple(f"X{i}" for i in range(31))
ALIEN_SPEC = LedgerSpec(
    dedup_order=("event_id",), types=ALIEN_TYPES, debit_types=ALIEN_TYPES, thresholds=dict.fromkeys(ALIEN_TYPES, 0.25)
)

BROKEN = """
broken AS (
  SELECT event_id, step,
    CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 11 = 0 THEN 'X' || CAST(event_id % 31 AS VARCHAR) ELSE type END AS type,
    CASE WHEN event_id % 13 = 0 THEN -amount - 1 ELSE amount END AS amount,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE nameOrig END AS nameOrig,
    nameDest, oldbalanceOrg, newbalanceOrig,
    CASE WHEN event_id % 19 = 0 THEN NULL ELSE isFraud END AS isFraud
  FROM ledger)"""
DOMAIN_SQL = "coalesce(type IN ('CASH_IN','CASH_OUT','TRANSFER','PAYMENT','DEBIT'), FALSE)"


def broken_ledger(spark, sf_dir):
    """The ledger with a fixed share of alien and null types, negative
    amounts and nulls in required columns, chosen by event."""
    eid = F.col("event_id")
    alien = F.concat(F.lit("X"), (eid % len(ALIEN_TYPES)).cast("string"))
    return read_ledger(spark, sf_dir).withColumns(
        {
            "type": F.when(eid % 29 == 0, None).when(eid % 11 == 0, alien).otherwise(F.col("type")),
            "amount": F.when(eid % 13 == 0, -F.col("amount") - 1).otherwise(F.col("amount")),
            "nameOrig": F.when(eid % 17 != 0, F.col("nameOrig")),
            "isFraud": F.when(eid % 19 != 0, F.col("isFraud")),
        }
    )


def _offenders(spark, gate, kind):
    """The stored table of all offenders that a failing gate names."""
    try:
        gate()
    except quality.QualityError as failure:
        return spark.read.parquet(failure.tables[kind])
    raise AssertionError("the gate let a broken ledger pass")


@query(
    "gate_broken_profile",
    O.with_ledger(
        "SELECT type AS value, COUNT(*) AS n_rows, CAST(count_if(amount < 0) AS BIGINT) AS n_negative, "
        + ", ".join(f"CAST(count_if({c} IS NULL) AS BIGINT) AS null_{c}" for c in SPEC.required_columns)
        + " FROM broken GROUP BY type",
        BROKEN,
    ),
)
def q_gate_broken_profile(spark, sf_dir):
    """What the bronze gate sees, per type of a broken ledger."""
    return quality.bronze_profile(broken_ledger(spark, sf_dir), SPEC)


@query(
    "gate_broken_types",
    O.with_ledger(f"SELECT type AS value, COUNT(*) AS n_rows FROM broken WHERE NOT {DOMAIN_SQL} GROUP BY type", BROKEN),
)
def q_gate_broken_types(spark, sf_dir):
    """Every type outside the domain, from the table the bronze gate's error names."""
    found = _offenders(spark, lambda: quality.validate_bronze(broken_ledger(spark, sf_dir), SPEC), "types")
    return found.select("value", "n_rows")


@query(
    "gate_broken_rows",
    O.with_ledger(
        f"""SELECT event_id, type, amount, concat_ws(', ',
    CASE WHEN nameOrig IS NULL THEN 'null nameOrig' END, CASE WHEN isFraud IS NULL THEN 'null isFraud' END,
    CASE WHEN amount < 0 THEN 'negative amount' END, CASE WHEN NOT {DOMAIN_SQL} THEN 'unexpected type' END) AS reasons
FROM broken WHERE nameOrig IS NULL OR isFraud IS NULL OR amount < 0 OR NOT {DOMAIN_SQL}""",
        BROKEN,
    ),
)
def q_gate_broken_rows(spark, sf_dir):
    """Every row that breaks a bronze rule, with the rules it breaks."""
    found = _offenders(spark, lambda: quality.validate_bronze(broken_ledger(spark, sf_dir), SPEC), "rows")
    return found.select("event_id", "type", "amount", F.array_join("reasons", ", ").alias("reasons"))


@query(
    "gate_broken_rates",
    O.with_ledger(
        """SELECT type AS transaction_type, COUNT(*) AS n_rows, CAST(count_if(off) AS BIGINT) AS n_inconsistent,
  CAST(0 AS BIGINT) AS n_unknown, CAST(count_if(off) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS rate,
  CAST(0.25 AS DOUBLE) AS threshold, TRUE AS violated
FROM (SELECT *, abs(newbalanceOrig - (oldbalanceOrg - amount)) > CAST(0.01 AS DOUBLE) AS off FROM alien) WHERE rn = 1
GROUP BY type HAVING CAST(count_if(off) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) > CAST(0.25 AS DOUBLE)""",
        BROKEN,
        """
alien AS (
  SELECT *, row_number() OVER (PARTITION BY step, type, amount, nameOrig, nameDest ORDER BY event_id) AS rn
  FROM broken WHERE type LIKE 'X%')""",
    ),
)
def q_gate_broken_rates(spark, sf_dir):
    """Every alien type whose inconsistency rate is above its threshold,
    from the table the silver gate's error names."""
    alien = silver_from_raw(broken_ledger(spark, sf_dir).where(F.col("type").startswith("X")), ALIEN_SPEC)
    return _offenders(spark, lambda: quality.validate_silver(stored(alien, "alien-silver"), ALIEN_SPEC), "rates")
