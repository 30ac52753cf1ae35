"""Independent DuckDB SQL for every checkable query.

Each string runs on DuckDB against the pre-registered views (``events``
among them).  The SQL is written from the operator semantics, not
generated from the Spark plans, so it is an independent check.
Rounded rates use the same exact integer half-up form as the Spark side:
``(2*s*10^dp*num + den) // (2*den) / 10^dp``.
"""

from __future__ import annotations

from ..spec import RAW_COLUMNS

LEDGER = """
ledger_base AS (
  SELECT event_id,
    CAST(date_diff('hour', TIMESTAMP '2024-01-01 00:00:00', ts) + 1 AS INTEGER) AS step,
    CASE event_type WHEN 'view' THEN 'CASH_IN' WHEN 'click' THEN 'CASH_OUT' WHEN 'purchase' THEN 'TRANSFER'
                    WHEN 'signup' THEN 'PAYMENT' ELSE 'DEBIT' END AS type,
    CAST(CAST(value AS DECIMAL(18,2)) * CASE event_id % 5 WHEN 0 THEN 1 WHEN 1 THEN 10 WHEN 2 THEN 100
                    WHEN 3 THEN 1000 ELSE 10000 END AS DOUBLE) AS amount,
    'C' || CAST(user_id AS VARCHAR) AS nameOrig,
    (CASE WHEN event_type = 'signup' THEN 'M' ELSE 'C' END) || json_extract_string(props, '$.k') AS nameDest
  FROM events),
ledger_p AS (
  SELECT *, amount + event_id % 1000 AS oldbalanceOrg,
    CASE type WHEN 'CASH_OUT' THEN 90 WHEN 'TRANSFER' THEN 95 WHEN 'PAYMENT' THEN 55 WHEN 'DEBIT' THEN 30 ELSE 0 END AS pct
  FROM ledger_base),
ledger_r AS (
  SELECT step, type, amount, nameOrig, oldbalanceOrg,
    CASE WHEN event_id % 100 < pct THEN oldbalanceOrg ELSE oldbalanceOrg - amount END AS newbalanceOrig,
    nameDest,
    CASE WHEN nameDest LIKE 'M%' THEN CAST(0 AS DOUBLE) ELSE CAST(event_id % 500 AS DOUBLE) END AS oldbalanceDest,
    CASE WHEN nameDest LIKE 'M%' THEN CAST(0 AS DOUBLE) ELSE event_id % 500 + amount END AS newbalanceDest,
    CASE WHEN type IN ('TRANSFER','CASH_OUT') AND event_id % 37 = 0 THEN 1 ELSE 0 END AS isFraud,
    CASE WHEN type = 'TRANSFER' AND amount > 200000 THEN 1 ELSE 0 END AS isFlaggedFraud,
    event_id
  FROM ledger_p),
ledger AS (SELECT * FROM ledger_r UNION ALL SELECT * FROM ledger_r WHERE event_id % 50 = 0)"""

SILVER = """
ledger_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY step, type, amount, nameOrig, nameDest ORDER BY event_id) AS rn
  FROM ledger),
silver AS (
  SELECT step, type AS transaction_type, amount, nameOrig AS name_orig,
    oldbalanceOrg AS oldbalance_orig, newbalanceOrig AS newbalance_orig, nameDest AS name_dest,
    oldbalanceDest AS oldbalance_dest, newbalanceDest AS newbalance_dest,
    isFraud AS is_fraud, isFlaggedFraud AS is_flagged_fraud, event_id,
    CASE WHEN nameOrig LIKE 'M%' THEN 'MERCHANT' ELSE 'CUSTOMER' END AS orig_account_type,
    CASE WHEN nameDest LIKE 'M%' THEN 'MERCHANT' ELSE 'CUSTOMER' END AS dest_account_type,
    CAST(type IN ('CASH_OUT','TRANSFER','DEBIT','PAYMENT')
         AND abs(newbalanceOrig - (oldbalanceOrg - amount)) > CAST(0.01 AS DOUBLE) AS INTEGER) AS balance_inconsistent
  FROM ledger_ranked WHERE rn = 1)"""


def ratio(num: str, den: str, dp: int, scale: int = 1) -> str:
    """Exact half-up round(scale*num/den, dp) as DOUBLE; NULL when den = 0."""
    m = 2 * scale * 10**dp
    return (
        f"(CASE WHEN ({den}) > 0 THEN CAST((CAST({num} AS BIGINT) * {m} + CAST({den} AS BIGINT)) "
        f"// (2 * CAST({den} AS BIGINT)) AS DOUBLE) / CAST({10**dp} AS DOUBLE) END)"
    )


def with_ledger(body: str, *ctes: str) -> str:
    parts = [LEDGER] + list(ctes)
    return "WITH " + ",".join(parts) + "\n" + body


def with_silver(body: str, *ctes: str) -> str:
    return with_ledger(body, SILVER, *ctes)


# --- shared CTEs and helpers of the query oracles ------------------------


def hash_key_sql(expr: str) -> str:
    return f"CAST('0x' || substr(md5({expr}), 1, 15) AS BIGINT)"


def wide_key_sql(expr: str) -> str:
    return f"md5({expr})"


TXN_KEY_SQL = wide_key_sql(
    "concat_ws('|', coalesce(CAST(step AS VARCHAR), '<null>'), coalesce(transaction_type, '<null>'), "
    "coalesce(CAST(CAST(amount AS DECIMAL(38,6)) AS VARCHAR) || ':' || "
    "CAST(CAST(floor((amount - CAST(CAST(amount AS DECIMAL(38,6)) AS DOUBLE)) * 1e18) AS BIGINT) AS VARCHAR), '<null>'), coalesce(name_orig, '<null>'), "
    "coalesce(name_dest, '<null>'))"
)


FACT_CTE = f"""
fact AS (
  SELECT {TXN_KEY_SQL} AS transaction_key, step AS time_key, transaction_type, name_orig, name_dest, amount,
    oldbalance_orig, newbalance_orig, oldbalance_dest, newbalance_dest, is_fraud, is_flagged_fraud,
    balance_inconsistent
  FROM silver)"""


DIM_TIME_CTE = """
dim_time AS (
  SELECT step, step AS time_key, CAST(step // 24 + 1 AS INTEGER) AS day, step % 24 AS hour_of_day
  FROM (SELECT DISTINCT step FROM silver))"""


DIM_TYPE_CTE = """
dim_type AS (
  SELECT transaction_type, CAST(dense_rank() OVER (ORDER BY transaction_type) AS INTEGER) AS type_key
  FROM (SELECT DISTINCT transaction_type FROM silver))"""


DIM_ACCOUNT_CTE = f"""
dim_account AS (
  SELECT account_id, min(account_type) AS account_type,
    {wide_key_sql("coalesce(account_id, '<null>')")} AS account_key
  FROM (SELECT name_orig AS account_id, orig_account_type AS account_type FROM silver
        UNION ALL SELECT name_dest, dest_account_type FROM silver)
  GROUP BY account_id)"""


ACCOUNT_TOTALS_CTE = """
account_totals AS (
  SELECT name_orig, CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_out,
    COUNT(*) AS n_transactions, CAST(SUM(is_fraud) AS BIGINT) AS n_fraud
  FROM silver GROUP BY name_orig)"""


TOP_ACCOUNTS_CTE = """
top_accounts AS (SELECT * FROM account_totals ORDER BY total_out DESC, name_orig LIMIT 1000)"""


BAND_SQL = """CASE WHEN amount < 1000 THEN '0-1K' WHEN amount < 10000 THEN '1K-10K'
  WHEN amount < 100000 THEN '10K-100K' WHEN amount < 1000000 THEN '100K-1M' WHEN amount >= 1000000 THEN '1M+' END"""


BY_BAND_CTE = f"""
by_band AS (
  SELECT {BAND_SQL} AS amount_band, COUNT(*) AS n_transactions, CAST(SUM(is_fraud) AS BIGINT) AS n_fraud
  FROM silver GROUP BY 1)"""


BY_TYPE_HOUR_CTE = """
by_type_hour AS (
  SELECT transaction_type, step % 24 AS hour_of_day, COUNT(*) AS n_transactions,
    CAST(SUM(is_fraud) AS BIGINT) AS n_fraud
  FROM silver GROUP BY 1, 2)"""


FEATURES_CTE = """
features AS (
  SELECT step, name_orig, name_dest, coalesce(amount, 0.0) AS amount, step % 24 AS hour_of_day,
    CAST(transaction_type = 'TRANSFER' AS INTEGER) AS is_transfer,
    coalesce(oldbalance_orig, 0.0) AS oldbalance_orig, coalesce(newbalance_orig, 0.0) AS newbalance_orig,
    coalesce(oldbalance_dest, 0.0) AS oldbalance_dest, coalesce(newbalance_dest, 0.0) AS newbalance_dest,
    coalesce(oldbalance_orig, 0.0) - coalesce(amount, 0.0) - coalesce(newbalance_orig, 0.0) AS error_balance_orig,
    coalesce(oldbalance_dest, 0.0) + coalesce(amount, 0.0) - coalesce(newbalance_dest, 0.0) AS error_balance_dest,
    balance_inconsistent, is_fraud AS label
  FROM silver WHERE transaction_type IN ('TRANSFER', 'CASH_OUT'))"""


SPLIT_KEY_SQL = (
    "concat_ws('|', '42', coalesce(CAST(step AS VARCHAR), '<null>'), coalesce(CAST(is_transfer AS VARCHAR), '<null>'), "
    "coalesce(CAST(CAST(amount AS DECIMAL(38,6)) AS VARCHAR), '<null>'), coalesce(name_orig, '<null>'), "
    "coalesce(name_dest, '<null>'))"
)


SPLIT_CTE = f"""
hashed AS (SELECT *, {hash_key_sql(SPLIT_KEY_SQL)} AS h FROM features),
split AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY h) <=
            floor(COUNT(*) OVER (PARTITION BY label) * 0.25 + 0.5) AS is_test
  FROM hashed)"""


RULE_SCORE_SQL = (
    "CAST(floor(amount / 10000) AS DOUBLE) + 0.5 * CAST(coalesce(balance_inconsistent, 0) AS DOUBLE)"
)


CONFUSION_CTE = """
cm AS (
  SELECT CAST(count_if(is_fraud = 0 AND is_flagged_fraud = 0) AS BIGINT) AS tn,
    CAST(count_if(is_fraud = 0 AND is_flagged_fraud = 1) AS BIGINT) AS fp,
    CAST(count_if(is_fraud = 1 AND is_flagged_fraud = 0) AS BIGINT) AS fn,
    CAST(count_if(is_fraud = 1 AND is_flagged_fraud = 1) AS BIGINT) AS tp
  FROM silver)"""


def div_sql(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END)"


REPORT_CTE = f"""
pr AS (
  SELECT tn, fp, fn, tp, tn + fp AS s0, fn + tp AS s1, tn + fp + fn + tp AS total,
    {div_sql('tn', 'tn + fn')} AS p0, {div_sql('tn', 'tn + fp')} AS r0, {div_sql('2 * tn', '2 * tn + fn + fp')} AS f0,
    {div_sql('tp', 'tp + fp')} AS p1, {div_sql('tp', 'tp + fn')} AS r1, {div_sql('2 * tp', '2 * tp + fp + fn')} AS f1
  FROM cm)"""


def wavg_sql(a: str, b: str) -> str:
    return div_sql(f"{a} * s0 + {b} * s1", "total")


CLASSIFICATION_REPORT_SQL = with_silver(
    f"""SELECT '0' AS class_label, p0 AS precision, r0 AS recall, f0 AS f1_score, s0 AS support FROM pr
UNION ALL SELECT '1', p1, r1, f1, s1 FROM pr
UNION ALL SELECT 'accuracy', NULL, NULL, {div_sql('tn + tp', 'total')}, total FROM pr
UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, total FROM pr
UNION ALL SELECT 'weighted avg', {wavg_sql('p0', 'p1')}, {wavg_sql('r0', 'r1')}, {wavg_sql('f0', 'f1')}, total FROM pr""",
    CONFUSION_CTE,
    REPORT_CTE,
)


RAW_SQL = ", ".join(RAW_COLUMNS)


RAW_ORACLE = with_ledger(f"SELECT {RAW_SQL} FROM ledger")
