"""Gold marts and the reports read from them."""

from __future__ import annotations

from ...operators import marts
from .. import oracle as O
from ..oracle import ACCOUNT_TOTALS_CTE, BY_BAND_CTE, BY_TYPE_HOUR_CTE, FACT_CTE, TOP_ACCOUNTS_CTE
from .inputs import by_type_hour, fact, silver
from .registry import SPEC, query


FRAUD_BY_TYPE_HOUR_SQL = O.with_silver(
    f"""SELECT transaction_type, step % 24 AS hour_of_day, COUNT(*) AS n_transactions,
  CAST(SUM(is_fraud) AS BIGINT) AS n_fraud, {O.ratio('SUM(is_fraud)', 'COUNT(*)', 4)} AS fraud_rate
FROM silver GROUP BY 1, 2"""
)


@query("fraud_by_type_hour", FRAUD_BY_TYPE_HOUR_SQL)
def q_fraud_by_type_hour(spark, sf_dir):
    return marts.fraud_by_type_hour(silver(spark, sf_dir), SPEC)


@query("top_accounts", O.with_silver("SELECT * FROM top_accounts", ACCOUNT_TOTALS_CTE, TOP_ACCOUNTS_CTE))
def q_top_accounts(spark, sf_dir):
    return marts.top_accounts(silver(spark, sf_dir), spec=SPEC)


@query(
    "fraud_by_amount_band",
    O.with_silver(
        f"SELECT *, {O.ratio('n_fraud', 'n_transactions', 4)} AS fraud_rate FROM by_band", BY_BAND_CTE
    ),
)
def q_fraud_by_amount_band(spark, sf_dir):
    return marts.fraud_by_amount_band(silver(spark, sf_dir), SPEC)


@query(
    "kpi_summary",
    O.with_silver(
        f"""SELECT COUNT(*) AS n_transactions, CAST(SUM(is_fraud) AS BIGINT) AS n_fraud,
  {O.ratio('SUM(is_fraud)', 'COUNT(*)', 4, 100)} AS fraud_pct,
  CAST(SUM(balance_inconsistent) AS BIGINT) AS n_balance_inconsistent FROM fact""",
        FACT_CTE,
    ),
)
def q_kpi_summary(spark, sf_dir):
    return marts.kpi_summary(fact(spark, sf_dir))


@query(
    "kpi_first",
    O.with_silver(
        f"""SELECT COUNT(*) AS n_transactions, CAST(SUM(is_fraud) AS BIGINT) AS n_fraud,
  {O.ratio('SUM(is_fraud)', 'COUNT(*)', 4, 100)} AS fraud_pct,
  CAST(SUM(balance_inconsistent) AS BIGINT) AS n_balance_inconsistent FROM fact LIMIT 1""",
        FACT_CTE,
    ),
)
def q_kpi_first(spark, sf_dir):
    return marts.first_row(marts.kpi_summary(fact(spark, sf_dir)))


@query(
    "fraud_pct_by_type",
    O.with_silver(
        f"""SELECT transaction_type, CAST(SUM(n_transactions) AS BIGINT) AS total, CAST(SUM(n_fraud) AS BIGINT) AS frauds,
  {O.ratio('SUM(n_fraud)', 'SUM(n_transactions)', 3, 100)} AS fraud_pct
FROM by_type_hour GROUP BY transaction_type""",
        BY_TYPE_HOUR_CTE,
    ),
)
def q_fraud_pct_by_type(spark, sf_dir):
    return marts.fraud_pct_by_type(by_type_hour(spark, sf_dir))


@query(
    "risky_hours",
    O.with_silver(
        f"""SELECT hour_of_day, CAST(SUM(n_fraud) AS BIGINT) AS frauds,
  {O.ratio('SUM(n_fraud)', 'SUM(n_transactions)', 3, 100)} AS fraud_pct
FROM by_type_hour GROUP BY hour_of_day ORDER BY frauds DESC, hour_of_day LIMIT 10""",
        BY_TYPE_HOUR_CTE,
    ),
)
def q_risky_hours(spark, sf_dir):
    return marts.risky_hours(by_type_hour(spark, sf_dir))


@query(
    "band_report",
    O.with_silver(
        f"""SELECT amount_band, n_transactions, n_fraud, {O.ratio('n_fraud', 'n_transactions', 2, 100)} AS fraud_pct
FROM by_band ORDER BY CASE amount_band WHEN '0-1K' THEN 1 WHEN '1K-10K' THEN 2 WHEN '10K-100K' THEN 3
  WHEN '100K-1M' THEN 4 ELSE 5 END""",
        BY_BAND_CTE,
    ),
)
def q_band_report(spark, sf_dir):
    return marts.band_report(marts.fraud_by_amount_band(silver(spark, sf_dir), SPEC), SPEC)


@query(
    "top10_accounts",
    O.with_silver(
        """SELECT name_orig, ROUND(total_out, 2) AS total_out, n_transactions, n_fraud
FROM top_accounts ORDER BY total_out DESC, name_orig LIMIT 10""",
        ACCOUNT_TOTALS_CTE,
        TOP_ACCOUNTS_CTE,
    ),
)
def q_top10_accounts(spark, sf_dir):
    return marts.top_k_accounts(marts.top_accounts(silver(spark, sf_dir), spec=SPEC), 10)


@query(
    "fraud_vs_inconsistency",
    O.with_silver(
        """SELECT is_fraud, balance_inconsistent, COUNT(*) AS n FROM fact
GROUP BY is_fraud, balance_inconsistent ORDER BY is_fraud DESC, balance_inconsistent DESC""",
        FACT_CTE,
    ),
)
def q_fraud_vs_inconsistency(spark, sf_dir):
    return marts.fraud_vs_inconsistency(fact(spark, sf_dir))


@query(
    "type_report_ordered",
    O.with_silver(
        f"""SELECT transaction_type, CAST(SUM(n_transactions) AS BIGINT) AS n_transactions,
  CAST(SUM(n_fraud) AS BIGINT) AS n_fraud,
  {O.ratio('SUM(n_fraud)', 'SUM(n_transactions)', 3, 100)} AS fraud_pct
FROM by_type_hour GROUP BY transaction_type""",
        BY_TYPE_HOUR_CTE,
    ),
)
def q_type_report_ordered(spark, sf_dir):
    return marts.type_report_ordered(by_type_hour(spark, sf_dir), SPEC)


@query(
    "hour_series",
    O.with_silver(
        "SELECT hour_of_day, CAST(SUM(n_fraud) AS BIGINT) AS n_fraud FROM by_type_hour GROUP BY hour_of_day ORDER BY hour_of_day",
        BY_TYPE_HOUR_CTE,
    ),
)
def q_hour_series(spark, sf_dir):
    return marts.hour_series(by_type_hour(spark, sf_dir))
