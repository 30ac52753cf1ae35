"""Star-schema queries: dimensions, fact, lookups, integrity."""

from __future__ import annotations

from ...operators import star
from .. import oracle as O
from ..oracle import DIM_ACCOUNT_CTE, DIM_TIME_CTE, DIM_TYPE_CTE, FACT_CTE, wide_key_sql
from .inputs import fact, silver, silver_table
from .registry import SPEC, query


@query("dim_time", O.with_silver("SELECT * FROM dim_time", DIM_TIME_CTE))
def q_dim_time(spark, sf_dir):
    return star.dim_time(silver(spark, sf_dir), SPEC)


@query("dim_transaction_type", O.with_silver("SELECT * FROM dim_type", DIM_TYPE_CTE))
def q_dim_transaction_type(spark, sf_dir):
    return star.dim_transaction_type(silver(spark, sf_dir))


@query("dim_account", O.with_silver("SELECT * FROM dim_account", DIM_ACCOUNT_CTE))
def q_dim_account(spark, sf_dir):
    return star.dim_account(silver(spark, sf_dir))


@query("fact_transactions", O.with_silver("SELECT * FROM fact", FACT_CTE))
def q_fact_transactions(spark, sf_dir):
    return fact(spark, sf_dir)


@query(
    "star_lookup",
    O.with_silver(
        f"""SELECT f.transaction_key, f.time_key, t.day, t.hour_of_day, k.type_key,
  {wide_key_sql("coalesce(f.name_orig, '<null>')")} AS orig_account_key,
  {wide_key_sql("coalesce(f.name_dest, '<null>')")} AS dest_account_key, f.amount, f.is_fraud
FROM fact f LEFT JOIN dim_time t ON f.time_key = t.time_key
LEFT JOIN dim_type k ON f.transaction_type = k.transaction_type""",
        FACT_CTE,
        DIM_TIME_CTE,
        DIM_TYPE_CTE,
    ),
)
def q_star_lookup(spark, sf_dir):
    # The columns of its SQL; star_lookup_accounts has the types as well.
    return _lookup(spark, sf_dir).drop("orig_account_type", "dest_account_type")


@query(
    "star_lookup_accounts",
    O.with_silver(
        """SELECT f.transaction_key, f.time_key, t.day, t.hour_of_day, k.type_key,
  o.account_key AS orig_account_key, d.account_key AS dest_account_key, f.amount, f.is_fraud,
  o.account_type AS orig_account_type, d.account_type AS dest_account_type
FROM fact f LEFT JOIN dim_time t ON f.time_key = t.time_key
LEFT JOIN dim_type k ON f.transaction_type = k.transaction_type
LEFT JOIN dim_account o ON f.name_orig IS NOT DISTINCT FROM o.account_id
LEFT JOIN dim_account d ON f.name_dest IS NOT DISTINCT FROM d.account_id""",
        FACT_CTE,
        DIM_TIME_CTE,
        DIM_TYPE_CTE,
        DIM_ACCOUNT_CTE,
    ),
)
def q_star_lookup_accounts(spark, sf_dir):
    return _lookup(spark, sf_dir)


def _lookup(spark, sf_dir):
    # As in the batch chain, the dimensions come from a materialised silver
    # table: the size check before broadcasting them is then a cheap scan,
    # not a second run of the dedup shuffle.
    s = silver_table(spark, sf_dir)
    return star.star_lookup(
        star.fact_transactions(s, SPEC), star.dim_time(s, SPEC), star.dim_transaction_type(s), accounts=star.dim_account(s)
    )


@query(
    "orphan_keys",
    O.with_silver(
        """SELECT r.role, COUNT(*) AS n_keys, CAST(count_if(d.key IS NULL) AS BIGINT) AS n_missing_keys,
  CAST(coalesce(SUM(CASE WHEN d.key IS NULL THEN r.n_rows END), 0) AS BIGINT) AS n_missing_rows
FROM (SELECT role, key, COUNT(*) AS n_rows FROM (
        SELECT 'sender' AS role, name_orig AS key FROM fact
        UNION ALL SELECT 'receiver', name_dest FROM fact
        UNION ALL SELECT 'time', CAST(time_key AS VARCHAR) FROM fact
        UNION ALL SELECT 'type', transaction_type FROM fact) GROUP BY role, key) r
LEFT JOIN (SELECT 'sender' AS role, account_id AS key FROM dim_account
           UNION ALL SELECT 'receiver', account_id FROM dim_account
           UNION ALL SELECT 'time', CAST(time_key AS VARCHAR) FROM dim_time
           UNION ALL SELECT 'type', transaction_type FROM dim_type) d
  ON r.role = d.role AND r.key = d.key
GROUP BY r.role""",
        FACT_CTE,
        "known AS (SELECT * FROM silver WHERE step % 7 <> 0 AND transaction_type <> 'DEBIT')",
        *(c.replace("FROM silver", "FROM known") for c in (DIM_TIME_CTE, DIM_TYPE_CTE, DIM_ACCOUNT_CTE)),
    ),
)
def q_orphan_keys(spark, sf_dir):
    """The fact against dimensions that lack every seventh step and one type: orphans in each role."""
    # Fact and three dimensions all derive from silver: materialise it once.
    s = silver_table(spark, sf_dir)
    known = s.where("step % 7 <> 0 AND transaction_type <> 'DEBIT'")
    return star.integrity_report(
        star.fact_transactions(s, SPEC), star.dim_account(known), star.dim_time(known, SPEC), star.dim_transaction_type(known)
    )
