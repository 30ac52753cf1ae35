"""Star schema: dimensions, fact, lookups and the integrity gate.

Keys are reproducible: account and transaction keys are a 60-bit hash of
the natural key (same value on every run, every partitioning, and in
DuckDB).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import day_number, hour_of_day, exact_text, wide_key
from ..functions.sizing import sized_broadcast
from ..spec import LedgerSpec

FACT_COLUMNS = [
    "transaction_key",
    "time_key",
    "transaction_type",
    "name_orig",
    "name_dest",
    "amount",
    "oldbalance_orig",
    "newbalance_orig",
    "oldbalance_dest",
    "newbalance_dest",
    "is_fraud",
    "is_flagged_fraud",
    "balance_inconsistent",
]

# Upper bound on rows of a small dimension we are willing to broadcast.
SMALL_DIM_ROWS = 1_000_000


def dim_time(silver: DataFrame, spec: LedgerSpec = LedgerSpec()) -> DataFrame:
    """One row per observed step: time_key, day (1-based), hour of day."""
    steps = silver.select("step").distinct()
    return steps.select(
        "step",
        F.col("step").alias("time_key"),
        day_number("step", spec.steps_per_day).alias("day"),
        hour_of_day("step", spec.steps_per_day).alias("hour_of_day"),
    )


def dim_transaction_type(silver: DataFrame) -> DataFrame:
    """Observed types with a dense 1..n key in alphabetical order.

    The distinct runs first (partial aggregation), so the global window
    only ever sees the handful of type values -- the domain gate bounds
    them to the configured type list.
    """
    types = silver.select("transaction_type").distinct()
    return types.withColumn("type_key", F.dense_rank().over(Window.orderBy("transaction_type")))


def account_roles(silver: DataFrame) -> DataFrame:
    """(account_id, account_type) for both sender and receiver, one scan.

    ``explode`` of a two-element array replaces a union of two scans.
    """
    pair = F.array(
        F.struct(F.col("name_orig").alias("account_id"), F.col("orig_account_type").alias("account_type")),
        F.struct(F.col("name_dest").alias("account_id"), F.col("dest_account_type").alias("account_type")),
    )
    return silver.select(F.explode(pair).alias("r")).select("r.account_id", "r.account_type")


def dim_account(silver: DataFrame) -> DataFrame:
    """One row per account id (sender or receiver) with a hashed key.

    An id seen with two types keeps the smallest type; ``min`` combines
    map-side, so a hot account costs one row per task in the shuffle.
    """
    accounts = account_roles(silver).groupBy("account_id").agg(F.min("account_type").alias("account_type"))
    return accounts.withColumn("account_key", wide_key("account_id"))


def transaction_key(spec: LedgerSpec = LedgerSpec()):
    parts = [exact_text(c) if c == "amount" else F.col(c).cast("string") for c in spec.dedup_keys]
    return wide_key(*parts)


def fact_transactions(silver: DataFrame, spec: LedgerSpec = LedgerSpec()) -> DataFrame:
    """The fact table: hashed transaction key, time key, measures, flags."""
    return silver.withColumn("transaction_key", transaction_key(spec)).withColumnRenamed("step", "time_key").select(
        *FACT_COLUMNS
    )


def star_lookup(
    fact: DataFrame,
    time_dim: DataFrame,
    type_dim: DataFrame,
    max_dim_rows: int = SMALL_DIM_ROWS,
    accounts: DataFrame | None = None,
) -> DataFrame:
    """Resolve the fact's foreign keys against the dimensions.

    Time and type dimensions are small and joined by a size-checked
    broadcast (no shuffle of the fact).  The account dimension is looked up
    for sender and receiver, giving key and type of each; an id that is null
    finds the dimension's null row.  These joins are shuffled by account id
    unless the planner measures the dimension as small, and AQE splits the
    fact rows of a hot account.  All joins are left joins: a fact row whose
    key is missing keeps a null dimension key instead of disappearing.
    Without ``accounts`` nothing is looked up: the account keys are the
    hashes that the dimension would hold, and there are no types.
    """
    t = sized_broadcast(time_dim.select("time_key", "day", "hour_of_day"), max_dim_rows)
    k = sized_broadcast(type_dim.select("transaction_type", "type_key"), max_dim_rows)
    found = fact.join(t, "time_key", "left").join(k, "transaction_type", "left")
    types = []
    for role in ("orig", "dest"):
        if accounts is None:
            found = found.withColumn(f"{role}_account_key", wide_key(f"name_{role}"))
            continue
        types.append(f"{role}_account_type")
        a = accounts.select(
            F.col("account_id").alias(f"{role}_id"),
            F.col("account_key").alias(f"{role}_account_key"),
            F.col("account_type").alias(types[-1]),
        )
        found = found.join(a, F.col(f"name_{role}").eqNullSafe(F.col(f"{role}_id")), "left")
    return found.select(
        "transaction_key",
        "time_key",
        "day",
        "hour_of_day",
        "type_key",
        "orig_account_key",
        "dest_account_key",
        "amount",
        "is_fraud",
        *types,
    )


def orphan_keys(fact: DataFrame, accounts: DataFrame, time_dim: DataFrame, type_dim: DataFrame) -> DataFrame:
    """Fact references missing from their dimension: (role, key, n_rows).

    Empty when the star is consistent.  Account ids from both roles are
    pre-aggregated (partial count per task) before the anti-join, so the
    shuffle carries distinct ids, not fact rows.
    """
    refs = fact.select(
        F.explode(
            F.array(
                F.struct(F.lit("sender").alias("role"), F.col("name_orig").alias("key")),
                F.struct(F.lit("receiver").alias("role"), F.col("name_dest").alias("key")),
            )
        ).alias("r")
    ).select("r.role", "r.key")
    acc_refs = refs.groupBy("role", "key").agg(F.count(F.lit(1)).alias("n_rows"))
    missing_acc = acc_refs.join(accounts.select(F.col("account_id").alias("key")), "key", "left_anti")
    time_refs = fact.groupBy(F.col("time_key").cast("string").alias("key")).agg(F.count(F.lit(1)).alias("n_rows"))
    missing_time = time_refs.join(
        sized_broadcast(time_dim.select(F.col("time_key").cast("string").alias("key")), SMALL_DIM_ROWS), "key", "left_anti"
    ).withColumn("role", F.lit("time"))
    type_refs = fact.groupBy(F.col("transaction_type").alias("key")).agg(F.count(F.lit(1)).alias("n_rows"))
    missing_type = type_refs.join(
        sized_broadcast(type_dim.select(F.col("transaction_type").alias("key")), SMALL_DIM_ROWS), "key", "left_anti"
    ).withColumn("role", F.lit("type"))
    cols = ["role", "key", "n_rows"]
    return missing_acc.select(*cols).unionByName(missing_time.select(*cols)).unionByName(missing_type.select(*cols))


def key_collisions(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once (uniqueness gate for hashed keys)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def integrity_report(fact: DataFrame, accounts: DataFrame, time_dim: DataFrame, type_dim: DataFrame) -> DataFrame:
    """Per reference role: distinct keys referenced, keys missing from the
    dimension, and fact rows pointing at a missing key.  All-zero
    ``n_missing_*`` columns mean the star is consistent."""
    refs = fact.select(
        F.explode(
            F.array(
                F.struct(F.lit("sender").alias("role"), F.col("name_orig").alias("key")),
                F.struct(F.lit("receiver").alias("role"), F.col("name_dest").alias("key")),
                F.struct(F.lit("time").alias("role"), F.col("time_key").cast("string").alias("key")),
                F.struct(F.lit("type").alias("role"), F.col("transaction_type").alias("key")),
            )
        ).alias("r")
    ).select("r.role", "r.key")
    per_key = refs.groupBy("role", "key").agg(F.count(F.lit(1)).alias("n_rows"))
    known = (
        accounts.select(F.lit("sender").alias("role"), F.col("account_id").alias("key"))
        .unionByName(accounts.select(F.lit("receiver").alias("role"), F.col("account_id").alias("key")))
        .unionByName(time_dim.select(F.lit("time").alias("role"), F.col("time_key").cast("string").alias("key")))
        .unionByName(type_dim.select(F.lit("type").alias("role"), F.col("transaction_type").alias("key")))
        .withColumn("known", F.lit(True))
    )
    missing = F.col("known").isNull()
    return (
        per_key.join(known, ["role", "key"], "left")
        .groupBy("role")
        .agg(
            F.count(F.lit(1)).alias("n_keys"),
            F.count_if(missing).alias("n_missing_keys"),
            F.coalesce(F.sum(F.when(missing, F.col("n_rows"))), F.lit(0)).cast("long").alias("n_missing_rows"),
        )
    )
