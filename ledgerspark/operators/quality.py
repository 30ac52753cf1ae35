"""Data-quality gates.

Each rule is a report DataFrame (so it can be inspected, stored and
checked by SQL); ``validate_*`` runs the reports and raises
:class:`QualityError` listing every violation.  Only bounded summaries
reach the driver: one row per rule, or per type value (capped for the
message, counted in full).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.sinks import write_table
from ..spec import LedgerSpec
from .star import integrity_report, key_collisions, orphan_keys

# How many offending values to name in an error message.
MESSAGE_VALUES = 20


class QualityError(Exception):
    """A data contract was violated; the message names every violation.

    ``tables`` maps each kind of offender to the stored Parquet table that
    holds all of them, however many the message names."""

    def __init__(self, message: str, tables: Mapping[str, str] | None = None):
        super().__init__(message)
        self.tables = dict(tables or {})


def required_columns_report(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Per required column: present in the schema, and its null count.

    One aggregation pass over the present columns; absent columns get
    ``present = false`` and a null count of null.
    """
    present = [c for c in required if c in df.columns]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in present]) if present else None
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(c in present).alias("present"),
            (F.col(c) if c in present else F.lit(None)).cast("long").alias("n_null"),
        )
        for c in required
    ]
    base = counts if counts is not None else df.limit(1).select()
    return base.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def amount_report(df: DataFrame, amount: str = "amount") -> DataFrame:
    """Rows, negative amounts and null amounts in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(amount) < 0).alias("n_negative"),
        F.count_if(F.col(amount).isNull()).alias("n_null_amount"),
    )


def domain_report(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Observed values of ``column`` with their row counts and whether each
    belongs to the allowed domain (a null value never does)."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.withColumn("in_domain", F.coalesce(F.col("value").isin(*allowed), F.lit(False)))


def volume_report(df: DataFrame) -> DataFrame:
    """Row count and whether the table is non-empty."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("non_empty", F.col("n_rows") > 0)


def duplicates_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct business keys and residual duplicates (one shuffle)."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
    ).withColumn("n_duplicates", F.col("n_rows") - F.col("n_keys"))


def inconsistency_report(
    df: DataFrame,
    thresholds: Mapping[str, float],
    type_col: str = "transaction_type",
    flag_col: str = "balance_inconsistent",
) -> DataFrame:
    """Per type: rows, flagged rows, rows of unknown flag, rate, threshold,
    and whether the rate is strictly above the threshold.

    The rate counts unknown (null) flags as not flagged and divides by all
    rows of the type.  Types without a threshold are reported, never
    violated.  Thresholds are a literal map, so no join is needed.
    """
    agg = df.groupBy(F.col(type_col).alias("transaction_type")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(F.col(flag_col).cast("long")), F.lit(0)).cast("long").alias("n_inconsistent"),
        F.count_if(F.col(flag_col).isNull()).alias("n_unknown"),
    )
    limits = F.create_map(*[x for k, v in sorted(thresholds.items()) for x in (F.lit(k), F.lit(float(v)))])
    rate = F.col("n_inconsistent").cast("double") / F.col("n_rows").cast("double")
    return agg.select(
        "transaction_type",
        "n_rows",
        "n_inconsistent",
        "n_unknown",
        rate.alias("rate"),
        F.element_at(limits, F.col("transaction_type")).alias("threshold"),
    ).withColumn("violated", F.coalesce(F.col("rate") > F.col("threshold"), F.lit(False)))


# --- enforcement ------------------------------------------------------------


def stored_report(report: DataFrame, name: str) -> DataFrame:
    """``report`` written to the shared scratch folder and read back."""
    spark = report.sparkSession
    path = scratch_path(spark, name)
    report.write.parquet(path)
    return spark.read.schema(report.schema).parquet(path)


def _raise(problems: list[str], layer: str, tables: Mapping[str, str] | None = None) -> None:
    if problems:
        raise QualityError(f"{layer} quality gate failed: " + "; ".join(problems), tables)


def offending_rows(df: DataFrame, spec: LedgerSpec = LedgerSpec(), type_col: str = "type") -> DataFrame:
    """The rows that break a row-wise bronze rule, with ``reasons``: the
    broken rules in the order null columns, amount, type."""
    rules = [(f"null {c}", F.col(c).isNull()) for c in spec.required_columns if c in df.columns]
    if "amount" in df.columns:
        rules.append(("negative amount", F.col("amount") < 0))
    rules.append(("unexpected type", ~F.coalesce(F.col(type_col).isin(*spec.types), F.lit(False))))
    broken = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules]))
    return df.withColumn("reasons", broken).filter(F.size("reasons") > 0)


def bronze_profile(df: DataFrame, spec: LedgerSpec = LedgerSpec(), type_col: str = "type") -> DataFrame:
    """Everything the bronze gate needs, in one aggregation pass: per type
    value, rows, negative amounts and nulls in each present required column."""
    present = [c for c in spec.required_columns if c in df.columns]
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    if "amount" in df.columns:
        aggs.append(F.count_if(F.col("amount") < 0).alias("n_negative"))
    aggs += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in present]
    return df.groupBy(F.col(type_col).alias("value")).agg(*aggs)


def validate_bronze(df: DataFrame, spec: LedgerSpec = LedgerSpec(), type_col: str = "type") -> list:
    """Required columns present and non-null, no negative amount, every type
    in the domain (a null type is out of the domain).  Returns the per-type
    profile rows on success (no more than the domain has values).

    Every row counts: the totals are summed by Spark over all types, and
    only the message names no more than the first offending types.  A
    failure stores all offending types (``tables["types"]``) and all
    offending rows (``tables["rows"]``); the rows cost a second pass, on
    failure only."""
    problems: list[str] = []
    tables: dict[str, str] = {}
    missing = [c for c in spec.required_columns if c not in df.columns]
    if missing:
        problems.append(f"missing columns {missing}")
    if type_col not in df.columns:
        _raise(problems + [f"missing column {type_col!r}"], "bronze")
    table = stored_report(bronze_profile(df, spec, type_col), "bronze-profile")
    present = [c for c in spec.required_columns if c in df.columns]
    known = F.coalesce(F.col("value").isin(*spec.types), F.lit(False))
    sums = [F.sum(c).alias(c) for c in table.columns if c not in ("value", "n_rows")]
    total = table.agg(F.count_if(~known).alias("n_offenders"), *sums).first()
    nulls = {c: total[f"null_{c}"] or 0 for c in present}
    bad_nulls = [f"{c}={n}" for c, n in nulls.items() if n]
    if bad_nulls:
        problems.append(f"null values in required columns ({', '.join(bad_nulls)})")
    if "amount" in df.columns:
        n_neg = total.n_negative or 0
        if n_neg:
            problems.append(f"{n_neg} negative amounts")
    if total.n_offenders:
        path = tables["types"] = scratch_path(df.sparkSession, "bronze-offenders")
        write_table(table.filter(~known), path)
        first = table.filter(~known).orderBy(F.desc("n_rows"), "value").limit(MESSAGE_VALUES).collect()
        names = ", ".join(f"{r.value!r} ({r.n_rows})" for r in first)
        problems.append(f"{total.n_offenders} unexpected types: {names} (all in {path})")
    if bad_nulls or total.n_offenders or ("amount" in df.columns and total.n_negative):
        tables["rows"] = scratch_path(df.sparkSession, "bronze-offending-rows")
        n = write_table(offending_rows(df, spec, type_col), tables["rows"])
        problems.append(f"{n} offending rows in {tables['rows']}")
    _raise(problems, "bronze", tables)
    return table.collect()


def validate_silver(df: DataFrame, spec: LedgerSpec = LedgerSpec()) -> DataFrame:
    """Non-empty, unique on the business key, and every per-type
    inconsistency rate at or under its threshold.  Returns the rate report
    (sorted by type) on success; a failure stores all violated rates
    (``tables["rates"]``)."""
    problems: list[str] = []
    tables: dict[str, str] = {}
    dup = duplicates_report(df, spec.dedup_keys).first()
    if dup.n_rows == 0:
        problems.append("table is empty")
    if dup.n_duplicates:
        problems.append(f"{dup.n_duplicates} residual duplicates on {list(spec.dedup_keys)}")
    report = stored_report(inconsistency_report(df, spec.thresholds), "silver-rates").orderBy("transaction_type")
    violated = report.filter("violated")
    n_violated = violated.count()
    if n_violated:
        path = tables["rates"] = scratch_path(df.sparkSession, "silver-violations")
        write_table(violated, path)
        problems.append(f"{n_violated} types above their threshold (all in {path}), no more than {MESSAGE_VALUES} named")
    for r in violated.limit(MESSAGE_VALUES).collect():
        problems.append(f"{r.transaction_type}: rate {r.rate:.1%} > threshold {r.threshold:.1%}")
    _raise(problems, "silver", tables)
    return report


def validate_gold(fact: DataFrame, accounts: DataFrame, time_dim: DataFrame, type_dim: DataFrame) -> DataFrame:
    """Keys unique in fact and account dimension, and every reference of the
    fact present in its dimension.  Returns the integrity report on success;
    a failure names the tables that hold all offending keys."""
    spark = fact.sparkSession
    problems: list[str] = []
    tables: dict[str, str] = {}
    reports = {
        "equal transaction keys": key_collisions(fact, "transaction_key"),
        "equal account keys": key_collisions(accounts, "account_key"),
        "references without a dimension row": orphan_keys(fact, accounts, time_dim, type_dim),
    }
    for what, rows in reports.items():
        path = scratch_path(spark, "gold-gate")
        n = write_table(rows, path)
        if n:
            tables[what] = path
            problems.append(f"{n} {what} (all in {path})")
    _raise(problems, "gold", tables)
    return integrity_report(fact, accounts, time_dim, type_dim)
