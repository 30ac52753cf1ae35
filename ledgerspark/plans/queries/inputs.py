"""Inputs shared by the registered queries: the silver ledger, fact, features, message files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...functions.columns import money_text
from ...operators import marts, models, star
from ...operators.clean import silver_from_raw, stamp_lineage
from ...operators.split import stratified_split
from ...operators import features as feats
from ...session import scratch_path, stored
from ...sources import sinks
from ...sources.ledger import read_ledger
from ...spec import RAW_COLUMNS
from ...streaming import land, messages
from .. import training
from ..medallion import gold_tables
from .registry import SPEC


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_from_raw(read_ledger(spark, sf_dir), SPEC)


def silver_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver stored once (Parquet under ``spark.checkpoint.dir``), for
    queries that derive several outputs from it -- as the batch chain does
    with its written silver table."""
    return stored(silver(spark, sf_dir), "silver-once")


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.fact_transactions(silver(spark, sf_dir), SPEC)


def by_type_hour(spark, sf_dir):
    return marts.fraud_by_type_hour(silver(spark, sf_dir), SPEC)


def split_key():
    return [
        F.col("step").cast("string"),
        F.col("is_transfer").cast("string"),
        money_text("amount"),
        F.col("name_orig"),
        F.col("name_dest"),
    ]


def features(spark, sf_dir):
    return feats.build_features(silver(spark, sf_dir), SPEC)


def split_features(spark, sf_dir):
    return stratified_split(
        features(spark, sf_dir), split_key(), "label", SPEC.test_fraction, SPEC.seed, materialize=True
    )


def rule_score():
    """A fixed, tie-heavy score: amount in 10k steps, +0.5 when the balance
    flag is set."""
    return F.floor(F.col("amount") / 10000).cast("double") + F.lit(0.5) * F.coalesce(
        F.col("balance_inconsistent"), F.lit(0)
    ).cast("double")


def raw(spark, sf_dir):
    return read_ledger(spark, sf_dir).select(*RAW_COLUMNS)


def bronze_table(spark, sf_dir) -> str:
    path = scratch_path(spark, "bronze")
    sinks.write_table(stamp_lineage(read_ledger(spark, sf_dir), "events.parquet"), path, partition_by=["type"])
    return path


def counts_frame(spark, counts: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(list(counts.items()), "table_name string, n_rows bigint")


def serving_tables(s: DataFrame) -> dict[str, DataFrame]:
    g = gold_tables(s, SPEC)
    return {
        "agg_fraud_by_type_hour": g["agg_fraud_by_type_hour"],
        "agg_top_accounts": g["agg_top_accounts"],
        "agg_fraud_by_amount_band": g["agg_fraud_by_amount_band"],
        "dim_transaction_type": g["dim_transaction_type"],
        "kpi_summary": marts.kpi_summary(g["fact_transactions"]),
    }


TOPIC = "ledger-transactions"


#: Most bytes of messages in a micro-batch of the landing queries.
BATCH_BYTES = 1 << 30


def message_files(spark, sf_dir, corrupt_flagged: bool = False, ordered: bool = False, where=None) -> str:
    """Write the ledger as JSON message files (the stand-in for a topic), one
    per input partition; ``ordered`` by event, so that positions follow the events.

    With ``corrupt_flagged`` the messages of rows the legacy system flagged
    are cut to their first 20 characters (malformed JSON)."""
    src = read_ledger(spark, sf_dir)
    if ordered:
        src = src.repartitionByRange("event_id").sortWithinPartitions("event_id")
    if where is not None:
        src = src.where(where)
    value = F.to_json(messages.message_struct())
    if corrupt_flagged:
        value = F.when(F.col("isFlaggedFraud") == 1, F.substring(value, 1, 20)).otherwise(value)
    path = scratch_path(spark, "messages")
    src.select(value.alias("value")).write.mode("overwrite").text(path)
    return path


def land_messages(spark, src_dir, out, ckpt, quarantine=None):
    return land.land_stream(
        land.file_source(spark, src_dir, bytes_per_batch=BATCH_BYTES), out, ckpt, f"kafka:{TOPIC}", quarantine_path=quarantine
    )


FEATURE_LIST = list(models.FEATURE_COLUMNS)


def trained(spark, sf_dir):
    return training.train(features(spark, sf_dir), SPEC)
