"""Stage-level entry points, one per step of the ledger workflow.

Each function takes explicit paths / targets (no environment
configuration) and runs as Spark jobs; they are the call sites a batch
scheduler or notebook uses.  Table handovers are always written tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .operators import quality
from .plans import medallion, training
from .sources import files, warehouse
from .spec import LedgerSpec
from .streaming import land, messages, positions


# --- batch layers -------------------------------------------------------------


def ingest_bronze(spark: SparkSession, csv_path: str, bronze_path: str, quarantine_path: str | None = None) -> int:
    """Raw CSV -> bronze Parquet partitioned by type; returns rows written."""
    return medallion.ingest_bronze(spark, csv_path, bronze_path, quarantine=quarantine_path)


def validate_bronze(spark: SparkSession, bronze_path: str, spec: LedgerSpec = LedgerSpec()) -> list:
    """Bronze contract; raises QualityError listing every violation."""
    return quality.validate_bronze(files.read_table(spark, bronze_path), spec)


def build_silver(spark: SparkSession, bronze_path: str, silver_path: str, spec: LedgerSpec = LedgerSpec()) -> DataFrame:
    """Bronze -> silver table; returns the silver table as written."""
    return medallion.build_silver(spark, bronze_path, silver_path, spec)


def validate_silver(spark: SparkSession, silver_path: str, spec: LedgerSpec = LedgerSpec()) -> DataFrame:
    """Silver contract and per-type inconsistency gate; returns the rate report."""
    return quality.validate_silver(files.read_table(spark, silver_path), spec)


def build_gold(spark: SparkSession, silver_path: str, gold_root: str, spec: LedgerSpec = LedgerSpec()) -> dict[str, int]:
    """Star schema and marts under ``gold_root``; returns table -> rows."""
    return medallion.build_gold(files.read_table(spark, silver_path), gold_root, spec)


def build_features(spark: SparkSession, silver_path: str, features_path: str, spec: LedgerSpec = LedgerSpec()) -> DataFrame:
    """Fraud feature table; returns it as written."""
    return medallion.build_feature_table(spark, silver_path, features_path, spec)


def train_and_evaluate(
    spark: SparkSession, features_path: str, out_root: str, spec: LedgerSpec = LedgerSpec()
) -> DataFrame:
    """Split, fit both models, evaluate on the test rows; models go to
    ``out_root/models`` and the tidy metrics to ``out_root/metrics`` (JSON).
    Returns the metrics."""
    t = training.train(files.read_table(spark, features_path), spec)
    report = training.evaluation(t)
    out_root = out_root.rstrip("/")
    training.save_models(t, f"{out_root}/models")
    training.save_metrics(report, f"{out_root}/metrics")
    return spark.read.json(f"{out_root}/metrics")


# --- streaming ------------------------------------------------------------------


def row_to_message(raw: DataFrame) -> DataFrame:
    """Raw ledger rows -> one typed JSON ``value`` per row."""
    return messages.to_messages(raw)


def produce(raw: DataFrame, target: str, limit: int = 0, order_by: tuple[str, ...] = (), kafka: dict | None = None) -> int:
    """Publish the first ``limit`` rows (0 = all) as JSON messages, to a
    Kafka topic (``kafka`` options: ``kafka.bootstrap.servers``, ``topic``)
    or as text files under ``target``.  A limit needs an order, so that it
    names the same rows each time.  Returns the number sent."""
    if limit > 0 and not order_by:
        raise ValueError("limit needs order_by")
    obs = Observation()
    counted = messages.to_messages(files.replay(raw, limit, order_by)).observe(obs, F.count(F.lit(1)).alias("n"))
    if kafka:
        messages.publish_messages(counted, target, fmt="kafka", options=kafka)
    else:
        messages.publish_messages(counted, target, fmt="text")
    return int(obs.get["n"])


def consume(
    spark: SparkSession,
    out_path: str,
    checkpoint: str,
    topic: str,
    source_path: str | None = None,
    bootstrap_servers: str | None = None,
    batch_size: int = 200,
    batch_timeout: float = 10.0,
    max_messages: int = 0,
    quarantine_path: str | None = None,
) -> int:
    """Land a topic (or a folder of message files) in the append-only zone.

    ``batch_size`` is a number of messages.  A folder is read by position:
    ``max_messages > 0`` lands the next so many messages after the last
    landed one, and a repeated call goes on from there; otherwise all are
    landed, and those that come until ``batch_timeout`` seconds pass
    without any (0 = land what is there and stop).  For Kafka a bounded
    call lands the first ``max_messages`` in one batch read, and otherwise
    the stream runs until ``batch_timeout`` seconds pass without input.
    Returns the rows landed.
    """
    lineage = f"kafka:{topic}"
    bounded = max_messages and max_messages > 0
    if not bootstrap_servers:
        log = positions.MessageLog(spark, source_path, f"{checkpoint}/log")
        if bounded:
            return positions.land_next(log, out_path, lineage, max_messages, batch_size, quarantine_path).landed
        return positions.land_until_idle(log, out_path, lineage, batch_size, batch_timeout, quarantine_path).landed
    if bounded:
        msgs = land.kafka_batch(spark, bootstrap_servers, topic)
        return land.land_bounded(msgs, out_path, lineage, max_rows=max_messages, order_by=("partition", "offset"),
                                 quarantine_path=quarantine_path).landed
    source = land.kafka_source(spark, bootstrap_servers, topic, batch_rows=batch_size)
    run = land.land_stream(
        source,
        out_path,
        checkpoint,
        lineage,
        quarantine_path=quarantine_path,
        available_now=not batch_timeout,
        processing_time="1 second",
        idle_timeout_s=batch_timeout or None,
    )
    return run.landed


# --- serving ------------------------------------------------------------------


def write_dataframe(df: DataFrame, name: str, target) -> int:
    """Replace served table ``name`` with ``df``; returns rows written."""
    return warehouse.publish_table(df, name, target)


def read_dataframe(spark: SparkSession, name: str, target) -> DataFrame:
    """``SELECT *`` of a served table."""
    return warehouse.read_served(spark, name, target)


def load_warehouse(spark: SparkSession, gold_root: str, target) -> dict[str, int]:
    """Publish the served gold tables plus the KPI summary."""
    return medallion.load_warehouse(spark, gold_root, target)
