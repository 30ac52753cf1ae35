"""Landing a transaction stream into an append-only Parquet zone.

``readStream`` (Kafka, or text files in tests) -> ``from_json`` with the
raw schema -> lineage stamp -> Parquet partitioned by type.  Rows whose
required fields did not decode go to a quarantine instead of stopping the
job.  Each micro-batch is written idempotently to its own batch folder
and the stream checkpoint records finished batches, so a restart (or a
re-run over the same input) never lands a row twice.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.clean import stamp_lineage
from ..spec import RAW_COLUMNS, RAW_SCHEMA, STREAM_BATCH_ROWS
from .messages import parse_messages, valid_messages


#: The batch of a row in a folder that many batches share.
ROW_BATCH = "row_batch"


def kafka_source(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    batch_rows: int = STREAM_BATCH_ROWS,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = True,
) -> DataFrame:
    """Topic subscription; ``batch_rows`` caps each micro-batch.  Needs the
    Kafka connector on the classpath (not present in this environment).
    Offsets that retention has removed fail the stream unless
    ``fail_on_data_loss`` is off."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("maxOffsetsPerTrigger", str(batch_rows))
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def file_source(
    spark: SparkSession, path: str, files_per_batch: int | None = 1, bytes_per_batch: int | None = None
) -> DataFrame:
    """Text files of one JSON message per line; a number of files or of
    bytes caps each micro-batch (``positions`` caps by rows)."""
    limit = ("maxBytesPerTrigger", bytes_per_batch) if bytes_per_batch else ("maxFilesPerTrigger", files_per_batch)
    return spark.readStream.format("text").option(limit[0], str(limit[1])).load(path)


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """The landing zone with its fixed schema: no rows where only bad
    messages, or none, have arrived."""
    return _read_batches(spark, path, StructType([*RAW_SCHEMA.fields]))


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """The quarantined messages with their batches; no rows where none was bad."""
    return _read_batches(spark, path, StructType().add("raw_value", "string").add("reason", "string"))


def _read_batches(spark: SparkSession, path: str, columns: StructType) -> DataFrame:
    schema = StructType([*columns.fields]).add("ingestion_timestamp", "timestamp").add("source_file", "string").add(ROW_BATCH, "long").add("batch_id", "long")
    try:
        rows = spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], schema)
    return rows.withColumn("batch_id", F.coalesce(ROW_BATCH, "batch_id")).drop(ROW_BATCH)


def default_quarantine(out_path: str) -> str:
    """Where undecodable messages go when no quarantine is named: a sibling
    of the landing zone (they are never dropped)."""
    return out_path.rstrip("/") + "__quarantine"


def rejected(parsed: DataFrame, lineage: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Quarantine rows: the message text, why, and the lineage stamp (the
    same shape as the batch ingest quarantine)."""
    return parsed.select(
        "raw_value",
        F.lit("undecodable message").alias("reason"),
        F.current_timestamp().alias("ingestion_timestamp"),
        F.lit(lineage).alias("source_file"),
        *keep,
    )


@dataclass
class LandingRun:
    landed: int
    quarantined: int
    batches: int


def _await_idle(query, idle_s: float, timeout_s: float | None, poll_s: float = 0.5) -> None:
    """Block until ``query`` has seen no input for ``idle_s`` seconds (or
    ``timeout_s`` elapsed, or it terminated)."""
    start = last_input = time.monotonic()
    last_batch = None
    while query.isActive:
        now = time.monotonic()
        status = query.status
        if status["isTriggerActive"] and status["isDataAvailable"]:
            last_input = now  # a batch with data is running: not idle
        p = query.lastProgress
        if p is not None and p["batchId"] != last_batch:
            last_batch = p["batchId"]
            if p["numInputRows"] > 0:
                last_input = now
        if now - last_input >= idle_s or (timeout_s is not None and now - start >= timeout_s):
            return
        query.awaitTermination(poll_s)


def land_stream(
    source: DataFrame,
    out_path: str,
    checkpoint: str,
    lineage: str,
    quarantine_path: str | None = None,
    partition_by: str = "type",
    available_now: bool = True,
    processing_time: str | None = None,
    timeout_s: float | None = None,
    idle_timeout_s: float | None = None,
) -> LandingRun:
    """Run the landing job.

    One streaming query reads the source once.  Each micro-batch is parsed
    once (persisted for its two writes; its size is capped by the source's
    per-batch limit), then valid rows go to ``out_path/batch_id=N/`` (by
    ``partition_by``) and undecodable messages to
    ``quarantine_path/batch_id=N/`` (default: a sibling of the landing
    zone).  Both writes overwrite their batch folder, so a batch replayed
    after a failure replaces its own output: exactly-once, with the
    checkpoint recording which batches are done.

    ``available_now`` drains what is there and stops; otherwise
    ``processing_time`` sets a periodic trigger and the call returns after
    ``timeout_s`` seconds, or once no micro-batch has brought input for
    ``idle_timeout_s`` seconds (the next start resumes from the checkpoint).
    """
    from ..sources.sinks import write_table

    quarantine_path = (quarantine_path or default_quarantine(out_path)).rstrip("/")
    out_path = out_path.rstrip("/")
    totals = {"landed": 0, "quarantined": 0, "batches": 0}

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_messages(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            ok = valid_messages(parsed)
            # The landing write also counts the batch's undecodable rows, so
            # an all-valid batch costs a single job.
            seen = Observation()
            counted = parsed.observe(seen, F.count_if(~ok).alias("bad"))
            good = stamp_lineage(counted.filter(ok).select(*RAW_COLUMNS), lineage)
            totals["landed"] += write_table(good, f"{out_path}/batch_id={batch_id}", partition_by=[partition_by])
            if seen.get["bad"]:
                bad = rejected(parsed.filter(~ok), lineage)
                totals["quarantined"] += write_table(bad, f"{quarantine_path}/batch_id={batch_id}")
            totals["batches"] += 1
        finally:
            parsed.unpersist()

    trigger = {"availableNow": True} if available_now else {"processingTime": processing_time or "10 seconds"}
    query = (
        source.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", f"{checkpoint}/landing")
        .trigger(**trigger)
        .start()
    )
    if available_now:
        query.awaitTermination()
    else:
        if idle_timeout_s:
            _await_idle(query, idle_timeout_s, timeout_s)
        else:
            query.awaitTermination(timeout_s)
        query.stop()
    return LandingRun(landed=totals["landed"], quarantined=totals["quarantined"], batches=totals["batches"])


def land_bounded(
    messages: DataFrame,
    out_path: str,
    lineage: str,
    max_rows: int = 0,
    order_by: tuple[str, ...] = (),
    quarantine_path: str | None = None,
    partition_by: str = "type",
) -> LandingRun:
    """Bounded landing from a batch read of the source (for Kafka, a batch
    read between ``startingOffsets`` and ``endingOffsets``): the first
    ``max_rows`` messages in ``order_by`` order (e.g. partition, offset),
    or all of them when ``max_rows`` is 0.  Lands in the same layout as
    :func:`land_stream`, under a batch folder named by the run's start
    time in milliseconds."""
    from ..sources.sinks import write_table

    quarantine_path = (quarantine_path or default_quarantine(out_path)).rstrip("/")
    batch = f"batch_id={int(time.time() * 1000)}"
    picked = messages.orderBy(*order_by).limit(max_rows) if max_rows and max_rows > 0 else messages
    parsed = parse_messages(picked)
    ok = valid_messages(parsed)
    good = stamp_lineage(parsed.filter(ok).select(*RAW_COLUMNS), lineage)
    landed = write_table(good, f"{out_path.rstrip('/')}/{batch}", partition_by=[partition_by])
    bad = write_table(rejected(parsed.filter(~ok), lineage), f"{quarantine_path}/{batch}")
    return LandingRun(landed=landed, quarantined=bad, batches=1)


def kafka_batch(
    spark: SparkSession, bootstrap_servers: str, topic: str, starting: str = "earliest", ending: str = "latest"
) -> DataFrame:
    """A bounded batch read of a topic, ordered by (partition, offset)."""
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("endingOffsets", ending)
        .load()
        .select(F.col("value").cast("string").alias("value"), "partition", "offset")
    )
