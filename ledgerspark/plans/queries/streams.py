"""Streaming landing queries (file source standing in for a topic)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...session import scratch_path
from ...operators.clean import stamp_lineage
from ...sources import files, sinks
from ...sources.ledger import read_ledger
from ...spec import RAW_COLUMNS, SILVER_COLUMNS, LedgerSpec
from ...streaming import land, positions
from .. import incremental
from .. import oracle as O
from ..oracle import RAW_ORACLE
from .inputs import TOPIC, bronze_table, land_messages, message_files, raw
from .registry import query


@query("stream_land", RAW_ORACLE)
def q_stream_land(spark, sf_dir):
    src = message_files(spark, sf_dir)
    out = scratch_path(spark, "landing")
    land_messages(spark, src, out, scratch_path(spark, "ckpt"))
    return land.read_landing(spark, out).select(*RAW_COLUMNS)


@query(
    "stream_rerun_adds_nothing",
    O.with_ledger(
        """SELECT 1 AS run, COUNT(*) AS n_landed, COUNT(*) AS n_in_sink FROM ledger
UNION ALL SELECT 2, 0, COUNT(*) FROM ledger"""
    ),
)
def q_stream_rerun_adds_nothing(spark, sf_dir):
    src = message_files(spark, sf_dir)
    out, ckpt = scratch_path(spark, "landing"), scratch_path(spark, "ckpt")
    rows = []
    for run in (1, 2):
        r = land_messages(spark, src, out, ckpt)
        rows.append((run, r.landed, files.read_table(spark, out).count()))
    return spark.createDataFrame(rows, "run int, n_landed bigint, n_in_sink bigint")


@query(
    "stream_quarantine",
    O.with_ledger(
        """SELECT CAST(count_if(isFlaggedFraud = 0) AS BIGINT) AS n_landed,
  CAST(count_if(isFlaggedFraud = 1) AS BIGINT) AS n_quarantined FROM ledger"""
    ),
)
def q_stream_quarantine(spark, sf_dir):
    """Messages of flagged rows arrive truncated (malformed JSON); they must
    land in quarantine while the rest of the stream lands normally."""
    src = message_files(spark, sf_dir, corrupt_flagged=True)
    out, bad = scratch_path(spark, "landing"), scratch_path(spark, "quarantine")
    land_messages(spark, src, out, scratch_path(spark, "ckpt"), quarantine=bad)
    n_landed = files.read_table(spark, out).count()
    n_bad = files.read_table(spark, bad).count()
    return spark.createDataFrame([(n_landed, n_bad)], "n_landed bigint, n_quarantined bigint")


@query(
    "stream_batch_union",
    O.with_ledger(
        """SELECT 'batch' AS origin, type, COUNT(*) AS n_rows FROM ledger GROUP BY type
UNION ALL SELECT 'stream', type, COUNT(*) FROM ledger GROUP BY type"""
    ),
)
def q_stream_batch_union(spark, sf_dir):
    """Batch bronze and the streamed landing zone share one schema, so one
    ``unionByName`` reads both origins."""
    batch = files.read_table(spark, bronze_table(spark, sf_dir))
    out = scratch_path(spark, "landing")
    land_messages(spark, message_files(spark, sf_dir), out, scratch_path(spark, "ckpt"))
    stream = files.read_table(spark, out)
    cols = [*RAW_COLUMNS, "ingestion_timestamp", "source_file"]
    both = batch.select(*cols, F.lit("batch").alias("origin")).unionByName(
        stream.select(*cols, F.lit("stream").alias("origin"))
    )
    return both.groupBy("origin", "type").agg(F.count(F.lit(1)).alias("n_rows"))


RESUME_ROWS = 1000


@query(
    "stream_bounded_resume",
    O.with_ledger(
        f"""SELECT CAST(1 + (rn - 1) // {RESUME_ROWS} AS INTEGER) AS run, {", ".join(RAW_COLUMNS)}
FROM (SELECT *, row_number() OVER (ORDER BY event_id) AS rn FROM ledger) WHERE rn <= {2 * RESUME_ROWS}"""
    ),
)
def q_stream_bounded_resume(spark, sf_dir):
    """A bounded consumer called twice: the second call goes on where the first stopped."""
    log = positions.MessageLog(spark, message_files(spark, sf_dir, ordered=True), scratch_path(spark, "log"))
    out, runs, seen = scratch_path(spark, "landing"), None, []
    for run in (1, 2):
        positions.land_next(log, out, f"kafka:{TOPIC}", max_rows=RESUME_ROWS)
        new = land.read_landing(spark, out).where(~F.col("batch_id").isin(seen))
        rows = new.select(F.lit(run).alias("run"), *RAW_COLUMNS)
        runs = rows if runs is None else runs.unionByName(rows)
        seen = [r["batch_id"] for r in land.read_landing(spark, out).select("batch_id").distinct().collect()]
    return runs


@query(
    "stream_row_batches",
    O.with_ledger(
        """SELECT CAST((rn - 1) // 500 AS BIGINT) AS batch, COUNT(*) AS n_messages,
  CAST(count_if(isFlaggedFraud = 1) AS BIGINT) AS n_quarantined
FROM (SELECT *, row_number() OVER (ORDER BY event_id) AS rn FROM ledger) GROUP BY 1"""
    ),
)
def q_stream_row_batches(spark, sf_dir):
    """A folder drained in batches of 500 messages, bad ones (truncated JSON) included: each batch's account."""
    folder = message_files(spark, sf_dir, corrupt_flagged=True, ordered=True)
    log = positions.MessageLog(spark, folder, scratch_path(spark, "log"))
    out, bad = scratch_path(spark, "landing"), scratch_path(spark, "quarantine")
    positions.land_next(log, out, f"kafka:{TOPIC}", batch_rows=500, quarantine_path=bad)
    good = land.read_landing(spark, out).select("batch_id", F.lit(0).alias("bad"))
    lost = land.read_quarantine(spark, bad).select("batch_id", F.lit(1).alias("bad"))
    batch = ((F.col("batch_id") - positions.FIRST_BATCH) / 500).cast("long").alias("batch")
    return good.unionByName(lost).groupBy(batch).agg(
        F.count(F.lit(1)).alias("n_messages"), F.sum("bad").cast("long").alias("n_quarantined"))


@query("stream_all_bad", O.with_ledger("SELECT CAST(0 AS BIGINT) AS n_landed, COUNT(*) AS n_quarantined FROM ledger WHERE isFlaggedFraud = 1"))
def q_stream_all_bad(spark, sf_dir):
    """A stream of bad messages alone leaves a landing zone that reads as no rows."""
    src = message_files(spark, sf_dir, corrupt_flagged=True, where=F.col("isFlaggedFraud") == 1)
    out, bad = scratch_path(spark, "landing"), scratch_path(spark, "quarantine")
    land_messages(spark, src, out, scratch_path(spark, "ckpt"), quarantine=bad)
    counts = (land.read_landing(spark, out).count(), files.read_table(spark, bad).count())
    return spark.createDataFrame([counts], "n_landed bigint, n_quarantined bigint")


# Without an event id the survivor is the smallest row by its other raw columns.
RAW_SILVER = """
raw_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY step, type, amount, nameOrig, nameDest
    ORDER BY oldbalanceOrg, newbalanceOrig, oldbalanceDest, newbalanceDest, isFraud, isFlaggedFraud) AS rn
  FROM ledger)"""
RAW_SILVER_SQL = """SELECT step, type AS transaction_type, amount, nameOrig AS name_orig,
  CASE WHEN nameOrig LIKE 'M%' THEN 'MERCHANT' ELSE 'CUSTOMER' END AS orig_account_type, nameDest AS name_dest,
  CASE WHEN nameDest LIKE 'M%' THEN 'MERCHANT' ELSE 'CUSTOMER' END AS dest_account_type,
  oldbalanceOrg AS oldbalance_orig, newbalanceOrig AS newbalance_orig, oldbalanceDest AS oldbalance_dest,
  newbalanceDest AS newbalance_dest, isFraud AS is_fraud, isFlaggedFraud AS is_flagged_fraud,
  CAST(type IN ('CASH_OUT','TRANSFER','DEBIT','PAYMENT')
       AND abs(newbalanceOrig - (oldbalanceOrg - amount)) > CAST(0.01 AS DOUBLE) AS INTEGER) AS balance_inconsistent
FROM raw_ranked WHERE rn = 1"""


@query("silver_incremental", O.with_ledger(RAW_SILVER_SQL, RAW_SILVER))
def q_silver_incremental(spark, sf_dir):
    """A third of the ledger arrives as a batch, the rest as a stream landed in two calls, with rows of the
    batch coming again: the silver of one full build."""
    third = F.col("event_id") % 3 == 0
    bronze = scratch_path(spark, "bronze")
    sinks.write_table(stamp_lineage(read_ledger(spark, sf_dir).where(third).select(*RAW_COLUMNS), "batch"), bronze, partition_by=["type"])
    folder = message_files(spark, sf_dir, ordered=True, where=~third | (F.col("event_id") % 5 == 0))
    log = positions.MessageLog(spark, folder, scratch_path(spark, "log"))
    out, silver, state = (scratch_path(spark, n) for n in ("landing", "silver", "state"))
    half = log.refresh() // 2
    incremental.refresh_silver(spark, silver, state, bronze=bronze, spec=LedgerSpec())
    for rows in (half, 0):
        positions.land_next(log, out, f"kafka:{TOPIC}", max_rows=rows)
        incremental.refresh_silver(spark, silver, state, landing=out, spec=LedgerSpec())
    return files.read_table(spark, silver).select(*SILVER_COLUMNS)


@query(
    "partition_refresh",
    O.with_ledger(
        f"""SELECT 'refresh' AS run, CAST(step // 24 AS INTEGER) AS ledger_day, COUNT(*) AS n_rows FROM (
  {RAW_SILVER_SQL}) GROUP BY 1, 2
UNION ALL SELECT 'reload', CAST(step // 24 AS INTEGER), COUNT(*) FROM ({RAW_SILVER_SQL}) WHERE step // 24 >= 2 GROUP BY 1, 2""",
        RAW_SILVER,
    ),
)
def q_partition_refresh(spark, sf_dir):
    """Days 2 and later sent again: a refresh leaves the other days in place, a full reload drops them."""
    rows = stamp_lineage(raw(spark, sf_dir), "batch")
    later = rows.where(F.floor(F.col("step") / 24) >= 2)
    silver, again = scratch_path(spark, "silver"), scratch_path(spark, "silver")
    incremental.merge_silver(spark, rows, silver)
    touched = incremental.merge_silver(spark, later, silver)
    assert min(touched) >= 2, touched
    incremental.merge_silver(spark, later, again)
    day = F.col(incremental.DAY)
    counts = [files.read_table(spark, p).groupBy(F.lit(n).alias("run"), day).agg(F.count(F.lit(1)).alias("n_rows"))
              for n, p in (("refresh", silver), ("reload", again))]
    return counts[0].unionByName(counts[1])
