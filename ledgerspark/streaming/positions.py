"""Reading a folder of message files by row position, as a topic is read by offset.

Every line of the folder has a position: files count in the order they are
first seen (by path among those seen together), lines in their order in the
file.  Files are immutable, as for any Spark file source; a file that turns up
later counts after all earlier ones, whatever its name, so no line is skipped.

State lives in a folder of two small Parquet tables: ``files`` (the first
position and the rows of each file, counted by Spark once) and ``positions``
(the ranges that have been landed).  Rows are landed under the position they
start at and the range is recorded afterwards: a run that dies in between is
repeated over the same start and replaces its own output.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.clean import stamp_lineage
from ..session import stored
from ..sources.sinks import write_table
from ..spec import RAW_COLUMNS
from .land import ROW_BATCH, LandingRun, default_quarantine, rejected
from .messages import parse_messages, valid_messages

#: Batches by position are numbered from here: never a micro-batch's or a run time's number.
FIRST_BATCH = 10**15
#: Messages of a folder that many small batches share.
FOLDER_ROWS = 1_000_000
_FILES = "ordinal long, file string, first long, rows long"
_POSITIONS = "start long, end long"


def _state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class MessageLog:
    """The lines of ``folder`` by position, with its state in ``state``."""

    def __init__(self, spark: SparkSession, folder: str, state: str):
        self.spark, self.folder, self.state = spark, folder, state.rstrip("/")

    def files(self) -> DataFrame:
        return _state(self.spark, f"{self.state}/files", _FILES)

    def refresh(self) -> int:
        """Count the lines of files not seen before; returns the position after the last line."""
        known = self.files()
        end, n = known.agg(F.coalesce(F.max(F.col("first") + F.col("rows")), F.lit(0)), F.count(F.lit(1))).first()
        listed = self.spark.read.format("binaryFile").load(self.folder).select(F.col("_metadata.file_path").alias("file"))
        new = [r["file"] for r in listed.join(known, "file", "left_anti").collect()]  # names, as Spark's own listing holds
        if not new:
            return end
        counts = self.spark.read.text(new).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
        found = self.spark.createDataFrame([(f,) for f in sorted(new)], "file string").join(counts, "file", "left")
        found = found.select("file", F.coalesce("rows", F.lit(0)).alias("rows"))
        by_path = Window.orderBy("file")  # one row per new file
        before = F.coalesce(F.sum("rows").over(by_path.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        rows = found.select((F.row_number().over(by_path) - 1 + n).cast("long").alias("ordinal"), "file",
                            (before + end).cast("long").alias("first"), "rows")
        write_table(rows, f"{self.state}/files/seen={n}")
        return self.files().agg(F.max(F.col("first") + F.col("rows"))).first()[0]

    def position(self) -> int:
        """The first position not landed yet."""
        return _state(self.spark, f"{self.state}/positions", _POSITIONS).agg(F.coalesce(F.max("end"), F.lit(0))).first()[0]

    def commit(self, start: int, end: int) -> None:
        """Record that the lines start..end-1 are landed."""
        write_table(self.spark.createDataFrame([(start, end)], _POSITIONS), f"{self.state}/positions/batch={start}")

    def rows(self, start: int, end: int, decode: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """(value, row) of the lines start..end-1; reads only the files that hold them.

        A file may be read in several blocks: a line's place is its place in
        the block plus the lines of the file's earlier blocks.  A task numbers
        the lines of a block one by one, so the least number of a block gives
        all places and no line is shuffled.  The lines are read once and
        stored; ``decode`` makes what is stored from (value, file, block, at)
        and keeps the last three.
        """
        known = self.files().where((F.col("first") < end) & (F.col("first") + F.col("rows") > start))
        paths = [r["file"] for r in known.select("file").collect()]
        lines = self.spark.createDataFrame([], "value string, file string, block long, at long")
        if paths:
            lines = self.spark.read.text(paths).select(
                "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("at"))
        lines = stored(decode(lines) if decode else lines, "lines")
        earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        blocks = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("at_first"))
        blocks = blocks.select("file", "block", "at_first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
        blocks = blocks.join(known.select("file", "first"), "file")
        blocks = blocks.select("file", "block", (F.col("first") + F.col("before") - F.col("at_first")).alias("shift"))
        # One row per block of the files: as many as the tasks that read them, or a few times more.
        numbered = lines.join(F.broadcast(blocks), ["file", "block"]).withColumn("row", F.col("at") + F.col("shift"))
        return numbered.where(F.col("row").between(start, end - 1)).drop("file", "block", "at", "shift")


def land_next(log: MessageLog, out_path: str, lineage: str, max_rows: int = 0, batch_rows: int = 0,
              quarantine_path: str | None = None, partition_by: str = "type") -> LandingRun:
    """Land the next ``max_rows`` messages after the last landed position (0: all there are).

    ``batch_rows`` divides them into batches of so many messages (0: one
    batch).  Small batches share a folder of about FOLDER_ROWS messages, whose
    rows name their own batch in ROW_BATCH (``read_landing`` and
    ``read_quarantine`` give it as batch_id): files grow with the messages, not
    with the batches.  Undecodable messages take positions too and go to the
    quarantine.  A repeated call lands what comes next.
    """
    end, start = log.refresh(), log.position()
    if max_rows > 0:
        end = min(end, start + max_rows)
    if end <= start:
        return LandingRun(0, 0, 0)
    size = batch_rows if batch_rows > 0 else end - start
    ok = valid_messages
    place = ("file", "block", "at")

    def decode(lines: DataFrame) -> DataFrame:
        parsed = parse_messages(lines, keep=place)  # the text is kept of undecodable messages only
        return parsed.withColumn("raw_value", F.when(~ok(parsed), F.col("raw_value")))

    batch = F.lit(start) + F.floor((F.col("row") - start) / size) * size
    # Folders begin at fixed positions, so a repeated run replaces them whatever its bounds.
    folder = F.greatest(F.lit(start), F.floor(batch / FOLDER_ROWS) * FOLDER_ROWS) if batch_rows > 0 else F.lit(start)
    parsed = log.rows(start, end, decode).withColumns(
        {"batch_id": (FIRST_BATCH + folder).cast("long"), ROW_BATCH: (FIRST_BATCH + batch).cast("long")})
    keys = ("batch_id", ROW_BATCH) if batch_rows > 0 else ("batch_id",)
    good = stamp_lineage(parsed.where(ok(parsed)).select(*keys, *RAW_COLUMNS), lineage)
    landed = write_table(good, out_path, partition_by=["batch_id", partition_by], dynamic_overwrite=True)
    bad = rejected(parsed.where(~ok(parsed)), lineage, keep=keys)
    quarantined = write_table(bad, quarantine_path or default_quarantine(out_path), partition_by=["batch_id"], dynamic_overwrite=True)
    log.commit(start, end)
    return LandingRun(landed=landed, quarantined=quarantined, batches=-(-(end - start) // size))


def land_until_idle(log: MessageLog, out_path: str, lineage: str, batch_rows: int, idle_s: float = 0.0,
                    quarantine_path: str | None = None, poll_s: float = 0.5) -> LandingRun:
    """Land all messages, and those that arrive until none has come for ``idle_s`` seconds."""
    landed = quarantined = batches = 0
    last = time.monotonic()
    while True:
        run = land_next(log, out_path, lineage, batch_rows=batch_rows, quarantine_path=quarantine_path)
        if run.batches:
            landed, quarantined, batches = landed + run.landed, quarantined + run.quarantined, batches + run.batches
            last = time.monotonic()
        if time.monotonic() - last >= idle_s:
            return LandingRun(landed, quarantined, batches)
        time.sleep(min(poll_s, idle_s))
