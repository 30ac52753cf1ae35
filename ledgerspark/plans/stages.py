"""Finished stages of a chain, so that a rerun starts where the last run stopped.

Each stage has one small JSON marker under ``root/_stages``.  It is written
as ``running`` before the stage touches its tables and as ``done``, with the
rows of each table, afterwards.  A stage is skipped only if its marker says
``done`` for the same fingerprint: the run id (the caller's name of the
input), the parameters the stage depends on, and the fingerprint of the
stage before it.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARKER = (
    "stage string, fingerprint string, state string, attempt bigint, "
    "counts array<struct<layer string, table_name string, n_rows bigint>>"
)

Counts = list[tuple[str, str, int]]


def stage_log(spark: SparkSession, root: str) -> DataFrame:
    """One row per stage that has begun under ``root``: stage, fingerprint,
    state, the attempt that ran it last, rows per table.  No rows where no
    stage has begun."""
    try:
        return spark.read.schema(MARKER).json(f"{root.rstrip('/')}/_stages/*")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MARKER)


def stage_tables(spark: SparkSession, root: str) -> DataFrame:
    """(attempt, layer, table_name, n_rows) of every table of finished stages."""
    done = stage_log(spark, root).filter(F.col("state") == "done")
    return done.select("attempt", F.explode("counts").alias("t")).select("attempt", "t.*")


@dataclass
class Stages:
    """The stages of one chain under ``root``; without a ``run_id`` every
    stage runs and no marker is kept, unless ``root`` holds markers of other
    runs, which are then replaced, as their tables are."""

    spark: SparkSession
    root: str
    run_id: str | None = None
    upstream: str = ""
    attempt: int = 0
    known: dict = field(default_factory=dict)

    def __post_init__(self):
        self.known = {r.stage: r for r in stage_log(self.spark, self.root).collect()}
        self.attempt = 1 + max((r.attempt for r in self.known.values()), default=0)
        if self.known and self.run_id is None:
            self.run_id = uuid.uuid4().hex

    def run(self, stage: str, params: dict, work: Callable[[], Counts]) -> Counts:
        """The rows per table of ``stage``, which runs unless it is done."""
        if self.run_id is None:
            return work()
        what = json.dumps([self.run_id, self.upstream, stage, params], sort_keys=True, default=str)
        self.upstream = hashlib.md5(what.encode()).hexdigest()
        last = self.known.get(stage)
        if last is not None and last.state == "done" and last.fingerprint == self.upstream:
            return [(c.layer, c.table_name, c.n_rows) for c in last.counts]
        self._mark(stage, "running", [])
        counts = work()
        self._mark(stage, "done", counts)
        return counts

    def _mark(self, stage: str, state: str, counts: Counts) -> None:
        row = [(stage, self.upstream, state, self.attempt, counts)]
        marker = self.spark.createDataFrame(row, MARKER).coalesce(1)
        marker.write.mode("overwrite").json(f"{self.root.rstrip('/')}/_stages/{stage}")
