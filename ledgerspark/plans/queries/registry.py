"""Registry of the named queries and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ...spec import LedgerSpec

from collections.abc import Callable


# The derived ledger carries event_id: it is the ingestion order, so the
# dedup survivor is the first event of each business key.
SPEC = LedgerSpec(dedup_order=("event_id",))

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``, with its
    oracle SQL when SQL can express it."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
