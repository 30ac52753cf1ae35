"""Size-checked broadcast.

``F.broadcast`` forces a side to be shipped whole to every executor.  It
is only safe when the side's size is bounded, so we check first: count
at most ``max_rows + 1`` rows (the ``limit`` stops the job early) and
broadcast only under the bound.  Above it the join is left to the
planner (sort-merge, or AQE's runtime conversion from measured sizes).

The check is meant for materialised inputs (a written dimension table, a
checkpoint): there the bounded count reads a few row groups.  On a frame
with an expensive lineage it would run that lineage once more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_ROWS = 1_000_000


def row_count_at_most(df: DataFrame, bound: int) -> int:
    """min(count(df), bound + 1), without counting past the bound."""
    return df.limit(bound + 1).count()


def sized_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    if row_count_at_most(df, max_rows) <= max_rows:
        return F.broadcast(df)
    return df
