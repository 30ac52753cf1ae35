"""Named queries over the driver's test tables, each with its oracle.

Every query takes ``(spark, sf_dir)``, reads the given tables (the ledger
is derived from ``events``) and returns a DataFrame.  ``ORACLES`` holds
the DuckDB SQL for each query that SQL can express.  The queries live in
``plans/queries/`` (one module per area); this module is the entry point.
"""

from __future__ import annotations

from .queries import ORACLES, QUERIES, SPEC
from .queries.inputs import features, rule_score, silver, split_features

__all__ = ["ORACLES", "QUERIES", "SPEC", "features", "rule_score", "silver", "split_features"]
