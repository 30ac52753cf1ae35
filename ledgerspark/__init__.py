"""Payment-ledger analytics on Spark: operators, sources, plans, streaming."""

__version__ = "0.1.0"
