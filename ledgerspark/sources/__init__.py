"""Readers and writers: CSV, Parquet, SQL on files, serving tables, the test ledger."""
