"""Column expressions and plan helpers (built-in Spark expressions only)."""
