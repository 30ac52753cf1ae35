"""File sources: raw CSV with a fixed schema, Parquet tables, SQL on files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..spec import RAW_SCHEMA

CORRUPT_COLUMN = "_corrupt_record"


def read_raw_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType = RAW_SCHEMA,
    corrupt_column: str = CORRUPT_COLUMN,
    check_header: bool = True,
) -> DataFrame:
    """CSV with a header, read with a fixed schema (never inferred).

    * ``check_header``: the header must name the schema's columns in order
      (``enforceSchema=false``); a swapped or renamed header fails the read
      instead of silently mapping columns by position.
    * Malformed lines (a bad number, too few fields) are kept: their fields
      are null and the raw line is in ``corrupt_column``, so
      :func:`split_corrupt` can route them to a quarantine.
    """
    full = StructType(list(schema.fields) + [StructField(corrupt_column, StringType(), True)])
    return (
        spark.read.schema(full)
        .option("header", True)
        .option("enforceSchema", not check_header)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", corrupt_column)
        .csv(path)
    )


def split_corrupt(df: DataFrame, corrupt_column: str = CORRUPT_COLUMN) -> tuple[DataFrame, DataFrame]:
    """(clean rows without the corrupt column, corrupt rows)."""
    bad = F.col(corrupt_column).isNotNull()
    return df.filter(~bad).drop(corrupt_column), df.filter(bad)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table; ``k=v`` directories become (pruneable) columns."""
    return spark.read.parquet(path)


def read_columns(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Only ``columns`` of a Parquet table: the scan reads just those."""
    return spark.read.parquet(path).select(*columns)


def sql_over_files(spark: SparkSession, sql: str, **paths: str) -> DataFrame:
    """Run SQL whose ``{name}`` placeholders are Parquet paths, read in
    place as ``parquet.`path` `` (no catalog registration needed)."""
    return spark.sql(sql.format(**{k: f"parquet.`{v}`" for k, v in paths.items()}))


def replay(df: DataFrame, limit: int = 0, order_by: Sequence[str] = ()) -> DataFrame:
    """Bounded replay: the first ``limit`` rows in ``order_by`` order, or all
    rows when ``limit`` is 0.  A top-n sort keeps n rows per task."""
    if limit and limit > 0:
        ordered = df.orderBy(*order_by) if order_by else df
        return ordered.limit(limit)
    return df


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)
