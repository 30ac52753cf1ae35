"""Publishing marts to a serving store, and reading them back.

Two targets share one interface:

* :class:`JdbcTarget` -- any JDBC database, written with Spark's JDBC
  writer in ``overwrite`` mode (drop, create, bulk insert: a repeat load
  leaves exactly the new rows).  Executors write their partitions in
  parallel.  Not exercised here: no database may run in this environment.
* :class:`DirectoryTarget` -- a folder of Parquet tables, one per name,
  on the shared file system; used by the tests.

Before publishing, column types are normalised the way the serving layer
expects: every integer type becomes BIGINT, every fractional type DOUBLE,
everything else text.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
)

from .sinks import write_table

_INTEGRAL = (ByteType, ShortType, IntegerType, LongType)
_FRACTIONAL = (FloatType, DoubleType, DecimalType)


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    properties: dict = field(default_factory=dict)
    batch_size: int = 10_000


@dataclass(frozen=True)
class DirectoryTarget:
    root: str


def serving_types(df: DataFrame) -> DataFrame:
    """Integer -> bigint, float/decimal -> double, anything else -> string."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, _INTEGRAL):
            cols.append(F.col(f.name).cast("bigint").alias(f.name))
        elif isinstance(f.dataType, _FRACTIONAL):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name).cast("string").alias(f.name))
    return df.select(*cols)


def publish_table(df: DataFrame, name: str, target: JdbcTarget | DirectoryTarget) -> int:
    """Replace table ``name`` in ``target`` with ``df``; return rows written."""
    typed = serving_types(df)
    if isinstance(target, DirectoryTarget):
        return write_table(typed, f"{target.root.rstrip('/')}/{name}")
    obs = Observation()
    counted = typed.observe(obs, F.count(F.lit(1)).alias("rows"))
    (
        counted.write.mode("overwrite")
        .option("truncate", "false")
        .option("batchsize", str(target.batch_size))
        .jdbc(target.url, name, properties=dict(target.properties))
    )
    return int(obs.get["rows"])


def read_served(spark: SparkSession, name: str, target: JdbcTarget | DirectoryTarget) -> DataFrame:
    """``SELECT *`` of a published table."""
    if isinstance(target, DirectoryTarget):
        return spark.read.parquet(f"{target.root.rstrip('/')}/{name}")
    return spark.read.jdbc(target.url, name, properties=dict(target.properties))


def load_serving(tables: dict[str, DataFrame], target: JdbcTarget | DirectoryTarget) -> dict[str, int]:
    """Publish every named table; return name -> rows loaded."""
    return {name: publish_table(df, name, target) for name, df in tables.items()}
