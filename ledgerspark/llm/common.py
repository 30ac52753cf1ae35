"""Helpers the operators share: stored intermediate tables, global row
numbers and running totals that never gather a group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.session import scratch_path, ship_package

#: The word separators of every contract: space and \t \n \v \f \r.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage in a way that survives a lost executor, and gives later
    joins plain scans, so that AQE can split a skewed side.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Most bytes and rows of one Arrow batch: bounds a worker's memory whatever the texts' lengths.
BATCH_BYTES = 16 * 1024 * 1024
BATCH_ROWS = 2000


def python_ready(df: DataFrame) -> None:
    """Ship this package to the executors' Python workers and bound their batches."""
    spark = df.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id's decimal text is a multiple of 5 (null id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def numbered(df: DataFrame, keys: list, name: str, out: str) -> DataFrame:
    """``df`` with column ``out``: the row's place (0, 1, ...) in the order of ``keys``.

    Range partitions are sorted and stored once with each row's partition and
    place in it; the partitions' sizes (one row per partition) then give the
    offsets.  Rows equal in all ``keys`` are numbered in stored order.
    """
    cols = df.columns
    placed = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    placed = stored(placed, name).withColumn("_part", F.shiftright("_at", 33))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # One row per range partition: bounded by the number of shuffle partitions.
    joined = placed.join(F.broadcast(offsets), "_part")
    place = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return joined.select(*cols, place.cast("long").alias(out))


def running_total(df: DataFrame, group: str, keys: list, value: str, name: str, out: str) -> DataFrame:
    """``df`` with column ``out``: the sum of ``value`` over the group's earlier rows in the order of ``keys``.

    A group may span many range partitions: each partition sums its own part
    and the parts' totals (one row per partition and group) carry over, so no
    task ever holds a whole hot group.  ``group`` must not be null and the
    keys must order a group's rows fully.
    """
    cols = df.columns
    parted = stored(
        df.repartitionByRange(F.col(group), *keys).withColumn("_part", F.spark_partition_id()), name
    )
    within = Window.partitionBy("_part", group).orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    local = parted.withColumn("_local", F.coalesce(F.sum(value).over(within), F.lit(0)))
    totals = parted.groupBy("_part", group).agg(F.sum(value).alias("_total"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", group, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))
    return local.join(offsets, ["_part", group]).select(
        *cols, (F.col("_before") + F.col("_local")).cast("long").alias(out)
    )


#: Joins that carry texts name their strategy (hint "merge"): the other side grows with
#: the corpus, and the plan is the same at every size; AQE splits a skewed key.


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _matched(docs: DataFrame, key: Column, pairs: DataFrame, how: str) -> DataFrame:
    g = pairs.select(F.col("doc_id").alias("_pair_id"), F.col("key").alias("_pair_key"))
    name = free_name(docs, "_key")
    marked = docs.withColumn(name, key).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("g._pair_id")) & (F.col(f"d.{name}") == F.col("g._pair_key"))
    return marked.join(g.alias("g").hint("merge"), same, how).drop(name)


def without(docs: DataFrame, key: Column, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose doc_id and ``key`` are in ``gone`` (doc_id, key)."""
    return _matched(docs, key, gone, "left_anti")


def only(docs: DataFrame, key: Column, pairs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id and ``key`` are in ``pairs`` (doc_id, key)."""
    return _matched(docs, key, pairs, "left_semi")


def first_of_repeats(docs: DataFrame, key: Column) -> DataFrame:
    """One of the rows that share doc_id and ``key``."""
    name = free_name(docs, "_key")
    return docs.withColumn(name, key).dropDuplicates(["doc_id", name]).drop(name)
