"""Session helper, shuffle sizing, the shared scratch folder, and shipping
the package to executor Python workers.

Intermediate tables and stream checkpoints go under the folder the
cluster names in ``spark.checkpoint.dir`` (a shared file system on a
real cluster).  Only when that setting is absent -- local runs and
tests -- do we create one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


# Target bytes per shuffle partition after AQE coalescing.
SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024


def scale_conf(shuffle_bytes: int, partition_bytes: int = SHUFFLE_PARTITION_BYTES) -> dict[str, str]:
    """Shuffle settings for an expected shuffle volume.

    AQE merges small shuffle partitions but never splits a large one
    (except skewed join sides), so the *initial* partition count must be
    big enough for the largest shuffle: ``shuffle_bytes / partition_bytes``
    (at least 200).  AQE then coalesces every smaller shuffle down to
    ``partition_bytes`` per task, so one setting serves all stages.
    """
    n = max(200, -(-int(shuffle_bytes) // int(partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(partition_bytes // 8),
    }


def get_spark(
    app_name: str = "ledgerspark", master: str | None = None, shuffle_bytes: int | None = None
) -> SparkSession:
    """A session tuned for the ledger jobs.

    Shuffle width is left to AQE: it coalesces small shuffles and splits
    skewed join partitions at run time.  ``shuffle_bytes`` (the expected
    size of the largest shuffle, e.g. the deduplicated ledger) sizes the
    initial partition count so that no reduce task starts oversized.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in (scale_conf(shuffle_bytes) if shuffle_bytes else {}).items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "static")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a local one only when unset."""
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="ledgerspark-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/ledgerspark/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read
    back: cuts the lineage, survives a lost executor, and later passes read
    only the columns they need."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in executor Python workers.

    Operators that run Python inside tasks (the isolation forest) pickle
    functions by module reference, so the workers must import
    ``ledgerspark``.  The package is zipped once on the driver and added
    with ``addPyFile``, which serves it to every executor (the usual way to
    ship a library with a job).  Done once per SparkContext.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="ledgerspark-pyfiles-"), "ledgerspark.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _, names in os.walk(pkg):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(app)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python file APIs can use a local path."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def is_local_fs(path: str) -> bool:
    return "://" not in path or path.startswith("file:")


__all__ = ["get_spark", "scale_conf", "checkpoint_root", "scratch_path", "stored", "ship_package", "local_path", "is_local_fs"]
