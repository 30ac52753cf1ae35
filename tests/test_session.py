"""Session helpers: size-checked broadcast, package shipping, scratch paths."""

from pyspark.sql import functions as F

from ledgerspark.functions.sizing import row_count_at_most, sized_broadcast
from ledgerspark.session import checkpoint_root, scratch_path, ship_package


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_broadcast_only_under_the_bound(spark):
    big = spark.range(100).withColumn("k", F.col("id") % 10)
    small = spark.range(10).withColumnRenamed("id", "k")
    assert row_count_at_most(small, 5) == 6  # stops counting past the bound
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        hinted = big.join(sized_broadcast(small, max_rows=100), "k")
        assert "BroadcastHashJoin" in _plan(hinted)
        unhinted = big.join(sized_broadcast(small, max_rows=5), "k")
        assert "BroadcastHashJoin" not in _plan(unhinted)
        assert hinted.count() == unhinted.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_ship_package_adds_an_importable_zip(spark):
    ship_package(spark)
    ship_package(spark)  # once per context
    includes = [p for p in spark.sparkContext._python_includes if p.endswith("ledgerspark.zip")]
    assert len(includes) == 1


def test_scratch_paths_live_under_the_checkpoint_dir(spark):
    root = checkpoint_root(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root) and b.startswith(root)
    assert root.rstrip("/") == spark.conf.get("spark.checkpoint.dir").rstrip("/")
