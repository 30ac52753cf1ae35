import os

import pytest
from pyspark.sql import functions as F

from ledgerspark.session import local_path, scratch_path
from ledgerspark.sources import files, sinks, warehouse
from ledgerspark.spec import RAW_COLUMNS, RAW_SCHEMA

HEADER = ",".join(RAW_COLUMNS)
GOOD = "1,TRANSFER,100.5,C1,200.0,99.5,C2,0.0,100.5,1,0"


def _write_text(path, lines):
    os.makedirs(local_path(path), exist_ok=True)
    with open(os.path.join(local_path(path), "part-0.csv"), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_csv_bad_rows_go_to_corrupt_column(spark):
    path = scratch_path(spark, "csv")
    _write_text(path, [HEADER, GOOD, "2,CASH_OUT,abc,C1,1,1,C2,0,0,0,0", "3,DEBIT,5.0,C1"])
    df = files.read_raw_csv(spark, path).cache()
    clean, bad = files.split_corrupt(df)
    assert [r.step for r in clean.collect()] == [1]
    assert sorted(r.step for r in bad.collect()) == [2, 3]
    assert clean.first().amount == 100.5 and clean.columns == RAW_COLUMNS


def test_csv_swapped_header_is_rejected(spark):
    path = scratch_path(spark, "csv")
    swapped = ",".join(["type", "step"] + RAW_COLUMNS[2:])
    _write_text(path, [swapped, GOOD])
    with pytest.raises(Exception, match="(?i)header|schema"):
        files.read_raw_csv(spark, path).collect()


def _frame(spark, types):
    rows = [(i, t, float(i), "C1", 0.0, 0.0, "C2", 0.0, 0.0, 0, 0) for i, t in enumerate(types)]
    return spark.createDataFrame(rows, RAW_SCHEMA)


def test_static_overwrite_drops_stale_partitions(spark, tmp_dir):
    assert sinks.write_table(_frame(spark, ["A", "B"]), tmp_dir, partition_by=["type"]) == 2
    assert sinks.write_table(_frame(spark, ["A"]), tmp_dir, partition_by=["type"]) == 1
    assert sorted(r.type for r in files.read_table(spark, tmp_dir).collect()) == ["A"]


def test_dynamic_overwrite_refreshes_only_present_partitions(spark, tmp_dir):
    sinks.write_table(_frame(spark, ["A", "B"]), tmp_dir, partition_by=["type"])
    sinks.write_table(_frame(spark, ["A", "A"]), tmp_dir, partition_by=["type"], dynamic_overwrite=True)
    got = sorted(r.type for r in files.read_table(spark, tmp_dir).collect())
    assert got == ["A", "A", "B"]


def test_partition_column_comes_back_and_prunes(spark, tmp_dir):
    sinks.write_table(_frame(spark, ["A", "B", "B"]), tmp_dir, partition_by=["type"])
    df = files.read_table(spark, tmp_dir).filter(F.col("type") == "B")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "type" in plan
    assert df.count() == 2
    assert sorted(d for d in os.listdir(local_path(tmp_dir)) if d.startswith("type=")) == ["type=A", "type=B"]


def test_column_pruned_read(spark, tmp_dir):
    sinks.write_table(_frame(spark, ["A"]), tmp_dir)
    df = files.read_columns(spark, tmp_dir, ["amount", "isFraud"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<amount:double,isFraud:int>" in plan


def test_replay_limit(spark):
    df = _frame(spark, ["A"] * 10)
    assert [r.step for r in files.replay(df, 3, ["step"]).collect()] == [0, 1, 2]
    assert files.replay(df, 0).count() == 10


def test_sql_over_files(spark, tmp_dir):
    sinks.write_table(_frame(spark, ["A", "B", "B"]), tmp_dir)
    got = files.sql_over_files(spark, "SELECT type, COUNT(*) AS n FROM {t} GROUP BY type", t=tmp_dir)
    assert {r.type: r.n for r in got.collect()} == {"A": 1, "B": 2}


def test_warehouse_replace_and_types(spark, tmp_dir):
    target = warehouse.DirectoryTarget(tmp_dir)
    df = spark.createDataFrame([(1, 0.5, "x"), (2, 1.5, "y")], "k int, v float, s string")
    assert warehouse.load_serving({"t": df}, target) == {"t": 2}
    assert warehouse.load_serving({"t": df}, target) == {"t": 2}
    back = warehouse.read_served(spark, "t", target)
    assert back.count() == 2
    assert dict(back.dtypes) == {"k": "bigint", "v": "double", "s": "string"}
    assert sorted((r.k, r.v, r.s) for r in back.collect()) == [(1, 0.5, "x"), (2, 1.5, "y")]


def test_ingest_bronze_quarantines_bad_lines_and_missing_type(spark):
    from ledgerspark.plans.medallion import ingest_bronze

    path = scratch_path(spark, "csv")
    _write_text(path, [HEADER, GOOD, "2,CASH_OUT,abc,C1,1,1,C2,0,0,0,0", "3,,5.0,C1,1,1,C2,0,0,0,0"])
    out, q = scratch_path(spark, "bronze"), scratch_path(spark, "quarantine")
    assert ingest_bronze(spark, path, out, quarantine=q) == 1
    bronze = files.read_table(spark, out).collect()
    assert [(r.step, r.type, r.source_file) for r in bronze] == [(1, "TRANSFER", "part-0.csv")]
    bad = sorted(r.raw_value for r in files.read_table(spark, q).collect())
    assert len(bad) == 2 and any("abc" in b for b in bad) and any('"step":3' in b for b in bad)


def test_medallion_from_csv_path(spark):
    from ledgerspark.plans.medallion import run_medallion

    path = scratch_path(spark, "csv")
    _write_text(path, [HEADER, GOOD, "2,CASH_OUT,abc,C1,1,1,C2,0,0,0,0"])
    root = scratch_path(spark, "chain")
    got = {(r.layer, r.table_name): r.n_rows for r in run_medallion(spark, path, root).collect()}
    assert got[("bronze", "transactions")] == 1 and got[("silver", "transactions")] == 1
    assert files.read_table(spark, f"{root}/quarantine").count() == 1


def test_scale_conf_sizes_initial_shuffle_width():
    from ledgerspark.session import scale_conf

    assert scale_conf(10 * 1024**2)["spark.sql.shuffle.partitions"] == "200"
    big = scale_conf(100 * 1024**4)  # 100 TiB
    assert big["spark.sql.shuffle.partitions"] == str(100 * 1024**4 // (128 * 1024**2))
    assert big["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(128 * 1024**2)


def test_static_overwrite_even_when_the_session_default_is_dynamic(spark, tmp_dir):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        sinks.write_table(_frame(spark, ["A", "B"]), tmp_dir, partition_by=["type"])
        sinks.write_table(_frame(spark, ["A"]), tmp_dir, partition_by=["type"])
        assert sorted(r.type for r in files.read_table(spark, tmp_dir).collect()) == ["A"]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
