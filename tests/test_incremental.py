"""Incremental silver: order, repetition and overlap of the origins do not matter; untouched days stay."""

from ledgerspark.operators.clean import stamp_lineage, to_silver
from ledgerspark.plans import incremental
from ledgerspark.session import scratch_path
from ledgerspark.sources.files import read_table
from ledgerspark.spec import RAW_SCHEMA, SILVER_COLUMNS


def _raw(spark, rows):
    full = [(s, t, a, "C1", o, 0.0, "C2", 0.0, 0.0, 0, 0) for s, t, a, o in rows]
    nullable = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW_SCHEMA.fields)
    return stamp_lineage(spark.createDataFrame(full, nullable), "test")


def _silver(spark, path):
    return sorted((tuple(r) for r in read_table(spark, path).select(*SILVER_COLUMNS).collect()), key=str)


ROWS = [(1, "TRANSFER", 5.0, 3.0), (1, "TRANSFER", 5.0, 2.0), (30, "DEBIT", 1.0, 9.0), (55, "CASH_IN", 2.0, 1.0),
        (30, "DEBIT", 1.0, 8.0), (None, "DEBIT", 1.0, 8.0), (1, "TRANSFER", 5.0, 3.0)]


def test_any_order_gives_the_full_build(spark):
    want = sorted((tuple(r) for r in to_silver(_raw(spark, ROWS)).select(*SILVER_COLUMNS).collect()), key=str)
    for parts in ((ROWS[:2], ROWS[2:4], ROWS[4:]), (ROWS[4:], ROWS, ROWS[:1])):
        path = scratch_path(spark, "silver")
        for part in parts:
            incremental.merge_silver(spark, _raw(spark, part), path)
        assert _silver(spark, path) == want


def test_only_touched_days_are_rewritten(spark):
    path = scratch_path(spark, "silver")
    assert incremental.merge_silver(spark, _raw(spark, ROWS), path) == [-1, 0, 1, 2]
    before = {r[0] for r in read_table(spark, path).where(f"{incremental.DAY} <> 1").select("_metadata.file_path").distinct().collect()}
    assert incremental.merge_silver(spark, _raw(spark, [(31, "DEBIT", 7.0, 7.0)]), path) == [1]
    after = {r[0] for r in read_table(spark, path).where(f"{incremental.DAY} <> 1").select("_metadata.file_path").distinct().collect()}
    assert before == after and len(_silver(spark, path)) == 5


def test_nothing_new_rewrites_nothing(spark):
    path, state = scratch_path(spark, "silver"), scratch_path(spark, "state")
    assert incremental.merge_silver(spark, _raw(spark, []), path) == []
    assert incremental.refresh_silver(spark, path, state, landing=scratch_path(spark, "no-zone")) == []
