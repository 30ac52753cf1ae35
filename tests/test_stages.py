"""A chain that stopped starts again at the stage that failed."""

from dataclasses import replace

import pytest

from ledgerspark.operators.quality import QualityError
from ledgerspark.plans.medallion import run_medallion
from ledgerspark.plans.stages import Stages, stage_log, stage_tables
from ledgerspark.spec import RAW_SCHEMA, LedgerSpec

ROWS = [(i, "CASH_OUT", 10.0 + i, f"C{i}", 100.0, 100.0 if i % 2 else 90.0 - i, "M1", 0.0, 0.0, 0, 0) for i in range(10)]


def test_stopped_chain_goes_on_at_the_gate(spark, tmp_dir):
    raw = spark.createDataFrame(ROWS, RAW_SCHEMA)
    strict = replace(LedgerSpec(), thresholds={"CASH_OUT": 0.1})
    with pytest.raises(QualityError, match="CASH_OUT"):
        run_medallion(spark, raw, tmp_dir, strict, "a", run_id="day 1")
    states = {r.stage: (r.state, r.attempt) for r in stage_log(spark, tmp_dir).collect()}
    assert states["3-silver"] == ("done", 1) and states["4-silver-gate"] == ("running", 1) and "5-gold" not in states
    again = {(r.layer, r.table_name): r.n_rows for r in run_medallion(spark, raw, tmp_dir, source_name="a", run_id="day 1").collect()}
    whole = {(r.layer, r.table_name): r.n_rows for r in run_medallion(spark, raw, f"{tmp_dir}-whole", source_name="a").collect()}
    assert again == whole
    assert {(r.layer, r.attempt) for r in stage_tables(spark, tmp_dir).collect()} == {("bronze", 1), ("silver", 1), ("gold", 2)}


def test_other_input_or_parameter_runs_again(spark, tmp_dir):
    ran = []

    def chain(run_id, b):
        s = Stages(spark, tmp_dir, run_id)
        s.run("a", {}, lambda: ran.append("a") or [])
        s.run("b", {"b": b}, lambda: ran.append("b") or [("gold", "t", 1)])
        return s.run("c", {}, lambda: ran.append("c") or [])

    for run_id, b, want in (("x", 1, "abc"), ("x", 1, ""), ("x", 2, "bc"), ("y", 2, "abc")):
        ran.clear()
        chain(run_id, b)
        assert "".join(ran) == want, (run_id, b)


def test_stage_that_dies_runs_again(spark, tmp_dir):
    def die():
        raise ValueError

    Stages(spark, tmp_dir, "x").run("a", {}, lambda: [("l", "t", 1)])
    with pytest.raises(ValueError):
        Stages(spark, tmp_dir, "y").run("a", {}, die)
    ran = []
    Stages(spark, tmp_dir, "x").run("a", {}, lambda: ran.append(1) or [])
    assert ran  # the table may be half the other run's


def test_no_run_id_keeps_no_markers(spark, tmp_dir):
    Stages(spark, tmp_dir).run("a", {}, lambda: [])
    assert stage_log(spark, tmp_dir).count() == 0


def test_run_without_id_replaces_markers(spark, tmp_dir):
    Stages(spark, tmp_dir, "x").run("a", {}, lambda: [])
    Stages(spark, tmp_dir).run("a", {}, lambda: [])
    ran = []
    Stages(spark, tmp_dir, "x").run("a", {}, lambda: ran.append(1) or [])
    assert ran  # the table is the other run's
