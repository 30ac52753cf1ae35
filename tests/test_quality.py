import pytest

from ledgerspark.operators.quality import (
    QualityError,
    inconsistency_report,
    required_columns_report,
    validate_bronze,
    validate_silver,
)
from ledgerspark.spec import INCONSISTENCY_THRESHOLDS, RAW_SCHEMA, LedgerSpec


def _rows(make_silver, ttype, n, flagged, start=0):
    return [
        dict(step=start + i, transaction_type=ttype, name_orig=f"C{start + i}", balance_inconsistent=int(i < flagged))
        for i in range(n)
    ]


def test_gate_passes_under_threshold(make_silver):
    report = validate_silver(make_silver(_rows(make_silver, "CASH_OUT", 10, 5)))
    assert [(r.transaction_type, r.rate) for r in report.collect()] == [("CASH_OUT", 0.5)]


def test_gate_fails_over_threshold_and_names_type(make_silver):
    with pytest.raises(QualityError, match="CASH_OUT"):
        validate_silver(make_silver(_rows(make_silver, "CASH_OUT", 10, 10)))


def test_low_volume_type_is_not_masked(make_silver):
    rows = _rows(make_silver, "CASH_OUT", 100, 1) + _rows(make_silver, "DEBIT", 5, 5, start=1000)
    with pytest.raises(QualityError, match="DEBIT") as err:
        validate_silver(make_silver(rows))
    assert "CASH_OUT" not in str(err.value)


def test_all_unknown_flags_do_not_break_the_gate(spark, make_silver):
    rows = [dict(step=i, transaction_type="DEBIT", name_orig=f"C{i}", balance_inconsistent=None) for i in range(4)]
    got = inconsistency_report(make_silver(rows), INCONSISTENCY_THRESHOLDS).first()
    assert (got.n_rows, got.n_inconsistent, got.n_unknown, got.rate, got.violated) == (4, 0, 4, 0.0, False)


def test_type_without_threshold_never_violates(make_silver):
    report = validate_silver(make_silver(_rows(make_silver, "CASH_IN", 3, 3)))
    row = report.first()
    assert row.threshold is None and row.violated is False


def test_lowered_threshold_is_a_parameter(make_silver):
    spec = LedgerSpec(thresholds={"CASH_OUT": 0.1})
    with pytest.raises(QualityError, match="CASH_OUT"):
        validate_silver(make_silver(_rows(make_silver, "CASH_OUT", 10, 5)), spec)


def test_residual_duplicates_fail(make_silver):
    with pytest.raises(QualityError, match="duplicates"):
        validate_silver(make_silver([dict(), dict()]))


def test_empty_silver_fails(make_silver):
    with pytest.raises(QualityError, match="empty"):
        validate_silver(make_silver([dict()]).limit(0))


def _bronze(spark, rows):
    return spark.createDataFrame(rows, RAW_SCHEMA)


GOOD = (1, "TRANSFER", 10.0, "C1", 10.0, 0.0, "C2", 0.0, 10.0, 0, 0)


def test_bronze_passes(spark):
    validate_bronze(_bronze(spark, [GOOD]))


def test_bronze_negative_amount(spark):
    bad = list(GOOD)
    bad[2] = -1.0
    with pytest.raises(QualityError, match="negative"):
        validate_bronze(_bronze(spark, [GOOD, tuple(bad)]))


def test_bronze_unknown_and_null_type(spark):
    unknown, null = list(GOOD), list(GOOD)
    unknown[1], null[1] = "REFUND", None
    df = spark.createDataFrame([GOOD, tuple(unknown), tuple(null)], RAW_SCHEMA.simpleString().replace("type:string", "type:string"))
    with pytest.raises(QualityError, match="REFUND") as err:
        validate_bronze(df)
    assert "None" in str(err.value)


def test_bronze_missing_column(spark):
    df = _bronze(spark, [GOOD]).drop("isFraud")
    with pytest.raises(QualityError, match="isFraud"):
        validate_bronze(df)


def test_required_columns_report_counts_nulls(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "step int, amount double")
    got = {r.column_name: (r.present, r.n_null) for r in required_columns_report(df, ["step", "amount", "nameOrig"]).collect()}
    assert got == {"step": (True, 1), "amount": (True, 2), "nameOrig": (False, None)}


def test_bronze_rejects_null_required_values(spark):
    null_name = list(GOOD)
    null_name[3] = None  # nameOrig
    df = spark.createDataFrame([GOOD, tuple(null_name)], RAW_SCHEMA.simpleString())
    with pytest.raises(QualityError, match="nameOrig=1"):
        validate_bronze(df)


def test_bronze_failure_stores_every_offender(spark):
    def row(i, kind="TRANSFER", amount=10.0, name="C1"):
        return (i, kind, amount, name, 10.0, 0.0, "C2", 0.0, 10.0, 0, 0)

    rows = [row(0), row(1, amount=-1.0), row(2, kind=None, amount=-2.0, name=None)]
    rows += [row(i, kind=f"T{i}") for i in range(3, 33)]
    with pytest.raises(QualityError, match="31 unexpected types") as err:
        validate_bronze(spark.createDataFrame(rows, RAW_SCHEMA.simpleString()))
    assert spark.read.parquet(err.value.tables["types"]).count() == 31
    found = {r.step: r.reasons for r in spark.read.parquet(err.value.tables["rows"]).collect()}
    assert len(found) == 32 and 0 not in found
    assert found[1] == ["negative amount"] and found[3] == ["unexpected type"]
    assert found[2] == ["null nameOrig", "negative amount", "unexpected type"]


def test_silver_failure_stores_every_violated_rate(spark, make_silver):
    with pytest.raises(QualityError) as err:
        validate_silver(make_silver([dict(transaction_type="DEBIT", balance_inconsistent=1)]))
    rate = spark.read.parquet(err.value.tables["rates"]).first()
    assert (rate.transaction_type, rate.rate, rate.violated) == ("DEBIT", 1.0, True)
