"""The stage-level entry points, end to end on a small ledger."""

import random

from ledgerspark import api
from ledgerspark.session import scratch_path
from ledgerspark.sources.files import read_table, write_csv
from ledgerspark.sources.warehouse import DirectoryTarget
from ledgerspark.spec import RAW_SCHEMA


def _raw(spark, n=240):
    rnd = random.Random(7)
    rows = []
    for i in range(n):
        t = ["TRANSFER", "CASH_OUT", "PAYMENT", "CASH_IN", "DEBIT"][i % 5]
        amount = float(rnd.randint(1, 10**6)) / 100
        old = amount + 100.0
        new = old - amount if i % 3 else old  # some inconsistent rows
        fraud = int(t in ("TRANSFER", "CASH_OUT") and i % 7 == 0)
        rows.append((i % 50 + 1, t, amount, f"C{i % 17}", old, new, f"C{i % 11 + 100}", 0.0, amount, fraud, 0))
    return spark.createDataFrame(rows, RAW_SCHEMA)


def test_batch_stages_end_to_end(spark):
    root = scratch_path(spark, "api")
    write_csv(_raw(spark), f"{root}/raw")
    assert api.ingest_bronze(spark, f"{root}/raw", f"{root}/bronze", f"{root}/quarantine") == 240
    api.validate_bronze(spark, f"{root}/bronze")
    assert api.build_silver(spark, f"{root}/bronze", f"{root}/silver").count() == 240
    report = api.validate_silver(spark, f"{root}/silver").collect()
    assert {r.transaction_type for r in report} == {"TRANSFER", "CASH_OUT", "PAYMENT", "CASH_IN", "DEBIT"}
    counts = api.build_gold(spark, f"{root}/silver", f"{root}/gold")
    assert counts["fact_transactions"] == 240
    assert api.build_features(spark, f"{root}/silver", f"{root}/features").count() == 96
    metrics = {(r.model, r.metric): r.value for r in api.train_and_evaluate(spark, f"{root}/features", f"{root}/ml").collect()}
    feats = read_table(spark, f"{root}/features")
    per_class = [r["count"] for r in feats.groupBy("label").count().collect()]
    expected = sum(int(n * 0.25 + 0.5) for n in per_class)  # exact share per class
    assert metrics[("logistic_regression", "n_test")] == metrics[("isolation_forest", "n_test")] == expected
    target = DirectoryTarget(f"{root}/warehouse")
    assert api.load_warehouse(spark, f"{root}/gold", target)["kpi_summary"] == 1
    assert api.read_dataframe(spark, "kpi_summary", target).first().n_transactions == 240


def test_produce_and_consume(spark):
    root = scratch_path(spark, "api-stream")
    raw = _raw(spark, 30)
    assert api.produce(raw, f"{root}/topic", limit=20, order_by=("step", "nameOrig")) == 20
    assert api.row_to_message(raw).count() == 30
    bounded = api.consume(spark, f"{root}/land1", f"{root}/ckpt1", "payments", source_path=f"{root}/topic", max_messages=5)
    assert bounded == 5 and read_table(spark, f"{root}/land1").count() == 5
    drained = api.consume(spark, f"{root}/land2", f"{root}/ckpt2", "payments", source_path=f"{root}/topic",
                          batch_timeout=0)
    assert drained == 20
    again = api.consume(spark, f"{root}/land2", f"{root}/ckpt2", "payments", source_path=f"{root}/topic",
                        batch_timeout=0)
    assert again == 0 and read_table(spark, f"{root}/land2").count() == 20


def test_command_line_chain(spark, capsys):
    from ledgerspark.cli import main

    out = scratch_path(spark, "cli")
    assert main(["--events", "/root/testdata/sf0.001", "--out", out, "--serve", f"{out}/wh"]) == 0
    printed = capsys.readouterr().out
    assert "silver  transactions" in printed and "served  kpi_summary" in printed
    assert read_table(spark, f"{out}/silver").count() == 1000
