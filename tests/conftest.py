import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

SILVER_DDL = (
    "step int, transaction_type string, amount double, name_orig string, orig_account_type string, "
    "name_dest string, dest_account_type string, oldbalance_orig double, newbalance_orig double, "
    "oldbalance_dest double, newbalance_dest double, is_fraud int, is_flagged_fraud int, balance_inconsistent int"
)


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="ledgerspark-tests-")
    s = (
        SparkSession.builder.master("local[4]")
        .appName("ledgerspark-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", ckpt)
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def tmp_dir(spark):
    from ledgerspark.session import scratch_path

    return scratch_path(spark, "test")


def silver_row(
    step=1,
    transaction_type="TRANSFER",
    amount=100.0,
    name_orig="C1",
    name_dest="C2",
    oldbalance_orig=200.0,
    newbalance_orig=100.0,
    oldbalance_dest=0.0,
    newbalance_dest=100.0,
    is_fraud=0,
    is_flagged_fraud=0,
    balance_inconsistent=0,
):
    def kind(n):
        return "MERCHANT" if n and n.startswith("M") else "CUSTOMER"

    return (
        step,
        transaction_type,
        amount,
        name_orig,
        kind(name_orig),
        name_dest,
        kind(name_dest),
        oldbalance_orig,
        newbalance_orig,
        oldbalance_dest,
        newbalance_dest,
        is_fraud,
        is_flagged_fraud,
        balance_inconsistent,
    )


@pytest.fixture
def make_silver(spark):
    def make(rows):
        return spark.createDataFrame([silver_row(**r) for r in rows], SILVER_DDL)

    return make
