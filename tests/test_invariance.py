"""Results must not depend on how Spark partitions the work."""

from collections import Counter

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
NAMES = [
    "silver_dedup",
    "fraud_by_type_hour",
    "top_accounts",
    "dim_account",
    "orphan_keys",
    "stratified_split",
    "average_precision",
    "gate_inconsistency_rate",
]


def _rows(spark, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    return Counter(tuple(r[c] for c in cols) for r in df.collect())


@pytest.mark.parametrize("name", NAMES)
def test_same_result_at_any_shuffle_width(spark, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = _rows(spark, name)
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        seven = _rows(spark, name)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert one == seven
