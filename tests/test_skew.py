"""A key holding a third of the rows: exact results, pre-aggregated shuffles."""

from pyspark.sql import functions as F

from ledgerspark.operators import marts, star
from ledgerspark.operators.clean import dedup
from ledgerspark.spec import DEDUP_KEYS


def _hot_silver(make_silver):
    rows = []
    for i in range(300):
        if i % 3 == 0:  # a third of the rows: one hot sender
            rows.append(dict(step=i, name_orig="C0", amount=10.0, is_fraud=int(i % 2 == 0)))
        else:
            rows.append(dict(step=i, name_orig=f"C{i}", amount=1.0))
    return make_silver(rows)


def test_hot_sender_totals_are_exact(make_silver):
    silver = _hot_silver(make_silver)
    top = marts.top_accounts(silver, k=1).first()
    assert (top.name_orig, top.total_out, top.n_transactions, top.n_fraud) == ("C0", 1000.0, 100, 50)
    assert star.dim_account(silver).count() == 201  # C0 + 200 cold senders (receiver C2 is one of them)


def test_hot_aggregation_is_partial_before_the_shuffle(make_silver):
    plan = marts.top_accounts(_hot_silver(make_silver), k=1)._jdf.queryExecution().executedPlan().toString()
    partial = plan.find("partial_sum")
    exchange = plan.rfind("Exchange hashpartitioning")
    assert partial != -1 and exchange != -1 and partial > exchange  # partial agg sits below the exchange


def test_hot_duplicate_collapses_to_one_row(spark, make_silver):
    base = _hot_silver(make_silver)
    copies = base.limit(1).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(150)))).drop("k")
    df = base.unionByName(copies)  # one business key now holds a third of the rows
    out = dedup(df, list(DEDUP_KEYS))
    assert out.count() == 300
    assert out.groupBy(*DEDUP_KEYS).count().filter("count > 1").count() == 0
