from pyspark.sql import functions as F

from ledgerspark.functions.columns import band
from ledgerspark.operators import marts, star
from ledgerspark.plans.medallion import build_gold
from ledgerspark.sources.files import read_table
from ledgerspark.spec import AMOUNT_BAND_EDGES, AMOUNT_BAND_LABELS


def test_counts_match_written_rows(spark, make_silver, tmp_dir):
    silver = make_silver(
        [
            dict(step=1, amount=500.0),
            dict(step=25, amount=50_000.0, is_fraud=1, name_orig="C2", name_dest="C1"),
            dict(step=30, transaction_type="CASH_OUT", amount=2_000_000.0, name_dest="M7"),
        ]
    )
    counts = build_gold(silver, tmp_dir)
    for name, n in counts.items():
        assert read_table(spark, f"{tmp_dir}/{name}").count() == n, name
    assert counts["fact_transactions"] == 3


def test_dim_time_day_and_hour(spark, make_silver):
    silver = make_silver([dict(step=s, name_orig=f"C{s}") for s in (0, 23, 24, 25, 47, 48)])
    got = {r.step: (r.time_key, r.day, r.hour_of_day) for r in star.dim_time(silver).collect()}
    assert got[25] == (25, 2, 1)
    assert got[23] == (23, 1, 23)
    assert got[24] == (24, 2, 0)
    assert got[47] == (47, 2, 23)
    assert got[48] == (48, 3, 0)
    assert got[0] == (0, 1, 0)


def test_dim_transaction_type_dense_alphabetical(spark, make_silver):
    silver = make_silver([dict(transaction_type=t) for t in ("TRANSFER", "CASH_OUT", "TRANSFER", "PAYMENT")])
    got = {r.transaction_type: r.type_key for r in star.dim_transaction_type(silver).collect()}
    assert got == {"CASH_OUT": 1, "PAYMENT": 2, "TRANSFER": 3}


def test_dim_account_dedups_both_roles(spark, make_silver):
    silver = make_silver([dict(name_orig="C1", name_dest="C2"), dict(step=2, name_orig="C2", name_dest="C1")])
    acc = star.dim_account(silver).collect()
    assert sorted(r.account_id for r in acc) == ["C1", "C2"]
    assert len({r.account_key for r in acc}) == 2


def test_fact_has_time_key_not_step(spark, make_silver):
    fact = star.fact_transactions(make_silver([dict()]))
    assert "time_key" in fact.columns and "step" not in fact.columns
    assert len(fact.columns) == 13


def test_surrogate_keys_do_not_depend_on_partitioning(spark, make_silver):
    silver = make_silver([dict(step=i, name_orig=f"C{i % 7}", amount=float(i)) for i in range(60)])
    a = {r.transaction_key for r in star.fact_transactions(silver.repartition(1)).collect()}
    b = {r.transaction_key for r in star.fact_transactions(silver.repartition(9)).collect()}
    assert a == b and len(a) == 60
    assert star.key_collisions(star.fact_transactions(silver), "transaction_key").count() == 0


def test_amount_bands(spark, make_silver):
    silver = make_silver([dict(amount=500.0, is_fraud=0), dict(step=2, amount=50_000.0, is_fraud=1)])
    got = {r.amount_band: (r.n_transactions, r.n_fraud) for r in marts.fraud_by_amount_band(silver).collect()}
    assert got == {"0-1K": (1, 0), "10K-100K": (1, 1)}


def test_band_edges_are_left_closed_and_null_stays_null(spark):
    values = [-5.0, 999.99, 1000.0, 9999.99, 10000.0, 100000.0, 1000000.0, None]
    df = spark.createDataFrame([(v,) for v in values], "amount double")
    got = [r.b for r in df.select(band("amount", AMOUNT_BAND_EDGES, AMOUNT_BAND_LABELS).alias("b")).collect()]
    assert got == ["0-1K", "0-1K", "1K-10K", "1K-10K", "10K-100K", "100K-1M", "1M+", None]


def test_top_accounts_order_and_ties(spark, make_silver):
    silver = make_silver(
        [
            dict(name_orig="C1", amount=100.0),
            dict(step=2, name_orig="C2", amount=900.0),
            dict(step=3, name_orig="C3", amount=100.0),
        ]
    )
    top = marts.top_accounts(silver, k=2).collect()
    assert (top[0].name_orig, top[0].total_out) == ("C2", 900.0)
    assert top[1].name_orig == "C1"  # tie with C3 broken by id
    assert marts.top_accounts(silver, k=2).count() == 2


def test_fraud_rate_is_exact_half_up(spark, make_silver):
    # 1 fraud in 32 rows = 0.03125 -> 0.0313 (half up at 4 dp)
    rows = [dict(step=i, name_orig=f"C{i}", is_fraud=1 if i == 0 else 0) for i in range(32)]
    got = marts.fraud_by_amount_band(make_silver(rows)).first()
    assert got.fraud_rate == 0.0313


def test_rollup_percent_from_sums(spark, make_silver):
    rows = [dict(step=h, name_orig=f"C{h}", is_fraud=h % 2) for h in range(4)]
    by = marts.fraud_by_type_hour(make_silver(rows))
    got = marts.fraud_pct_by_type(by).first()
    assert (got.total, got.frauds, got.fraud_pct) == (4, 2, 50.0)


def test_star_integrity_report_and_orphans(spark, make_silver):
    silver = make_silver([dict(name_orig="C1", name_dest="C2"), dict(step=2, name_orig="C3", name_dest="M4")])
    fact = star.fact_transactions(silver)
    accounts = star.dim_account(silver)
    report = {r.role: (r.n_keys, r.n_missing_keys) for r in star.integrity_report(
        fact, accounts, star.dim_time(silver), star.dim_transaction_type(silver)).collect()}
    assert report["sender"] == (2, 0) and report["receiver"] == (2, 0)
    partial = accounts.filter(F.col("account_id") != "C3")
    orphans = star.orphan_keys(fact, partial, star.dim_time(silver), star.dim_transaction_type(silver)).collect()
    assert [(r.role, r.key, r.n_rows) for r in orphans] == [("sender", "C3", 1)]


def test_star_lookup_broadcasts_small_dims(spark, make_silver):
    silver = make_silver([dict(step=s, name_orig=f"C{s}") for s in range(10)])
    out = star.star_lookup(star.fact_transactions(silver), star.dim_time(silver), star.dim_transaction_type(silver))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert out.count() == 10


def test_medallion_then_warehouse_load(spark, make_silver, tmp_dir):
    from ledgerspark.plans.medallion import load_warehouse
    from ledgerspark.sources.warehouse import DirectoryTarget, read_served
    from ledgerspark.spec import RAW_SCHEMA
    from ledgerspark.plans.medallion import run_medallion

    rows = [
        (1, "CASH_OUT", 200.0, "C1", 1000.0, 800.0, "M9", 0.0, 0.0, 0, 0),
        (1, "CASH_OUT", 200.0, "C1", 1000.0, 800.0, "M9", 0.0, 0.0, 0, 0),
        (2, "TRANSFER", 50.0, "C2", 100.0, 50.0, "C3", 5.0, 55.0, 1, 0),
        (3, "PAYMENT", 10.0, "C2", 50.0, 40.0, "M4", 0.0, 0.0, 0, 0),
    ]
    summary = {(r.layer, r.table_name): r.n_rows for r in
               run_medallion(spark, spark.createDataFrame(rows, RAW_SCHEMA), tmp_dir, source_name="t.csv").collect()}
    assert summary[("bronze", "transactions")] == 4 and summary[("silver", "transactions")] == 3
    assert summary[("gold", "ml_features")] == 2  # CASH_OUT + TRANSFER
    target = DirectoryTarget(f"{tmp_dir}/warehouse")
    loaded = load_warehouse(spark, f"{tmp_dir}/gold", target)
    assert loaded["kpi_summary"] == 1 and loaded["dim_transaction_type"] == 3
    kpi = read_served(spark, "kpi_summary", target).first()
    assert (kpi.n_transactions, kpi.n_fraud, kpi.fraud_pct) == (3, 1, 33.3333)


def test_feature_type_filter_reaches_the_silver_scan(spark, make_silver, tmp_dir):
    from ledgerspark.operators.features import build_features
    from ledgerspark.sources.sinks import write_table

    write_table(make_silver([dict(), dict(step=2, transaction_type="CASH_IN")]), tmp_dir)
    feats = build_features(read_table(spark, tmp_dir))
    plan = feats._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(transaction_type, [CASH_OUT,TRANSFER])]" in plan or (
        "PushedFilters:" in plan and "In(transaction_type" in plan
    )
    assert feats.count() == 1


def test_star_lookup_keeps_fact_rows_with_missing_keys(spark, make_silver):
    silver = make_silver([dict(step=1, name_orig="C1"), dict(step=2, name_orig="C2")])
    time_dim = star.dim_time(silver).filter(F.col("step") == 1)
    out = star.star_lookup(star.fact_transactions(silver), time_dim, star.dim_transaction_type(silver))
    got = sorted((r.time_key, r.day) for r in out.collect())
    assert got == [(1, 1), (2, None)]


def test_star_lookup_takes_keys_and_types_from_the_account_dimension(spark, make_silver):
    silver = make_silver([
        dict(step=1, name_orig="C1", name_dest="M9"),
        dict(step=2, name_orig="C2", name_dest="C1"),
        dict(step=3, name_orig="C1", name_dest="M8"),
    ])
    accounts = star.dim_account(silver).filter(~F.col("account_id").isin("C2", "M8"))
    accounts = accounts.withColumn("account_type", F.concat(F.lit("type of "), "account_id"))
    key = {r.account_id: r.account_key for r in accounts.collect()}
    out = star.star_lookup(
        star.fact_transactions(silver), star.dim_time(silver), star.dim_transaction_type(silver), accounts=accounts
    )
    got = {r.time_key: (r.orig_account_key, r.orig_account_type, r.dest_account_key, r.dest_account_type)
           for r in out.collect()}
    assert got == {
        1: (key["C1"], "type of C1", key["M9"], "type of M9"),
        2: (None, None, key["C1"], "type of C1"),
        3: (key["C1"], "type of C1", None, None),
    }


def test_star_lookup_of_a_null_account_finds_the_null_row(spark, make_silver):
    silver = make_silver([dict(step=1, name_orig="C1")]).withColumn("name_orig", F.lit(None).cast("string"))
    row = star.star_lookup(
        star.fact_transactions(silver), star.dim_time(silver), star.dim_transaction_type(silver),
        accounts=star.dim_account(silver),
    ).first()
    assert row.orig_account_key is not None and row.dest_account_key is not None


def test_rates_equal_reference_style_rounding(spark):
    """The exact half-up rates equal round(avg(flag), 4) / ROUND(sum*100.0/count, 4)
    as Spark computes them, on the whole test ledger."""
    from ledgerspark.functions.columns import hour_of_day
    from ledgerspark.plans.catalog import SPEC, silver

    s = silver(spark, "/root/testdata/sf0.01")
    ours = marts.fraud_by_type_hour(s, SPEC)
    ref = s.groupBy("transaction_type", hour_of_day("step").alias("hour_of_day")).agg(
        F.round(F.avg("is_fraud"), 4).alias("ref_rate")
    )
    joined = ours.join(ref, ["transaction_type", "hour_of_day"])
    assert joined.count() == 120
    assert joined.filter(F.col("fraud_rate") != F.col("ref_rate")).count() == 0
    kpi = marts.kpi_summary(s).first().fraud_pct
    ref_pct = s.agg(F.round(F.sum("is_fraud") * 100.0 / F.count(F.lit(1)), 4).alias("p")).first().p
    assert kpi == float(ref_pct)


def test_keys_tell_amounts_apart_beyond_six_decimals(spark, make_silver):
    fact = star.fact_transactions(make_silver([dict(amount=1.0000001), dict(amount=1.0000002), dict(amount=100.0)]))
    assert len({r.transaction_key for r in fact.collect()}) == 3


def _star(silver):
    return [star.fact_transactions(silver), star.dim_account(silver), star.dim_time(silver), star.dim_transaction_type(silver)]


def test_gold_gate(spark, make_silver):
    import re

    import pytest

    from ledgerspark.operators.quality import QualityError, validate_gold
    from ledgerspark.sources.files import read_table

    silver = make_silver([dict(step=k, name_orig=f"C{k}") for k in range(1, 60)])
    good = _star(silver)
    assert {r.n_missing_rows for r in validate_gold(*good).collect()} == {0}
    orphaned = [good[0], good[1].where("account_id NOT IN ('C7', 'C8')"), good[2].where("time_key <> 9"), good[3]]
    with pytest.raises(QualityError, match="3 references without") as error:
        validate_gold(*orphaned)
    path = re.search(r"all in (\S+)\)", str(error.value))[1]
    assert sorted((r.role, r.key) for r in read_table(spark, path).collect()) == [("sender", "C7"), ("sender", "C8"), ("time", "9")]
    twice = [good[0], good[1].withColumn("account_key", F.lit("same")), *good[2:]]
    with pytest.raises(QualityError, match="1 equal account keys"):
        validate_gold(*twice)
    with pytest.raises(QualityError, match="59 equal transaction keys"):
        validate_gold(good[0].unionByName(good[0]), *good[1:])


def test_the_chain_stops_at_the_gold_gate(spark, make_silver, tmp_dir, monkeypatch):
    import pytest

    from ledgerspark.operators import quality
    from ledgerspark.plans import medallion
    from ledgerspark.spec import RAW_SCHEMA

    whole = medallion.star.dim_account
    monkeypatch.setattr(medallion.star, "dim_account", lambda s: whole(s).where("account_id <> 'C1'"))
    rows = [(1, "CASH_OUT", 200.0, "C1", 1000.0, 800.0, "M9", 0.0, 0.0, 0, 0)]
    with pytest.raises(quality.QualityError, match="references without"):
        medallion.run_medallion(spark, spark.createDataFrame(rows, RAW_SCHEMA), tmp_dir)
