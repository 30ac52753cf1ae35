import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerspark.operators import iforest, metrics, models
from ledgerspark.operators.features import build_features
from ledgerspark.operators.split import stratified_split
from ledgerspark.spec import FEATURE_COLUMNS


def test_features_keep_eligible_types_only(make_silver):
    silver = make_silver([dict(transaction_type="TRANSFER"), dict(step=2, transaction_type="CASH_IN")])
    assert build_features(silver).count() == 1


def test_signed_sender_residual(make_silver):
    silver = make_silver(
        [
            dict(oldbalance_orig=200.0, amount=100.0, newbalance_orig=100.0),
            dict(step=2, oldbalance_orig=200.0, amount=100.0, newbalance_orig=50.0),
        ]
    )
    got = [r.error_balance_orig for r in build_features(silver).orderBy("step").collect()]
    assert got == [0.0, 50.0]


def test_is_transfer_and_label(make_silver):
    silver = make_silver([dict(transaction_type="TRANSFER", is_fraud=1), dict(step=2, transaction_type="CASH_OUT")])
    got = [(r.is_transfer, r.label) for r in build_features(silver).orderBy("step").collect()]
    assert got == [(1, 1), (0, 0)]


def test_features_fill_money_nulls_but_keep_flag(make_silver):
    silver = make_silver([dict(oldbalance_orig=None, balance_inconsistent=None)])
    row = build_features(silver).first()
    assert row.oldbalance_orig == 0.0 and row.balance_inconsistent is None
    assert len(build_features(silver).columns) == 14


# --- average precision ---------------------------------------------------


def naive_ap(labels, scores):
    pos = sum(labels)
    if pos == 0:
        return None
    pairs = sorted(zip(scores, labels), key=lambda p: -p[0])
    ap, tp, n, i = 0.0, 0, 0, 0
    while i < len(pairs):
        j, step_tp = i, 0
        while j < len(pairs) and pairs[j][0] == pairs[i][0]:
            step_tp += pairs[j][1]
            j += 1
        tp += step_tp
        n += j - i
        ap += step_tp / pos * (tp / n)
        i = j
    return ap


def test_ap_tied_example(spark):
    labels = [1, 0, 1, 1, 0, 0]
    scores = [0.9, 0.9, 0.8, 0.5, 0.5, 0.1]
    df = spark.createDataFrame(list(zip(labels, scores)), "label int, score double")
    got = metrics.average_precision(df).first().average_precision
    assert got == pytest.approx(naive_ap(labels, scores), abs=1e-9)
    # thresholds 0.9 / 0.8 / 0.5: (1/2 + 2/3 + 3/5) / 3
    assert got == pytest.approx((1 / 2 + 2 / 3 + 3 / 5) / 3, abs=1e-9)


@settings(max_examples=15, deadline=None, derandomize=True)
@given(
    st.lists(st.tuples(st.integers(0, 1), st.integers(0, 30)), min_size=1, max_size=80),
    st.integers(1, 9),
)
def test_ap_matches_naive(spark, pairs, buckets):
    labels = [p[0] for p in pairs]
    scores = [p[1] / 7.0 for p in pairs]
    df = spark.createDataFrame(list(zip(labels, scores)), "label int, score double")
    got = metrics.average_precision(df, buckets=buckets).first().average_precision
    want = naive_ap(labels, scores)
    if want is None:
        assert got is None
    else:
        assert got == pytest.approx(want, abs=1e-8)


def test_confusion_and_report_with_absent_class(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "label int, prediction int")
    cm = {(r.actual, r.predicted): r.n for r in metrics.confusion_matrix(df).collect()}
    assert cm == {(0, 0): 2, (0, 1): 0, (1, 0): 1, (1, 1): 0}
    rep = {r.class_label: r for r in metrics.classification_report(df).collect()}
    assert rep["1"].precision == 0.0 and rep["1"].recall == 0.0 and rep["1"].f1_score == 0.0
    assert rep["0"].precision == pytest.approx(2 / 3) and rep["0"].recall == 1.0
    assert rep["accuracy"].f1_score == pytest.approx(2 / 3) and rep["accuracy"].support == 3
    assert rep["macro avg"].recall == 0.5
    assert rep["weighted avg"].recall == pytest.approx(2 / 3)


# --- split -------------------------------------------------------------------


def _labelled(spark, n=2000, pos_every=37):
    rows = [(i, f"C{i % 97}", float(i % 50), int(i % pos_every == 0)) for i in range(n)]
    return spark.createDataFrame(rows, "step int, name_orig string, amount double, label int")


def _key():
    return [F.col("step").cast("string"), F.col("name_orig")]


def test_split_exact_per_class_share(spark):
    df = _labelled(spark)
    out = stratified_split(df, _key(), "label", 0.25, 42)
    counts = {(r.label, r.is_test): r.n for r in out.groupBy("label", "is_test").agg(F.count("*").alias("n")).collect()}
    n_pos = sum(1 for i in range(2000) if i % 37 == 0)
    assert counts[(1, True)] == int(n_pos * 0.25 + 0.5)
    assert counts[(0, True)] == int((2000 - n_pos) * 0.25 + 0.5)
    assert out.count() == 2000


def test_split_independent_of_partitioning(spark):
    df = _labelled(spark)
    a = {r.step for r in stratified_split(df.repartition(1), _key()).filter("is_test").collect()}
    b = {r.step for r in stratified_split(df.repartition(11), _key()).filter("is_test").collect()}
    assert a == b
    c = {r.step for r in stratified_split(df, _key(), seed=7).filter("is_test").collect()}
    assert c != a


# --- models -----------------------------------------------------------------


def _toy_features(spark, n=400, outliers=()):
    rnd = random.Random(3)
    rows = []
    for i in range(n):
        base = [rnd.gauss(0, 1) for _ in FEATURE_COLUMNS]
        label = int(i % 10 == 0)
        if label:
            base[0] += 4.0
        rows.append((i, f"C{i}", "C0", *base, label))
    for j, o in enumerate(outliers):
        rows.append((n + j, f"X{j}", "C0", *([o] * len(FEATURE_COLUMNS)), 1))
    cols = ", ".join(f"{c} double" for c in FEATURE_COLUMNS)
    return spark.createDataFrame(rows, f"step int, name_orig string, name_dest string, {cols}, label int")


def test_logistic_learns_a_shift(spark):
    df = _toy_features(spark)
    model = models.fit_logistic(df, max_iter=50)
    scored = models.score_logistic(model, df)
    means = {r.label: r.m for r in scored.groupBy("label").agg(F.avg("score").alias("m")).collect()}
    assert means[1] > 0.5 > means[0]


def test_isolation_forest_ranks_planted_outliers_first(spark):
    df = _toy_features(spark, n=600, outliers=(25.0, -30.0, 40.0))
    key = [F.col("name_orig")]
    model = iforest.fit_isolation_forest(df, FEATURE_COLUMNS, key, trees=30, psi=128, seed=1)
    assert len(model.nodes) <= 30 * (2 * 128 - 1)
    scored = iforest.score_isolation_forest(df, model)
    top = [r.name_orig for r in scored.orderBy(F.desc("score")).limit(3).collect()]
    assert sorted(top) == ["X0", "X1", "X2"]
    s = [r.score for r in scored.select("score").collect()]
    assert all(0.0 < v < 1.0 for v in s)


def test_isolation_forest_independent_of_partitioning(spark):
    df = _toy_features(spark, n=300)
    key = [F.col("name_orig")]
    a = iforest.fit_isolation_forest(df.repartition(1), FEATURE_COLUMNS, key, trees=5, psi=64, seed=3)
    b = iforest.fit_isolation_forest(df.repartition(8), FEATURE_COLUMNS, key, trees=5, psi=64, seed=3)
    cols = ["tree", "node", "feature", "threshold", "size"]
    pa = a.nodes.sort_values(["tree", "node"])[cols].reset_index(drop=True)
    pb = b.nodes.sort_values(["tree", "node"])[cols].reset_index(drop=True)
    assert pa.equals(pb)


def test_model_save_and_load(spark, tmp_dir):
    df = _toy_features(spark, n=100)
    model = models.fit_logistic(df, max_iter=20)
    models.save_model(model, tmp_dir)
    again = models.score_logistic(models.load_model(tmp_dir), df).select("score").collect()
    first = models.score_logistic(model, df).select("score").collect()
    assert again == first


def test_forest_save_and_load(spark, tmp_dir):
    df = _toy_features(spark, n=200)
    model = iforest.fit_isolation_forest(df, FEATURE_COLUMNS, [F.col("name_orig")], trees=4, psi=32, seed=5)
    iforest.save_forest(spark, model, tmp_dir)
    again = iforest.load_forest(spark, tmp_dir)
    a = iforest.score_isolation_forest(df, model).select("score").collect()
    b = iforest.score_isolation_forest(df, again).select("score").collect()
    assert a == b and again.psi == 32 and again.trees == 4


def test_training_plan_end_to_end(spark, tmp_dir):
    from ledgerspark.plans import training

    df = _toy_features(spark, n=400)
    t = training.train(df, trees=10, psi=32)
    assert 0.0 < t.contamination < 1.0
    lr = training.logistic_scores(t)
    forest = training.forest_scores(t)
    n_test = t.split.filter("is_test").count()
    assert lr.count() == forest.count() == n_test == 100  # 25 % of 400, exact per class
    metrics_df = training.evaluate(lr, "lr").unionByName(training.evaluate(forest, "if"))
    training.save_metrics(metrics_df, f"{tmp_dir}/metrics")
    back = {(r.model, r.metric): r.value for r in spark.read.json(f"{tmp_dir}/metrics").collect()}
    assert back[("lr", "n_test")] == 100.0
    assert back[("lr", "tn")] + back[("lr", "fp")] + back[("lr", "fn")] + back[("lr", "tp")] == 100.0
    assert back[("lr", "average_precision")] > 0.5  # the shifted class is easy
    training.save_models(t, f"{tmp_dir}/models")
    again = iforest.load_forest(spark, f"{tmp_dir}/models/isolation_forest")
    assert again.trees == 10
    assert models.load_model(f"{tmp_dir}/models/logistic_regression") is not None


@pytest.mark.parametrize("row", [(1, None), (1, float("nan")), (None, 0.5), (2, 0.5)])
def test_average_precision_raises_on_rows_it_cannot_rank(spark, row):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1), row], "label int, score double")
    with pytest.raises(ValueError, match="1 of 3 rows"):
        metrics.average_precision(df)


@pytest.mark.parametrize("row", [(1, None), (None, 0), (2, 1), (0, -1)])
def test_confusion_counts_raise_on_rows_in_no_cell(spark, row):
    df = spark.createDataFrame([(1, 1), (0, 0), row], "label int, prediction int")
    with pytest.raises(Exception, match="1 rows have"):
        metrics.confusion_counts(df).collect()
    assert tuple(metrics.confusion_counts(df.limit(0)).first()) == (0, 0, 0, 0)
