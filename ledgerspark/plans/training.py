"""Fraud scoring end to end on Spark: split, fit, score, evaluate, persist.

Replaces a single-process fit: the feature table stays distributed, only
bounded summaries (class counts, model coefficients, the forest's node
table, one-row metrics) ever reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import money_text
from ..operators import iforest, metrics, models
from ..operators.split import stratified_split
from ..session import stored
from ..spec import FEATURE_COLUMNS, FOREST_SAMPLE, FOREST_TREES, MIN_CONTAMINATION, LedgerSpec

SCORED_COLUMNS = ["step", "name_orig", "name_dest", "amount", "label", "score", "prediction"]


def row_key() -> list[Column]:
    """Identity of a feature row (the business key; type via is_transfer)."""
    return [
        F.col("step").cast("string"),
        F.col("is_transfer").cast("string"),
        money_text("amount"),
        F.col("name_orig"),
        F.col("name_dest"),
    ]


@dataclass
class Trained:
    split: DataFrame
    logistic: PipelineModel
    forest: iforest.IsolationForestModel
    forest_cut: float
    contamination: float
    class_counts: dict[int, int]

    @property
    def n_train(self) -> int:
        return sum(self.class_counts.values())


def split(features: DataFrame, spec: LedgerSpec = LedgerSpec(), materialize: bool = True) -> DataFrame:
    return stratified_split(features, row_key(), "label", spec.test_fraction, spec.seed, materialize=materialize)


def train(features: DataFrame, spec: LedgerSpec = LedgerSpec(), trees: int = FOREST_TREES, psi: int = FOREST_SAMPLE) -> Trained:
    """Split once, then fit both models on the training rows.

    The split table is stored (Parquet under ``spark.checkpoint.dir``)
    before fitting: the solvers, the forest sampler, the quantile cut and
    both scorings then read that table instead of re-running the split's
    lineage, and a lost executor recomputes nothing before it.
    """
    s = stored(split(features, spec), "split")
    train_rows = models.fill_features(s.filter(~F.col("is_test")))
    # One pass for the class sizes: class weights, contamination, forest size.
    counts = models.class_counts(train_rows)
    n_train = sum(counts.values())
    logistic = models.fit_logistic(train_rows, counts=counts)
    fraud_rate = counts.get(1, 0) / n_train if n_train else 0.0
    contamination = max(float(fraud_rate), MIN_CONTAMINATION)
    # The forest is grown on the unscaled features: split points are drawn
    # uniformly between a node's min and max per feature, so any per-feature
    # affine scaling gives the same forest in distribution; no scaler needed.
    forest = iforest.fit_isolation_forest(
        train_rows, FEATURE_COLUMNS, row_key(), trees=trees, psi=psi, seed=spec.seed, n=n_train
    )
    cut = iforest.anomaly_cut(iforest.score_isolation_forest(train_rows.select(*FEATURE_COLUMNS), forest), contamination)
    return Trained(s, logistic, forest, cut, contamination, counts)


def test_rows(t: Trained) -> DataFrame:
    return models.fill_features(t.split.filter(F.col("is_test")))


def logistic_scores(t: Trained) -> DataFrame:
    return models.score_logistic(t.logistic, test_rows(t)).select(*SCORED_COLUMNS)


def forest_scores(t: Trained) -> DataFrame:
    needed = dict.fromkeys([*SCORED_COLUMNS[:5], *FEATURE_COLUMNS])
    scored = iforest.score_isolation_forest(test_rows(t).select(*needed), t.forest)
    return scored.withColumn("prediction", (F.col("score") > F.lit(t.forest_cut)).cast("int")).select(*SCORED_COLUMNS)


def evaluate(scored: DataFrame, model_name: str) -> DataFrame:
    """Tidy rows (model, metric, value): AP, the four confusion cells, test
    size, test fraud rate and the flattened per-class report (AP, then one
    aggregate for everything else)."""
    ap = metrics.average_precision(scored, "label", "score").select(
        F.lit("average_precision").alias("metric"), F.col("average_precision").alias("value")
    )
    y, p = F.col("label"), F.col("prediction")
    counts = scored.agg(
        F.count_if((y == 0) & (p == 0)).cast("double").alias("tn"),
        F.count_if((y == 0) & (p == 1)).cast("double").alias("fp"),
        F.count_if((y == 1) & (p == 0)).cast("double").alias("fn"),
        F.count_if((y == 1) & (p == 1)).cast("double").alias("tp"),
        F.count(F.lit(1)).cast("double").alias("n_test"),
        F.avg(y.cast("double")).alias("fraud_rate_test"),
    )
    names = ("tn", "fp", "fn", "tp", "n_test", "fraud_rate_test")
    rest = counts.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in names])).alias("m")
    ).select("m.*")
    # The per-class report from the same counts, flattened:
    # report.<class>.<precision|recall|f1_score|support>.
    fields = ("precision", "recall", "f1_score", "support")
    report = metrics.report_from_counts(counts).select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.concat(F.lit("report."), F.col("class_label"), F.lit("." + f)).alias("metric"),
                        F.col(f).cast("double").alias("value"),
                    )
                    for f in fields
                ]
            )
        ).alias("m")
    ).select("m.*").filter(F.col("value").isNotNull())
    return ap.unionByName(rest).unionByName(report).select(F.lit(model_name).alias("model"), "metric", "value")


def train_and_evaluate(spark: SparkSession, features: DataFrame, spec: LedgerSpec = LedgerSpec()) -> DataFrame:
    """Fit both models and return their tidy metrics, plus ``n_train``."""
    t = train(features, spec)
    return evaluation(t)


def evaluation(t: Trained) -> DataFrame:
    """Tidy metrics of both fitted models, including the training size.

    Every test row is scored once per model; the metrics read the stored
    labels, scores and predictions."""
    def scored_once(scores: DataFrame) -> DataFrame:
        return stored(scores.select("label", "score", "prediction"), "scored")

    scored = evaluate(scored_once(logistic_scores(t)), "logistic_regression").unionByName(
        evaluate(scored_once(forest_scores(t)), "isolation_forest")
    )
    sizes = t.split.sparkSession.createDataFrame(
        [(m, "n_train", float(t.n_train)) for m in ("logistic_regression", "isolation_forest")],
        "model string, metric string, value double",
    )
    return scored.unionByName(sizes)


def save_models(t: Trained, root: str) -> None:
    """Persist the fitted pipeline (scaler + logistic regression) and the
    forest's node table under ``root`` (a shared folder)."""
    root = root.rstrip("/")
    models.save_model(t.logistic, f"{root}/logistic_regression")
    iforest.save_forest(t.split.sparkSession, t.forest, f"{root}/isolation_forest")


def save_metrics(metrics_df: DataFrame, path: str) -> None:
    """Write the (few-row) tidy metrics table as one JSON file."""
    metrics_df.coalesce(1).write.mode("overwrite").json(path)
