"""Feature table, stratified split and evaluation metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import metrics
from .. import oracle as O
from ..oracle import CLASSIFICATION_REPORT_SQL, CONFUSION_CTE, FEATURES_CTE, RULE_SCORE_SQL, SPLIT_CTE
from .inputs import features, rule_score, silver, split_features
from .registry import query


@query("ml_features", O.with_silver("SELECT * FROM features", FEATURES_CTE))
def q_ml_features(spark, sf_dir):
    return features(spark, sf_dir)


@query(
    "stratified_split",
    O.with_silver(
        "SELECT step, name_orig, name_dest, amount, is_transfer, label, is_test FROM split",
        FEATURES_CTE,
        SPLIT_CTE,
    ),
)
def q_stratified_split(spark, sf_dir):
    return split_features(spark, sf_dir).select(
        "step", "name_orig", "name_dest", "amount", "is_transfer", "label", "is_test"
    )


@query(
    "split_class_rates",
    O.with_silver(
        """SELECT CASE WHEN is_test THEN 'test' ELSE 'train' END AS split, COUNT(*) AS n_rows,
  CAST(SUM(label) AS BIGINT) AS n_fraud, CAST(SUM(label) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS fraud_rate
FROM split GROUP BY 1""",
        FEATURES_CTE,
        SPLIT_CTE,
    ),
)
def q_split_class_rates(spark, sf_dir):
    s = split_features(spark, sf_dir)
    return s.groupBy(F.when(F.col("is_test"), "test").otherwise("train").alias("split")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("label").cast("long")).alias("n_fraud"),
        (F.sum(F.col("label").cast("long")).cast("double") / F.count(F.lit(1)).cast("double")).alias("fraud_rate"),
    )


@query(
    "average_precision",
    O.with_silver(
        f"""SELECT CASE WHEN SUM(tp) > 0 THEN
  CAST(SUM(CAST(tp * (CAST(ctp AS DOUBLE) / CAST(cn AS DOUBLE)) AS DECIMAL(38,9))) AS DOUBLE) / CAST(SUM(tp) AS DOUBLE)
  END AS average_precision
FROM (SELECT s, tp, SUM(tp) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS ctp,
             SUM(n) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS cn
      FROM (SELECT {RULE_SCORE_SQL} AS s, SUM(label) AS tp, COUNT(*) AS n FROM features GROUP BY 1))""",
        FEATURES_CTE,
    ),
)
def q_average_precision(spark, sf_dir):
    return metrics.average_precision(features(spark, sf_dir).withColumn("score", rule_score()), "label", "score")


@query(
    "confusion",
    O.with_silver(
        """SELECT 0 AS actual, 0 AS predicted, tn AS n FROM cm UNION ALL SELECT 0, 1, fp FROM cm
UNION ALL SELECT 1, 0, fn FROM cm UNION ALL SELECT 1, 1, tp FROM cm""",
        CONFUSION_CTE,
    ),
)
def q_confusion(spark, sf_dir):
    return metrics.confusion_matrix(silver(spark, sf_dir), "is_fraud", "is_flagged_fraud")


@query("classification_report", CLASSIFICATION_REPORT_SQL)
def q_classification_report(spark, sf_dir):
    return metrics.classification_report(silver(spark, sf_dir), "is_fraud", "is_flagged_fraud")
