"""Model queries: scaler statistics, logistic regression, isolation forest."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import iforest, models
from ...session import scratch_path, stored
from ...sources import files
from ...sources.ledger import read_ledger
from ...spec import RAW_COLUMNS
from ...streaming import land, messages
from .. import oracle as O, training
from ..oracle import FEATURES_CTE, RAW_SQL, SPLIT_CTE
from .forest_sql import FOREST_NODES_SQL, FOREST_SCORES_SQL
from .inputs import FEATURE_LIST, TOPIC, features, split_features, trained
from .registry import SPEC, query


def z_stats_sql() -> str:
    parts = []
    for f in FEATURE_LIST:
        col = f"CAST(coalesce({f}, 0) AS DOUBLE)"
        parts.append(
            f"""SELECT '{f}' AS feature, ROUND(AVG(z), 6) + 0.0 AS mean, ROUND(stddev_samp(z), 6) + 0.0 AS std
FROM (SELECT CASE WHEN sd = 0 THEN 0.0 ELSE ({col} - m) / sd END AS z
      FROM train, (SELECT AVG({col}) AS m, stddev_samp({col}) AS sd FROM train))"""
        )
    return " UNION ALL ".join(parts)


@query(
    "scaled_stats",
    O.with_silver(
        z_stats_sql(),
        FEATURES_CTE,
        SPLIT_CTE,
        "\ntrain AS (SELECT * FROM split WHERE NOT is_test)",
    ),
)
def q_scaled_stats(spark, sf_dir):
    """Mean and std of each standardised feature on the training rows: the
    scaler is fitted on train only, so these are 0 and 1."""
    train_rows = models.fill_features(split_features(spark, sf_dir).filter(~F.col("is_test")))
    z = models.scaled_columns(models.fit_scaler(train_rows), train_rows)
    stats = z.agg(*[x for f in FEATURE_LIST for x in (F.avg(f).alias(f"m_{f}"), F.stddev_samp(f).alias(f"s_{f}"))])
    rows = F.array(
        *[
            F.struct(
                F.lit(f).alias("feature"),
                (F.round(F.col(f"m_{f}"), 6) + F.lit(0.0)).alias("mean"),
                (F.round(F.col(f"s_{f}"), 6) + F.lit(0.0)).alias("std"),
            )
            for f in FEATURE_LIST
        ]
    )
    return stats.select(F.explode(rows).alias("r")).select("r.*")


@query("lr_scores")
def q_lr_scores(spark, sf_dir):
    return training.logistic_scores(trained(spark, sf_dir))


@query("iforest_scores")
def q_iforest_scores(spark, sf_dir):
    return training.forest_scores(trained(spark, sf_dir))


@query("model_evaluation")
def q_model_evaluation(spark, sf_dir):
    return training.train_and_evaluate(spark, features(spark, sf_dir), SPEC)


@query("model_roundtrip")
def q_model_roundtrip(spark, sf_dir):
    """Persist both fitted models, load them back, score the test rows."""
    t = trained(spark, sf_dir)
    lr_path, forest_path = scratch_path(spark, "model-lr"), scratch_path(spark, "model-forest")
    models.save_model(t.logistic, lr_path)
    iforest.save_forest(spark, t.forest, forest_path)
    test = training.test_rows(t)
    lr = models.score_logistic(models.load_model(lr_path), test).select(*training.SCORED_COLUMNS)
    forest = iforest.score_isolation_forest(test, iforest.load_forest(spark, forest_path))
    forest = forest.withColumn("prediction", (F.col("score") > F.lit(t.forest_cut)).cast("int"))
    return lr.withColumn("model", F.lit("logistic_regression")).unionByName(
        forest.select(*training.SCORED_COLUMNS).withColumn("model", F.lit("isolation_forest"))
    )


@query("forest_nodes", FOREST_NODES_SQL)
def q_forest_nodes(spark, sf_dir):
    """Every node of the fitted forest."""
    nodes = trained(spark, sf_dir).forest.nodes  # at most trees x (2 psi - 1) rows
    return spark.createDataFrame(nodes, iforest.NODE_SCHEMA).select("tree", "node", "feature", "threshold", "size", "depth")


@query("forest_test_scores", FOREST_SCORES_SQL)
def q_forest_test_scores(spark, sf_dir):
    """Anomaly score of every test row, to six decimals."""
    scores = stored(training.forest_scores(trained(spark, sf_dir)), "forest-test-scores")
    return scores.select("step", "name_orig", "name_dest", "amount", F.round("score", 6).alias("score"))


#: Decimals to which the gradient must vanish; without a fit it is of the order of 0.1.
GRADIENT_DECIMALS = 5


@query(
    "lr_optimum",
    O.with_silver(
        " UNION ALL ".join(
            f"SELECT '{t}' AS term, CAST(0 AS DOUBLE) AS gradient, COUNT(*) AS n_train FROM split WHERE NOT is_test"
            for t in [*FEATURE_LIST, "(intercept)"]
        ),
        FEATURES_CTE,
        SPLIT_CTE,
    ),
)
def q_lr_optimum(spark, sf_dir):
    """The gradient of the regularised, class-weighted loss at the fitted
    coefficients, over all training rows: 0 to five decimals in every term."""
    t = trained(spark, sf_dir)
    train_rows = t.split.filter(~F.col("is_test"))
    gradient = models.logistic_gradient(t.logistic, train_rows, counts=t.class_counts)
    rounded = F.round("gradient", GRADIENT_DECIMALS) + F.lit(0.0)
    return gradient.select("term", rounded.alias("gradient"), F.lit(t.n_train).cast("long").alias("n_train"))


@query(
    "model_reload",
    O.with_silver(
        " UNION ALL ".join(
            f"SELECT '{m}' AS model, COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS n_changed FROM split WHERE is_test"
            for m in ("logistic_regression", "isolation_forest")
        ),
        FEATURES_CTE,
        SPLIT_CTE,
    ),
)
def q_model_reload(spark, sf_dir):
    """Both models saved and loaded: test rows whose score or prediction differs from the fitted model's."""
    t = trained(spark, sf_dir)
    root = scratch_path(spark, "models")
    training.save_models(t, root)
    lr = models.load_model(f"{root}/logistic_regression")
    forest = iforest.load_forest(spark, f"{root}/isolation_forest")
    test = stored(training.test_rows(t), "test-rows")

    def before(scored):
        return scored.withColumnRenamed("score", "score_before").withColumnRenamed("prediction", "prediction_before")

    twice = models.score_logistic(lr, before(models.score_logistic(t.logistic, test)))
    lr_same = F.col("score").eqNullSafe(F.col("score_before")) & F.col("prediction").eqNullSafe(F.col("prediction_before"))
    trees = iforest.score_isolation_forest(iforest.score_isolation_forest(test.select(*FEATURE_LIST), t.forest, "score_before"), forest)
    counts = [F.count(F.lit(1)).alias("n_rows")]
    rows = [
        ("logistic_regression", *twice.agg(*counts, F.count_if(~lr_same)).first()),
        ("isolation_forest", *trees.agg(*counts, F.count_if(~F.col("score").eqNullSafe(F.col("score_before")))).first()),
    ]
    return spark.createDataFrame(rows, "model string, n_rows bigint, n_changed bigint")


@query(
    "stream_bounded_landing",
    O.with_ledger(f"SELECT {RAW_SQL} FROM ledger ORDER BY event_id LIMIT 1000"),
)
def q_stream_bounded_landing(spark, sf_dir):
    """Stop after 1000 messages: the first 1000 by offset are landed."""
    msgs = messages.to_messages(read_ledger(spark, sf_dir), key="event_id").withColumn(
        "offset", F.col("key").cast("long")
    )
    out = scratch_path(spark, "landing")
    land.land_bounded(msgs, out, f"kafka:{TOPIC}", max_rows=1000, order_by=("offset",))
    return files.read_table(spark, out).select(*RAW_COLUMNS)
