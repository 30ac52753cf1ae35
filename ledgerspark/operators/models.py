"""Supervised scoring: scaler + class-balanced logistic regression (Spark ML).

The objective matches a balanced, L2-regularised logistic regression with
C = 1: per-row weight ``n / (2 * n_class)`` (the weights sum to n), and
``regParam = 1 / n`` because Spark averages the weighted loss while the
C-form sums it.  Features are standardised by the fitted scaler, so the
solver's own standardisation is off.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..spec import FEATURE_COLUMNS

RAW_VECTOR = "raw_features"
SCALED_VECTOR = "scaled_features"


def fill_features(df: DataFrame, cols: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """Null feature values become 0 (the flag is nullable by design)."""
    return df.na.fill(0, subset=list(cols))


def scaler_stages(cols: Sequence[str] = FEATURE_COLUMNS):
    return [
        VectorAssembler(inputCols=list(cols), outputCol=RAW_VECTOR, handleInvalid="error"),
        StandardScaler(inputCol=RAW_VECTOR, outputCol=SCALED_VECTOR, withMean=True, withStd=True),
    ]


def fit_scaler(train: DataFrame, cols: Sequence[str] = FEATURE_COLUMNS) -> PipelineModel:
    return Pipeline(stages=scaler_stages(cols)).fit(fill_features(train, cols))


def class_counts(df: DataFrame, label: str = "label") -> dict[int, int]:
    """Rows per class (one row per class reaches the driver)."""
    return {int(r[label]): int(r["n"]) for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}


def with_class_weights(
    train: DataFrame, label: str = "label", weight: str = "weight", counts: dict[int, int] | None = None
) -> tuple[DataFrame, int]:
    """Add balanced class weights ``n / (k * n_class)``; returns (frame, n).
    ``counts`` (rows per class) is computed when not given."""
    counts = class_counts(train, label) if counts is None else counts
    n = sum(counts.values())
    k = len(counts)
    expr = F.lit(None).cast("double")
    for cls, n_c in counts.items():
        term = F.lit(n / (k * n_c))
        expr = F.when(F.col(label) == cls, term).otherwise(expr)
    return train.withColumn(weight, expr), n


def fit_logistic(
    train: DataFrame,
    cols: Sequence[str] = FEATURE_COLUMNS,
    label: str = "label",
    max_iter: int = 1000,
    c: float = 1.0,
    counts: dict[int, int] | None = None,
) -> PipelineModel:
    """Scaler + weighted logistic regression, fitted on ``train`` only."""
    weighted, n = with_class_weights(fill_features(train, cols), label, counts=counts)
    lr = LogisticRegression(
        featuresCol=SCALED_VECTOR,
        labelCol=label,
        weightCol="weight",
        maxIter=max_iter,
        regParam=1.0 / (c * max(n, 1)),
        elasticNetParam=0.0,
        standardization=False,
        fitIntercept=True,
    )
    return Pipeline(stages=[*scaler_stages(cols), lr]).fit(weighted)


def scaled_expressions(model: PipelineModel, cols: Sequence[str] = FEATURE_COLUMNS) -> list[Column]:
    """The fitted standardisation as column expressions: (x - mean) * (1/std),
    and 0 for a column whose training std is 0 (the scaler's convention)."""
    scaler = next(st for st in model.stages if isinstance(st, StandardScalerModel))
    mean, std = scaler.mean.toArray(), scaler.std.toArray()
    return [
        ((F.col(c).cast("double") - F.lit(float(m))) * F.lit(1.0 / float(sd)) if sd != 0 else F.lit(0.0)).alias(c)
        for c, m, sd in zip(cols, mean, std)
    ]


def score_logistic(model: PipelineModel, df: DataFrame, cols: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """Adds ``score`` (P(label = 1)) and integer ``prediction`` (cut 0.5).

    The fitted pipeline is applied as plain expressions -- standardisation
    from the scaler's mean/std, then ``sigmoid(b + w . z)`` from the
    coefficients -- so scoring has no vector stages, stays in whole-stage
    codegen, and never ships the model object into tasks.
    """
    lr = model.stages[-1]
    z = scaled_expressions(model, cols)
    margin = F.lit(float(lr.intercept))
    for zi, w in zip(z, lr.coefficients.toArray()):
        margin = margin + F.lit(float(w)) * zi
    filled = fill_features(df, cols)
    return (
        filled.withColumn("_margin", margin)
        .withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_margin"))))
        .withColumn("prediction", (F.col("_margin") > 0).cast("int"))
        .drop("_margin")
    )


def logistic_gradient(
    model: PipelineModel,
    train: DataFrame,
    cols: Sequence[str] = FEATURE_COLUMNS,
    label: str = "label",
    c: float = 1.0,
    counts: dict[int, int] | None = None,
) -> DataFrame:
    """(term, gradient): the derivative of the objective that ``fit_logistic``
    minimises -- the mean weighted loss plus the L2 penalty -- at the fitted
    model, for each feature and the intercept.  It vanishes at the optimum,
    and only there (the objective is convex).  One aggregate over ``train``."""
    weighted, n = with_class_weights(train, label, counts=counts)
    scored = score_logistic(model, weighted, cols)
    pull = F.col("weight") * (F.col("score") - F.col(label)) / F.lit(float(max(n, 1)))
    penalty = [float(w) / (c * max(n, 1)) for w in model.stages[-1].coefficients.toArray()]
    sums = [F.sum(pull * z) + F.lit(p) for z, p in zip(scaled_expressions(model, cols), penalty)] + [F.sum(pull)]
    terms = F.array(
        *[F.struct(F.lit(t).alias("term"), g.alias("gradient")) for t, g in zip([*cols, "(intercept)"], sums)]
    )
    return scored.agg(terms.alias("terms")).select(F.explode("terms").alias("t")).select("t.*")


def scaled_columns(model: PipelineModel, df: DataFrame, cols: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """The standardised features as plain columns (same names)."""
    return fill_features(df, cols).select(*scaled_expressions(model, cols))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
