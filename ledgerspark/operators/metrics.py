"""Evaluation metrics computed on Spark from (label, score / prediction).

``average_precision`` is the exact step-wise AP (tied scores share one
threshold), not Spark's interpolated ``areaUnderPR``.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import safe_div

# Number of score ranges the running sums are split into.
AP_BUCKETS = 1024
# Fixed-point scale of the per-threshold AP terms before they are summed:
# the sum of fixed-point terms does not depend on the order of additions.
AP_TERM_SCALE = 9


# Target rows per score range when the range count is chosen automatically.
AP_ROWS_PER_RANGE = 1_000_000
AP_MAX_BUCKETS = 65_536


def average_precision(df: DataFrame, label: str = "label", score: str = "score", buckets: int | None = None) -> DataFrame:
    """One row: ``average_precision`` = sum over thresholds of
    (recall step) x precision, thresholds = distinct scores, descending.

    Distributed exactly, without a single-partition window:

    * rows collapse to one per distinct score (tp, n) -- partial aggregate;
    * approximate quantiles of the scores split them into at most
      ``buckets`` score ranges of similar size -- by default about a
      million rows per range, 1 024 to 65 536 ranges (only the cut points
      reach the driver);
    * per-range totals (<= ``buckets`` rows) give each range the counts of
      all higher ranges;
    * a window partitioned by range runs the sums inside each range.

    A row without a score (null, NaN) or with a label other than 0 and 1 has
    no place in the ranking: such rows are counted and raise ``ValueError``.
    """
    s, y = F.col(score).cast("double"), F.col(label)
    scored = df.select(s.alias("_s"), y.cast("long").alias("_y"))
    ranked = s.isNotNull() & ~F.isnan(s) & y.isNotNull() & y.isin(0, 1)
    n, n_ranked = df.agg(F.count(F.lit(1)), F.count_if(ranked)).first()
    if n > n_ranked:
        raise ValueError(f"{n - n_ranked} of {n} rows have no {score} or a {label} other than 0 and 1")
    per_score = scored.groupBy("_s").agg(F.sum("_y").alias("_tp"), F.count(F.lit(1)).alias("_n"))
    # Range boundaries only balance the work (the result is exact for any
    # boundaries), so they come from one shuffle-free pass over the scores.
    if buckets is None:
        buckets = min(AP_MAX_BUCKETS, max(AP_BUCKETS, -(-n // AP_ROWS_PER_RANGE)))
    probs = [i / buckets for i in range(1, buckets)]
    cuts = sorted(set(scored.approxQuantile("_s", probs, 1.0 / (4 * buckets)))) if buckets > 1 else []
    splits = [float("-inf")] + [c for c in cuts if c not in (float("-inf"), float("inf"))] + [float("inf")]
    if len(splits) > 2:
        ranged = Bucketizer(splits=splits, inputCol="_s", outputCol="_r", handleInvalid="keep").transform(per_score)
    else:
        ranged = per_score.withColumn("_r", F.lit(0.0))
    totals = ranged.groupBy("_r").agg(F.sum("_tp").alias("_rtp"), F.sum("_n").alias("_rn"))
    higher = Window.orderBy(F.desc("_r")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_r",
        F.coalesce(F.sum("_rtp").over(higher), F.lit(0)).alias("_otp"),
        F.coalesce(F.sum("_rn").over(higher), F.lit(0)).alias("_on"),
    )
    # At most `buckets` + 1 rows (<= 65 537): a proven bound, so broadcasting is safe.
    inside = Window.partitionBy("_r").orderBy(F.desc("_s")).rowsBetween(Window.unboundedPreceding, 0)
    run = ranged.join(F.broadcast(offsets), "_r").select(
        "_tp",
        (F.sum("_tp").over(inside) + F.col("_otp")).alias("_ctp"),
        (F.sum("_n").over(inside) + F.col("_on")).alias("_cn"),
    )
    term = (F.col("_tp") * (F.col("_ctp") / F.col("_cn"))).cast(f"decimal(38,{AP_TERM_SCALE})")
    agg = run.agg(F.sum(term).cast("double").alias("_num"), F.sum("_tp").alias("_pos"))
    return agg.select(F.when(F.col("_pos") > 0, F.col("_num") / F.col("_pos")).alias("average_precision"))


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row with tn, fp, fn, tp (single pass); rows in none of the cells (nulls, other values) raise."""
    y, p = F.col(label), F.col(prediction)
    cells = ["tn", "fp", "fn", "tp"]
    counts = df.agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count(F.lit(1)).alias("n"),
    )
    left = F.col("n") - sum(F.col(c) for c in cells)
    message = F.concat(left.cast("string"), F.lit(f" rows have a {label} or {prediction} other than 0 and 1"))
    return counts.select(*[F.when(left == 0, F.col(c)).otherwise(F.raise_error(message).cast("long")).alias(c) for c in cells])


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """The 2x2 matrix as rows (actual, predicted, n); empty cells are 0."""
    cells = F.array(
        *[
            F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"), F.col(c).alias("n"))
            for a, b, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
        ]
    )
    return confusion_counts(df, label, prediction).select(F.explode(cells).alias("c")).select("c.*")


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per class precision / recall / f1 / support, plus accuracy, macro
    and support-weighted averages.  A zero denominator gives 0.0.
    The accuracy row carries the accuracy in ``f1_score`` and the total
    in ``support``."""
    return report_from_counts(confusion_counts(df, label, prediction))


def report_from_counts(c: DataFrame) -> DataFrame:
    """The classification report from a one-row frame with tn, fp, fn, tp."""
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    s0, s1 = tn + fp, fn + tp
    p0, r0, f0 = safe_div(tn, tn + fn), safe_div(tn, tn + fp), safe_div(2 * tn, 2 * tn + fn + fp)
    p1, r1, f1 = safe_div(tp, tp + fp), safe_div(tp, tp + fn), safe_div(2 * tp, 2 * tp + fp + fn)
    total = s0 + s1

    def row(name, p, r, f, s):
        return F.struct(
            F.lit(name).alias("class_label"),
            p.cast("double").alias("precision"),
            r.cast("double").alias("recall"),
            f.cast("double").alias("f1_score"),
            s.cast("long").alias("support"),
        )

    def weighted(a, b):
        return safe_div(a * s0 + b * s1, total)

    rows = F.array(
        row("0", p0, r0, f0, s0),
        row("1", p1, r1, f1, s1),
        row("accuracy", F.lit(None), F.lit(None), safe_div(tn + tp, total), total),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, total),
        row("weighted avg", weighted(p0, p1), weighted(r0, r1), weighted(f0, f1), total),
    )
    return c.select(F.explode(rows).alias("r")).select("r.*")
