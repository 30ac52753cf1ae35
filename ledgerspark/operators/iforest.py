"""Isolation forest (Liu, Ting & Zhou, 2008) on Spark.

Training never moves the data to one process:

1. **Sample pool.**  A row joins the pool when a hash of its key falls
   under ``p = min(1, oversample * trees * psi / n)``; the pool holds about
   ``oversample * trees * psi`` rows whatever ``n`` is.
2. **Per-tree samples.**  Each pool row is offered to every tree with a
   per-tree hash; each tree keeps its ``psi`` smallest hashes (a window per
   tree over the bounded pool).  Every tree therefore sees a uniform
   sample without replacement, chosen by hashes only -- the same forest on
   any partitioning.
3. **Build.**  All trees grow together, level by level: one aggregation
   gives each node's least and greatest value per feature; feature and
   split point (uniform between the two) are drawn from a hash of seed,
   tree and node; depth limit ceil(log2 psi).  No Python.
4. **Score.**  The forest is ``trees * (2 psi - 1)`` nodes at most (a
   proven bound, ~51k rows for 100 x 256), so it is shipped to the tasks
   and ``mapInPandas`` scores Arrow batches with vectorised traversal:
   ``s = 2 ** (-E[h(x)] / c(psi))``, high = more anomalous.
5. **Cut.**  A row is predicted anomalous above the exact
   ``(1 - contamination)`` percentile of the training scores
   (:func:`anomaly_cut`, distributed, see ``quantile.py``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.columns import key_text, surrogate_key
from ..session import ship_package, stored
from .quantile import percentile

EULER_GAMMA = 0.5772156649015329
NODE_SCHEMA = (
    "tree int, node int, feature int, threshold double, left int, right int, size long, depth int"
)


def average_path_length(n):
    """c(n): mean path length of an unsuccessful BST search over n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[n == 2] = 1.0
    m = n[big]
    out[big] = 2.0 * (np.log(m - 1.0) + EULER_GAMMA) - 2.0 * (m - 1.0) / m
    return out


@dataclass
class IsolationForestModel:
    nodes: pd.DataFrame  # NODE_SCHEMA rows, bounded by trees * (2 psi - 1)
    features: list[str]
    psi: int
    trees: int

    def arrays(self):
        d = self.nodes.sort_values(["tree", "node"])
        width = int(d.groupby("tree")["node"].max().max()) + 1
        shape = (self.trees, width)
        feat = np.full(shape, -1, dtype=np.int64)
        thr = np.zeros(shape)
        left = np.zeros(shape, dtype=np.int64)
        right = np.zeros(shape, dtype=np.int64)
        size = np.zeros(shape)
        depth = np.zeros(shape)
        t, k = d["tree"].to_numpy(), d["node"].to_numpy()
        feat[t, k] = d["feature"].to_numpy()
        thr[t, k] = d["threshold"].to_numpy()
        left[t, k] = d["left"].to_numpy()
        right[t, k] = d["right"].to_numpy()
        size[t, k] = d["size"].to_numpy()
        depth[t, k] = d["depth"].to_numpy()
        return feat, thr, left, right, size, depth


def draw(*parts: str | Column) -> Column:
    """A number in [0, 1) that the text of ``parts`` decides: 52 bits of its md5."""
    digits = F.substring(F.md5(key_text(*parts)), 1, 13)
    return F.conv(digits, 16, 10).cast("bigint").cast("double") / F.lit(float(1 << 52))


def node_splits(rows: DataFrame, width: int, depth: int, max_depth: int, seed: int) -> DataFrame:
    """(tree, node, feature, threshold, left, right, size, depth) of the nodes that ``rows``
    (tree, node, x) have reached; a leaf has feature -1.

    A node of several rows splits at a feature drawn among those that vary in
    it, at a point drawn between that feature's least and greatest value
    there; both sides get a row.
    """
    x = [F.col("x")[k] for k in range(width)]
    spread = rows.groupBy("tree", "node").agg(
        F.count(F.lit(1)).alias("size"),
        *[F.min(c).alias(f"lo{k}") for k, c in enumerate(x)],
        *[F.max(c).alias(f"hi{k}") for k, c in enumerate(x)],
    )
    varying = F.filter(
        F.array(*[F.when(F.col(f"hi{k}") > F.col(f"lo{k}"), F.lit(k)) for k in range(width)]), lambda k: k.isNotNull()
    )
    lo, hi = (F.array(*[F.col(f"{end}{k}") for k in range(width)]) for end in ("lo", "hi"))
    node = [F.lit(str(seed)), F.col("tree").cast("string"), F.col("node").cast("string")]
    chosen = spread.select("tree", "node", "size", varying.alias("varying"), lo.alias("lo"), hi.alias("hi")).withColumn(
        "feature",
        F.when(
            (F.size("varying") > 0) & F.lit(depth < max_depth),
            F.get("varying", F.floor(draw(*node, F.lit("feature")) * F.size("varying")).cast("int")),
        ),
    )
    low, high = F.get("lo", F.col("feature")), F.get("hi", F.col("feature"))
    point = low + draw(*node, F.lit("point")) * (high - low)
    inner = F.col("feature").isNotNull()

    def child(k: int) -> Column:
        return F.when(inner, 2 * F.col("node") + F.lit(k)).otherwise(-1).cast("int")

    return chosen.select(
        "tree",
        "node",
        F.coalesce("feature", F.lit(-1)).cast("int").alias("feature"),
        F.when(inner, F.when(point > low, F.least(point, high)).otherwise(high)).otherwise(F.lit(0.0)).alias("threshold"),
        child(1).alias("left"),
        child(2).alias("right"),
        F.col("size").cast("long").alias("size"),
        F.lit(depth).cast("int").alias("depth"),
    )


def grow_trees(samples: DataFrame, width: int, psi: int, seed: int) -> DataFrame:
    """The node table of the trees over ``samples`` (tree, x): level by level,
    one aggregation per level, all trees at once.  Nodes are numbered as in a
    heap (children of k: 2k + 1 and 2k + 2)."""
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    rows, levels = samples.withColumn("node", F.lit(0)), None
    for depth in range(max_depth + 1):
        level = stored(node_splits(rows, width, depth, max_depth, seed), "forest-level")
        levels = level if levels is None else levels.unionByName(level)
        # At most trees * psi nodes: a proven bound.
        split = F.broadcast(level.where("feature >= 0").select("tree", "node", "feature", "threshold", "left", "right"))
        side = F.when(F.get("x", F.col("feature")) < F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        rows = rows.join(split, ["tree", "node"]).select("tree", "x", side.alias("node"))
    return levels


def tree_samples(
    df: DataFrame, features: Sequence[str], key: Sequence[Column], trees: int, psi: int, seed: int, oversample: float, n: int
) -> DataFrame:
    """(tree, x): for every tree the ``psi`` pool rows of least hash."""
    cut = int(min(1.0, oversample * trees * psi / max(n, 1)) * (1 << 60))
    x = F.array(*[F.col(c).cast("double") for c in features]).alias("x")
    pool = df.select(x, surrogate_key(F.lit(f"{seed}:pool"), *key).alias("_k")).filter(F.col("_k") < F.lit(cut))
    offered = pool.select("x", "_k", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    turn = F.substring(F.md5(key_text(F.lit(f"{seed}:tree"), F.col("tree").cast("string"), F.col("_k").cast("string"))), 1, 15)
    pick = Window.partitionBy("tree").orderBy("_t", "_k")
    return offered.withColumn("_t", turn).withColumn("_rn", F.row_number().over(pick)).filter(F.col("_rn") <= psi).select("tree", "x")


def fit_isolation_forest(
    df: DataFrame,
    features: Sequence[str],
    key: Sequence[Column],
    trees: int = 100,
    psi: int = 256,
    seed: int = 42,
    oversample: float = 2.0,
    n: int | None = None,
) -> IsolationForestModel:
    """Fit on ``df`` (nulls in ``features`` must already be filled); ``n``
    is its row count when already known."""
    n = df.count() if n is None else n
    psi = int(min(psi, max(n, 1)))
    samples = stored(tree_samples(df, features, key, trees, psi, seed, oversample, n), "forest-samples")
    nodes = grow_trees(samples, len(features), psi, seed)
    # Bounded summary (<= trees * (2 psi - 1) rows) -> the model object.
    return IsolationForestModel(nodes=nodes.toPandas(), features=list(features), psi=psi, trees=trees)


def _scorer(model: IsolationForestModel, out_col: str):
    feat, thr, left, right, size, depth = model.arrays()
    length = depth + average_path_length(size)
    # A leaf leads to itself on both sides: a level is four look-ups, whatever nodes are reached.
    here, leaf = np.arange(feat.shape[1]), feat < 0
    step = np.stack([np.where(leaf, here, right), np.where(leaf, here, left)], axis=2).reshape(len(feat), -1)
    read = np.where(leaf, 0, feat)
    deepest = [int(d.max()) for d in depth]
    c_psi = float(average_path_length(np.array([model.psi]))[0]) or 1.0
    cols = model.features

    def score(batches):
        for pdf in batches:
            x = pdf[cols].to_numpy(dtype=float).ravel()
            m = len(pdf)
            total = np.zeros(m)
            first = np.arange(m) * len(cols)
            for t in range(feat.shape[0]):
                node = np.zeros(m, dtype=np.int64)
                for _ in range(deepest[t]):
                    below = x[first + read[t][node]] < thr[t][node]
                    node = step[t][2 * node + below]
                total += length[t][node]
            mean_path = total / feat.shape[0]
            yield pdf.assign(**{out_col: np.power(2.0, -mean_path / c_psi)})

    return score


def score_isolation_forest(df: DataFrame, model: IsolationForestModel, out_col: str = "score") -> DataFrame:
    """Adds the anomaly score in (0, 1); higher = more anomalous."""
    ship_package(df.sparkSession)
    schema = StructType(list(df.schema.fields) + [StructField(out_col, DoubleType(), False)])
    return df.mapInPandas(_scorer(model, out_col), schema)


def anomaly_cut(scored: DataFrame, contamination: float, score: str = "score") -> float:
    """Score above which a row is predicted anomalous: the exact
    (1 - contamination) percentile of the training scores (linear
    interpolation).  The scores are stored first because the exact
    percentile makes a few passes and scoring runs trees in Python."""
    q = percentile(stored(scored.select(score), "forest-scores"), score, 1.0 - contamination)
    return float(q) if q is not None else float("inf")


def save_forest(spark, model: IsolationForestModel, path: str) -> None:
    """Persist the forest as a Parquet table of nodes plus one metadata row."""
    path = path.rstrip("/")
    spark.createDataFrame(model.nodes, NODE_SCHEMA).write.mode("overwrite").parquet(f"{path}/nodes")
    meta = spark.createDataFrame(
        [(model.psi, model.trees, model.features)], "psi int, trees int, features array<string>"
    )
    meta.write.mode("overwrite").json(f"{path}/meta")


def load_forest(spark, path: str) -> IsolationForestModel:
    path = path.rstrip("/")
    meta = spark.read.json(f"{path}/meta").first()
    nodes = spark.read.parquet(f"{path}/nodes").toPandas()
    return IsolationForestModel(nodes=nodes, features=list(meta["features"]), psi=int(meta["psi"]), trees=int(meta["trees"]))
