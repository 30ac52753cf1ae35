"""Deterministic stratified train/test split.

Every row gets a 60-bit hash of (seed, row key).  Within each class the
``round(fraction * n_class)`` rows with the smallest hashes form the test
set -- an exact per-class share that depends only on the data and the
seed, never on partitioning or row order.

Finding the per-class cut without a global sort (two histogram levels):

1. histogram of the hash's top 16 bits per class (<= classes x 65 536
   rows, partial-aggregated); running counts over that small table locate
   the bucket holding each class's cut and how many of its rows are still
   needed;
2. the same on the next 16 bits, over the rows of that boundary bucket
   only;
3. only rows inside the level-2 boundary bucket (about n / 2^32 per class)
   are ranked, by a window partitioned by class.

Rows hashed below the cut are test, rows above are train.  The cuts hold
one entry per class, a proven bound, so they travel as literal maps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import surrogate_key
from ..session import stored

HASH_BITS = 60
LEVEL_BITS = 16
MASK = (1 << LEVEL_BITS) - 1


def row_hash(seed: int, parts: Sequence[Column]) -> Column:
    return surrogate_key(F.lit(str(seed)), *parts)


def _cuts(hist: DataFrame, label: str, bucket: str, target: str) -> dict:
    """Per class: (bucket where the running count reaches ``target``, rows of
    that bucket still needed).  ``hist`` holds (label, bucket, target, _n),
    a small table; the result has one entry per class."""
    running = Window.partitionBy(label).orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
    rows = (
        hist.withColumn("_upto", F.sum("_n").over(running))
        .withColumn("_before", F.col("_upto") - F.col("_n"))
        .filter((F.col("_before") < F.col(target)) & (F.col("_upto") >= F.col(target)))
        .select(label, F.col(bucket).alias("cut"), (F.col(target) - F.col("_before")).alias("need"))
        .collect()
    )
    return {r[label]: (int(r["cut"]), int(r["need"])) for r in rows}


def _lookup(mapping: dict, key: Column, pos: int) -> Column:
    """``mapping[key][pos]`` as a literal-map expression (null when absent)."""
    if not mapping:
        return F.lit(None).cast("long")
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v[pos]))])
    return F.try_element_at(m, key)


def stratified_split(
    df: DataFrame,
    key: Sequence[Column],
    label: str = "label",
    test_fraction: float = 0.25,
    seed: int = 42,
    out_col: str = "is_test",
    materialize: bool = False,
) -> DataFrame:
    """``df`` plus a boolean ``out_col`` marking the test rows.

    ``key`` must identify a row (e.g. the business key); ties of the
    60-bit hash are broken by the key, so the result is exact.  Passes over
    ``df``: level-1 histogram, level-2 histogram (boundary bucket only),
    assignment.  The cuts (one per class) reach the driver and come back as
    literal maps, so the assignment is a projection -- no join -- plus a
    window over the ~n / 2^32 boundary rows.  When ``df`` is not a stored
    table (its lineage has shuffles), ``materialize`` stores the hashed
    rows once so the passes do not each replay that lineage.
    """
    h = df.withColumn("_h", row_hash(seed, key))
    h = h.withColumn("_b1", F.shiftright("_h", HASH_BITS - LEVEL_BITS)).withColumn(
        "_b2", F.shiftright("_h", HASH_BITS - 2 * LEVEL_BITS).bitwiseAND(F.lit(MASK))
    )
    if materialize:
        h = stored(h, "split-rows")
    y = F.col(label)

    hist1 = h.groupBy(label, "_b1").agg(F.count(F.lit(1)).alias("_n"))
    # Class sizes are sums over the small level-1 histogram: no extra pass.
    class_n = F.sum("_n").over(Window.partitionBy(label))
    hist1 = hist1.withColumn("_target", F.floor(class_n * F.lit(test_fraction) + F.lit(0.5)).cast("long"))
    cut1 = _cuts(hist1, label, "_b1", "_target")

    b1_cut = _lookup(cut1, y, 0)
    need1 = _lookup(cut1, y, 1)
    hist2 = (
        h.filter(F.col("_b1") == b1_cut)
        .groupBy(label, "_b2")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_need1", need1)
    )
    cut2 = _cuts(hist2, label, "_b2", "_need1")
    b2_cut = _lookup(cut2, y, 0)
    need2 = _lookup(cut2, y, 1)

    at_cut = (F.col("_b1") == b1_cut) & (F.col("_b2") == b2_cut)
    below = (F.col("_b1") < b1_cut) | ((F.col("_b1") == b1_cut) & (F.col("_b2") < b2_cut))
    decided = h.filter(~F.coalesce(at_cut, F.lit(False))).withColumn(out_col, F.coalesce(below, F.lit(False)))
    rank = F.row_number().over(Window.partitionBy(label).orderBy("_h", *key))
    ranked = h.filter(F.coalesce(at_cut, F.lit(False))).withColumn(out_col, rank <= need2)
    cols = df.columns + [out_col]
    return decided.select(*cols).unionByName(ranked.select(*cols))
