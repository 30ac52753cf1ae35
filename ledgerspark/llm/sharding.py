"""Sharding by a Feistel permutation of global row numbers.

Rows are numbered 0..n-1 in id order.  A four-round Feistel network permutes
the smallest domain 4^w >= n; a value outside 0..n-1 walks on through the
cycle until it is inside, which permutes 0..n-1 itself.  Place p goes to
shard p mod k, slot p div k: shard sizes differ by one row at most, and both
can be computed, or inverted, for any row without looking at another.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, python_ready, stored

SHARDS = 8
SEED = 20260
ROUNDS = 4
#: Fixed odd multipliers of the round function (31-bit arithmetic).
MIX_A, MIX_B = 1103515245, 747796405


def _round(right: np.ndarray, key: int, half_bits: int) -> np.ndarray:
    low31 = (1 << 31) - 1
    t = (right * MIX_A + key) & low31
    t ^= t >> 15
    t = (t * MIX_B) & low31
    t ^= t >> 13
    return (t >> 3 ^ t) & ((1 << half_bits) - 1)


def _keys(seed: int) -> list[int]:
    return [(seed * 2654435761 + 40503 * (r + 1) * (r + 7)) % (1 << 31) for r in range(ROUNDS)]


def _half_bits(n: int) -> int:
    bits = 1
    while 4**bits < n:
        bits += 1
    if bits > 31:
        raise ValueError("at most 2^62 rows")
    return bits


def _network(x: np.ndarray, half_bits: int, keys: list[int]) -> np.ndarray:
    left, right = x >> half_bits, x & ((1 << half_bits) - 1)
    for key in keys:
        left, right = right, left ^ _round(right, key, half_bits)
    return left << half_bits | right


def permute(rows, n: int, seed: int = SEED) -> np.ndarray:
    """The shuffled place of each row number in 0..n-1."""
    half, keys = _half_bits(n), _keys(seed)
    place = _network(np.asarray(rows, dtype=np.int64), half, keys)
    while (out := place >= n).any():
        place[out] = _network(place[out], half, keys)
    return place


def unpermute(places, n: int, seed: int = SEED) -> np.ndarray:
    """The row number at each shuffled place: the inverse of ``permute``."""
    half, keys = _half_bits(n), _keys(seed)[::-1]
    mask = (1 << half) - 1
    flip = lambda v: v >> half | (v & mask) << half  # noqa: E731  the network run backwards
    rows = flip(_network(flip(np.asarray(places, dtype=np.int64)), half, keys))
    while (out := rows >= n).any():
        rows[out] = flip(_network(flip(rows[out]), half, keys))
    return rows


def shard_rows(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, size, text_crc32, law, shard, slot, grown_shard, row_no, place.

    Law ``rows``: shard sizes differ by one row at most; slots run from 0
    without gaps; ``grown_shard`` is null.  Rows are numbered by doc_id, ties
    by checksum and size, null ids first; rows alike in all three are
    interchangeable.  A null text has size 1 and checksum 0.  Other columns
    are ignored; an empty table gives an empty result.
    """
    python_ready(docs)
    sized = stored(
        docs.select(
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        ),
        "shard-sizes",
    )
    rows = numbered(sized, ["doc_id", "text_crc32", "size"], "shard-rows", "row_no")
    n = sized.count()

    @F.pandas_udf("long")
    def place(row_no: pd.Series) -> pd.Series:
        return pd.Series(permute(row_no.to_numpy(), n, seed))

    return rows.withColumn("place", place("row_no")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        (F.col("place") % shards).cast("int").alias("shard"),
        F.floor(F.col("place") / shards).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "row_no",
        "place",
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED, rows_per_file: int = 1_000_000) -> None:
    """Write ``docs`` (unique, non-null doc_id) as Parquet folders ``shard=N``, in slot order within each file."""
    placed = shard_rows(docs, shards, seed).select("doc_id", "shard", "slot")
    whole = docs.join(placed, "doc_id")
    piece = F.floor(F.col("slot") / rows_per_file)
    whole.repartition("shard", piece).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
