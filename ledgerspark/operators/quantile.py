"""Exact percentile of a numeric column by radix selection.

Doubles are ordered like a 64-bit integer made of their bit pattern
(:func:`order_key`, built-in expressions only).  The value at a rank is
found from the top 16 bits down: one aggregation counts rows per 16-bit
digit among the rows that share the digits found so far, and the running
counts locate the rank.  Four such levels end at a single value, whatever
the distribution; a level sends the driver at most 65 536 rows (partial
aggregation; a value that fills a third of the column is one row a task).

``percentile`` interpolates linearly between the two neighbouring order
statistics, the usual default of numeric libraries.
"""

from __future__ import annotations

import math
import struct

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored

DIGIT_BITS = 16
#: Least exponent of a normal double, and the key of infinity.
LEAST_EXPONENT = -1022
INFINITY_KEY = 0x7FF << 52


def order_key(x: Column) -> Column:
    """A long that orders doubles as their values do: the bits of the absolute
    value with the sign of ``x``.  NaN comes last; null stays null."""
    a = F.abs(x)
    guess = F.floor(F.log2(a)).cast("double")
    # The logarithm may be off by a rounding at a power of two.
    power = F.pow(F.lit(2.0), guess)
    exponent = F.when(power > a, guess - 1).when(power * 2 <= a, guess + 1).otherwise(guess)
    mantissa = (a / F.pow(F.lit(2.0), exponent) - 1) * F.lit(float(1 << 52))
    normal = (exponent.cast("long") - F.lit(LEAST_EXPONENT - 1)) * F.lit(1 << 52) + mantissa.cast("long")
    tiny = (a * F.lit(2.0**1000) * F.lit(2.0**74)).cast("long")
    bits = (
        F.when(F.isnan(x), F.lit(INFINITY_KEY + 1))
        .when(a == F.lit(math.inf), F.lit(INFINITY_KEY))
        .when(a < F.lit(2.0**LEAST_EXPONENT), tiny)
        .otherwise(normal)
    )
    return F.when(~F.isnan(x) & (x < 0), -bits).otherwise(bits)


def key_value(key: int) -> float:
    """The double that has ``key`` as its order key."""
    return math.copysign(struct.unpack("<d", struct.pack("<q", abs(key)))[0], key)


def _locate(counts: list[tuple], rank: int) -> tuple[int, int]:
    """(key, rank within key) for the 0-based ``rank`` over sorted counts."""
    seen = 0
    for key, n in counts:
        if rank < seen + n:
            return key, rank - seen
        seen += n
    raise ValueError("rank beyond the number of rows")


def order_statistics(df: DataFrame, col: str, ranks: list[int]) -> list[float]:
    """Values at the 0-based ``ranks`` of the non-null values of ``col``; ranks
    that share their upper digits share the passes, which read the stored keys."""
    keys = stored(df.select(order_key(F.col(col).cast("double")).alias("_k")), "order-keys").filter(F.col("_k").isNotNull())
    found: dict[int, int] = {}

    def descend(frame: DataFrame, wanted: dict[int, int], shift: int) -> None:
        digits = F.shiftright("_k", shift)
        rows = frame.groupBy(digits.alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()
        counts = sorted((r.d, r.n) for r in rows)
        located = {rank: _locate(counts, rest) for rank, rest in wanted.items()}
        if shift == 0:
            found.update({rank: key for rank, (key, _) in located.items()})
            return
        for key in sorted({key for key, _ in located.values()}):
            inside = {rank: rest for rank, (k, rest) in located.items() if k == key}
            descend(frame.filter(digits == F.lit(key)), inside, shift - DIGIT_BITS)

    descend(keys, {r: r for r in ranks}, 64 - DIGIT_BITS)
    return [key_value(found[r]) for r in ranks]


def percentile(df: DataFrame, col: str, q: float) -> float | None:
    """Exact q-quantile (0 <= q <= 1) of ``col`` with linear interpolation
    between order statistics; None for an empty column."""
    n = df.agg(F.count(F.col(col)).alias("n")).first().n
    if not n:
        return None
    pos = (n - 1) * q
    k = int(math.floor(pos))
    frac = pos - k
    if frac == 0 or k + 1 >= n:
        return order_statistics(df, col, [k])[0]
    lower, upper = order_statistics(df, col, [k, k + 1])
    # The same interpolation arithmetic as numpy's default method.
    if frac >= 0.5:
        return upper - (upper - lower) * (1 - frac)
    return lower + (upper - lower) * frac
