"""Column expressions shared by the operators.

All of these are built-in Catalyst expressions (no Python UDFs), so they
stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def account_type(name: str | Column, merchant_prefix: str = "M") -> Column:
    """MERCHANT when the account id starts with the merchant prefix, else CUSTOMER.

    A null id falls to CUSTOMER (the reference behaviour); the null gate
    is what rejects such rows.
    """
    return F.when(_c(name).startswith(merchant_prefix), F.lit("MERCHANT")).otherwise(F.lit("CUSTOMER"))


def known_amount(amount: str | Column) -> Column:
    """The amount, 0.0 where it is null or not a number."""
    return F.coalesce(F.nanvl(_c(amount), F.lit(None).cast("double")), F.lit(0.0))


def balance_residual(before: str | Column, flow: str | Column, after: str | Column) -> Column:
    """What a balance lacks after ``flow`` (money in is positive): before + flow - after; null if any is null."""
    return _c(before) + _c(flow) - _c(after)


def balance_inconsistent(
    txn_type: str | Column,
    old_balance: str | Column,
    amount: str | Column,
    new_balance: str | Column,
    debit_types: Sequence[str],
    tolerance: float,
) -> Column:
    """1 when a sender-debit row's balance moved by more than ``tolerance``
    away from ``old - amount``; 0 otherwise.

    Three-valued on purpose: a debit-type row with a null balance yields
    NULL (unknown), a non-debit row yields 0.
    """
    deviation = F.abs(balance_residual(old_balance, -_c(amount), new_balance))
    return (_c(txn_type).isin(*debit_types) & (deviation > F.lit(tolerance))).cast("int")


def hour_of_day(step: str | Column, steps_per_day: int = 24) -> Column:
    return _c(step) % F.lit(steps_per_day)


def day_number(step: str | Column, steps_per_day: int = 24) -> Column:
    """1-based day of a step (step 0..23 -> day 1, 24 -> day 2)."""
    return (F.floor(_c(step) / F.lit(steps_per_day)) + F.lit(1)).cast("int")


def band(value: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the left-closed / right-open range holding ``value``.

    ``labels`` has one more entry than ``edges``.  A null value gets a
    null band instead of silently landing in the last one.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("band needs len(labels) == len(edges) + 1")
    v = _c(value)
    expr = F.when(v < F.lit(edges[0]), F.lit(labels[0]))
    for lo, hi, label in zip(edges, list(edges[1:]) + [None], labels[1:]):
        cond = v >= F.lit(lo) if hi is None else v < F.lit(hi)
        expr = expr.when(cond, F.lit(label))
    return expr


def ordinal(value: str | Column, order: Sequence[str]) -> Column:
    """1-based position of ``value`` in ``order``; unknown values get null
    (callers sort with ``asc_nulls_last`` so they go last)."""
    pos = F.array_position(F.array(*[F.lit(x) for x in order]), _c(value))
    return F.when(pos > 0, pos.cast("int"))


def key_text(*parts: str | Column) -> Column:
    """Canonical text of a composite natural key.

    Doubles are rendered as fixed-point decimals so that the text (and any
    hash of it) is the same in every SQL engine; nulls become an explicit
    marker instead of disappearing from the concatenation.
    """
    return F.concat_ws("|", *[F.coalesce(_c(p), F.lit("<null>")) for p in parts])


def surrogate_key(*parts: str | Column) -> Column:
    """Reproducible 60-bit surrogate key: first 15 hex digits of md5(key)."""
    digest = F.md5(key_text(*parts))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def wide_key(*parts: str | Column) -> Column:
    """Reproducible 128-bit surrogate key: md5 of the natural key, as 32 hex digits."""
    return F.md5(key_text(*parts))


def exact_text(amount: str | Column) -> Column:
    """A text that tells any two doubles of 1/64 or more apart: six decimals,
    and what they leave over in units of 1e-18 (the same in every SQL engine)."""
    rounded = _c(amount).cast("decimal(38,6)")
    rest = F.floor((_c(amount) - rounded.cast("double")) * F.lit(1e18))
    return F.concat(rounded.cast("string"), F.lit(":"), rest.cast("string"))


def money_text(amount: str | Column) -> Column:
    return _c(amount).cast("decimal(38,6)").cast("string")


def exact_sum(amount: str | Column, scale: int = 2) -> Column:
    """Sum of a money column in fixed-point, returned as double.

    Summing doubles depends on the order of additions; a sum of decimals
    does not, so every run (and every engine) agrees.  Amounts enter with
    six decimals and only the total is rounded.
    """
    return F.round(F.sum(_c(amount).cast("decimal(28,6)")), scale).cast("double")


def half_up_ratio(num: str | Column, den: str | Column, dp: int, scale: int = 1) -> Column:
    """round(scale * num / den, dp), half-up, computed in exact integers.

    ``num`` and ``den`` are non-negative integer columns.  With
    ``a = 2*scale*10^dp*num + den`` and ``b = 2*den`` the rounded value is
    ``floor(a / b) / 10^dp``; ``a - pmod(a, b)`` is an exact multiple of
    ``b`` so the double division is exact.  A zero denominator gives null.
    """
    n = _c(num).cast("long")
    d = _c(den).cast("long")
    a = n * F.lit(2 * scale * 10**dp) + d
    b = F.when(d > 0, d * F.lit(2))
    return ((a - F.pmod(a, b)) / b) / F.lit(float(10**dp))


def safe_div(num: str | Column, den: str | Column) -> Column:
    """num / den as double, 0.0 when the denominator is 0 (report convention)."""
    return F.when(_c(den) == 0, F.lit(0.0)).otherwise(_c(num).cast("double") / _c(den).cast("double"))
