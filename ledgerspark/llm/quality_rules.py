"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger stores the bits of the
failed rules with the measurements behind them.  A policy is a version and a
mask, so applying another version, or asking what each rule costs, reads the
ledger and never the text again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import python_ready

SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper"]


def _c(name: str) -> Column:
    return F.col(name)



def rules() -> list[tuple[str, Column]]:
    """The rules in bit order: (name, condition under which it fails)."""
    return [
        ("few_words", _c("n_words") < 50),
        ("repeated_words", 100 * _c("n_repeat_words") > 50 * _c("n_words")),
        ("symbols", 10 * _c("n_symbols") > _c("n_words")),
        ("duplicate_lines", 10 * _c("n_dup_lines") > 3 * _c("n_lines")),
        ("short_mean_word", _c("word_chars") < 2 * _c("n_words")),
        ("long_mean_word", _c("word_chars") > 15 * _c("n_words")),
        ("shouting", 2 * _c("n_upper") > _c("word_chars")),
    ]


BASE_MASK = 0b0000011
#: Version -> mask of the rules that reject.
POLICIES = {1: BASE_MASK, 2: 0b1111111}
POLICY = 2


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    base = len(ids)
    if base**3 < 2**62:
        window = (code[:-2] * base + code[1:-1]) * base + code[2:]
    else:
        _, pair = np.unique(code[:-2] * base + code[1:-1], return_inverse=True)
        window = pair * base + code[2:]
    _, inverse, counts = np.unique(window, return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= again
    return int(covered.sum())


def measure(text: bytes) -> tuple[int, ...]:
    """The measurements of one UTF-8 text, in the order of MEASURES."""
    words = text.split()  # bytes split at exactly space and \t \n \v \f \r
    joined = b"".join(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (
        len(words),
        len(joined.decode("utf-8", "replace")),
        len(joined) - len(joined.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(words),
        len(lines),
        len(joined) - len(joined.translate(None, UPPER)),
    )


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [measure(x.as_py() or b"") for x in batch.column(1)]
        table = np.array(found, dtype=np.int64).reshape(-1, len(MEASURES))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(table[:, k]) for k in range(len(MEASURES)))], ["doc_id", *MEASURES]
        )


def rule_ledger(docs: DataFrame) -> DataFrame:
    """(doc_id, measurements, fail_bits) per row of ``docs`` (doc_id, text).

    Null and empty texts measure zero everywhere (and fail few_words).
    Repeated rows are judged each for itself; other columns are ignored.
    """
    python_ready(docs)
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, " + ", ".join(f"{m} long" for m in MEASURES)
    measured = docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(_measured, schema)
    bits = F.lit(0).cast("long")
    for k, (_, fails) in enumerate(rules()):
        bits = bits + F.when(fails, F.lit(1 << k)).otherwise(F.lit(0))
    return measured.withColumn("fail_bits", bits)


def apply_policy(ledger: DataFrame, version: int = POLICY) -> DataFrame:
    """The ledger with base_failed, kept and policy; keeps every row."""
    mask = POLICIES[version]
    return (
        ledger.withColumn("base_failed", F.col("fail_bits").bitwiseAND(F.lit(BASE_MASK)) != 0)
        .withColumn("kept", F.col("fail_bits").bitwiseAND(F.lit(mask | BASE_MASK)) == 0)
        .withColumn("policy", F.lit(version))
    )


def ablation(ledger: DataFrame, version: int = POLICY) -> DataFrame:
    """Per rule of a policy: rows that fail it, rows it alone rejects, rows kept without it."""
    mask = POLICIES[version]
    counts = ledger.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))  # at most 2^rules rows
    row = []
    for k, (name, _) in enumerate(rules()):
        if mask >> k & 1:
            bit, rest = 1 << k, mask & ~(1 << k)
            row.append(
                F.struct(
                    F.lit(name).alias("rule"),
                    F.sum(F.when(F.col("fail_bits").bitwiseAND(F.lit(bit)) != 0, F.col("n")).otherwise(0)).alias("failed"),
                    F.sum(
                        F.when(F.col("fail_bits").bitwiseAND(F.lit(mask)) == bit, F.col("n")).otherwise(0)
                    ).alias("only_this"),
                    F.sum(
                        F.when(F.col("fail_bits").bitwiseAND(F.lit(rest)) == 0, F.col("n")).otherwise(0)
                    ).alias("kept_without"),
                )
            )
    return counts.agg(F.array(*row).alias("r")).select(F.inline("r"))
