"""Word n-grams in numpy, and a filter of fixed size that spares shuffles."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit integers."""
    x = (x ^ x >> U(30)) * U(0xBF58476D1CE4E5B9)
    x = (x ^ x >> U(27)) * U(0x94D049BB133111EB)
    return x ^ x >> U(31)


class WordIds(dict):
    """Numbers for words in the order of their first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def _powers(n: int) -> list[np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2^64; remembered."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(n, 4096).bit_length()
        _POWERS.clear()
        for value in (_BASE, pow(_BASE, -1, 1 << 64)):
            line = np.full(size, value, np.uint64)
            line[0] = 1
            _POWERS.append(np.cumprod(line, dtype=np.uint64))
    return _POWERS


#: A random number for each byte value.
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * U(_BASE))
#: Bytes hashed at once.
BLOCK_BYTES = 1 << 20


def words_of(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, starts, ends) of the words of ``data``, which single spaces end; two spaces enclose an empty word.

    A word's hash is the polynomial of its bytes, the difference of two
    running sums, mixed: arrays over bytes are faster than a lookup per word.
    """
    letters = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(letters == 32)
    starts = np.append(0, ends + 1)[: len(ends)]
    hashes = np.empty(len(ends), np.uint64)
    done = 0
    while done < len(ends):
        at = int(starts[done])
        stop = max(int(np.searchsorted(ends, at + BLOCK_BYTES, side="right")), done + 1)
        part = letters[at : int(ends[stop - 1])]
        power, back = _powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * power[: len(part)], out=sums[1:], dtype=np.uint64)
        a, b = starts[done:stop] - at, ends[done:stop] - at
        hashes[done:stop] = (sums[b] - sums[a]) * back[a]
        done = stop
    return mix(hashes + (ends - starts).astype(np.uint64)), starts, ends


class Fingerprints:
    """Rabin-Karp fingerprints of word sequences: prefix polynomials of the words' hashes, modulo 2^64."""

    def __init__(self, hashes: np.ndarray):
        power, self.back = _powers(len(hashes) + 1)
        self.sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * power[: len(hashes)], out=self.sums[1:], dtype=np.uint64)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The fingerprint of the words start..end-1: their part of the running sum, moved to the origin."""
        return mix((self.sums[end] - self.sums[start]) * self.back[start])


#: The filter's bits: 16 MB whatever the data.
FILTER_BITS = 27
_BLOCK = 4096


def hash_filter(hashes: DataFrame, bits: int = FILTER_BITS) -> Broadcast:
    """A bit table of the 64-bit hashes in the one column of ``hashes``, for ``passes``.

    It never loses a member; the more members, the more others pass.  So it
    only spares work: whatever passes is judged exactly afterwards.  Its size
    is ``2^bits`` bits, set by the parameter alone: the bits are joined on the
    executors, and the driver receives the table, never the hashes.
    """
    spark = hashes.sparkSession
    masks = (
        hashes.select(F.shiftrightunsigned(F.col(hashes.columns[0]), 64 - bits).alias("at"))
        .selectExpr("shiftright(at, 6) AS word", "shiftleft(1L, CAST(at & 63 AS INT)) AS bit")
        .groupBy("word").agg(F.bit_or("bit").alias("mask"))
        .withColumn("block", F.floor(F.col("word") / _BLOCK).cast("int"))
    )

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        line = np.zeros(_BLOCK, np.int64)
        line[part["word"].to_numpy() % _BLOCK] = part["mask"].to_numpy()
        return pd.DataFrame({"block": part["block"].iloc[:1], "data": [zlib.compress(line.tobytes(), 1)]})

    table = np.zeros(max(1 << bits - 6, _BLOCK), np.uint64)
    for block, data in masks.groupBy("block").applyInPandas(pack, "block int, data binary").collect():
        table[block * _BLOCK : (block + 1) * _BLOCK] = np.frombuffer(zlib.decompress(data), np.uint64)
    return spark.sparkContext.broadcast(table)


def passes(table: np.ndarray, hashes: np.ndarray, bits: int = FILTER_BITS) -> np.ndarray:
    """Which of the hashes the filter lets pass: all its members, and others by chance."""
    at = hashes >> U(64 - bits)
    return (table[(at >> U(6)).astype(np.int64)] >> (at & U(63)) & U(1)).astype(bool)
