"""Phrase collocation mining by Rabin-Karp fingerprints.

Prefix polynomials give every n-gram of a batch of texts its fingerprint by
two lookups and a product.  Counts per fingerprint go through one shuffle for
each phrase length; a longer phrase is only fingerprinted where both phrases
one word shorter may be frequent.  An occurrence pointer (place in the batch)
stays with each fingerprint: where the fingerprint is frequent, the pointer
names the phrase, all its occurrences in the batch are compared with it word
for word, and the phrase's text is written out, so that the counts that
decide are counts of texts, whatever fingerprints collide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import python_ready, stored
from .grams import Fingerprints, U, WordIds, hash_filter, mix, passes, words_of

MAX_WORDS = 3
MIN_COUNT = 10
COVERED_PERCENT = 50
TOP = 2000
#: Bytes of a chunk: bounds a worker's memory; a longer text is one chunk.
CHUNK_BYTES = 6 << 20
#: Partitions of a language's candidates that are ranked first.
RANK_PARTS = 64

_BREAK = b"\xff"  # in no UTF-8 text
#: Lower case for A-Z, a break for piece separators, a space for the tab.
_TABLE = bytearray(range(256))
for _c in range(65, 91):
    _TABLE[_c] = _c + 32
for _c in b".,;:!?\x0a\x0b\x0c\x0d":
    _TABLE[_c] = 255
_TABLE[9] = 32
_TABLE = bytes(_TABLE)


def spaced(text: bytes) -> bytes:
    """The lower-cased words of the text's pieces, each ended by a space, a break after each piece."""
    return b" ".join([*text.translate(_TABLE).replace(_BREAK, b" \xff ").split(), _BREAK, b""])


class _Chunk:
    """Texts' words with fingerprints by language."""

    def __init__(self, langs: list[str], texts: list[bytes]):
        self.data = b"".join(texts)
        hashes, begins, ends = words_of(self.data)
        self.langs = sorted(set(langs))
        number = {lang: k for k, lang in enumerate(self.langs)}
        self.word_break = np.frombuffer(self.data, np.uint8)[begins] == 255
        doc = np.searchsorted(np.cumsum([len(t) for t in texts]), begins, side="right")
        self.lang = np.array([number[x] for x in langs], np.int64)[doc]
        self.salt = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest()) for x in self.langs], np.uint64)
        self.breaks = np.concatenate([[0], np.cumsum(self.word_break)])
        self.prints = Fingerprints(hashes)

    def starts(self, n: int) -> np.ndarray:
        """Where n words lie in one piece."""
        if len(self.word_break) < n:
            return np.empty(0, np.int64)
        return np.flatnonzero(self.breaks[n:] == self.breaks[: len(self.breaks) - n])

    def of(self, at: np.ndarray, n: int) -> np.ndarray:
        return mix(self.prints.of(at, at + n) + self.salt[self.lang[at]] + U(n))

    def likely(self, n: int, table: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """(starts, fingerprints) of the n-grams both of whose parts of n-1 words pass the filter."""
        at = self.starts(n)
        if n > 1 and table is not None:
            at = at[passes(table, self.of(at, n - 1))]
            at = at[passes(table, self.of(at + 1, n - 1))]
        return at, self.of(at, n)


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[_Chunk]:
    langs, texts, size = [], [], 0
    for batch in batches:
        for lang, data in zip(batch["lang"], batch["data"], strict=True):
            langs.append(lang)
            texts.append(spaced(data))
            size += len(texts[-1])
            if size >= CHUNK_BYTES:
                yield _Chunk(langs, texts)
                langs, texts, size = [], [], 0
    if texts:
        yield _Chunk(langs, texts)


def _count(sizes: tuple[int, ...], table: Broadcast | None):
    """(fp, f): how often each fingerprint of phrases of these sizes occurs in a chunk."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in _chunks(batches):
            for n in sizes:
                _, prints = chunk.likely(n, table.value if table else None)
                found, f = np.unique(prints, return_counts=True)
                yield pd.DataFrame({"fp": found.view(np.int64), "f": f})

    return count


def same_phrases(words: np.ndarray, at: np.ndarray, prints: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(pointer, count) of the distinct phrases at ``at``: of those with one fingerprint, those equal to the first.

    What differs from the first of its fingerprint (a collision) is taken up again among its like.
    """
    while len(at):
        _, first, own, f = np.unique(prints, return_index=True, return_inverse=True, return_counts=True)
        pointer = at[first]
        same = np.ones(len(at), bool)
        for k in range(n):
            same &= words[at + k] == words[pointer[own] + k]
        yield pointer, f if same.all() else np.bincount(own[same], minlength=len(first))
        at, prints = at[~same], prints[~same]


def _materialise(max_words: int, table: Broadcast):
    """(lang, n, phrase, f) of the phrases whose fingerprint may be frequent; n = 0: all words of the language."""

    def phrases(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in _chunks(batches):
            ids = WordIds()
            word = ids.of(chunk.data.split())
            words = list(ids)
            totals = np.bincount(chunk.lang[~chunk.word_break], minlength=len(chunk.langs))
            yield pd.DataFrame({"lang": chunk.langs, "n": 0, "phrase": b"", "f": totals})
            for n in range(1, max_words + 1):
                at, prints = chunk.likely(n, table.value)
                on = passes(table.value, prints)
                for pointer, f in same_phrases(word, at[on], prints[on], n):
                    columns = [word[pointer + k].tolist() for k in range(n)]
                    texts = [b" ".join([words[i] for i in ids]) for ids in zip(*columns, strict=True)]
                    langs = np.array(chunk.langs, object)[chunk.lang[pointer]]
                    yield pd.DataFrame({"lang": langs, "n": n, "phrase": pd.Series(texts, dtype=object), "f": f})

    return phrases


def frequent_phrases(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, n, phrase, f): phrases of up to ``max_words`` words found ``min_count`` times; n = 0: the language's words."""
    python_ready(docs)
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("data"))
    frequent, table = None, None
    for sizes in [(1, 2), *((n,) for n in range(3, max_words + 1))] if max_words > 1 else [(1,)]:
        counts = texts.mapInPandas(_count(sizes, table), "fp long, f long").groupBy("fp").agg(F.sum("f").alias("f"))
        found = stored(counts.where(F.col("f") >= min_count).select("fp"), "phrase-prints")
        frequent = found if frequent is None else frequent.unionByName(found)
        table = hash_filter(frequent)
    named = texts.mapInPandas(_materialise(max_words, table), "lang string, n int, phrase binary, f long")
    counts = named.groupBy("lang", "n", F.col("phrase").cast("string").alias("phrase")).agg(F.sum("f").alias("f"))
    return stored(counts.where((F.col("n") == 0) | (F.col("f") >= min_count)), "phrases")


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT,
                 covered_percent: int = COVERED_PERCENT, top: int = TOP) -> DataFrame:
    """The ``top`` collocations of each language: lang, rank, phrase, a, l, r, n, score.

    Texts (null: empty) are lower-cased in A-Z and split at ``.,;:!?``, line
    feeds and the like into pieces; words are divided by spaces and tabs.  A
    candidate has 2 to ``max_words`` words and a >= ``min_count`` occurrences,
    overlapping ones included; a cut after its first k words has the parts'
    counts l and r and the score floor(10^6 a^2 / (l r)); the lowest cut counts
    (ties: least k).  A candidate inside a longer one with at least
    ``covered_percent`` of its occurrences goes.  A null lang is ``und``;
    repeated rows count as often as they occur; equal scores rank by a, then
    by the phrase's bytes; texts of any length are read whole, in one chunk;
    other columns are ignored; an empty table gives an empty result.
    """
    phrases = frequent_phrases(docs, max_words, min_count)
    parts = phrases.where("n > 0").select("lang", "phrase", "f")
    candidates = phrases.where("n > 1").withColumnRenamed("f", "a").withColumn("words", F.split("phrase", " "))

    def piece(start, length):
        return F.array_join(F.slice("words", start, length), " ")

    cuts = candidates.select("lang", "phrase", "n", "a", "words", F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", piece(F.lit(1), F.col("k")).alias("left"),
                       piece(F.col("k") + 1, F.col("n") - F.col("k")).alias("right"))
    l_of = parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    r_of = parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    cuts = cuts.join(l_of, ["lang", "left"]).join(r_of, ["lang", "right"])
    # Counts of up to 15 digits: the products fit 38.
    a, left, right = (F.col(c).cast("decimal(15,0)") for c in "alr")
    cuts = cuts.withColumn("num", a * a * F.lit(1000000).cast("decimal(7,0)")).withColumn("den", left * right)
    scored = cuts.withColumn("score", F.expr("num div den")).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inner = candidates.where("n > 2").select("lang", "a", "words", F.explode(F.sequence(F.lit(2), F.col("n") - 1)).alias("m"), "n")
    inner = inner.select("lang", "a", "words", "m", F.explode(F.sequence(F.lit(1), F.col("n") - F.col("m") + 1)).alias("at"))
    inner = inner.select("lang", "a", piece(F.col("at"), F.col("m")).alias("phrase"))
    covers = inner.groupBy("lang", "phrase").agg(F.max("a").alias("cover"))
    open_ = scored.join(covers, ["lang", "phrase"], "left").where(
        F.col("cover").isNull() | (F.col("cover") * 100 < F.col("a") * covered_percent))

    rows = open_.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # The best of each part of a language first: no task ranks a whole language.
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))).orderBy(*order)
    best = rows.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    totals = phrases.where("n = 0").select("lang", F.col("f").alias("n"))
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
