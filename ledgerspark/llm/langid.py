"""Language ID by error-correcting output codes.

Each language has a codeword of bits; for each bit one linear classifier over
hashed byte n-grams predicts the bit.  Decoding sums, for every codeword, the
classifiers' weighted losses on its bits, and takes the codeword of least
loss; a second codeword close behind marks the document as ambiguous.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, held_out, python_ready

UNKNOWN = "und"
#: Hash buckets of bigrams and of trigrams.
BUCKETS = 4096
#: Labelled rows aimed at per language, and the longest text (bytes) taken as training row.
TRAIN_ROWS = 400
#: Most labelled rows over all languages: bounds what the driver holds, whatever the number of languages.
TRAIN_TOTAL = 8000
TRAIN_BYTES = 1 << 18
#: A document is ambiguous if the best language's probability is below this.
CLEAR = 0.6
CHUNK = 1 << 20
_LETTER = re.compile(r"[^\W\d_]")
#: ASCII bytes other than letters count as one separator.
_BLANK = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def has_letter(text: str) -> bool:
    """True if some character is a letter (Unicode category L*)."""
    return any(m.group().isalpha() for m in _LETTER.finditer(text))


def ngram_counts(text: str, buckets: int = BUCKETS) -> np.ndarray:
    """Hashed counts of the lower-case text's byte bigrams and trigrams; long texts in chunks."""
    counts = np.zeros(2 * buckets, dtype=np.float64)
    for at in range(0, len(text), CHUNK):
        # Two characters of the last chunk lead in, so that no n-gram is lost.
        data = (" " if at == 0 else "") + text[max(0, at - 2) : at + CHUNK].lower() + " "
        b = np.frombuffer(data.encode("utf-8", "replace").translate(_BLANK), np.uint8).astype(np.uint32)
        word = (b[1:] != 32) | (b[:-1] != 32)
        two = (b[:-1] << np.uint32(8) | b[1:])[word]
        counts[:buckets] += np.bincount((two * np.uint32(2654435761)) >> np.uint32(20), minlength=buckets)[:buckets]
        three = (b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:])[word[1:] & word[:-1]]
        counts[buckets:] += np.bincount((three * np.uint32(2246822519)) >> np.uint32(20), minlength=buckets)[:buckets]
    return counts


def features(text: str, buckets: int = BUCKETS) -> np.ndarray:
    """Square roots of the n-grams' shares: a vector of length 1 for each half."""
    counts = ngram_counts(text, buckets)
    for half in (counts[:buckets], counts[buckets:]):
        half /= max(half.sum(), 1.0)
    return np.sqrt(counts).astype(np.float32)


def _sparse(x: np.ndarray) -> tuple[bytes, bytes]:
    """Places and values of the numbers other than 0."""
    at = np.flatnonzero(x)
    return at.astype("<u2").tobytes(), x[at].astype("<f4").tobytes()


def _dense(at: bytes, value: bytes, buckets: int = BUCKETS) -> np.ndarray:
    x = np.zeros(2 * buckets, np.float32)
    x[np.frombuffer(at, "<u2")] = np.frombuffer(value, "<f4")
    return x


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """n codewords of +-1 bits: all useful bits for few languages, else the best of some random codes."""
    if n <= 1:
        return np.ones((n, 1), dtype=np.int8)
    if n <= 6:
        columns = [c for c in itertools.product((1, -1), repeat=n) if c[0] == 1 and -1 in c]
        return np.array(columns, dtype=np.int8).T
    rng, length, best, most = np.random.default_rng(seed), int(np.ceil(12 * np.log2(n))), None, -1
    for _ in range(50):
        code = rng.choice(np.array([1, -1], dtype=np.int8), size=(n, length))
        apart = (length - code.astype(int) @ code.T.astype(int)) // 2
        least = int((apart + length * np.eye(n, dtype=int)).min())
        if least > most and (abs(code.astype(int).sum(axis=0)) < n).all():
            best, most = code, least
    return best if best is not None else code


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # features x bits
    bias: np.ndarray
    bit_weight: np.ndarray  # how far each bit's classifier is to be trusted

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(best language's index, its probability, ambiguous) per feature row."""
        margins = x @ self.weights + self.bias
        loss = np.logaddexp(0.0, -margins[:, None, :] * self.code[None]) @ self.bit_weight
        near = np.exp(loss.min(axis=1, keepdims=True) - loss)
        score = near.max(axis=1) / near.sum(axis=1)
        return loss.argmin(axis=1), score, score < CLEAR


def fit(x: np.ndarray, languages: list[str], steps: int = 150, decay: float = 1e-4) -> LanguageModel:
    """Fit the bit classifiers by logistic regression (full-batch Adam)."""
    names = sorted(set(languages))
    code = codewords(len(names))
    index = {name: k for k, name in enumerate(names)}
    row = np.array([index[v] for v in languages])
    target = code[row].astype(np.float32)
    # Languages weigh alike, however many rows each has.
    share = (1.0 / np.bincount(row, minlength=len(names)))[row].astype(np.float32)
    share /= share.sum()
    w, b = np.zeros((x.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    m, v, mb, vb = (np.zeros_like(a) for a in (w, w, b, b))
    for t in range(1, steps + 1):
        pull = -target * share[:, None] / (1 + np.exp(np.clip(target * (x @ w + b), -30, 30)))
        for value, grad, first, second in ((w, x.T @ pull + decay * w, m, v), (b, pull.sum(axis=0), mb, vb)):
            first += 0.1 * (grad - first)
            second += 0.01 * (grad**2 - second)
            value -= 0.3 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    right = (share[:, None] * (np.sign(x @ w + b) == target)).sum(axis=0)
    trust = np.clip(np.log((right + 1e-3) / (1 - right + 1e-3)), 0.1, None)
    return LanguageModel(names, code, w, b, (trust / trust.mean()).astype(np.float32))


def train(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> LanguageModel | None:
    """Fit on about ``train_rows`` rows per language of ``docs`` (doc_id, text, lang), none of them held out;
    on fewer per language where that would be over TRAIN_TOTAL rows in all.

    The rows are those with the smallest hash of their id, so the sample does
    not depend on partitions; rows without text or lang, or of more than
    TRAIN_BYTES bytes, are no training rows.  None if there are none.
    """
    python_ready(docs)
    usable = docs.where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))
        & (F.octet_length("text") <= TRAIN_BYTES)
    ).select("lang", "text", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)).alias("draw"))
    sizes = {r[0]: r[1] for r in usable.groupBy("lang").count().collect()}  # one row per language
    if not sizes:
        return None
    each = min(train_rows, max(TRAIN_TOTAL // len(sizes), 1))
    limit = F.create_map(*[F.lit(v) for k, n in sizes.items() for v in (k, int(min(1.0, each / n) * (1 << 30)))])
    sample = usable.where(F.col("draw") <= limit[F.col("lang")])

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(v, *_sparse(features(t))) for v, t in zip(batch["lang"], batch["text"], strict=True) if has_letter(t)]
            yield pd.DataFrame(rows, columns=["lang", "at", "value"])

    rows = sample.select("lang", "text").mapInPandas(vectors, "lang string, at binary, value binary").collect()
    if not rows:
        return None
    known = sorted(((r["lang"], _dense(r["at"], r["value"])) for r in rows), key=lambda r: (r[0], r[1].tobytes()))
    return fit(np.stack([x for _, x in known]), [lang for lang, _ in known])


def predict_texts(model: LanguageModel | None, texts) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(language, score, ambiguous) of each text; ``und`` and score 0 without a letter."""
    lang, score, unsure = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
    if model is None:
        return lang, score, unsure
    known = [k for k, t in enumerate(texts) if t and has_letter(t)]
    for at in range(0, len(known), 256):
        part = known[at : at + 256]
        best, p, amb = model.decode(np.stack([features(texts[k]) for k in part]))
        for k, j, s, a in zip(part, best, p, amb, strict=True):
            lang[k], score[k], unsure[k] = model.languages[j], min(float(s), 1.0), bool(a)
    return lang, score, unsure


def language_column(docs: DataFrame, model: LanguageModel | None) -> Column:
    """Struct (lang_pred, score, ambiguous) of the column ``text`` of ``docs``.

    Reads nothing but the text.  Null, empty and letterless texts are ``und``
    with score 0, as is everything without a model.
    """
    python_ready(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bits x buckets numbers, whatever the corpus

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            lang, score, unsure = predict_texts(shared.value, texts.tolist())
            yield pd.DataFrame({"lang_pred": lang, "score": score, "ambiguous": unsure})

    return label(F.col("text"))


def language_id(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Train on ``docs`` (doc_id, text, lang) and predict all its rows: doc_id, held_out, lang_pred, score, ambiguous.

    Rows repeated with an id are predicted each for itself; other columns
    are ignored; an empty table gives an empty result.
    """
    found = docs.select("doc_id", language_column(docs, train(docs, train_rows)).alias("found"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "found.*")


def accepted(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs`` whose language is clear: neither ``und`` nor ambiguous; all their columns, whatever
    their names.  Null and empty texts are ``und`` and go; repeated rows are judged alike; an empty table gives
    an empty result."""
    name = free_name(docs, "_language")
    found = docs.withColumn(name, language_column(docs, train(docs, train_rows)))
    clear = (F.col(name)["lang_pred"] != UNKNOWN) & ~F.col(name)["ambiguous"]
    return found.where(clear).drop(name)
