"""Toxicity by a convolutional text classifier.

Words are hashed into an embedding table; filters of several widths slide
over the text, each keeps its maximum, and a logistic output reads the
maxima.  Trained on all labelled rows: blocks of rows move the parameters by
numpy inside Spark tasks, and each pass ends with the mean of their movements.
The threshold of each language (as language ID sees it in the text) is
calibrated on the quarter of the rows left out of training and mapped to a
score of one half.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import langid
from .common import held_out, python_ready, running_total, stored

#: Labelled rows of a block on average, and the words from which a block goes in parts.
BLOCK_ROWS = 2700
BLOCK_WORDS = 1 << 23
#: Scale of the numbers that Spark adds up as integers.
FIXED = float(1 << 30)
#: So many that an unseen word seldom falls on a toxic one.
BUCKETS = 1 << 20
DIM = 12
FILTERS = 6
WIDTHS = (1, 2, 3)
#: Passes over the training rows; the one of least loss on the rows left out is kept.
EPOCHS = 4
#: Words in fewer training texts have no embedding; of how many texts a word counts as half known.
MIN_TEXTS = 3
HALF_KNOWN = 20
#: Rows of the corpus' toxic share that a language's own share is mixed with.
SHARE_ROWS = 20
#: Positive validation rows a language needs for a threshold of its own.
MIN_POSITIVE = 15
CACHE_ENTRIES = 100_000
CHUNK = 1 << 18
#: Rows of an Arrow batch of movements.
MOVED_ROWS = 1 << 16
_EDGES = ".,;:!?\"'()[]{}|*%&$#<>-_"


class _WordBuckets(dict):
    """Hash bucket of each word, remembered; emptied when full.  Bucket 0 is for padding."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        bare = word.strip(_EDGES)
        self[word] = k = 1 + zlib.crc32(bare.encode("utf-8", "replace")) % BUCKETS if bare else 0
        return k


_BUCKETS = _WordBuckets()


def word_buckets(text: str) -> np.ndarray:
    words = text.lower().split()
    return np.fromiter(map(_BUCKETS.__getitem__, words), np.int32, len(words))


@dataclass
class ToxicityModel:
    known: np.ndarray  # bucket -> row of the embeddings; 0: padding or rare
    emb: np.ndarray
    filters: list[np.ndarray]  # of each width: offset x dimension x filter
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: float
    languages: langid.LanguageModel | None = None
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5

    @cached_property
    def tables(self) -> list[list[np.ndarray]]:
        """Width, offset -> rows x filters."""
        return [[(self.emb @ f[o]).astype(np.float32) for o in range(len(f))] for f in self.filters]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "tables"}  # three times the embeddings: made where needed

    def maxima(self, ids: list[np.ndarray]) -> np.ndarray:
        """Each filter's maximum over each text; long texts in overlapping chunks."""
        result = np.zeros((len(ids), sum(len(b) for b in self.bias)), np.float32)
        pad = max(WIDTHS) - 1
        k = 0
        while k < len(ids):
            if len(ids[k]) > CHUNK:
                parts = [ids[k][a : a + CHUNK + pad] for a in range(0, len(ids[k]), CHUNK)]
                result[k] = self._maxima(parts).max(axis=0)
                k += 1
                continue
            end, n = k, 0
            while end < len(ids) and (n := n + len(ids[end])) <= CHUNK:
                end += 1
            end = max(end, k + 1)
            result[k:end] = self._maxima(ids[k:end])
            k = end
        return result

    def _maxima(self, ids: list[np.ndarray]) -> np.ndarray:
        pad = max(WIDTHS) - 1
        blank = np.zeros(pad, np.int32)
        line = np.concatenate([x for t in ids for x in (t, blank)] + [blank])
        line = self.known[line]
        starts = np.concatenate([[0], np.cumsum([len(t) + pad for t in ids])[:-1]]).astype(np.int64)
        n = len(line) - pad
        found = []
        for tables, bias in zip(self.tables, self.bias, strict=True):
            total = tables[0][line[:n]]
            for offset in range(1, len(tables)):
                total += tables[offset][line[offset : n + offset]]
            found.append(np.maximum(np.maximum.reduceat(total, starts, axis=0) + bias, 0))
        return np.concatenate(found, axis=1)

    def raw(self, ids: list[np.ndarray]) -> np.ndarray:
        return self.maxima(ids) @ self.out + self.out_bias

    def score(self, raw: np.ndarray, languages: list[str]) -> np.ndarray:
        shift = np.array([self.thresholds.get(v, self.threshold) for v in languages])
        return 1 / (1 + np.exp(-np.clip(raw - shift, -40, 40)))


def evidence(n: np.ndarray, toxic: np.ndarray, expected: np.ndarray) -> np.ndarray:
    """Signed root of the deviance of ``toxic`` of a word's n texts from ``expected``.

    Shrunk by what the greatest of so many words reaches by chance: nothing is
    cut, but three toxic texts count for much only where toxic texts are few.
    """
    def part(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a * np.log(np.maximum(a, 1e-12) / np.maximum(b, 1e-12))

    squared = 2 * np.maximum(part(toxic, expected) + part(n - toxic, n - expected), 0)
    chance = 2 * np.log(max(len(n), 2))
    return np.sign(toxic - expected) * np.sqrt(squared) * squared / (squared + chance)


@dataclass
class Network:
    """The parameters under training: embeddings of the known words, and filters and output as one vector."""

    known: np.ndarray
    emb: np.ndarray
    prior: np.ndarray  # the embeddings at the start
    free: np.ndarray  # how far a word may move from where its evidence puts it
    small: np.ndarray

    def parts(self, small: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
        """Views of ``small``: filters (offset x dimension x filter) of each width, biases, output, its bias."""
        small, at, filters = self.small if small is None else small, 0, []
        for w in WIDTHS:
            filters.append(small[at : at + w * DIM * FILTERS].reshape(w, DIM, FILTERS))
            at += w * DIM * FILTERS
        n = FILTERS * len(WIDTHS)
        return filters, small[at : at + n], small[at + n : at + 2 * n], small[at + 2 * n :]

    def packed(self) -> ToxicityModel:
        filters, bias, out, out_bias = self.parts()
        return ToxicityModel(self.known, self.emb.copy(), [f.copy() for f in filters], [b.astype(np.float32) for b in np.split(bias, len(WIDTHS))],
                             out.astype(np.float32), float(out_bias[0]))


def language_shares(n: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Toxic share of each language, from its training rows and the toxic ones among them."""
    return (toxic + SHARE_ROWS * toxic.sum() / n.sum()) / (n + SHARE_ROWS)


def label_weights(n: float, toxic: float) -> tuple[float, float]:
    """Weights of rows labelled 0 and 1: both labels weigh alike."""
    rate = toxic / n
    return 0.5 / max(1 - rate, 1e-6), 0.5 / max(rate, 1e-6)


def first_network(words: np.ndarray, texts: np.ndarray, toxic: np.ndarray, expected: np.ndarray, seed: int) -> Network:
    """The network before training, from each word's training texts, the toxic ones, and the number expected."""
    rng = np.random.default_rng(seed)
    known = np.zeros(BUCKETS + 1, np.int32)
    known[words] = np.arange(1, len(words) + 1)
    free = np.append(0, texts / (texts + HALF_KNOWN))[:, None].astype(np.float32)
    emb = (rng.normal(0, 0.1, (len(words) + 1, DIM)) * free).astype(np.float32)
    # A max pool trains only what it picks: the first axis starts at the word's
    # evidence of toxicity, and one filter of each width reads it.
    emb[1:, 0] = np.clip(evidence(texts, toxic, expected) / 4, -1, 4)
    emb[0] = 0
    filters = [rng.normal(0, 0.2, (w, DIM, FILTERS)) for w in WIDTHS]
    for f in filters:
        f[:, 0, 0] = 1.0
    n = FILTERS * len(WIDTHS)
    out = rng.normal(0, 0.05, n)
    out[::FILTERS] = 0.5
    small = np.concatenate([*[f.ravel() for f in filters], np.zeros(n), out, [-1.0]])
    return Network(known, emb, emb.copy(), free, small)


def _windows(emb: np.ndarray, filters: list[np.ndarray], rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(rows x filters) greatest convolution of each row, and the words of the window that gave it."""
    pad, n_filters = max(WIDTHS) - 1, FILTERS * len(WIDTHS)
    tops = np.full((len(rows), n_filters), -np.inf)
    wins = np.zeros((len(rows), n_filters, pad + 1), np.int32)
    # Widths are 1, 2, ...: offset o is read by the widths above it, whose filters come last.
    steps = [np.concatenate([f[o] for f in filters[o:]], axis=1).astype(np.float32) for o in range(pad + 1)]
    every, offsets = np.arange(n_filters), np.arange(pad + 1)
    inside = offsets <= (every // FILTERS)[:, None]
    pieces = [(k, t[a : a + CHUNK + pad], min(CHUNK, len(t) - a)) for k, t in enumerate(rows) for a in range(0, len(t), CHUNK)]
    at = 0
    while at < len(pieces):
        line, spans, size = [], [], 0
        while at < len(pieces) and (not spans or size + len(pieces[at][1]) <= CHUNK):
            k, words, n = pieces[at]
            spans.append((k, size, size + n))
            line += [words, np.zeros(pad, np.int32)]
            size += len(words) + pad
            at += 1
        line = np.concatenate(line)
        x, end = emb[line], len(line) - pad
        conv = x[:end] @ steps[0]
        for o in range(1, pad + 1):
            conv[:, o * FILTERS :] += x[o : end + o] @ steps[o]
        for k, a, b in spans:
            where = conv[a:b].argmax(axis=0)
            value = conv[a + where, every]
            better = value > tops[k]
            tops[k] = np.where(better, value, tops[k])
            wins[k] = np.where(better[:, None] & inside, line[a + where[:, None] + offsets], wins[k])
    return np.where(np.isinf(tops), 0, tops), wins


def train_block(net: Network, ids: list[np.ndarray], labels: np.ndarray, weights: tuple[float, float],
                seed: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One pass over a block of rows from the network's parameters: (rows of the embeddings, their
    movement, movement of ``small``).  Gradients reach only the windows that gave a maximum."""
    lines = [net.known[t] for t in ids]
    own = np.unique(np.concatenate([np.zeros(1, np.int32), *lines]))  # row 0 stays row 0
    lines = [np.searchsorted(own, t).astype(np.int32) for t in lines]
    start, prior, free = net.emb[own], net.prior[own], net.free[own]
    emb, small = start.copy(), net.small.copy()
    filters, bias, out, out_bias = net.parts(small)
    params = [emb, small]
    first, second, grads, spare = ([np.zeros_like(p) for p in params] for _ in "abcd")
    weight = np.where(labels == 1, weights[1], weights[0])
    order, step = np.random.default_rng(seed).permutation(len(lines)), 0
    for at in range(0, len(order), 32):
        batch = order[at : at + 32]
        tops, wins = _windows(emb, filters, [lines[k] for k in batch])
        full = np.array([len(lines[k]) > 0 for k in batch])
        joined = np.maximum(tops + bias, 0)
        p = 1 / (1 + np.exp(-np.clip(joined @ out + out_bias[0], -30, 30)))
        pull = weight[batch] * (p - labels[batch]) / len(batch)
        for g in grads:
            g.fill(0)
        to_filters, to_bias, to_out, to_out_bias = net.parts(grads[1])
        to_out += pull @ joined
        to_out_bias += pull.sum()
        back = pull[:, None] * out * (joined > 0)
        to_bias += back.sum(axis=0)
        back *= full[:, None]
        for i, f in enumerate(filters):
            part = slice(i * FILTERS, (i + 1) * FILTERS)
            for o in range(len(f)):
                words = wins[:, part, o]
                to_filters[i][o] += np.einsum("mfd,mf->df", emb[words], back[:, part])
                np.add.at(grads[0], words.ravel(), (back[:, part, None] * f[o].T).reshape(-1, DIM).astype(np.float32))
        grads[0][0] = 0
        step += 1
        for p, g, a, b, t in zip(params, grads, first, second, spare, strict=True):
            np.subtract(p, prior if p is emb else 0, out=t)
            t *= 1e-3
            g += t
            np.subtract(g, a, out=t)
            t *= 0.1
            a += t
            np.multiply(g, g, out=t)
            t -= b
            t *= 0.01
            b += t
            np.sqrt(b, out=t)
            t *= (1 - 0.99**step) ** -0.5
            t += 1e-8
            np.divide(a, t, out=t)
            t *= 0.01 / (1 - 0.9**step)
            if p is emb:
                t *= free
            p -= t
        emb[0] = 0
    moved = emb - start
    changed = np.flatnonzero(moved.any(axis=1))
    return own[changed], moved[changed], small - net.small


def fit(ids: list[np.ndarray], labels: np.ndarray, check_ids: list[np.ndarray], check_labels: np.ndarray,
        seed: int = 11, epochs: int = EPOCHS, languages: np.ndarray | None = None) -> ToxicityModel:
    """Train the network on rows at hand, as one block; ``train`` does the same by blocks in Spark.

    With ``languages``, one per text, a word's toxic texts are held against
    the toxic share of the languages it is found in.
    """
    own = np.zeros(len(ids), int) if languages is None else np.unique(languages, return_inverse=True)[1]
    share = language_shares(np.bincount(own), np.bincount(own, labels))
    texts, toxic, expected = word_evidence(ids, labels, share[own])
    common = np.flatnonzero(texts >= MIN_TEXTS)
    net = first_network(common, texts[common], toxic[common], expected[common], seed)
    weights = label_weights(len(labels), labels.sum())
    best, least = None, np.inf
    for epoch in range(epochs):
        words, moved, small = train_block(net, ids, labels, weights, [seed, epoch, 0])
        net.emb[words] += moved
        net.small += small
        model = net.packed()
        now = -epoch  # nothing to compare: the last pass
        if len(check_ids):
            each = np.logaddexp(0, -np.where(check_labels == 1, 1, -1) * model.raw(check_ids))
            now = float(np.mean([each[check_labels == v].mean() for v in np.unique(check_labels)]))
        if now < least:
            best, least = model, now
    return best


def word_evidence(ids: list[np.ndarray], labels: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per bucket: its texts, the toxic ones among them, and the sum of the texts' ``shares``."""
    texts, toxic, expected = (np.zeros(BUCKETS + 1) for _ in "abc")
    for t, y, v in zip(ids, labels, shares, strict=True):
        words = np.unique(t)
        texts[words] += 1
        toxic[words] += y
        expected[words] += v
    texts[0] = 0
    return texts, toxic, expected


def best_thresholds(scored: DataFrame) -> dict[str | None, float]:
    """The cut of greatest F0.5, halfway to the next lower score, over all rows of ``scored`` (lang, toxic, raw):
    of each language with MIN_POSITIVE toxic rows and one that is not, and of all rows (None) with one of each.

    Precision counts more than recall, as toxic labels set at random cannot be
    recalled.  Equal scores fall on one side of a cut.  One row per language
    reaches the driver.
    """
    group = F.explode(F.array(F.lit("all"), F.concat(F.lit("lang "), "lang"))).alias("group")
    cells = stored(scored.select(group, "raw", "toxic").groupBy("group", "raw")
                   .agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("hits")), "toxicity-cells")
    sums = cells.groupBy("group").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n")).collect()
    usable = {r["group"]: r["hits"] for r in sums if (1 if r["group"] == "all" else MIN_POSITIVE) <= r["hits"] < r["n"]}
    if not usable:
        return {}
    cells = cells.where(F.col("group").isin(list(usable)))
    high = [F.desc("raw")]
    ranked = running_total(cells, "group", high, "n", "toxicity-ranks", "n_before")
    ranked = running_total(ranked, "group", high, "hits", "toxicity-hits", "hits_before")
    positive = F.create_map(*[F.lit(v) for pair in usable.items() for v in pair])[F.col("group")]
    f = 1.25 * (F.col("hits_before") + F.col("hits")) / (F.col("n_before") + F.col("n") + 0.25 * positive)
    best = ranked.groupBy("group").agg(F.max(F.struct(f.alias("f"), "raw"))["raw"].alias("cut"))
    best = {r["group"]: r["cut"] for r in best.collect()}
    cut = F.create_map(*[F.lit(v) for pair in best.items() for v in pair])[F.col("group")]
    low = cells.where(F.col("raw") < cut).groupBy("group").agg(F.max("raw").alias("low")).collect()
    low = {r["group"]: r["low"] for r in low}
    return {None if k == "all" else k[len("lang "):]: (v + low.get(k, v - 1)) / 2 for k, v in best.items()}


def labelled_rows(docs: DataFrame, labels: DataFrame, languages: langid.LanguageModel | None) -> DataFrame | None:
    """All labelled texts that are not held out, stored: block, check, draw, toxic, lang, ids.  Rows of a block
    lie together, in one order.  None without rows of both labels."""
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max((F.col("toxic") != 0).cast("int")).alias("toxic"))
    )
    sizes = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return None
    blocks = -(-sum(sizes.values()) // BLOCK_ROWS)
    # A bit table of the labelled ids, of bounded size: few other texts are shuffled (none is lost where it fills up).
    bits = min(1 << 25, 1 << (16 * sum(sizes.values()) - 1).bit_length())
    bit = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(bits))
    table = known.select(F.shiftright(bit, 6).alias("slot"), F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int")).alias("set"))
    table = table.groupBy("slot").agg(F.bit_or("set").alias("set"))
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", "text", F.shiftright(bit, 6).alias("slot"), bit.bitwiseAND(F.lit(63)).cast("int").alias("place"))
    texts = texts.join(F.broadcast(table), "slot").where(F.getbit("set", F.col("place")) == 1).select("doc_id", "text")
    draw = F.xxhash64("doc_id")
    apart = F.floor(F.crc32(F.col("doc_id").cast("string").cast("binary")) / 5) % 4 == 0
    joined = texts.join(known.hint("merge"), "doc_id").select(
        F.pmod(draw, F.lit(blocks)).alias("block"), apart.alias("check"), draw.alias("draw"), "toxic", "text")
    shared = docs.sparkSession.sparkContext.broadcast(languages)

    def ids(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.drop(columns="text").assign(
                lang=langid.predict_texts(shared.value, batch["text"].tolist())[0],
                ids=[word_buckets(t).astype("<i4").tobytes() for t in batch["text"]])

    rows = joined.mapInPandas(ids, "block long, check boolean, draw long, toxic int, lang string, ids binary")
    return stored(rows.repartition(blocks, "block").sortWithinPartitions("block", "check", "draw", "ids"), "toxicity-rows")


def collected(df: DataFrame) -> dict[str, np.ndarray]:
    """The columns of ``df``, without nulls, by Arrow whatever the session's settings: as rows of Python
    objects they would take the driver ten times the memory."""
    table = df.toArrow()
    return {name: table[name].to_numpy() for name in table.column_names}


def _lines(batch: pd.DataFrame) -> list[np.ndarray]:
    return [np.frombuffer(t, "<i4") for t in batch["ids"]]


def counted_words(rows: DataFrame, share: dict[str, float]) -> pd.DataFrame:
    """word, texts, toxic, expected of all words of MIN_TEXTS training texts; BUCKETS rows at most."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((3, BUCKETS + 1))
        for batch in batches:
            sums += word_evidence(_lines(batch), batch["toxic"].to_numpy(float), batch["lang"].map(share).to_numpy(float))
        words = np.flatnonzero(sums[0])
        # Fixed point: the sums do not depend on the order of the additions.
        part = [np.rint(s * scale).astype(np.int64) for s, scale in zip(sums[:, words], (1, 1, FIXED), strict=True)]
        yield pd.DataFrame({"word": words.astype(np.int32), "texts": part[0], "toxic": part[1], "expected": part[2]})

    each = rows.select("toxic", "lang", "ids").mapInPandas(count, "word int, texts long, toxic long, expected long")
    sums = each.groupBy("word").agg(*[F.sum(c).alias(c) for c in ("texts", "toxic", "expected")])
    found = collected(sums.where(F.col("texts") >= MIN_TEXTS))
    order = found["word"].argsort()
    return pd.DataFrame({c: v[order] for c, v in found.items()})


@dataclass
class SharedNetwork:
    """A network in the tasks: what stays over the passes, and the parameters of one pass."""

    fixed: Broadcast
    now: Broadcast

    @staticmethod
    def start(net: Network, spark: SparkSession) -> SharedNetwork:
        fixed = spark.sparkContext.broadcast((net.known, net.prior, net.free))
        return SharedNetwork(fixed, spark.sparkContext.broadcast((net.emb, net.small)))

    def next(self, net: Network, spark: SparkSession) -> SharedNetwork:
        self.now.destroy()
        return SharedNetwork(self.fixed, spark.sparkContext.broadcast((net.emb, net.small)))

    def network(self) -> Network:
        known, prior, free = self.fixed.value
        emb, small = self.now.value
        return Network(known, emb, prior, free, small)


class Moves:
    """Sums, in fixed point, of the movements of a task's blocks: row 0 on are ``small``, then the embeddings."""

    def __init__(self, width: int, words: int):
        self.width = width
        self.sums = np.zeros((width + words, DIM), np.int64)
        self.blocks = np.zeros(width + words, np.int32)

    def add(self, words: np.ndarray, moved: np.ndarray, small: np.ndarray) -> None:
        small = np.append(small, np.zeros(self.width * DIM - len(small))).reshape(self.width, DIM)
        at = np.concatenate([np.arange(self.width), self.width + words])
        self.sums[at] += np.rint(np.concatenate([small, moved]) * FIXED).astype(np.int64)
        self.blocks[at] += 1

    def tables(self, columns: list[str]) -> Iterator[pd.DataFrame]:
        """word (``small``: -1, -2, ...), the blocks that moved it, and the sums of their movements."""
        moved = np.flatnonzero(self.blocks)
        for at in (moved[k : k + MOVED_ROWS] for k in range(0, len(moved), MOVED_ROWS)):
            word = np.where(at < self.width, -1 - at, at - self.width).astype(np.int32)
            yield pd.DataFrame(self.sums[at], columns=columns).assign(word=word, blocks=self.blocks[at])


def summed_moves(net: Network, shared: SharedNetwork, rows: DataFrame, weights: tuple[float, float], seed: int, epoch: int) -> DataFrame:
    """d0, d1, ..., word, blocks: per task and word the sum of the movements that its blocks make from the network's parameters."""
    width, words = -(-len(net.small) // DIM), len(net.emb)
    columns = [f"d{k}" for k in range(DIM)]

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, ids, toxic, size, moves = None, [], [], 0, Moves(width, words)

        def train() -> None:
            moves.add(*train_block(shared.network(), ids, np.array(toxic, float), weights, [seed, epoch, number]))

        for batch in batches:
            for at, y, t in zip(batch["block"], batch["toxic"], _lines(batch), strict=True):
                if ids and (at != number or size + len(t) > BLOCK_WORDS):
                    train()
                    ids, toxic, size = [], [], 0
                number, size = at, size + len(t)
                ids.append(t)
                toxic.append(y)
        if ids:
            train()
        yield from moves.tables(columns)

    schema = ", ".join(f"{c} long" for c in columns) + ", word int, blocks int"
    # A task for each core: what is shuffled is bounded by the cores and the words, not by the blocks.
    tasks = rows.sparkSession.sparkContext.defaultParallelism
    return rows.select("block", "toxic", "ids").coalesce(tasks).mapInPandas(blocks, schema)


def trained_pass(net: Network, shared: SharedNetwork, rows: DataFrame, weights: tuple[float, float], seed: int, epoch: int) -> None:
    """One pass over all training rows: every block starts from the network's parameters, which then move
    by the mean of the blocks' movements (an embedding by the mean of the blocks that moved it)."""
    width = -(-len(net.small) // DIM)
    columns = [f"d{k}" for k in range(DIM)]
    mean = [(F.sum(c) / F.sum("blocks") / FIXED).cast("float").alias(c) for c in columns]
    moves = collected(summed_moves(net, shared, rows, weights, seed, epoch).groupBy("word").agg(*mean))
    at = moves["word"]
    word, small = at >= 0, np.zeros((width, DIM))
    for k, c in enumerate(columns):
        net.emb[at[word], k] += moves[c][word]
        small[-1 - at[~word], k] = moves[c][~word]
    net.small += small.ravel()[: len(net.small)]


def scored_rows(rows: DataFrame, shared: SharedNetwork) -> DataFrame:
    """lang, toxic, raw of the rows, stored."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.network().packed()
        for batch in batches:
            lines = _lines(batch)
            for at in range(0, len(lines), 512):
                part = batch[["lang", "toxic"]].iloc[at : at + 512]
                yield part.assign(raw=model.raw(lines[at : at + 512]).astype(float))

    return stored(rows.select("lang", "toxic", "ids").mapInPandas(score, "lang string, toxic int, raw double"), "toxicity-scored")


def mean_loss(scored: DataFrame) -> float:
    """Mean over the labels of the mean logistic loss of their rows."""
    margin = F.when(F.col("toxic") == 1, F.col("raw")).otherwise(-F.col("raw"))
    loss = F.greatest(-margin, F.lit(0.0)) + F.log1p(F.exp(-F.abs(margin)))
    return scored.groupBy("toxic").agg(F.avg(F.round(loss, 9).cast("decimal(20,9)")).alias("loss")).agg(F.avg("loss").cast("double")).first()[0]


def train(docs: DataFrame, labels: DataFrame, seed: int = 11) -> ToxicityModel | None:
    """Fit on all labelled rows of ``docs`` (doc_id, text, lang) that are not held out.

    ``labels`` (doc_id, toxic).  Three quarters of the rows train the network,
    all the others choose the pass and the thresholds.  An id labelled twice is
    toxic if one label says so; null labels, texts and ids are left out.  None
    without rows of both labels.  Word counts, gradients and thresholds are
    computed in Spark; the driver holds the model: BUCKETS embeddings at most.
    """
    python_ready(docs)
    languages = langid.train(docs)
    rows = labelled_rows(docs, labels, languages)
    if rows is None:
        return None
    own, apart = rows.where(~F.col("check")), rows.where("check")
    sizes = own.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).toPandas()
    n, toxic = sizes["n"].to_numpy(float), sizes["toxic"].to_numpy(float)
    if not 0 < toxic.sum() < n.sum():
        return None
    words = counted_words(own, dict(zip(sizes["lang"], language_shares(n, toxic), strict=True)))
    net = first_network(words["word"].to_numpy(), words["texts"].to_numpy(float), words["toxic"].to_numpy(float),
                        words["expected"].to_numpy(float) / FIXED, seed)
    weights = label_weights(n.sum(), toxic.sum())
    checked = not apart.isEmpty()
    model, least, scored = None, np.inf, None
    shared = SharedNetwork.start(net, docs.sparkSession)
    for epoch in range(EPOCHS):
        trained_pass(net, shared, own, weights, seed, epoch)
        shared = shared.next(net, docs.sparkSession)
        if not checked:
            model = net.packed()  # nothing to compare: the last pass
            continue
        found = scored_rows(apart, shared)
        if (loss := mean_loss(found)) < least:
            model, least, scored = net.packed(), loss, found
    shared.now.destroy()
    shared.fixed.destroy()
    model.languages = languages
    cuts = best_thresholds(scored) if checked else {}
    model.threshold = cuts.pop(None, 0.0)
    model.thresholds = cuts
    return model


def predict(docs: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """doc_id, score, predicted, lang_pred per row of ``docs``; without a model every score is 0."""
    python_ready(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size, whatever the corpus
    kind = dict(docs.dtypes)["doc_id"]

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own, texts = shared.value, [t or "" for t in batch["text"]]
            score, lang = np.zeros(len(texts)), [langid.UNKNOWN] * len(texts)
            if own is not None:
                lang = langid.predict_texts(own.languages, texts)[0]
                for at in range(0, len(texts), 512):
                    part = slice(at, at + 512)
                    score[part] = own.score(own.raw([word_buckets(t) for t in texts[part]]), lang[part])
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": score, "predicted": (score >= 0.5).astype("int32"), "lang_pred": lang})

    return docs.select("doc_id", "text").mapInPandas(label, f"doc_id {kind}, score double, predicted int, lang_pred string")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on the labelled rows and score all rows of ``docs``: doc_id, held_out, score, predicted, lang_pred.

    The score reads nothing but the text.  Null and empty texts are scored
    like a text without known words; repeated rows each for itself; other
    columns are ignored; an empty table gives an empty result.
    """
    out = predict(docs, train(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "lang_pred")
