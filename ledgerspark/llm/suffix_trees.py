"""Substring dedup by prefix-partitioned suffix trees, over words.

A window is ``window`` consecutive words.  The suffixes that begin with a
window are split into groups by a prefix of variable length: it ends with the
window's *anchor*, its ``gram`` words of least hash.  Equal windows have equal
anchors at equal places, so all suffixes that may share a window meet, and
neighbouring suffixes with one anchor travel as one row (a *run*).  Runs of
equal words are one leaf with its smallest document.

A group that fits in memory becomes a suffix tree (as its sorted leaves and
the depth at which neighbours part): the inner nodes at least a window deep
are the repeats, and their smallest document keeps its words.  The suffixes
of a group that is too large are split by longer prefixes, up to a whole
window, where a group is one node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import python_ready, stored
from .grams import Fingerprints, U, WordIds, hash_filter, mix, passes, words_of

WINDOW = 50
GRAM = 8
#: Different runs of words that one subtree holds at most (about 30 MB in a task).
LEAVES = 4096
#: Bytes of a chunk: bounds a worker's memory; a longer text is one chunk.
CHUNK_BYTES = 6 << 20
#: Rows without an id come after all others.
LAST = (1 << 63) - 1


class _Texts:
    """Texts' words, each ended by a space, and the runs of their windows."""

    def __init__(self, rows: list[tuple], texts: list[bytes], size: list[int], window: int, gram: int):
        self.rows, self.data, self.size = rows, b"".join(texts), np.array(size, np.int64)
        self.offset = np.cumsum(self.size) - self.size
        hashes, self.begins, self.ends = words_of(self.data)
        self.prints = Fingerprints(hashes)
        self.first = self.last = self.anchor = self.gram = self.own = np.empty(0, np.int64)
        n_windows = np.maximum(self.size - window + 1, 0)
        if not n_windows.any():
            return
        at = np.arange(len(hashes) - gram + 1)
        grams = self.prints.of(at, at + gram)
        low, span, wide = grams & ~U(0xFFFFFFFF) | at.astype(np.uint64), 1, window - gram + 1
        while span * 2 <= wide:
            low, span = np.minimum(low[:-span], low[span:]), span * 2
        if span < wide:
            low = np.minimum(low[: len(low) - (wide - span)], low[wide - span :])
        own = np.repeat(np.arange(len(rows)), n_windows)
        start = np.arange(len(own)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows) + self.offset[own]
        place = (low[start] & U(0xFFFFFFFF)).astype(np.int64)
        new = np.flatnonzero(np.diff(place, prepend=-1))
        self.first, self.last = start[new], start[np.append(new[1:], len(start)) - 1]
        self.anchor, self.own = place[new], own[new]
        self.gram = grams[self.anchor]

    def runs(self, on: np.ndarray, window: int) -> np.ndarray:
        """The runs' identity: all their words, and the anchor's place."""
        first = self.first[on]
        return mix(self.prints.of(first, self.last[on] + window) + (self.anchor[on] - first).astype(np.uint64))


def _texts(batches: Iterator[pd.DataFrame], window: int, gram: int) -> Iterator[_Texts]:
    rows, texts, sizes, total = [], [], [], 0
    for batch in batches:
        for id_, key, data in zip(batch["id"], batch["key"], batch["data"], strict=True):
            words = data.split()
            if len(words) < window:
                continue
            rows.append((id_, key))
            sizes.append(len(words))
            words.append(b"")
            texts.append(b" ".join(words))
            total += len(texts[-1])
            if total >= CHUNK_BYTES:
                yield _Texts(rows, texts, sizes, window, gram)
                rows, texts, sizes, total = [], [], [], 0
    if rows:
        yield _Texts(rows, texts, sizes, window, gram)


def _anchors(window: int, gram: int):
    def anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for texts in _texts(batches, window, gram):
            found, n = np.unique(texts.gram, return_counts=True)
            yield pd.DataFrame({"gram": found.view(np.int64), "n": n})

    return anchors


def _runs(window: int, gram: int, table: Broadcast):
    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for texts in _texts(batches, window, gram):
            on = np.flatnonzero(passes(table.value, texts.gram))
            own = texts.own[on]
            ids = np.array(texts.rows, np.int64).reshape(-1, 2)[own]
            yield pd.DataFrame({
                "gram": texts.gram[on].view(np.int64), "run": texts.runs(on, window).view(np.int64),
                "id": ids[:, 0], "key": ids[:, 1],
                "first": texts.first[on] - texts.offset[own], "last": texts.last[on] - texts.offset[own]})

    return runs


def _leaves(window: int, gram: int, table: Broadcast):
    """(gram, run, id, key, words) of the runs that the filter lets pass."""

    def leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for texts in _texts(batches, window, gram):
            ids = np.array(texts.rows, np.int64).reshape(-1, 2)[texts.own]
            run = texts.runs(np.arange(len(texts.own)), window)
            on = np.flatnonzero(passes(table.value, mix(texts.gram ^ run ^ ids[:, 0].view(np.uint64) ^ ids[:, 1].view(np.uint64))))
            begins, ends = texts.begins[texts.first[on]], texts.ends[texts.last[on] + window - 1]
            words = [texts.data[a:b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
            yield pd.DataFrame({"gram": texts.gram[on].view(np.int64), "run": run[on].view(np.int64), "id": ids[on, 0],
                                "key": ids[on, 1], "words": pd.Series(words, dtype=object)})

    return leaves


def _mixed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"h": mix(batch["h"].to_numpy().view(np.uint64)).view(np.int64)})


def deep_nodes(words: np.ndarray, start: np.ndarray, group: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The inner nodes at least ``depth`` words deep of the groups' suffix trees: (leaf order, node of each).

    Leaves are the suffixes words[start:], sorted by their first ``depth``
    words (by prefix doubling: the ranks of 2k words are those of the pairs
    of ranks of k words).  Neighbours of one node part at that depth or beyond.
    """
    rank, k = np.unique(words, return_inverse=True)[1].astype(np.int64), 1
    while k * 2 <= depth:
        pair = rank[:-k] * (len(words) + 1) + rank[k:]
        rank, k = np.unique(pair, return_inverse=True)[1].astype(np.int64), k * 2
    head, tail = rank[start], rank[start + depth - k]
    order = np.lexsort((tail, head, group))
    part = np.zeros(len(order), bool)
    for line in (group, head, tail):
        part[1:] |= line[order[1:]] != line[order[:-1]]
    return order, np.cumsum(part)


def _subtrees(window: int):
    """(gram, run, low, high, smallest): the smallest document that shares a run's windows low..high.

    Rows come sorted by gram; a group is taken up when it is complete.
    """

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        ids, texts = WordIds(), [t.split() for t in rows["words"]]
        words = ids.of([w for t in texts for w in t])
        size = np.array([len(t) for t in texts])
        n = size - window + 1
        own = np.repeat(np.arange(len(texts)), n)
        place = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
        start = (np.cumsum(size) - size)[own] + place
        order, node = deep_nodes(words, start, rows["gram"].to_numpy()[own], window)
        heads = np.flatnonzero(np.diff(node, prepend=-1))
        least = np.minimum.reduceat(rows["smallest"].to_numpy()[own[order]], heads)[node]
        smallest = np.empty(len(own), np.int64)
        smallest[order] = least
        # Neighbouring windows that share with the same document are one maximal repeat.
        cut = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (smallest[1:] != smallest[:-1])))
        end = np.append(cut[1:], len(own)) - 1
        return pd.DataFrame({"gram": rows["gram"].to_numpy()[own[cut]], "run": rows["run"].to_numpy()[own[cut]],
                             "low": place[cut], "high": place[end], "smallest": smallest[cut]})

    def subtrees(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            gram = batch["gram"].to_numpy()
            held.append(batch)
            size += len(batch)
            if size < LEAVES:
                continue
            rows = pd.concat(held)
            done = rows["gram"].to_numpy() != gram[-1]  # the last group may go on
            if done.any():
                yield solve(rows[done])
                rows = rows[~done]
            held, size = [rows], len(rows)
        if size:
            yield solve(pd.concat(held))

    return subtrees


def _long_prefixes(window: int):
    """(gram, run, low, prefix, smallest) of each window of runs in a group too large for a tree."""

    def prefixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for gram, run, smallest, data in zip(batch["gram"], batch["run"], batch["smallest"], batch["words"], strict=True):
                words = data.split()
                n = len(words) - window + 1
                names = [hashlib.blake2b(b" ".join(words[k : k + window]), digest_size=16).digest() for k in range(n)]
                yield pd.DataFrame({"gram": gram, "run": run, "low": range(n), "prefix": names, "smallest": smallest})

    return prefixes


_REPEATS = "gram long, run long, low int, high int, smallest long"


def repeats(texts: DataFrame, window: int = WINDOW, gram: int = GRAM, leaves: int = LEAVES) -> DataFrame:
    """(id, key, first, last) of the windows of ``texts`` (id, key, data) that a smaller id also has: places first..last."""
    counts = texts.mapInPandas(_anchors(window, gram), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    table = hash_filter(stored(counts.where("n > 1").select("gram"), "tree-anchors"))
    runs = texts.mapInPandas(_runs(window, gram, table), "gram long, run long, id long, key long, first int, last int")
    runs = stored(runs, "tree-runs")

    distinct = runs.groupBy("gram", "run").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "key")).alias("least"), F.max(F.col("last") - F.col("first")).alias("high"))
    distinct = stored(distinct.select("gram", "run", "n", "least.*", "high"), "tree-distinct")
    groups = distinct.groupBy("gram").agg(F.count(F.lit(1)).alias("n_leaves"), F.sum("n").alias("n_runs"))
    groups = stored(distinct.join(groups.where("n_runs > 1").select("gram", "n_leaves"), "gram"), "tree-groups")

    alone = groups.where("n_leaves = 1").select("gram", "run", F.lit(0).alias("low"), "high", F.col("id").alias("smallest"))
    many = groups.where("n_leaves > 1")
    wanted = many.select(F.expr("gram ^ run ^ id ^ key").alias("h")).mapInPandas(_mixed, "h long")
    named = texts.mapInPandas(_leaves(window, gram, hash_filter(wanted)), "gram long, run long, id long, key long, words binary")
    # Repeated rows give a run twice.
    named = named.join(many.select("gram", "run", "id", "key", "n_leaves"), ["gram", "run", "id", "key"])
    named = stored(named.dropDuplicates(["gram", "run"]).withColumnRenamed("id", "smallest"), "tree-leaves")

    small = named.where(F.col("n_leaves") <= leaves).repartition("gram").sortWithinPartitions("gram")
    in_trees = small.select("gram", "run", "smallest", "words").mapInPandas(_subtrees(window), _REPEATS)
    large = named.where(F.col("n_leaves") > leaves).mapInPandas(
        _long_prefixes(window), "gram long, run long, low int, prefix binary, smallest long")
    nodes = large.groupBy("gram", "prefix").agg(F.min("smallest").alias("smallest"))
    by_prefix = large.drop("smallest").join(nodes, ["gram", "prefix"])
    found = alone.unionByName(in_trees).unionByName(
        by_prefix.select("gram", "run", "low", F.col("low").alias("high"), "smallest"))
    found = stored(found, "tree-repeats")
    again = runs.join(found, ["gram", "run"]).where(F.col("smallest") < F.col("id"))
    return again.select("id", "key", (F.col("first") + F.col("low")).alias("first"), (F.col("first") + F.col("high")).alias("last"))


_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])


def _cut(window: int):
    """What stays of each text without the words in the windows first..last."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, sha = [], [], []
            for data, spans in zip(batch.column("data").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                words = data.split()
                n.append(len(words))
                if spans:
                    change = np.zeros(len(words) + 1, np.int64)
                    np.add.at(change, [s["first"] for s in spans], 1)
                    np.add.at(change, [s["last"] + window for s in spans], -1)
                    words = [words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
                gone.append(n[-1] - len(words))
                sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, schema=_OUT)

    return cut


def substring_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, leaves: int = LEAVES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, kept_sha256.

    A word (between spaces and ASCII control white space) goes if it lies in
    a window of ``window`` words that also starts in a row with a smaller
    doc_id; windows are judged on the input.  Null texts have no words, and
    shorter texts lose none; rows of one id, repeated ones included, leave
    each other alone; a null id comes after all others.  Long texts are
    treated whole, in one chunk; other columns are ignored; an empty table
    gives an empty result.
    """
    if not 0 < gram <= window:
        raise ValueError("gram must be 1 to window")
    python_ready(docs)
    data = F.coalesce("text", F.lit("")).cast("binary")
    id_ = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), id_.alias("id"), F.xxhash64(data).alias("key"), data.alias("data"))
    spans = repeats(texts.drop("doc_id"), window, gram, leaves)
    # A text has no more runs than words.
    spans = stored(spans.groupBy("id", "key").agg(F.collect_list(F.struct("first", "last")).alias("spans")), "tree-spans")
    whole = texts.join(spans.hint("merge"), ["id", "key"], "left")
    return whole.select("doc_id", "data", "spans").mapInArrow(_cut(window), "doc_id long, n_words long, n_removed long, kept_sha256 string")
