"""MinHash near-dedup for weighted shingles (ProbMinHash).

Each distinct five-word shingle of a text, weighted by its count, is a
Poisson process whose arrivals fall on random registers; a register keeps
the shingle that reached it first.  Two texts agree in a register with the
probability Jaccard similarity of their weighted shingles.  Generating
arrivals stops once all registers are filled and nothing earlier can come.

Bands of registers propose candidates, register agreement thins them, and
the exact similarity of the shingle weights decides.  Classes are the
connected components of the links found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, first_of_repeats, only, python_ready, stored, without

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: 21 bands of 6 registers find a pair of similarity 0.8 with probability 0.998.
BANDS, ROWS = 21, 6
REGISTERS = 128
#: Share of agreeing registers below which a pair is not compared in full: 3.5 deviations below 0.8.
LIKELY = 0.68
#: Bytes of shingles, and members, of a bucket that are compared as one tile.
TILE_BYTES = 2 * 1024 * 1024
TILE = 512
#: Tiles of a side that meet under one key: at most STRIP x STRIP comparisons of tiles in a task, however large the bucket.
STRIP = 8
#: Bounds what a reused worker keeps over the stages of a pipeline: about 20 MB.
CACHE_ENTRIES = 100_000

U = np.uint64
_ODD = [U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9), U(0xD6E8FEB86659FD93), U(0xA0761D6478BD642F)]


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


_HASHES = _WordHashes()


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit integers."""
    x = (x ^ x >> U(30)) * U(0xBF58476D1CE4E5B9)
    x = (x ^ x >> U(27)) * U(0x94D049BB133111EB)
    return x ^ x >> U(31)


def shingles(text: bytes, width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, counts) of the text's shingles; a shorter text is one shingle, an empty text none."""
    words = text.split()
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    n = max(len(words) - width + 1, 1)
    total = np.zeros(n, np.uint64)
    for k in range(min(width, len(words))):
        total = _mix(total + h[k : k + n] * _ODD[k % len(_ODD)] + U(k + 1))
    return np.unique(total, return_counts=True)


def registers(items: list[tuple[np.ndarray, np.ndarray]], m: int = REGISTERS) -> np.ndarray:
    """The texts' registers (texts x m): low 32 bits of the shingle that came first."""
    out = np.full((len(items), m), np.iinfo(np.uint64).max)
    todo, patience = [k for k, (h, _) in enumerate(items) if len(h)], 3.0
    while todo:
        sizes = np.array([len(items[k][0]) for k in todo])
        h = np.concatenate([items[k][0] for k in todo])
        w = np.concatenate([items[k][1] for k in todo]).astype(np.float64)
        own = np.repeat(np.arange(len(todo)), sizes)
        total = np.add.reduceat(w, np.concatenate([[0], np.cumsum(sizes)[:-1]]))
        # All registers are reached by then, but with probability e^-patience at most.
        stop = (m / total * (np.log(m) + patience))[own]
        first = np.full(len(todo) * m, np.iinfo(np.uint64).max)
        time, state = np.zeros(len(h)), h
        while len(h):
            state = _mix(state + U(0x9E3779B97F4A7C15))
            time = time - np.log(((state >> U(11)).astype(np.float64) + 1) / (1 << 53)) / w
            on = time < stop
            h, w, own, stop, time, state = h[on], w[on], own[on], stop[on], time[on], state[on]
            where = own * m + (_mix(state ^ U(0x5851F42D4C957F2D)) % U(m)).astype(np.int64)
            arrival = time.astype(np.float32).view(np.uint32).astype(np.uint64) << U(32) | h & U(0xFFFFFFFF)
            np.minimum.at(first, where, arrival)
        first = first.reshape(-1, m)
        full = (first != np.iinfo(np.uint64).max).all(axis=1)
        for row, k in enumerate(todo):
            if full[row]:
                out[k] = first[row]
        todo, patience = [k for row, k in enumerate(todo) if not full[row]], patience * 2
    return (out & U(0xFFFFFFFF)).astype(np.uint32)


def band_keys(regs: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per text and band."""
    part = regs[:, : bands * rows].reshape(len(regs), bands, rows).astype(np.uint64)
    key = np.broadcast_to(_mix(np.arange(1, bands + 1, dtype=np.uint64)), part.shape[:2])
    for k in range(rows):
        key = _mix(key + part[:, :, k] * _ODD[k % len(_ODD)])
    return key.view(np.int64)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The probability Jaccard similarity of two weighted shingle sets, exactly.

    The sum over common shingles d of 1 / sum over all shingles e of
    max(a[e] / a[d], b[e] / b[d]); shingles of equal weight pair count together.
    """
    both, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    xa, xb = a[1][ia], b[1][ib]
    pairs, counts = np.unique(xa.astype(np.uint64) << U(32) | xb.astype(np.uint64), return_counts=True)
    only_a, only_b = a[1].sum() - xa.sum(), b[1].sum() - xb.sum()
    wa, wb = (pairs >> U(32)).astype(float), (pairs & U(0xFFFFFFFF)).astype(float)
    total = 0.0
    for x, y, n in zip(wa, wb, counts, strict=True):
        total += n / (only_a / x + only_b / y + (np.maximum(wa / x, wb / y) * counts).sum())
    return float(total)


class _Shelf:
    """Weighted shingle sets laid end to end, to compare one set with all of them at once."""

    def __init__(self, items: list[tuple[np.ndarray, np.ndarray]]):
        sizes = np.array([len(h) for h, _ in items])
        self.items, self.starts = items, np.cumsum(sizes) - sizes
        self.words, self.ids = np.unique(np.concatenate([h for h, _ in items]), return_inverse=True)
        self.weights = np.concatenate([w for _, w in items])
        self.totals = np.add.reduceat(self.weights, self.starts)
        self.plain = self.totals == sizes  # every shingle once
        self.shares = self.weights / np.repeat(self.totals, sizes)

    def similar(self, a: tuple[np.ndarray, np.ndarray], among: np.ndarray, threshold: float) -> np.ndarray:
        """Those of the sets numbered ``among`` whose similarity to ``a`` is ``threshold`` or more.

        Between sets that hold each shingle once it is the shared part of their
        union; for others the shared part of the weights' distributions is an
        upper bound, and ``probability_jaccard`` decides.
        """
        at = np.minimum(np.searchsorted(self.words, a[0]), len(self.words) - 1)
        there = self.words[at] == a[0]
        weight = np.zeros(len(self.words))
        weight[at[there]] = a[1][there]
        met, total = weight[self.ids], a[1].sum()
        common = np.add.reduceat(met > 0, self.starts, dtype=np.int64)[among]
        sure = common / (total + self.totals[among] - common) >= threshold
        plain = self.plain[among] & (total == len(a[0]))
        if plain.all():
            return among[sure]
        bound = np.add.reduceat(np.minimum(met / total, self.shares), self.starts)[among]
        keep = [
            k if p else b >= threshold - 1e-9 and probability_jaccard(a, self.items[j]) >= threshold
            for k, p, b, j in zip(sure, plain, bound, among, strict=True)
        ]
        return among[np.array(keep, bool)]


def _pack(item: tuple[np.ndarray, np.ndarray]) -> bytes:
    return item[0].astype("<u8").tobytes() + item[1].astype("<u4").tobytes()


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(data) // 12
    return np.frombuffer(data, "<u8", n), np.frombuffer(data, "<u4", n, 8 * n).astype(np.int64)


def _signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), 500):
            part = batch.iloc[at : at + 500]
            items = [shingles(bytes(t)) for t in part["text"]]
            keys = band_keys(registers(items))
            yield part[["doc_id", "text_key"]].assign(
                bands=[list(k) if len(i[0]) else [] for k, i in zip(keys, items, strict=True)]
            )


def _described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Fingerprint (a byte per register), band keys and packed shingles of each text."""
    for batch in batches:
        items = [shingles(bytes(t)) for t in batch["text"]]
        regs = np.concatenate([registers(items[k : k + 500]) for k in range(0, len(items), 500)]) if items else []
        marks = [_mix(r.astype(np.uint64)).astype(np.uint8).tobytes() for r in regs]
        bands = list(band_keys(regs)) if items else []
        yield pd.DataFrame({"tid": batch["tid"], "mark": marks, "bands": bands, "shingles": [_pack(i) for i in items]})


def _alike(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        keep = [
            np.mean(np.frombuffer(x, np.uint8) == np.frombuffer(y, np.uint8)) >= LIKELY
            for x, y in zip(batch["mark_a"], batch["mark_b"], strict=True)
        ]
        yield batch.loc[keep, ["a", "b"]]


def _tiles(threshold: float):
    """Links between different classes of two tiles of a bucket.

    A pair is compared in the first bucket that it shares only, and not if
    links found before already join its classes: so a link is left out only
    where it would change no class.
    """

    def side(tile) -> tuple:
        return (
            [r["tid"] for r in tile], np.array([r["cls"] for r in tile]),
            np.stack([np.frombuffer(r["mark"], np.uint8) for r in tile]), np.stack([r["bands"] for r in tile]),
            [_unpack(r["shingles"]) for r in tile],
        )

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for bucket, left, right in zip(batch["bucket"], batch["left"], batch["right"], strict=True):
                (ta, ca, ma, ba, sa), (tb, cb, mb, bb, sb) = side(left), side(right)
                joined, links, shelf = {}, [], _Shelf(sb)

                def find(c: int) -> int:
                    while (up := joined.get(c, c)) != c:  # noqa: B023
                        c = up
                    return c

                for k in range(len(ta)):
                    agree = (ma[k] == mb).mean(axis=1)
                    here = ba[k][(ba[k] == bb).argmax(axis=1)] == bucket
                    on = np.flatnonzero((ca[k] != cb) & (agree >= LIKELY) & here)
                    on = on[[find(int(c)) != find(int(ca[k])) for c in cb[on]]] if len(on) else on
                    for j in shelf.similar(sa[k], on, threshold) if len(on) else ():
                        one, two = find(int(ca[k])), find(int(cb[j]))
                        if one != two:
                            joined[one] = two
                            links.append((min(ta[k], tb[j]), max(ta[k], tb[j])))
                if links:
                    yield pd.DataFrame(links, columns=["a", "b"])

    return compare


def _similar(threshold: float):
    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = [
                probability_jaccard(_unpack(x), _unpack(y)) >= threshold
                for x, y in zip(batch["shingles_a"], batch["shingles_b"], strict=True)
            ]
            yield batch.loc[keep, ["a", "b"]]

    return check


def components(edges: DataFrame, name: str = "near-components") -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the least node of its component.

    Every node hooks to its least neighbour, pointers are doubled down to
    their roots, edges move to the roots; until no edge is left.
    """
    spark = edges.sparkSession
    edges = stored(edges.where("a <> b").select("a", "b"), name)
    roots = None
    while not edges.isEmpty():
        ways = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = stored(ways.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
                      .select("node", F.least("node", "low").alias("root")), name)
        while True:
            jump = hook.join(hook.select(F.col("node").alias("root"), F.col("root").alias("next")), "root")
            jump = stored(jump.select("node", "next", (F.col("next") != F.col("root")).alias("moved")), name)
            hook = jump.select("node", F.col("next").alias("root"))
            if jump.where("moved").isEmpty():
                break
        if roots is None:
            roots = hook
        else:
            moved = hook.select(F.col("node").alias("root"), F.col("root").alias("next"))
            old = roots.join(moved, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
            roots = stored(old, name)
        a = hook.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        b = hook.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = stored(edges.join(a, "a").join(b, "b").where("ra <> rb")
                       .select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), name)
    return spark.createDataFrame([], "node long, root long") if roots is None else roots


def _text_key() -> Column:
    """md5 of the words of the column ``text``, joined by single spaces."""
    run = rf"[\x09-\x0D]{SPACE}*|\x20{SPACE}+"
    words = F.trim(F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), run, " "))
    return F.unhex(F.md5(words.cast("binary")))


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, text (binary)."""
    return docs.select("doc_id", _text_key().alias("text_key"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def _links(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of similarity ``threshold`` or more."""
    def both(column: str) -> DataFrame:
        one = texts.select(F.col("tid").alias("a"), F.col(column).alias(f"{column}_a"))
        two = texts.select(F.col("tid").alias("b"), F.col(column).alias(f"{column}_b"))
        return pairs.join(one, "a").join(two, "b")

    pairs = stored(pairs.distinct(), "near-pairs")
    pairs = stored(both("mark").mapInPandas(_alike, "a long, b long"), "near-likely")
    return stored(both("shingles").mapInPandas(_similar(threshold), "a long, b long"), "near-links")


def near_classes(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """(row, doc_id, text_key, class) per row of ``docs``; rows of a class are linked by similarity, see ``near_dedup``."""
    python_ready(docs)
    kind = dict(docs.dtypes)["doc_id"]
    signed = _keyed(docs).mapInPandas(_signed, f"doc_id {kind}, text_key binary, bands array<long>")
    signed = stored(signed.withColumn("row", F.monotonically_increasing_id()), "near-signed")

    # One text per sequence of words; its id is the least row that has it.
    firsts = signed.where(F.size("bands") > 0).groupBy("text_key").agg(F.min("row").alias("tid"))
    firsts = stored(firsts, "near-firsts")
    heads = signed.join(firsts.select(F.col("tid").alias("row")), "row").select(
        F.col("row").alias("tid"), "doc_id", "text_key", "bands")
    each = stored(heads.select("tid", F.explode("bands").alias("bucket")), "near-bands")
    shared = each.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stored(each.join(stored(shared, "near-buckets"), "bucket"), "near-members")

    # The texts that share a bucket, described for comparing.
    weight = stored(members.groupBy("tid").agg(F.sum("n").alias("weight")), "near-weights")
    live = heads.join(weight.select("tid"), "tid").select("tid", "doc_id", "text_key").alias("l")
    again = _keyed(docs).alias("k")
    same = F.col("k.doc_id").eqNullSafe(F.col("l.doc_id")) & (F.col("k.text_key") == F.col("l.text_key"))
    wanted = again.join(live.hint("merge"), same).select("l.tid", "k.text")
    texts = stored(wanted.mapInPandas(_described, "tid long, mark binary, bands array<long>, shingles binary"), "near-texts")
    texts = stored(texts.dropDuplicates(["tid"]), "near-texts") if _repeats(signed) else texts

    # Every member of a bucket against the member with most company: one comparison each.
    ranked = members.join(weight, "tid")
    centre = F.max(F.struct("weight", F.negative("tid").alias("minus"))).alias("best")
    centres = stored(ranked.groupBy("bucket").agg(centre).select("bucket", F.negative("best.minus").alias("centre")), "near-centres")
    pairs = members.join(centres, "bucket").where("tid <> centre").select(
        F.least("tid", "centre").alias("a"), F.greatest("tid", "centre").alias("b"))
    links = _links(pairs, texts, threshold)

    # In buckets of several classes still, every member outside the largest class against every
    # member of another class: tile by tile, so that only links leave a task.
    roots = components(links)
    classed = members.join(roots.withColumnRenamed("node", "tid"), "tid", "left").select(
        "bucket", "tid", F.coalesce("root", "tid").alias("cls"))
    classed = stored(classed, "near-classed")
    per = stored(classed.groupBy("bucket", "cls").agg(F.count(F.lit(1)).alias("m")), "near-per-class")
    mixed = stored(
        per.groupBy("bucket").agg(F.count(F.lit(1)).alias("classes"), F.sum("m").alias("size"),
                                  F.max(F.struct("m", "cls")).alias("top"))
        .where("classes > 1").select("bucket", "size", F.col("top.cls").alias("top")),
        "near-mixed",
    )
    inside = stored(classed.join(mixed, "bucket"), "near-inside")
    lengths = texts.select("tid", F.octet_length("shingles").alias("bytes"))
    loads = inside.join(lengths, "tid").groupBy("bucket").agg(F.sum("bytes").alias("bytes"))
    tiles = loads.select("bucket", F.ceil(F.col("bytes") / TILE_BYTES).alias("by_bytes"))
    open_ = inside.join(stored(tiles, "near-loads"), "bucket").join(texts, "tid")
    count = F.greatest(F.col("by_bytes"), F.ceil(F.col("size") / TILE))
    tile, strips = F.pmod(F.xxhash64("tid", "bucket"), count).alias("tile"), F.ceil(count / STRIP).alias("strips")
    item = F.struct("tid", "cls", "mark", "bands", "shingles").alias("item")
    open_ = stored(open_.select("bucket", tile, strips, (F.col("cls") != F.col("top")).alias("outside"), item), "near-open")

    def packed(rows: DataFrame, name: str, own: str, other: str) -> DataFrame:
        """The tiles, each once for every strip of the other side."""
        tiles = stored(rows.groupBy("bucket", "tile", "strips").agg(F.collect_list("item").alias(name)), "near-tiles")
        strip = F.floor(F.col("tile") / STRIP).alias(own)
        return tiles.select("bucket", name, strip, F.explode(F.sequence(F.lit(0), F.col("strips") - 1)).alias(other))

    left, right = packed(open_.where("outside"), "left", "one", "two"), packed(open_, "right", "two", "one")
    pairs = left.join(right, ["bucket", "one", "two"])
    links = links.unionByName(stored(pairs.mapInPandas(_tiles(threshold), "a long, b long"), "near-links"))

    roots = components(links)
    named = firsts.join(roots.withColumnRenamed("node", "tid"), "tid", "left").select(
        "text_key", F.coalesce("root", "tid").alias("class"))
    named = stored(named, "near-named")
    joined = signed.select("row", "doc_id", "text_key", F.size("bands").alias("n")).join(named, "text_key", "left")
    # A text without words is a class of its own.
    return stored(joined.select("row", "doc_id", "text_key", F.coalesce("class", "row").alias("class")), "near-rows")


def _repeats(signed: DataFrame) -> bool:
    """True if a row is repeated with its id and words."""
    seen = signed.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n"))
    return not seen.where("n > 1").isEmpty()


def _verdicts(docs: DataFrame, threshold: float) -> DataFrame:
    rows = near_classes(docs, threshold)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("void"), "doc_id", "row", "text_key")).alias("first")
    groups = stored(rows.groupBy("class").agg(first, F.count(F.lit(1)).alias("class_size")), "near-groups")
    return rows.join(groups, "class").select(
        "doc_id",
        F.col("first.doc_id").alias("class_id"),
        F.col("class_size").cast("long").alias("class_size"),
        (F.col("first.row") == F.col("row")).alias("kept"),
        "text_key",
        (F.col("first.text_key") == F.col("text_key")).alias("keepers_text"),
    )


def near_dedup(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, class_id, class_size, kept.

    Rows linked by a similarity of ``threshold`` or more, directly or through
    others, form a class, named by its least doc_id (null ids sort last);
    that row is kept, of repeated rows with that id one.  Equal word
    sequences are always linked.  A text of one to four words is one
    shingle; null, empty and blank texts are classes of their own.  Other
    columns are ignored; an empty table gives an empty result.
    """
    return _verdicts(docs, threshold).drop("text_key", "keepers_text")


def near_unique(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that ``near_dedup`` keeps, with all their columns, whatever their names.

    Nulls, empty and blank texts, ties, repeated rows and an empty table are
    treated as there: of rows with the keeper's id and text one stays, rows
    with its id and another text go.
    """
    verdicts = stored(_verdicts(docs, threshold).where(~F.col("kept")), "near-verdicts")
    pairs = verdicts.select("doc_id", F.col("text_key").alias("key"),
                            (F.col("doc_id").eqNullSafe(F.col("class_id")) & F.col("keepers_text")).alias("again"))
    again = stored(pairs.where("again").select("doc_id", "key").distinct(), "near-repeats")
    left = without(docs, _text_key(), pairs.where("NOT again").select("doc_id", "key"))
    if again.isEmpty():
        return left
    return without(left, _text_key(), again).unionByName(first_of_repeats(only(left, _text_key(), again), _text_key()))
