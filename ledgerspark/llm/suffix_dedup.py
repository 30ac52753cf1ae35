"""Suffix-array dedup by bucket-pointer refinement.

A string of ``length`` bytes that starts at two places makes both removable.
Positions fall into buckets by the q-gram at a chosen place of the string,
buckets of one leave, and the others are refined by the buckets of longer and
longer strings around that place, until every start is decided.

Not every position is bucketed at first: a string is represented by the
q-gram of least hash in it, the same in every copy of the string, so a run
of neighbouring starts shares one representative (one row in about 185).
Such a run is decided as a whole where it can be, and split where it cannot:

* the *core*, common to all its strings, occurs once: none of them repeats;
* the *hull*, which spans all its strings, occurs again: all of them repeat;
* else its starts are cut into smaller ranges, refined in turn, with what
  the last round has settled.

Identifiers of strings are 128-bit hashes (64-bit for the first q-grams,
which only ever send starts on to the next round), made from running sums
over the text, so that those of all rounds cost a few array operations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import python_ready, stored

LENGTH = 400
GRAM = 32
#: Starts decided together in each round after the first; the last must be 1.
GRIDS = (64, 8, 1)
#: Starts scanned at once in a long text; positions in it fit the low 24 bits of a sort key.
CHUNK = 1 << 23

U = np.uint64
_BASE = 0x9E3779B97F4A7C15
SPAN = ["tid", "m", "low", "high"]
RUN = np.dtype([("m", "<i4"), ("first", "<i4"), ("last", "<i4"), ("gram", "<i8")])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> U(30)) * U(0xBF58476D1CE4E5B9)
    x = (x ^ x >> U(27)) * U(0x94D049BB133111EB)
    return x ^ x >> U(31)


def gram_buckets(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """The bucket of the ``gram`` bytes (a power of two) at each position.

    Doubling: the bucket of 2k bytes comes from the buckets of k bytes here and k further on.
    """
    x, step, factor = data.astype(np.uint64) + U(1), 1, _BASE
    while step < gram:
        x = x[:-step] * U(factor) + x[step:]
        step, factor = step * 2, factor * factor % (1 << 64)
    return _mix(x)


def runs(text: bytes, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """The runs (m, first, last, gram) of the starts 0..n-length: position and bucket of their common q-gram.

    A run that goes on in the next chunks is one run: two would count as two places.
    """
    n, wide = len(text) - length + 1, length - gram + 1
    found = []
    for at in range(0, n, CHUNK):
        data = np.frombuffer(text, np.uint8, min(CHUNK, n - at) + length - 1, at)
        bucket = gram_buckets(data, gram)
        low = bucket & ~U(0xFFFFFF) | np.arange(len(bucket), dtype=np.uint64)
        span = 1
        while span * 2 <= wide:
            low, span = np.minimum(low[:-span], low[span:]), span * 2
        if span < wide:
            low = np.minimum(low[: len(low) - (wide - span)], low[wide - span :])
        place = (low & U(0xFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        part = np.empty(len(first), RUN)
        part["m"], part["first"] = place[first] + at, first + at
        part["last"] = np.append(first[1:], len(place)) - 1 + at
        part["gram"] = bucket[place[first]].view(np.int64)
        if len(part) and found and found[-1]["m"][-1] == part["m"][0]:
            found[-1]["last"][-1] = part["last"][0]
            part = part[1:]
        if len(part):
            found.append(part)
    return np.concatenate(found) if found else np.empty(0, RUN)


_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_BYTE = [_mix(np.arange(256, dtype=np.uint64) + U(1000 * k + 1)) for k in (1, 2)]
_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def _powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each base its first n powers and those of its inverse, modulo 2^64; remembered."""
    if not _POWERS or len(_POWERS[0][0]) < n:
        size = 1 << max(n, 4096).bit_length()
        _POWERS.clear()
        for base in _BASES:
            both = []
            for value in (base, pow(base, -1, 1 << 64)):
                line = np.full(size, value, np.uint64)
                line[0] = 1
                both.append(np.cumprod(line, dtype=np.uint64))
            _POWERS.append((both[0], both[1]))
    return _POWERS


def names(text: np.ndarray, start: np.ndarray, end: np.ndarray, kind: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit numbers that identify the strings text[start:end] of each kind.

    Sums of the bytes' random numbers times powers of a base: any string's
    sum is a difference of two running sums, moved to the text's start.
    """
    found = []
    for table, (power, back) in zip(_BYTE, _powers(len(text) + 1), strict=True):
        sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(table[text] * power[: len(text)], out=sums[1:], dtype=np.uint64)
        found.append(_mix((sums[end] - sums[start]) * back[start] + kind.astype(np.uint64) * U(_BASE)).view(np.int64))
    return found


def _ranges(text: np.ndarray, m: np.ndarray, low: np.ndarray, high: np.ndarray, kind: np.ndarray, length: int):
    """Core and hull identifiers of the ranges of offsets low..high before m, and whether the hull is in the text.

    Long texts are read in chunks with the strings' reach on both sides.
    """
    core, hull = [np.empty(len(m), np.int64) for _ in "ab"], [np.empty(len(m), np.int64) for _ in "ab"]
    inside = (m - high >= 0) & (m - low + length <= len(text))
    for at in range(0, max(len(text), 1), CHUNK):
        on = np.flatnonzero((m >= at) & (m < at + CHUNK))
        if not len(on):
            continue
        left = max(0, at - length)
        part = text[left : at + CHUNK + 2 * length]
        a, b, k = m[on] - left - low[on], m[on] - left - high[on], kind[on]
        fits = inside[on]
        for out, start, end in ((core, a, b + length), (hull, np.where(fits, b, 0), np.where(fits, a + length, 0))):
            for line, value in zip(out, names(part, start, end, k), strict=True):
                line[on] = value
    return core, hull, inside


def _unpacked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), 1000):
            part = batch.iloc[at : at + 1000]
            rows = [np.frombuffer(r, RUN) for r in part["runs"]]
            table = np.concatenate(rows)
            if len(table):
                out = pd.DataFrame({name: table[name] for name in RUN.names})
                out.insert(0, "tid", np.repeat(part["tid"].to_numpy(), [len(r) for r in rows]))
                yield out


_NAMED = ["tid", "m", "low", "high", "settled", "core1", "core2", "hull1", "hull2", "inside"]
_NAMED_TYPES = ("tid long, m int, low int, high int, settled boolean, core1 long, core2 long, "
                "hull1 long, hull2 long, inside boolean")


def _round(grid: int, length: int, gram: int):
    """Cores and hulls of the ranges of ``grid`` offsets that the texts' open offsets fall into."""

    def name(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made, size = [], 0
            columns = [batch[c] for c in ("tid", "text", "m", "low", "high", "settled")]
            for tid, text, m, low, high, settled in zip(*columns, strict=True):
                m, low, high = (np.asarray(v, np.int64) for v in (m, low, high))
                first = low // grid
                n = high // grid - first + 1
                own = np.repeat(np.arange(len(m)), n)
                kind = first[own] + np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
                a, b, m = kind * grid, np.minimum(kind * grid + grid - 1, length - gram), m[own]
                core, hull, inside = _ranges(np.frombuffer(text, np.uint8), m, a, b, kind, length)
                made.append((np.full(len(own), tid), m, np.maximum(a, low[own]), np.minimum(b, high[own]),
                             np.asarray(settled, bool)[own], *core, *hull, inside))
                size += len(own)
                if size > 200_000:
                    yield pd.DataFrame(dict(zip(_NAMED, map(np.concatenate, zip(*made, strict=True)), strict=True)))
                    made, size = [], 0
            if made:
                yield pd.DataFrame(dict(zip(_NAMED, map(np.concatenate, zip(*made, strict=True)), strict=True)))

    return name


def _decide(named: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(repeated, open) of ranges with their core and hull.

    repeated: the ranges whose strings all occur again.  open: what the next
    round needs: undecided ranges, and of the repeated ones that share their
    core one of each hull (``settled``), as the undecided may repeat it.
    """
    core, hull = ["core1", "core2"], ["hull1", "hull2"]
    cores = named.groupBy(*core).agg(
        F.count(F.lit(1)).alias("n_core"), F.max((~F.col("settled")).cast("int")).alias("has_open"))
    cores = stored(cores.where("n_core > 1 AND has_open = 1").select(*core), "suffix-cores")
    hulls = named.where("inside").groupBy(*hull).agg(
        F.count(F.lit(1)).alias("n_hull"), F.min(F.struct("tid", "m")).alias("first"))
    hulls = stored(hulls.where("n_hull > 1").withColumn("inside", F.lit(True)), "suffix-hulls")
    judged = named.join(hulls, [*hull, "inside"], "left").withColumn("again", F.col("n_hull").isNotNull())
    judged = stored(judged.drop(*hull, "inside", "n_hull"), "suffix-judged")
    # Where a core is shared, one range of each repeated hull stands for all.
    stands = ~F.col("again") | ((F.col("first.tid") == F.col("tid")) & (F.col("first.m") == F.col("m")))
    ahead = judged.where(stands).join(cores, core, "left_semi")
    # Stored, so that AQE may split a hot core in the join, and the count below combines before its shuffle.
    ahead = stored(ahead.withColumn("settled", F.col("settled") | F.col("again")), "suffix-ahead")
    # A core left with settled ranges alone needs no further round.
    needed = ahead.groupBy(*core).agg(F.min(F.col("settled").cast("int")).alias("s")).where("s = 0").select(*core)
    needed = stored(needed, "suffix-needed")
    return judged.where(~F.col("settled") & F.col("again")), stored(
        ahead.join(needed, core, "left_semi").select("tid", "m", "low", "high", "settled"), "suffix-open")


def _cut(length: int):
    """What stays of each text without the strings at its repeated starts."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for tid, text, m, low, high in zip(*(batch[c] for c in ("tid", "text", "m", "low", "high")), strict=True):
                text, m = memoryview(text), np.asarray(m, np.int64)
                kept, removed, spans, end = hashlib.sha256(), 0, 0, 0
                start = 0  # of the stretch that is kept
                for first, last in sorted(zip((m - high).tolist(), (m - low).tolist(), strict=True)):
                    stop = last + length
                    if spans == 0 or first > end:
                        kept.update(text[start:first])
                        removed, spans = removed + stop - first, spans + 1
                        start = end = stop
                    elif stop > end:
                        removed += stop - end
                        start = end = stop
                kept.update(text[start:])
                rows.append((tid, removed, spans, kept.hexdigest()))
            yield pd.DataFrame(rows, columns=["tid", "n_removed", "n_spans", "kept_sha256"])

    return cut


def _items(rows: DataFrame, *columns: str) -> DataFrame:
    """A text's rows as aligned arrays, one per column; no more than the text has bytes."""
    packed = rows.groupBy("tid").agg(F.collect_list(F.struct(*columns)).alias("items"))
    return packed.select("tid", *[F.col(f"items.{c}").alias(c) for c in columns])


def _key() -> Column:
    return F.unhex(F.md5("data"))


def suffix_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, grids: tuple[int, ...] = GRIDS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte goes if it lies in a string of ``length`` UTF-8 bytes that also
    starts elsewhere in the input, in the same text or another.  Null counts
    as empty; texts shorter than ``length`` lose nothing; equal texts of at
    least that length lose everything.  Repeated rows are equal texts.  Other
    columns are ignored; an empty table gives an empty result.
    """
    if grids[-1] != 1 or gram & (gram - 1) or gram > length:
        raise ValueError("grids must end with 1; gram must be a power of two, at most length")
    python_ready(docs)
    source = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("data"))

    @F.pandas_udf("binary")
    def runs_of(texts: pd.Series) -> pd.Series:
        return pd.Series([runs(bytes(t), length, gram).tobytes() for t in texts], dtype=object)

    heads = stored(
        source.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", _key().alias("key"),
            F.octet_length("data").cast("long").alias("n_bytes"), F.sha2("data", 256).alias("sha"),
            runs_of("data").alias("runs"),
        ),
        "suffix-heads",
    )
    # Equal texts are one text with its number of copies.
    texts = stored(heads.groupBy("key").agg(F.min("row").alias("tid"), F.count(F.lit(1)).alias("copies")), "suffix-texts")
    firsts = heads.where(F.col("n_bytes") >= length).join(texts.select(F.col("tid").alias("row"), "copies"), "row")
    firsts = stored(firsts.select(F.col("row").alias("tid"), "doc_id", "key", "copies", "runs"), "suffix-firsts")

    run_type = "tid long, m int, first int, last int, gram long"
    grams = firsts.select("tid", "runs").mapInPandas(_unpacked, run_type)
    shared = stored(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram"), "suffix-grams")
    candidates = stored(grams.join(shared.hint("merge"), "gram"), "suffix-candidates")
    # In the first round a range is a whole run: its core is the q-gram.
    marks = candidates.select("tid", "m", (F.col("m") - F.col("last")).alias("low"), (F.col("m") - F.col("first")).alias("high"))
    wanted = firsts.select("tid", "doc_id", "key", "copies").join(_items(marks, *SPAN[1:]), "tid").alias("w")
    same = F.col("s.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("s.key") == F.col("w.key"))
    again = source.withColumn("key", _key()).alias("s")
    live = again.join(wanted.hint("merge"), same).select(
        "w.tid", F.col("s.data").alias("text"), *[f"w.{c}" for c in SPAN[1:]],
        F.transform("w.m", lambda m: F.col("w.copies") > 1).alias("settled"))
    live = stored(live, "suffix-live")
    if not heads.groupBy("doc_id", "key").count().where("count > 1").isEmpty():
        live = stored(live.dropDuplicates(["tid"]), "suffix-live")  # rows repeated with their id

    ranges, spans = live, []
    for grid in (length, *grids):
        named = stored(ranges.mapInPandas(_round(grid, length, gram), _NAMED_TYPES), "suffix-named")
        # In the last round the ranges are single strings, so that core and hull are one.
        repeated, open_ = _decide(named)
        spans.append(repeated.select(*SPAN))
        ranges = live.select("tid", "text").join(_items(open_, *SPAN[1:], "settled").hint("merge"), "tid")
    every = spans[0]
    for more in spans[1:]:
        every = every.unionByName(more)
    cut = live.select("tid", "text").join(_items(every, *SPAN[1:]).hint("merge"), "tid")
    cut = stored(cut.mapInPandas(_cut(length), "tid long, n_removed long, n_spans long, kept_sha256 string"), "suffix-cut")

    found = stored(texts.join(cut, "tid", "left").drop("tid"), "suffix-found")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    return heads.drop("runs").join(found, "key").select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )
