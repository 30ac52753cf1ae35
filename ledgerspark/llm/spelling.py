"""Spelling variant grouping with a variable-length gram index.

A dictionary of grams is grown from the words: all grams of two letters, and
longer ones where the gram one letter shorter is frequent.  A word is cut
into the longest grams at each place that the dictionary has.  One edit can
change only some of a word's grams; their largest number over all places is
the word's *bound*.  Two words one edit apart share every gram beyond the
bound, so one of the ``bound + 1`` rarest grams of each: only these lists are
merged, and the members that meet are compared letter by letter.

Grams left of the edit keep their distance from the word's start, grams right
of it from its end, and the lengths differ by one at most: a list holds one
gram at one such place in words of one length.  Words so short that an edit
may change all their grams are taken up again with a dictionary of shorter
grams.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import python_ready, stored
from .grams import words_of

MIN_LETTERS = 6
MIN_COUNT = 5
#: A form occurs so many times as often as its variant.
RATIO = 5
#: One run in so many loses a letter.
DROP_ONE_IN = 199
#: Longest grams of the dictionaries, one after the other; the last makes every word's bound smaller than its grams.
LONGEST = (4, 3, 2)
SHORTEST = 2
#: A gram is lengthened if more than one word in so many has it: bounds the dictionary, whatever the words.
SHARE = 4000
#: Words of a list that are compared as one tile, and letters compared at once.
TILE = 2048
PAIR_BYTES = 1 << 23
#: Bytes of a run up to which its checksum is moved, not computed anew.
MOVED = 60
#: Distinct words held by a counting task before it hands them on.
HELD = 300_000

#: Latin-1 letters of the contract, lower-cased in A-Z; everything else divides words.
_TABLE = bytearray(b" " * 256)
for _c in (*range(97, 123), *range(0xC0, 0x100)):
    _TABLE[_c] = _c
for _c in range(65, 91):
    _TABLE[_c] = _c + 32
_TABLE = bytes(_TABLE)


def noisy_words(ids: list[str], texts: list[str], min_letters: int = MIN_LETTERS, one_in: int = DROP_ONE_IN) -> Counter:
    """How often each word (Latin-1 bytes) occurs in the texts, after the contract's deletions.

    The checksum of ``<id>:<run>`` is that of the run, moved by what the
    beginning makes of as many zero bytes (it is linear): a run's is computed once.
    """
    spaced = [t.encode("latin-1", "replace").translate(_TABLE) + b" " for t in texts]
    data = b"".join(spaced)
    hashes, begins, ends = words_of(data)
    on = ends - begins >= min_letters
    begins, ends = begins[on], ends[on]
    text = np.searchsorted(np.cumsum([len(t) for t in spaced]), begins, side="right")
    # Runs of one text chunk are told apart by 64-bit hashes.
    _, first, token = np.unique(hashes[on], return_index=True, return_inverse=True)
    runs = [data[a:b] for a, b in zip(begins[first].tolist(), ends[first].tolist(), strict=True)]
    whole = [w if w.isascii() else w.decode("latin-1").encode() for w in runs]
    sums, size = np.fromiter(map(zlib.crc32, whole), np.int64, len(runs)), np.fromiter(map(len, whole), np.int64, len(runs))
    starts = [zlib.crc32(f"{i}:".encode()) for i in ids]
    widths = np.unique(np.minimum(size, MOVED + 1))
    moves = np.array([[zlib.crc32(bytes(w), s) ^ zlib.crc32(bytes(w)) for w in widths.tolist()] for s in starts], np.int64)
    h = sums[token] ^ moves.reshape(len(texts), -1)[text, np.searchsorted(widths, np.minimum(size[token], MOVED + 1))]
    for k in np.flatnonzero(size[token] > MOVED).tolist():
        h[k] = zlib.crc32(whole[token[k]], starts[text[k]])
    hit = h % one_in == 0
    counts = np.bincount(token[~hit], minlength=len(runs))
    out = Counter({runs[k]: n for k, n in zip(np.flatnonzero(counts).tolist(), counts[counts > 0].tolist(), strict=True)})
    for k, c in zip(token[hit].tolist(), h[hit].tolist(), strict=True):
        run, at = runs[k], c % len(runs[k])
        if len(run) > min_letters:
            out[run[:at] + run[at + 1 :]] += 1
    return out


def _counted(min_letters: int, one_in: int):
    def rows(held: Counter) -> pd.DataFrame:
        return pd.DataFrame({"word": [w.decode("latin-1") for w in held], "n": list(held.values())})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = Counter()
        for batch in batches:
            held.update(noisy_words(batch["id"].tolist(), batch["text"].tolist(), min_letters, one_in))
            if len(held) >= HELD:
                yield rows(held)
                held.clear()
        if held:
            yield rows(held)

    return count


def word_counts(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, one_in: int = DROP_ONE_IN) -> DataFrame:
    """(word, n) of the words with enough letters and occurrences."""
    python_ready(docs)
    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    counts = texts.mapInPandas(_counted(min_letters, one_in), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return stored(counts.where(F.col("n") >= min_count), "spelling-words")


class Grams:
    """A gram dictionary (gram -> frequency) with the beginnings and endings of its grams."""

    def __init__(self, counts: dict[str, int]):
        self.counts = counts
        self.longest = max(map(len, counts), default=SHORTEST)
        self.heads = {g[:k] for g in counts for k in range(1, len(g))}
        self.tails = {g[k:] for g in counts for k in range(1, len(g))}

    def cut(self, word: str) -> list[tuple[int, int]]:
        """The word's grams (start, end): the longest at each place, without those inside the one before."""
        out, reach = [], 0
        for a in range(len(word) - SHORTEST + 1):
            b = next((b for b in range(min(a + self.longest, len(word)), a + SHORTEST, -1) if word[a:b] in self.counts), a + SHORTEST)
            if b > reach:
                out.append((a, b))
                reach = b
        return out

    def bound(self, word: str, grams: list[tuple[int, int]]) -> int:
        """The most grams that one edit can change, over all places.

        An edit at letter i (before it, for an insertion) changes the grams
        across it.  A gram before it may grow if its letters up to the edit
        begin a longer gram; a gram after it may vanish in a longer one if the
        letters from the edit to its end are the ending of one.
        """
        n = len(word)
        replaced, inserted = [0] * (n + 1), [0] * (n + 1)
        for a, b in grams:
            for i in range(a, b):
                replaced[i] += 1
                inserted[i] += i > a
            for i in range(b, min(a + self.longest, n + 1)):
                if word[a:i] in self.heads:
                    replaced[i] += i < n
                    inserted[i] += 1
            for after in range(max(b - self.longest + 1, 0), a + 1):
                if word[after:b] in self.tails:
                    inserted[after] += 1
                    if after:
                        replaced[after - 1] += 1
        return max(max(replaced), max(inserted))


#: A list's sides: words of one length (one letter replaced); the shorter and the longer word (one letter more).
SAME, SHORT, LONG = 0, 1, 2


def lists_of(word: str, grams: Grams) -> tuple[int, list[tuple[int, int]]]:
    """(grams beyond the bound, [(list, side)]): the lists of the word's ``bound + 1`` rarest grams."""
    cut = grams.cut(word)
    bound = grams.bound(word, cut)
    rarest = sorted(cut, key=lambda p: (grams.counts.get(word[p[0] : p[1]], 0), word[p[0] : p[1]], p))[: bound + 1]
    n, out = len(word), []
    for a, b in rarest:
        gram = word[a:b]
        for side, length, kind, at in ((SAME, n, "=", a), (SHORT, n, "s", a), (SHORT, n, "e", n - b),
                                       (LONG, n - 1, "s", a), (LONG, n - 1, "e", n - b)):
            out.append((xxhash.xxh64_intdigest(f"{kind}{length},{at},{gram}") - (1 << 63), side))
    return len(cut) - bound, out


def _gram_counts(longest: int):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held = Counter()
            for word in batch["word"]:
                held.update({word[a : a + k] for k in range(SHORTEST, longest + 1) for a in range(len(word) - k + 1)})
            if held:
                yield pd.DataFrame({"gram": list(held), "f": list(held.values())})

    return count


def gram_dictionary(words: DataFrame, longest: int, share: int = SHARE) -> Grams:
    """All grams of two letters, and longer ones whose beginning is in more than one word of ``share``.

    A word has no more grams of one length than letters, so at most
    ``share x mean length`` grams of each length are lengthened: the
    dictionary's size does not grow with the words.
    """
    counts = stored(words.mapInPandas(_gram_counts(longest), "gram string, f long").groupBy("gram").agg(F.sum("f").alias("f")), "spelling-grams")
    limit = words.count() // share
    head = counts.where(F.col("f") > limit).select(F.col("gram").alias("head"))
    longer = counts.where(F.length("gram") > SHORTEST).withColumn("head", F.expr("substring(gram, 1, length(gram) - 1)"))
    kept = counts.where(F.length("gram") == SHORTEST).select("gram", "f").unionByName(longer.join(head, "head").select("gram", "f"))
    return Grams({r["gram"]: r["f"] for r in kept.collect()})


def _listed(grams: Broadcast):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [lists_of(w, grams.value) for w in batch["word"]]
            yield pd.DataFrame({"word": batch["word"], "beyond": [b for b, _ in found], "list": [[k for k, _ in f] for _, f in found],
                                "side": [[s for _, s in f] for _, f in found]})

    return rows


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of two letter tables differ in exactly one letter."""
    return (a != b).sum(axis=1) == 1


def one_more(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Which rows of ``long`` are the rows of ``short`` with one letter more."""
    n = short.shape[1]
    ahead = np.cumprod(short == long[:, :n], axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64)
    behind = np.cumprod((short == long[:, 1:])[:, ::-1], axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64)
    return ahead + behind >= n


def _pairs(first: np.ndarray, end: np.ndarray, block: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, partner) with partners first..end-1 of each row, in blocks."""
    n = np.maximum(end - first, 0)
    total = np.cumsum(n)
    at, row = 0, 0
    while row < len(n):
        stop = max(int(np.searchsorted(total, at + block, side="right")), row + 1)
        rows = np.repeat(np.arange(row, stop), n[row:stop])
        partner = first[rows] + np.arange(len(rows)) - np.repeat(total[row:stop] - n[row:stop] - at, n[row:stop])
        if len(rows):
            yield rows, partner
        at, row = int(total[stop - 1]), stop


def _met(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """(a, b) of the words one edit apart among the rows of each list and tile pair.

    Rows: list, low, high, tile, side, settled, word; lists whole.  Only pairs
    with a settled word count here: the others come up in the next round.
    """
    letters = rows["word"].str.len().to_numpy()
    side, settled = rows["side"].to_numpy(), rows["settled"].to_numpy()
    group = rows.groupby(["list", "low", "high"], sort=False).ngroup().to_numpy()
    tile, cross = rows["tile"].to_numpy(), (rows["low"] != rows["high"]).to_numpy()
    # In a list, settled words come before the others, and shorter words before longer ones.
    order = np.lexsort((~settled, side, group))
    words = rows["word"].to_numpy()[order]
    letters, side, settled, group, tile, cross = (x[order] for x in (letters, side, settled, group, tile, cross))
    ends = np.searchsorted(group, group, side="right")
    here = np.arange(len(group))
    for length in np.unique(letters[side != LONG]):
        own = (letters == length) & (side != LONG)
        for kind, test in ((SAME, one_replaced), (SHORT, one_more)):
            mine = np.flatnonzero(own & (side == kind))
            if not len(mine):
                continue
            first = here[mine] + 1
            if kind == SAME:
                stop = np.where(settled[mine], ends[mine], first)
            else:  # the partners are the list's longer words
                first = np.searchsorted(group * 3 + side, group[mine] * 3 + LONG)
                stop = ends[mine]
            width = int(length) + (kind == SHORT)
            theirs = mine if kind == SAME else np.flatnonzero((side == LONG) & (letters == width))
            left = _table(words[mine], int(length))
            right = left if kind == SAME else _table(words[theirs], width)
            for row, partner in _pairs(first, stop, max(PAIR_BYTES // width, 1)):
                i = mine[row]
                fits = (settled[i] | settled[partner]) & (~cross[i] | (tile[i] != tile[partner]))
                row, i, partner = row[fits], i[fits], partner[fits]
                near = test(left[row], right[np.searchsorted(theirs, partner)])
                if near.any():
                    a, b = words[i[near]], words[partner[near]]
                    yield pd.DataFrame({"a": np.where(a < b, a, b), "b": np.where(a < b, b, a)})


def _table(words: np.ndarray, width: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), width)


def _merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by list and tiles; a list's tile pair is taken up when it is complete."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size < 4 * TILE:
            continue
        rows = pd.concat(held, ignore_index=True)
        last = rows.iloc[-1]
        done = ((rows["list"] != last["list"]) | (rows["low"] != last["low"]) | (rows["high"] != last["high"])).to_numpy()
        if done.any():
            yield from _met(rows[done])
            rows = rows[~done]
        held, size = [rows], len(rows)
    if size:
        yield from _met(pd.concat(held, ignore_index=True))


def near_words(words: DataFrame, longest: tuple[int, ...] = LONGEST, share: int = SHARE, tile: int = TILE) -> DataFrame:
    """(a, b) with a < b: the pairs of ``words`` (word) exactly one inserted, deleted or replaced letter apart."""
    spark = words.sparkSession
    rest, found = words.select("word"), None
    for k in longest:
        grams = spark.sparkContext.broadcast(gram_dictionary(rest, k, share))
        parts = rest.mapInPandas(_listed(grams), "word string, beyond int, list array<long>, side array<int>")
        parts = stored(parts, "spelling-parts")
        rows = parts.select("word", (F.col("beyond") > 0).alias("settled"), F.explode(F.arrays_zip("list", "side")).alias("p"))
        rows = rows.select("p.list", "p.side", "settled", "word")
        sizes = rows.groupBy("list").agg(F.count(F.lit(1)).alias("size"), F.max(F.col("settled").cast("int")).alias("s"))
        sizes = sizes.where("size > 1 AND s = 1").select("list", F.ceil(F.col("size") / tile).cast("int").alias("tiles"))
        tiled = rows.join(sizes, "list").withColumn("tile", F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int"))
        # Every two tiles of a long list meet in a group of their own.
        tiled = tiled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        tiled = tiled.select("list", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "tile", "side", "settled", "word")
        tiled = tiled.repartition("list", "low", "high").sortWithinPartitions("list", "low", "high")
        near = stored(tiled.mapInPandas(_merged, "a string, b string").distinct(), "spelling-near")
        found = near if found is None else found.unionByName(near)
        rest = parts.where("beyond <= 0").select("word")
        if rest.isEmpty():
            break
    else:
        raise ValueError("words so short that one edit may change all their grams")
    return found.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form): the last word on the way from form to form, by pointer doubling."""
    links = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = links.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = stored(moved, "spelling-roots")
        links = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return links


def spelling_variants(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, ratio: int = RATIO,
                      one_in: int = DROP_ONE_IN, longest: tuple[int, ...] = LONGEST, share: int = SHARE, tile: int = TILE) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Words are the runs of Latin letters of ``docs`` (doc_id, text), lower-cased
    in A-Z, one in ``one_in`` less a letter, that have ``min_letters`` letters
    and occur ``min_count`` times.  The form is the most frequent word one
    edit away (ties: the first in code-point order) if it occurs ``ratio``
    times as often; the root is the last of a chain of forms.  Null texts have
    no words; a null doc_id reads as an empty one; repeated rows count each
    time; texts and words of any length are read whole; other columns are
    ignored; an empty table gives an empty result.
    """
    if min_letters < SHORTEST + 3:
        raise ValueError(f"words need {SHORTEST + 3} letters")
    if ratio < 2:
        raise ValueError("a form must be more frequent than its variant")
    words = word_counts(docs, min_letters, min_count, one_in)
    near = stored(near_words(words, longest, share, tile), "spelling-pairs")
    both = near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b")))
    other = words.select(F.col("word").alias("b"), F.col("n").alias("near_n"))
    best = both.join(other, "b").groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "b")).alias("best"))
    rows = words.join(best, "word", "left").withColumn("is_form", -F.col("best.less") >= ratio * F.col("n"))
    rows = rows.select("word", F.when(F.col("is_form"), F.col("best.b")).alias("form"), "n",
                       F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                       F.when(F.col("is_form"), -F.col("best.less")).alias("form_n"))
    rows = stored(rows, "spelling-forms")
    last = roots(rows.where(F.col("form").isNotNull()))
    return rows.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
