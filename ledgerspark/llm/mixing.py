"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are shuffled into one line of words and cut into
blocks of equal length.  Slot t of the mix falls to the source whose share of
the unit interval holds the golden-ratio point of t; the k-th slot of a source
takes its k-th block, beginning anew at the end of the line.  Every prefix of
the mix is thereby close to the target weights, and a source's total is its
target to the word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, numbered, running_total, stored

BLOCK_WORDS = 1024
SHARE = 1.5
MOST = 2
WEIGHTS = (3, 1, 2)
SEED = "mix-1"
#: Points live on a grid of 2^31; the multiplier is the odd number next to 2^31 / golden ratio.
GRID_BITS = 31
GOLDEN = 1327217885
CELL_BITS = 19


def point(t: Column) -> Column:
    """The golden-ratio point of slot t as an integer below 2^31."""
    grid = F.lit(1 << GRID_BITS)
    return (t % grid) * F.lit(GOLDEN) % grid


def _source_key(source: Column) -> Column:
    """Sources in code point order, null last; never null itself."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def source_targets(sized: DataFrame, share: float = SHARE, most: float = MOST, weights: tuple = WEIGHTS) -> DataFrame:
    """(key, source_size, target) per source: weights in turn, no target above ``most`` times its size.

    A target is min(most * size, level * weight); the level rises while
    sources reach their bound, until all targets add up.
    """
    sums = stored(sized.groupBy("key").agg(F.sum("size").alias("source_size")), "mix-sources")
    turn = F.col("nr") % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))
    ranked = stored(
        numbered(sums, ["key"], "mix-ranks", "nr").select(
            "key", "source_size", weight.alias("weight"), (F.col("source_size") * F.lit(most)).alias("most")
        ),
        "mix-weights",
    )
    total = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, bound = 0.0, -1
    while True:
        over = F.col("most") <= level * F.col("weight")
        full, free, n = ranked.agg(
            F.sum(F.when(over, F.col("most")).otherwise(0)),
            F.sum(F.when(over, 0).otherwise(F.col("weight"))),
            F.sum(over.cast("int")),
        ).first()
        if not free or n == bound:
            break
        level, bound = (total - full) / free, n
    target = F.least(F.col("most").cast("double"), F.lit(level) * F.col("weight"))
    if not free:  # every source is at its bound
        target = F.col("most").cast("double")
    return ranked.select("key", "source_size", target.alias("target"))


def mix(docs: DataFrame, share: float = SHARE, most: float = MOST, weights: tuple = WEIGHTS,
        block_words: int = BLOCK_WORDS, seed: str = SEED, keep_text: bool = False) -> tuple[DataFrame, DataFrame]:
    """(documents, pieces) of the mix of ``docs`` (doc_id, text, source).

    documents: row_no, doc_id, source, size, source_size, target (and, with
    ``keep_text``, every column of ``docs`` in the struct ``doc``).  pieces:
    slot, row_no, epoch, first_word, end_word -- the words of a document that
    a slot takes, in the order of the mix.

    Null text: no words.  Null source: a source of its own, the last.  Rows
    repeated with an id count each for itself; a source without words has
    target 0; an empty table gives empty results.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    whole = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")] if keep_text else []
    sized = stored(
        docs.select(
            F.monotonically_increasing_id().alias("row_no"),
            "doc_id",
            "source",
            _source_key(F.col("source")).alias("key"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("crc"),
            F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("draw"),
            *whole,
        ),
        "mix-sized",
    )
    light = sized.select("row_no", "key", "size", "crc", "draw")
    targets = stored(source_targets(light, share, most, weights), "mix-targets")

    # The words each source gives, and the blocks that takes: whole passes, then part of one.
    per_pass = F.ceil(F.col("source_size") / block_words)
    rest = F.col("words") % F.col("source_size")
    quota = stored(
        targets.withColumn("words", F.floor(F.col("target") + 0.5).cast("long"))
        .where("words > 0")
        .withColumn("passes", F.floor(F.col("words") / F.col("source_size")))
        .withColumn("rest", rest)
        .withColumn("per_pass", per_pass)
        .withColumn("n_slots", F.col("passes") * per_pass + F.ceil(F.col("rest") / block_words)),
        "mix-quota",
    )
    n_slots = quota.agg(F.sum("n_slots")).first()[0] or 0
    bounds = _bounds(quota, n_slots)
    cell = F.explode(F.sequence(F.shiftright("low", CELL_BITS), F.shiftright(F.col("high") - 1, CELL_BITS)))
    cells = bounds.where("high > low").select("key", "low", "high", cell.alias("cell"))
    points = spark.range(n_slots).select(F.col("id").alias("t"), point(F.col("id")).alias("p"))
    points = points.withColumn("cell", F.shiftright("p", CELL_BITS))
    drawn = points.join(cells, "cell").where("p >= low AND p < high").select("key", "t", F.lit(1).alias("one"))
    ranks = stored(running_total(drawn, "key", [F.col("t")], "one", "mix-slots", "k"), "mix-ranked")

    # A source drawn too rarely (by a few slots, as the points are not exact) gets its last slots at the end.
    drawn_n = ranks.groupBy("key").agg(F.count(F.lit(1)).alias("n_drawn"))
    late = (
        quota.join(drawn_n, "key", "left")
        .withColumn("n_drawn", F.coalesce("n_drawn", F.lit(0)))
        .where("n_drawn < n_slots")
        .select("key", F.explode(F.sequence(F.col("n_drawn"), F.col("n_slots") - 1)).alias("k"))
        .select("key", (F.lit(n_slots) + F.col("k")).alias("t"), "k")
    )
    slots = (
        ranks.select("key", "t", "k").unionByName(late).join(quota.drop("target"), "key").where("k < n_slots")
        .withColumn("epoch", F.floor(F.col("k") / F.col("per_pass")))
        .withColumn("block", F.col("k") % F.col("per_pass"))
        .select("key", F.col("t").alias("slot"), "epoch", "block",
                F.when(F.col("epoch") == F.col("passes"), F.col("rest")).otherwise(F.col("source_size")).alias("stop"))
    )

    line = running_total(light, "key", [F.col(c) for c in ("draw", "crc", "size", "row_no")], "size", "mix-line", "start")
    line = line.withColumn("end", F.col("start") + F.col("size")).where("size > 0")
    first, last = F.floor(F.col("start") / block_words), F.floor((F.col("end") - 1) / block_words)
    parts = line.select("key", "row_no", "start", "end", F.explode(F.sequence(first, last)).alias("block"))
    low = F.greatest(F.col("start"), F.col("block") * block_words)
    high = F.least(F.col("end"), (F.col("block") + 1) * block_words, F.col("stop"))
    taken = parts.join(slots, ["key", "block"]).where(low < high).select(
        "slot", "row_no", "epoch", (low - F.col("start")).alias("first_word"), (high - F.col("start")).alias("end_word")
    )
    keep = ["row_no", "doc_id", "source", "size", "source_size", "target"] + (["doc"] if keep_text else [])
    return sized.join(targets, "key").select(*keep), taken


def _bounds(quota: DataFrame, n_slots: int) -> DataFrame:
    """Each source's part [low, high) of the grid, in proportion to its slots."""
    line = running_total(quota.withColumn("all", F.lit("all")), "all", [F.col("key")], "n_slots", "mix-bounds", "before")
    scale = float(1 << GRID_BITS) / max(n_slots, 1)
    return line.select(
        "key",
        F.round(F.col("before") * F.lit(scale)).cast("long").alias("low"),
        F.round((F.col("before") + F.col("n_slots")) * F.lit(scale)).cast("long").alias("high"),
    )


def mix_taken(docs: DataFrame, **params) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken; see ``mix``."""
    documents, taken = mix(docs, **params)
    words = taken.groupBy("row_no").agg(F.sum(F.col("end_word") - F.col("first_word")).alias("taken"))
    return documents.join(words, "row_no", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def mix_documents(docs: DataFrame, **params) -> DataFrame:
    """The mix as documents: the columns of ``docs``, a row for each time a document is taken.

    A document taken in part (one per source at most) has its text cut to
    the taken words, joined by single spaces; an ``n_chars`` column follows.
    """
    documents, taken = mix(docs, keep_text=True, **params)
    times = taken.groupBy("row_no", "epoch").agg(F.max("end_word").alias("n_taken"))
    rows = documents.select("row_no", "size", "doc").join(times.hint("merge"), "row_no")
    some = F.concat_ws(" ", F.slice(F.regexp_extract_all("doc.text", F.lit(WORD), F.lit(0)), 1, F.col("n_taken").cast("int")))
    text = F.when(F.col("n_taken") < F.col("size"), some).otherwise(F.col("doc.text"))
    kinds = dict(docs.dtypes)

    def column(c: str) -> Column:
        if c == "text":
            return text.alias(c)
        if c == "n_chars":
            return F.char_length(text).cast(kinds[c]).alias(c)
        return F.col("doc").getField(c).alias(c)

    return rows.select(*[column(c) for c in docs.columns])
