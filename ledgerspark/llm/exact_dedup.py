"""Exact dedup by deterministic block naming (DataFrame operations only).

A normalised text is cut into blocks of ``block_bytes`` bytes.  Distinct
blocks are sorted and numbered; the numbers of adjacent blocks form pairs,
distinct pairs are sorted and numbered in turn, and so on until each
document has one number.  Equal numbers at equal level mean equal texts, by
construction and without any chance of a collision.

A 64-bit hash of each block serves only to let documents leave early: a
block whose hash occurs once occurs once, so its document has no copy.
Everything that stays is compared by content.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, first_of_repeats, stored, without

BLOCK_BYTES = 4096


def _normal() -> Column:
    """The column ``text`` with one space for each separator run, as UTF-8; a lone space already is that."""
    run = rf"[\x09-\x0D]{SPACE}*|\x20{SPACE}+"
    return F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), run, " ").cast("binary")


def _blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """(doc_id, text_sha256, blocks): the normalised text as an array of binary blocks."""
    norm = docs.select("doc_id", _normal().alias("bin"))
    last = F.greatest(F.ceil(F.octet_length("bin") / block_bytes).cast("int"), F.lit(1)) - 1
    return norm.select(
        "doc_id",
        F.sha2("bin", 256).alias("text_sha256"),
        F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.substring(F.col("bin"), i * block_bytes + 1, F.lit(block_bytes)),
        ).alias("blocks"),
    )


def _numbered_names(distinct: DataFrame, keys: list[str], then: list[str], name: str) -> DataFrame:
    """Integer names in the order of ``keys`` and ``then``; unique, with gaps between range partitions."""
    ranked = distinct.repartitionByRange(*keys).sortWithinPartitions(*keys, *then)
    return stored(ranked.withColumn("name", F.monotonically_increasing_id()), name)


def text_classes(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """(heads, classes).

    heads: every row as (row, doc_id, text_sha256).  classes: (doc_id,
    text_sha256, level, name) for the rows that may have a copy; equal
    (level, name) means equal normalised text.
    """
    heads = stored(
        _blocks(docs, block_bytes).select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            "text_sha256",
            F.transform("blocks", lambda b: F.xxhash64(b)).alias("hashes"),
        ),
        "exact-heads",
    )
    each = heads.select("row", F.posexplode("hashes").alias("i", "h"))
    # A block alone in the corpus proves its document unique.  The place in
    # the document is part of the key: copies agree in it.
    seen = stored(
        each.groupBy("h", "i").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h", "i"),
        "exact-seen",
    )
    shared = each.join(seen, ["h", "i"]).groupBy("row").agg(F.count(F.lit(1)).alias("n_shared"))
    live = stored(
        heads.join(shared, "row")
        .where(F.col("n_shared") == F.size("hashes"))
        .select("doc_id", "text_sha256")
        .distinct(),
        "exact-live",
    )

    again = _blocks(docs, block_bytes).alias("b")
    same = F.col("b.doc_id").eqNullSafe(F.col("l.doc_id")) & (F.col("b.text_sha256") == F.col("l.text_sha256"))
    content = stored(
        again.join(live.alias("l").hint("merge"), same, "left_semi").select(
            "doc_id", "text_sha256", F.monotonically_increasing_id().alias("text_no"), "blocks"
        ),
        "exact-content",
    )
    who = content.select("doc_id", "text_sha256", "text_no")
    parts = content.select(
        "text_no", F.size("blocks").alias("n"), F.posexplode("blocks").alias("i", "block")
    )
    # The hash leads the order, so that choosing range bounds samples numbers and no blocks.
    distinct = parts.select("block").distinct().withColumn("h", F.xxhash64("block"))
    names = _numbered_names(distinct, ["h"], ["block"], "exact-names").drop("h")
    now = stored(parts.join(names, "block").select("text_no", "n", "i", "name"), "exact-level")

    level, done = 0, []
    while True:
        done.append(now.where("n = 1").select("text_no", F.lit(level).alias("level"), "name"))
        rest = now.where("n > 1")
        if rest.isEmpty():
            break
        level += 1
        half = F.floor(F.col("i") / 2).cast("int")
        pairs = stored(
            rest.groupBy("text_no", half.alias("i"))
            .agg(
                F.first("n").alias("n"),
                F.max(F.when(F.col("i") % 2 == 0, F.col("name"))).alias("left"),
                # An odd last block has no neighbour; names start at 0.
                F.coalesce(F.max(F.when(F.col("i") % 2 == 1, F.col("name"))), F.lit(-1)).alias("right"),
            )
            .withColumn("n", F.floor((F.col("n") + 1) / 2).cast("int")),
            "exact-pairs",
        )
        names = _numbered_names(pairs.select("left", "right").distinct(), ["left", "right"], [], "exact-names")
        now = stored(pairs.join(names, ["left", "right"]).select("text_no", "n", "i", "name"), "exact-level")
    roots = done[0]
    for more in done[1:]:
        roots = roots.unionByName(more)
    # A row repeated with its id has its text in `content` twice, under one name.
    classes = who.join(roots, "text_no").select("doc_id", "text_sha256", "level", "name").distinct()
    return heads.select("row", "doc_id", "text_sha256"), stored(classes, "exact-classes")


def exact_dedup(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of separators became one
    space; a null text counts as empty, and an empty text equals other empty
    texts.  The smallest doc_id stays (null ids sort last); of rows repeated
    with that id exactly one stays.  Other columns are ignored; an empty
    table gives an empty result.
    """
    heads, classes = text_classes(docs, block_bytes)
    h, c = heads.alias("h"), classes.alias("c")
    same = F.col("h.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("h.text_sha256") == F.col("c.text_sha256"))
    members = stored(h.join(c, same).select("h.row", "h.doc_id", "level", "name"), "exact-members")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("void"), "doc_id", "row")).alias("first")
    groups = stored(
        members.groupBy("level", "name").agg(first, F.count(F.lit(1)).alias("group_size")), "exact-groups"
    )
    verdicts = members.join(groups, ["level", "name"]).select("row", "first", "group_size")
    return heads.join(verdicts, "row", "left").select(
        "doc_id",
        F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("first.row") == F.col("row"), F.lit(True)).alias("kept"),
        "text_sha256",
    )


def exact_unique(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, with all their columns."""
    verdicts = stored(exact_dedup(docs, block_bytes).where(~F.col("kept")), "exact-verdicts")
    again = F.col("doc_id").eqNullSafe(F.col("keep_id"))  # a repeat of the row that stays
    key = F.sha2(_normal(), 256)
    left = without(docs, key, verdicts.where(~again).select("doc_id", F.col("text_sha256").alias("key")))
    return left if verdicts.where(again).isEmpty() else first_of_repeats(left, key)
