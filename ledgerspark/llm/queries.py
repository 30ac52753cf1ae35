"""The registered query of each operator (``opN_<name>``), with its DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .collocations import collocations
from .exact_dedup import exact_dedup
from .langid import language_id
from .mixing import mix_taken
from .near_dedup import near_dedup
from .packing import pack
from .quality_rules import apply_policy, rule_ledger
from . import mixing, sharding
from .sharding import shard_rows
from .spelling import spelling_variants
from .suffix_dedup import suffix_dedup
from .suffix_trees import substring_dedup
from .toxicity import toxicity
from .warc import warc_round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return register


#: Steps and table of the CRC-32 register, one entry per byte.
CRC_CTE = """crc_steps AS (
      SELECT b, 0 AS k, b AS c FROM range(256) t(b)
      UNION ALL SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_steps WHERE k < 8
    ), crc_table AS (SELECT list(c ORDER BY b) AS tab FROM crc_steps WHERE k = 8)"""


def _crc_sql(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a non-empty text, beside ``crc_table``."""
    return f"""xor(list_reduce(list_prepend(4294967295,
               list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST('0x' || h AS BIGINT))),
               lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("op1_language_id")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(_table(spark, sf_dir, "documents"))


@_query("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query("op3_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"))


@_query(
    "op4_exact_dedup",
    r"""
    WITH n AS (
      SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
    )
    SELECT doc_id,
           min(doc_id) OVER (PARTITION BY t) AS keep_id,
           count(*) OVER (PARTITION BY t) AS group_size,
           doc_id = min(doc_id) OVER (PARTITION BY t) AS kept,
           sha256(t) AS text_sha256
    FROM n
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents"))


def _feistel_sql(value: str) -> str:
    """Four rounds of the network on a struct of halves ``l`` and ``r``, written out from its definition."""
    halves = f"{{'l': ({value}) >> w, 'r': ({value}) & ((1 << w) - 1)}}"
    for key in sharding._keys(sharding.SEED):
        steps = [
            f"(x.r * {sharding.MIX_A} + {key}) & 2147483647",
            "xor(t, t >> 15)",
            f"(t * {sharding.MIX_B}) & 2147483647",
            "xor(t, t >> 13)",
            "xor(t >> 3, t) & ((1 << w) - 1)",
        ]
        mixed = steps[0]
        for step in steps[1:]:
            mixed = f"list_transform([{mixed}], lambda t: {step})[1]"
        halves = f"list_transform([{halves}], lambda x: {{'l': x.r, 'r': xor(x.l, {mixed})}})[1]"
    return f"list_transform([{halves}], lambda x: (x.l << w) | x.r)[1]"


@_query(
    "op5_sharding",
    f"""
    WITH RECURSIVE {CRC_CTE}, sized AS (
      SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
             CASE WHEN coalesce(text, '') = '' THEN 0 ELSE {_crc_sql('text')} END AS crc
      FROM documents, crc_table
    ), numbered AS (
      SELECT doc_id, size, crc, row_number() OVER (ORDER BY doc_id NULLS FIRST, crc, size) - 1 AS row_no,
             count(*) OVER () AS n
      FROM sized
    ), walk AS (
      SELECT *, CAST(greatest(1, (SELECT min(b) FROM range(1, 32) t(b) WHERE power(4, b) >= n)) AS BIGINT) AS w,
             row_no AS place, FALSE AS moved FROM numbered
      UNION ALL
      SELECT doc_id, size, crc, row_no, n, w, {_feistel_sql('place')}, TRUE FROM walk WHERE NOT moved OR place >= n
    )
    SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'rows' AS law,
           CAST(place % {sharding.SHARDS} AS INTEGER) AS shard, CAST(place // {sharding.SHARDS} AS BIGINT) AS slot,
           CAST(NULL AS INTEGER) AS grown_shard, CAST(row_no AS BIGINT) AS row_no, CAST(place AS BIGINT) AS place
    FROM walk WHERE moved AND place < n
    """,
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(_table(spark, sf_dir, "documents"))


@_query(
    "op6_suffix_dedup",
    """
    WITH d AS (
      SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS b FROM documents
    ), named AS (
      SELECT rid, s, md5_number(b[s : s + 399]) AS h
      FROM (SELECT rid, b, unnest(range(1, octet_length(b) - 398)) AS s FROM d WHERE octet_length(b) >= 400)
    ), again AS (
      SELECT rid, s FROM named WHERE h IN (SELECT h FROM named GROUP BY h HAVING count(*) > 1)
    ), marked AS (
      SELECT rid, s, coalesce(s > lag(s) OVER (PARTITION BY rid ORDER BY s) + 400, TRUE) AS opens FROM again
    ), runs AS (
      SELECT rid, min(s) AS low, max(s) + 400 AS high
      FROM (SELECT rid, s, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY rid ORDER BY s) AS run FROM marked)
      GROUP BY rid, run
    ), kept AS (
      SELECT rid, low, high, coalesce(lag(high) OVER (PARTITION BY rid ORDER BY low), 1) AS since FROM runs
    ), cut AS (
      SELECT rid, count(*) AS n_spans, sum(high - low) AS n_removed, max(high) AS tail,
             string_agg(hex(b[since : low - 1]), '' ORDER BY low) AS head
      FROM kept JOIN d USING (rid) GROUP BY rid
    )
    SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
           CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
           sha256(CASE WHEN cut.rid IS NULL THEN b ELSE unhex(head || hex(b[tail : octet_length(b)])) END) AS kept_sha256
    FROM d LEFT JOIN cut USING (rid)
    """,
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(_table(spark, sf_dir, "documents"))


@_query(
    "op7_mixing",
    f"""
    WITH sized AS (
      SELECT row_number() OVER () AS rid, doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS key,
             CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
             md5(concat('{mixing.SEED}', coalesce(CAST(doc_id AS VARCHAR), ''))) AS draw
      FROM documents
    ), sums AS (SELECT key, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY key
    ), weighed AS (
      SELECT key, source_size, {mixing.MOST} * source_size AS most,
             list_value{mixing.WEIGHTS}[(row_number() OVER (ORDER BY key) - 1) % {len(mixing.WEIGHTS)} + 1] AS weight
      FROM sums
    ), total AS (SELECT CAST({mixing.SHARE} AS DOUBLE) * sum(source_size) AS total, sum(weight) AS weights FROM weighed
    ), steps AS (
      -- With the first sources, by size for their weight, at their bound: the level of the others.
      SELECT key, most / weight AS reach,
             (total - CAST(coalesce(sum(most) OVER before, 0) AS DOUBLE)) / CAST(weights - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS level
      FROM weighed, total
      WINDOW before AS (ORDER BY most / weight, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), found AS (SELECT arg_min(level, reach) AS level FROM steps WHERE reach > level
    ), targets AS (
      SELECT key, source_size,
             least(CAST(most AS DOUBLE), coalesce(level * weight, CAST(most AS DOUBLE))) AS target
      FROM weighed, found
    ), line AS (
      SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS words,
             coalesce(sum(size) OVER (PARTITION BY key ORDER BY draw, rid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM sized JOIN targets USING (key)
    )
    SELECT doc_id, size, source_size, target,
           CAST(CASE WHEN source_size = 0 THEN 0 ELSE (words // source_size) * size
             + greatest(0, least(size, words % source_size - start)) END AS BIGINT) AS taken
    FROM line
    """,
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_taken(_table(spark, sf_dir, "documents"))


@_query(
    "op8_warc",
    r"""
    WITH p AS (
      SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
    ), d AS (
      SELECT page_id, html, hex, min(page_id) OVER (PARTITION BY html) AS first,
             list_transform(range(0, 40, 1), lambda i: strpos('0123456789abcdef', hex[i + 1]) - 1) AS nib
      FROM p
    )
    SELECT page_id, strlen(html) AS payload_bytes,
           array_to_string(list_transform(range(0, 32), lambda k:
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
               1 + ((nib[1 + (5 * k) // 4] * 16 + CASE WHEN (5 * k) // 4 < 39 THEN nib[2 + (5 * k) // 4] ELSE 0 END)
                    // CAST(power(2, 3 - (5 * k) % 4) AS BIGINT)) % 32]), '') AS payload_digest,
           CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first THEN first END AS refers_to
    FROM d
    """,
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(_table(spark, sf_dir, "pages")).drop("url")


@_query("op9_near_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(_table(spark, sf_dir, "documents"))


@_query(
    "op10_quality_rules",
    r"""
    WITH d AS (
      SELECT doc_id, coalesce(text, '') AS text,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
      FROM documents
    ), w AS (
      SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d
    ), t AS (
      SELECT doc_id, i, w AS a, lead(w) OVER p AS b, lead(w, 2) OVER p AS c
      FROM w WINDOW p AS (PARTITION BY doc_id ORDER BY i)
    ), again AS (
      SELECT doc_id, i FROM t WHERE c IS NOT NULL
      QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1
    ), rep AS (
      SELECT doc_id, count(DISTINCT i + o) AS n FROM again, (VALUES (0), (1), (2)) AS v(o) GROUP BY doc_id
    ), m AS (
      SELECT d.doc_id, len(ws) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             coalesce(rep.n, 0) AS n_repeat_words, CAST(len(ls) AS BIGINT) AS n_lines,
             CAST(length(regexp_replace(text, '[^A-Z]', '', 'g')) AS BIGINT) AS n_upper
      FROM d LEFT JOIN rep USING (doc_id)
    ), b AS (
      SELECT *, CAST((n_words < 50) AS BIGINT) + 2 * CAST((100 * n_repeat_words > 50 * n_words) AS BIGINT)
        + 4 * CAST((10 * n_symbols > n_words) AS BIGINT) + 8 * CAST((10 * n_dup_lines > 3 * n_lines) AS BIGINT)
        + 16 * CAST((word_chars < 2 * n_words) AS BIGINT) + 32 * CAST((word_chars > 15 * n_words) AS BIGINT)
        + 64 * CAST((2 * n_upper > word_chars) AS BIGINT) AS fail_bits
      FROM m
    )
    SELECT *, fail_bits % 4 <> 0 AS base_failed, fail_bits = 0 AS kept, 2 AS policy FROM b
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_policy(rule_ledger(_table(spark, sf_dir, "documents")))


@_query(
    "op11_collocations",
    r"""
    WITH p AS (
      SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
      FROM documents
    ), w AS (
      SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p
    ), g AS (
      SELECT lang, m, unnest(list_transform(range(1, CAST(len(ws) AS BIGINT) - m + 2),
        lambda i: array_to_string(ws[i : i + m - 1], ' '))) AS phrase
      FROM w, (VALUES (1), (2), (3)) AS v(m)
    ), f AS (
      SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 10
    ), total AS (
      SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang
    ), c AS (
      SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE m > 1
    ), cut AS (
      SELECT c.lang, c.m, c.phrase, c.a, k, x.f AS l, y.f AS r,
             CAST(CAST(1000000 AS HUGEINT) * c.a * c.a // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
      FROM (SELECT *, unnest(range(1, m)) AS k FROM c) AS c
      JOIN f AS x ON x.lang = c.lang AND x.m = k AND x.phrase = array_to_string(ws[1 : k], ' ')
      JOIN f AS y ON y.lang = c.lang AND y.m = c.m - k AND y.phrase = array_to_string(ws[k + 1 : c.m], ' ')
    ), low AS (
      SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
    ), inner_ AS (
      SELECT lang, unnest([array_to_string(ws[1 : 2], ' '), array_to_string(ws[2 : 3], ' ')]) AS phrase, a
      FROM c WHERE m = 3
    ), cover AS (
      SELECT lang, phrase, max(a) AS cover FROM inner_ GROUP BY ALL
    ), ranked AS (
      SELECT low.*, row_number() OVER (PARTITION BY low.lang ORDER BY score DESC, a DESC, low.phrase) AS rank
      FROM low LEFT JOIN cover ON cover.lang = low.lang AND cover.phrase = low.phrase
      WHERE cover IS NULL OR 100 * cover < 50 * a
    )
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


@_query(
    "op12_substring_dedup",
    r"""
    WITH d AS (
      SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
    ), w AS (
      SELECT r, doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i, len(ws) AS n FROM d
    ), h AS (
      SELECT r, doc_id, i, n, md5(string_agg(w, ' ') OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)) AS h FROM w
    ), again AS (
      SELECT r, i FROM h WHERE i + 49 <= n QUALIFY min(doc_id) OVER (PARTITION BY h) < doc_id
    ), gone AS (
      SELECT DISTINCT r, unnest(range(i, i + 50)) AS i FROM again
    ), kept AS (
      SELECT w.r, string_agg(w.w, ' ' ORDER BY w.i) AS t, count(*) AS k FROM w ANTI JOIN gone USING (r, i) GROUP BY w.r
    )
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(k, 0) AS BIGINT) AS n_removed,
           sha256(coalesce(t, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (r)
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(_table(spark, sf_dir, "documents"))


@_query(
    "op13_spelling_variants",
    rf"""
    WITH RECURSIVE {CRC_CTE}, runs AS (
      SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
      FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
      GROUP BY ALL
    ), drawn AS (
      SELECT run, n, {_crc_sql("CAST(doc_id AS VARCHAR) || ':' || run")} AS h FROM runs, crc_table
    ), words AS (
      SELECT word, CAST(sum(n) AS BIGINT) AS n
      FROM (SELECT n, CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM drawn)
      WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
    ), cuts AS (
      SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS cut
      FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
    ), near AS (
      SELECT a.word, b.word AS other, b.n FROM cuts a JOIN cuts b ON a.i = b.i AND a.cut = b.cut AND a.word <> b.word
      UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.cut = b.word
      UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.cut = b.word
    ), best AS (
      SELECT word, count(*) AS n_near, arg_min(other, (-n, other)) AS other, max(n) AS other_n FROM near GROUP BY word
    ), formed AS (
      SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
             CASE WHEN other_n >= 5 * words.n THEN other END AS form, CASE WHEN other_n >= 5 * words.n THEN other_n END AS form_n
      FROM words LEFT JOIN best USING (word)
    ), followed AS (
      SELECT word, word AS root FROM formed
      UNION ALL SELECT followed.word, formed.form FROM followed JOIN formed ON followed.root = formed.word WHERE formed.form IS NOT NULL
    )
    SELECT formed.word, form, root, formed.n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n
    FROM formed JOIN followed ON formed.word = followed.word
    WHERE root IN (SELECT word FROM formed WHERE form IS NULL)
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(_table(spark, sf_dir, "documents"))
