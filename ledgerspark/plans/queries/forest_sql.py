"""DuckDB SQL that grows the isolation forest and scores the test rows, level by level."""

from __future__ import annotations

from ...spec import FEATURE_COLUMNS, FOREST_SAMPLE, FOREST_TREES, SPLIT_SEED
from ..oracle import FEATURES_CTE, SPLIT_CTE, SPLIT_KEY_SQL, hash_key_sql, with_silver

DEPTH = (FOREST_SAMPLE - 1).bit_length()
WIDTH = len(FEATURE_COLUMNS)


def _draw(what: str) -> str:
    text = f"concat_ws('|', '{SPLIT_SEED}', CAST(tree AS VARCHAR), CAST(node AS VARCHAR), '{what}')"
    return f"(CAST(CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT) AS DOUBLE) / CAST({1 << 52} AS DOUBLE))"


def _lists(fn: str) -> str:
    return "[" + ", ".join(f"{fn}(x[{k}])" for k in range(1, WIDTH + 1)) + "]"


def _rows() -> str:
    x = "[" + ", ".join(f"CAST(coalesce({c}, 0) AS DOUBLE)" for c in FEATURE_COLUMNS) + "]"
    pool_key = hash_key_sql(SPLIT_KEY_SQL.replace(f"'{SPLIT_SEED}'", f"'{SPLIT_SEED}:pool'"))
    turn = hash_key_sql(f"concat_ws('|', '{SPLIT_SEED}:tree', CAST(tree AS VARCHAR), CAST(k AS VARCHAR))")
    share = f"least(1.0, CAST({2.0 * FOREST_TREES * FOREST_SAMPLE} AS DOUBLE) / n)"
    return f"""
part AS MATERIALIZED (SELECT step, name_orig, name_dest, amount, is_test, {x} AS x, {pool_key} AS k FROM split),
training AS (SELECT CAST(COUNT(*) AS DOUBLE) AS n FROM part WHERE NOT is_test),
pool AS (SELECT x, k, n FROM part, training WHERE NOT is_test AND k < CAST({share} * CAST({1 << 60} AS DOUBLE) AS BIGINT)),
offered AS (SELECT x, k, n, tree, {turn} AS t FROM pool, range({FOREST_TREES}) AS r(tree)),
r0 AS MATERIALIZED (
  SELECT tree, CAST(0 AS BIGINT) AS node, x FROM (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY t, k) AS rn FROM offered)
  WHERE rn <= least({FOREST_SAMPLE}, n))"""


def _level(d: int) -> str:
    varying = "list_concat(" * (WIDTH - 1) + "CASE WHEN hi[1] > lo[1] THEN [0] ELSE [] END"
    for k in range(2, WIDTH + 1):
        varying += f", CASE WHEN hi[{k}] > lo[{k}] THEN [{k - 1}] ELSE [] END)"
    picked = f"varying[CAST(floor({_draw('feature')} * len(varying)) AS BIGINT) + 1]"
    point = f"lo[feature + 1] + {_draw('point')} * (hi[feature + 1] - lo[feature + 1])"
    return f"""
s{d} AS (SELECT tree, node, COUNT(*) AS size, {_lists('min')} AS lo, {_lists('max')} AS hi FROM r{d} GROUP BY tree, node),
v{d} AS (SELECT *, {varying} AS varying FROM s{d}),
f{d} AS (SELECT *, CASE WHEN {d} < {DEPTH} AND len(varying) > 0 THEN {picked} END AS feature FROM v{d}),
p{d} AS (SELECT *, {point} AS point FROM f{d}),
n{d} AS MATERIALIZED (
  SELECT tree, node, feature, size, CASE WHEN point > lo[feature + 1] THEN least(point, hi[feature + 1])
    ELSE hi[feature + 1] END AS threshold FROM p{d}),
r{d + 1} AS MATERIALIZED (
  SELECT tree, 2 * node + CASE WHEN x[feature + 1] < threshold THEN 1 ELSE 2 END AS node, x
  FROM r{d} JOIN n{d} USING (tree, node) WHERE feature IS NOT NULL)"""


def _walk(d: int) -> str:
    return f"""
w{d + 1} AS MATERIALIZED (
  SELECT id, tree, 2 * node + CASE WHEN x[feature + 1] < threshold THEN 1 ELSE 2 END AS node, x
  FROM w{d} JOIN n{d} USING (tree, node) WHERE feature IS NOT NULL)"""


def _mean_path(n: str) -> str:
    return (f"CASE WHEN {n} > 2 THEN 2.0 * (ln({n} - 1.0) + CAST(0.5772156649015329 AS DOUBLE)) - 2.0 * ({n} - 1.0) / {n} "
            f"WHEN {n} = 2 THEN 1.0 ELSE 0.0 END")


_LEVELS = [_rows(), *[_level(d) for d in range(DEPTH + 1)]]

FOREST_NODES_SQL = with_silver(
    " UNION ALL ".join(
        f"SELECT CAST(tree AS INTEGER) AS tree, CAST(node AS INTEGER) AS node, CAST(coalesce(feature, -1) AS INTEGER) AS feature, "
        f"coalesce(threshold, 0.0) AS threshold, size, CAST({d} AS INTEGER) AS depth FROM n{d}"
        for d in range(DEPTH + 1)
    ),
    FEATURES_CTE, SPLIT_CTE, *_LEVELS,
)

FOREST_SCORES_SQL = with_silver(
    f"""SELECT step, name_orig, name_dest, amount,
  round(pow(2.0, -(total / {FOREST_TREES}.0) / ({_mean_path(f"CAST(least({FOREST_SAMPLE}, n) AS DOUBLE)")})), 6) AS score
FROM tests JOIN (SELECT id, SUM(path) AS total FROM paths GROUP BY id) USING (id), training""",
    FEATURES_CTE, SPLIT_CTE, *_LEVELS,
    "\ntests AS MATERIALIZED (SELECT *, row_number() OVER () AS id FROM part WHERE is_test)",
    f"\nw0 AS (SELECT id, tree, CAST(0 AS BIGINT) AS node, x FROM tests, range({FOREST_TREES}) AS r(tree))",
    *[_walk(d) for d in range(DEPTH)],
    "\npaths AS (" + " UNION ALL ".join(
        f"SELECT id, {d} + {_mean_path('CAST(size AS DOUBLE)')} AS path FROM w{d} JOIN n{d} USING (tree, node) WHERE feature IS NULL"
        for d in range(DEPTH + 1)) + ")",
)
