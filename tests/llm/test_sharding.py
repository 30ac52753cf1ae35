import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerspark.llm import sharding as S


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 65, 1000, 4097])
def test_permutation_and_inverse(n):
    p = S.permute(np.arange(n), n)
    assert sorted(p) == list(range(n))
    assert (S.unpermute(p, n) == np.arange(n)).all()


def test_rows_spread_evenly():
    p = S.permute(np.arange(80_000), 80_000)
    counts = np.histogram2d(p // 10_000, np.arange(80_000) // 10_000, bins=8)[0]
    assert abs(counts - 1250).max() < 200


def test_shards(make_docs, awkward):
    rows = S.shard_rows(make_docs(awkward)).collect()
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.get(k, 0) for k in range(8)) <= 1
    for k in sizes:
        assert sorted(r["slot"] for r in rows if r["shard"] == k) == list(range(sizes[k]))
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in awkward)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    assert {r["law"] for r in rows} == {"rows"} and {r["grown_shard"] for r in rows} == {None}


def test_reproducible_whatever_the_partitions(make_docs):
    rows = [(k, f"text {k}") for k in range(300)]
    one = S.shard_rows(make_docs(rows).repartition(1)).select("doc_id", "shard", "slot").collect()
    many = S.shard_rows(make_docs(rows).repartition(13)).select("doc_id", "shard", "slot").collect()
    assert Counter(one) == Counter(many)


def test_written_shards_are_in_slot_order(spark, make_docs, tmp_dir):
    docs = make_docs([(k, f"text {k}") for k in range(100)], extra=False)
    S.write_shards(docs, tmp_dir, shards=4)
    back = spark.read.parquet(tmp_dir)
    assert back.count() == 100 and {r[0] for r in back.select("shard").distinct().collect()} == {0, 1, 2, 3}


def test_empty_table(make_docs):
    assert S.shard_rows(make_docs([])).count() == 0
