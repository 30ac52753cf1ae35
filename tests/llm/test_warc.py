import base64
import gzip
import hashlib
import io
import random

import pytest

from ledgerspark.llm import warc as W

KINDS = "page_id long, url string, html string, kept string"


def rows():
    rng = random.Random(2)
    big = "".join(rng.choice("abc<>é\r\n") for _ in range(300_000))
    return [(1, "http://a/x y\n", "<p>one</p>", "k"), (2, None, None, "k"), (3, "http://c", "", "k"), (4, "u", big, "k"), (5, "u", big, "k"),
            (None, "http://n", "<p>one</p>", "k"), (1, "http://a/x y\n", "<p>one</p>", "k"), (6, "u", "WARC/1.1\r\n\r\n", "k")]


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    data = rows()
    got = W.warc_round_trip(spark.createDataFrame(data, KINDS), least).collect()
    first = {}
    for i, _, h, _ in data:
        h = h or ""
        if i is not None:
            first[h] = min(i, first.get(h, i))
    want = []
    for i, _, h, _ in data:
        h = h or ""
        again = i != first[h] and len(h.encode()) >= least
        digest = base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
        want.append((i, len(h.encode()), digest, "revisit" if again else "response", first[h] if again else None))
    key = lambda r: tuple(str(v) for v in r)
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r[n] for n in names) for r in got), key=key) == sorted(want, key=key)


def test_payloads_and_small_archives(spark, tmp_dir):
    pages = spark.createDataFrame(rows(), KINDS)
    manifest = W.write_archives(pages, tmp_dir, archive_bytes=10_000)
    assert manifest.count() > 1
    got = W.read_archives(manifest, tmp_dir, keep_payload=True).where("record_type = 'response' AND page_id = 4").collect()
    assert [bytes(r["payload"]).decode() for r in got] == [rows()[3][2]]


def one(payload=b"hello", digest=None):
    page = {"page_id": 7, "url": "http://x", "payload": payload, "revisits": False, "digest": digest or W.base32_sha1(payload)}
    return W.page_record(page)


def test_reader_reads_concatenated_members_in_small_steps(monkeypatch):
    monkeypatch.setattr(W, "READ_BYTES", 7)
    found = list(W.read_records(io.BytesIO(one() + one(b"") + one(b"x" * 5000)), keep_payload=True))
    assert [r["payload"] for r in found] == [b"hello", b"", b"x" * 5000]
    assert gzip.decompress(one()).startswith(b"WARC/1.1\r\n")


@pytest.mark.parametrize("damage", ["digest", "cut", "length", "no warc"])
def test_reader_rejects_damage(damage):
    if damage == "digest":
        data = one(digest="A" * 32)
    elif damage == "cut":
        data = one()[:-9]
    elif damage == "length":
        data = gzip.compress(gzip.decompress(one()).replace(b"Content-Length: ", b"Content-Length: 9"))
    else:
        data = gzip.compress(b"nonsense\r\n\r\n")
    with pytest.raises(W.WarcError):
        list(W.read_records(io.BytesIO(data)))


def test_empty_table(spark):
    assert W.warc_round_trip(spark.createDataFrame([], KINDS)).count() == 0


def test_archives_are_read_by_several_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    pages = spark.range(400).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.expr("repeat(md5(cast(id as string)), 40)").alias("html"))
    manifest = W.write_archives(pages, str(tmp_path), archive_bytes=3000)
    assert manifest.count() >= 4
    tasks = W.read_archives(manifest, str(tmp_path)).select(F.spark_partition_id().alias("p")).groupBy("p").count().count()
    assert tasks >= 3
