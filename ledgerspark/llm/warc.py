"""WARC archives: a writer (one gzip member per record) and a sequential reader.

The reader decompresses incrementally, one member after another, frames each
record by its Content-Length and checks its payload against the digest, all
in bounded memory whatever a record's length.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.session import scratch_path

from .common import python_ready, stored

#: Payloads of at least so many bytes are stored once; later ones revisit it.
MIN_REVISIT_BYTES = 0
#: An archive is closed once it has so many bytes.
ARCHIVE_BYTES = 256 * 1024 * 1024
READ_BYTES = 1 << 16
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def _file_system(path: str):
    """(file system, path in it) for a local path or any URI that pyarrow knows."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def _urn(page_id) -> str:
    return f"<urn:page:{page_id}>"


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC record as one gzip member."""
    lines = [f"{k}: {re.sub(r'[^!-~]+', '%20', v.strip()) if k.endswith('URI') else v}" for k, v in headers]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}", "", ""]).encode()
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def page_record(page: dict) -> bytes:
    """The record of a page (page_id, url, payload, digest, revisits, first_id, first_url)."""
    payload = page["payload"]
    own = page["page_id"]
    headers = [
        ("WARC-Type", "revisit" if page["revisits"] else "response"),
        ("WARC-Record-ID", _urn(own if own is not None else f"unnamed:{uuid.uuid4()}")),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", page["url"] or "urn:unknown"),
        ("WARC-Payload-Digest", f"sha1:{page['digest']}"),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if own is not None:
        headers.append(("X-Page-Id", str(own)))
    if page["revisits"]:
        headers += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", _urn(page["first_id"])),
            ("WARC-Refers-To-Target-URI", page["first_url"] or "urn:unknown"),
        ]
    return record(headers, HTTP_HEAD if page["revisits"] else HTTP_HEAD + payload)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def write_archives(pages: DataFrame, path: str, min_revisit_bytes: int = MIN_REVISIT_BYTES,
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives under ``path``; the manifest (archive, n_records).

    Each attempt of a task writes under names of its own, and only archives
    of the attempts that Spark accepted are in the manifest.  Null html is an
    empty payload.  Of equal payloads the smallest page_id is the response
    (a null id never is, unless all are null: then each is a response); rows
    repeated with that id are responses too.
    """
    python_ready(pages)
    base = pages.select(
        "page_id", F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("hex", F.sha1("payload"))
    firsts = stored(
        base.groupBy("hex", F.octet_length("payload").alias("n"))
        .agg(F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("first"),
             F.count(F.lit(1)).alias("copies"))
        .where((F.col("copies") > 1) & (F.col("n") >= min_revisit_bytes))
        .select("hex", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url")),
        "warc-firsts",
    )
    revisits = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    marked = base.join(firsts.hint("merge"), "hex", "left").select(
        "page_id", "url", "payload", "first_id", "first_url", revisits.alias("revisits"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, folder = _file_system(path)
        fs.create_dir(folder, recursive=True)
        out, name, n, size = None, "", 0, 0
        for batch in batches:
            batch = batch.astype(object).where(batch.notna(), None)
            for page in batch.to_dict("records"):
                if out is None:
                    name, n, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{folder}/{name}", compression=None)
                page["payload"] = bytes(page["payload"])
                data = page_record(page | {"digest": base32_sha1(page["payload"])})
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= archive_bytes:
                    out.close()
                    out = None
                    yield pd.DataFrame({"archive": [name], "n_records": [n]})
        if out is not None:
            out.close()
            yield pd.DataFrame({"archive": [name], "n_records": [n]})

    wide = marked.select(F.col("page_id").cast("string").alias("page_id"),
                         "url", "payload", F.col("first_id").cast("string").alias("first_id"), "first_url", "revisits")
    return stored(wide.mapInPandas(write, "archive string, n_records long"), "warc-manifest")


class WarcError(ValueError):
    """An archive that is not well formed, or a payload that differs from its digest."""


class _Member:
    """The decompressed bytes of one gzip member, read in steps."""

    def __init__(self, stream, start: bytes):
        self.stream, self.unread = stream, start
        self.unzip = zlib.decompressobj(31)
        self.ready = b""

    def more(self) -> bool:
        """Decompress a further step; False at the member's end."""
        while not self.unzip.eof:
            given = self.unzip.unconsumed_tail or self.unread or self.stream.read(READ_BYTES)
            if not given:
                raise WarcError("archive ends within a record")
            self.unread = b""
            got = self.unzip.decompress(given, READ_BYTES)
            if self.unzip.eof:
                self.unread = self.unzip.unused_data
            if got:
                self.ready += got
                return True
        return False

    def until(self, mark: bytes, at_most: int = 1 << 20) -> bytes:
        while (k := self.ready.find(mark)) < 0:
            if len(self.ready) > at_most or not self.more():
                raise WarcError("header without end")
        found, self.ready = self.ready[:k], self.ready[k + len(mark) :]
        return found

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.ready and not self.more():
                raise WarcError("record shorter than its Content-Length")
            part, self.ready = self.ready[:n], self.ready[n:]
            n -= len(part)
            yield part

    def rest(self) -> bytes:
        while self.more():
            if len(self.ready) > 4:
                break
        return self.ready


def _headers(data: bytes) -> tuple[str, dict[str, str]]:
    version, *lines = data.decode("utf-8", "replace").split("\r\n")
    return version, {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def read_records(stream, keep_payload: bool = False) -> Iterator[dict]:
    """The records of an archive in order: headers, payload_bytes, payload_digest and, if asked, payload.

    ``stream`` has read(n).  Raises WarcError on damage.
    """
    unread = stream.read(READ_BYTES)
    while unread:
        member = _Member(stream, unread)
        version, headers = _headers(member.until(b"\r\n\r\n"))
        if not version.startswith("WARC/"):
            raise WarcError(f"no WARC record: {version[:40]!r}")
        n, digest, kept, head = int(headers["content-length"]), hashlib.sha1(), [], b""
        http = "application/http" in headers.get("content-type", "")
        count, in_head = 0, http
        for part in member.take(n):
            if in_head:
                head += part
                k = head.find(b"\r\n\r\n")
                if k < 0:
                    continue
                part, in_head = head[k + 4 :], False
            digest.update(part)
            count += len(part)
            if keep_payload:
                kept.append(part)
        if member.rest() != b"\r\n\r\n":
            raise WarcError("record does not end where its Content-Length says")
        found = base64.b32encode(digest.digest()).decode()
        said = headers.get("warc-payload-digest", "").removeprefix("sha1:")
        if headers.get("warc-type") == "revisit":
            found, count = said, int(headers.get("x-payload-length", 0))
        elif said and said != found:
            raise WarcError(f"payload of {headers.get('warc-record-id')} differs from its digest")
        yield {"headers": headers, "payload_bytes": count, "payload_digest": found} | (
            {"payload": b"".join(kept)} if keep_payload else {})
        unread = member.unread or stream.read(READ_BYTES)


#: Most tasks that read archives; beyond that a task reads several.
READ_TASKS = 100_000


def read_archives(manifest: DataFrame, path: str, keep_payload: bool = False, id_type: str = "long") -> DataFrame:
    """One row per record of the manifest's archives under ``path``.

    page_id, url, payload_bytes, payload_digest, record_type, refers_to (and payload).
    """
    python_ready(manifest)
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    schema = "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string"
    if keep_payload:
        names, schema = [*names, "payload"], schema + ", payload binary"

    def row(r: dict) -> tuple:
        h = r["headers"]
        refers = h.get("warc-refers-to", "").removeprefix("<urn:page:").removesuffix(">") or None
        out = (h.get("x-page-id"), h.get("warc-target-uri"), r["payload_bytes"], r["payload_digest"], h["warc-type"], refers)
        return (*out, r["payload"]) if keep_payload else out

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, expected in zip(batch["archive"], batch["n_records"], strict=True):
                fs, folder = _file_system(path)
                rows, size, n = [], 0, 0
                with fs.open_input_stream(f"{folder}/{name}", compression=None) as stream:
                    for r in read_records(stream, keep_payload):
                        rows.append(row(r))
                        n, size = n + 1, size + len(r.get("payload", b""))
                        if len(rows) >= 5000 or size >= 1 << 24:
                            yield pd.DataFrame(rows, columns=names)
                            rows, size = [], 0
                if n != expected:
                    raise WarcError(f"{name} has {n} records, not {expected}")
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    # One archive is the unit of work.  The number keeps AQE from merging the tasks: the manifest is tiny, the archives are not.
    spread = manifest.repartition(min(max(manifest.count(), 1), READ_TASKS))
    found = spread.mapInPandas(read, schema)
    return found.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def warc_round_trip(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write ``pages`` as archives in the shared scratch folder and read them back; see the two steps.

    Extra columns are ignored; an empty table writes no archive.
    """
    path = scratch_path(pages.sparkSession, "warc")
    manifest = write_archives(pages, path, min_revisit_bytes)
    return read_archives(manifest, path, id_type=dict(pages.dtypes)["page_id"])
