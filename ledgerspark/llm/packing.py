"""Packing by power-of-two decomposition.

A document of n ids becomes floor(n / 4096) pieces of 4096 ids and, for the
rest, one piece per set bit of its length.  Every piece is a sequence of its
own, and sequences of equal length form a bucket: no sequence crosses
documents, and none needs padding.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, python_ready, stored

MAX_TOKENS = 4096
END_ID = 2
TOKENIZER = "word_bpe_49k.json"
#: Encoded words of late, and as many before them, kept per worker.
CACHE_ENTRIES = 100_000
#: Texts encoded together: bounds what a worker, reused by later stages, holds beside the cache.
TEXTS = 500

# The tokenizer's split pattern, for lower-case text of U+0021..U+00FF.
_LATIN = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]"
    r"|[^\sa-z0-9ªµºß-öø-ÿ²³¹¼-¾]+"
)
_PLAIN = re.compile(r"[\x21-\x7e¡-¬®-ÿ]+")
# A run of such marks after a word is one piece.
_MARKS = ".,;:!?()[]{}\"*#$%&|>-_/"


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class _Cache(dict):
    """Encoded strings by key, computed on first use.  When it is full, the strings are set aside, and
    those not used again until it is full once more are lost: frequent words stay."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode
        self.aside = {}

    def __missing__(self, key):
        value = self.aside.get(key)
        if value is None:
            value = self.encode(key)
        if len(self) >= CACHE_ENTRIES:
            self.aside = dict(self)
            self.clear()
        self[key] = value
        return value


def _is_word(chunk: str) -> bool:
    """Latin-1 letters only: one piece of the split pattern."""
    return chunk.isalpha() and (chunk.isascii() or _PLAIN.fullmatch(chunk) is not None)


class _Chunks(_Cache):
    """Encoded chunks.  A word with capitals, or with marks at its end, is found by the bare word and not kept itself."""

    def __missing__(self, key):
        word = key.rstrip(_MARKS)
        if len(word) < len(key):
            if word and _is_word(word):
                return self[word] + self[key[len(word) :]]
        elif not key.islower() and _is_word(key) and (word := key.lower()) != key:
            return self[word]
        return super().__missing__(key)


class WordEncoder:
    """Texts to little-endian uint32 ids, equal to the tokenizer's own.

    The tokenizer drops white space and never joins across it, so texts are
    encoded chunk by chunk (between spaces and line feeds) and chunks repeat:
    of many texts, each chunk is looked up once.  A chunk outside plain
    Latin-1 goes to the tokenizer as it is.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        letters = _byte_letters()
        # Printable ASCII stands for itself in the byte-level alphabet.
        self.alphabet = {c: "".join(letters[b] for b in chr(c).encode()) for c in range(0x80, 0x100)}
        self.chunks = _Chunks(self._chunk)

    def _piece(self, piece: str) -> bytes:
        tokens = self.model.tokenize(piece if piece.isascii() else piece.translate(self.alphabet))
        return array("I", [t.id for t in tokens]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if not chunk:
            return b""
        if _is_word(chunk):
            return self._piece(chunk.lower())
        if _PLAIN.fullmatch(chunk) and "<|" not in chunk:
            return b"".join(map(self._piece, _LATIN.findall(chunk.lower())))
        return array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: none), and where each text's begin, with their end at last."""
        lists = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        words = lists.flatten().dictionary_encode()
        found = list(map(self.chunks.__getitem__, words.dictionary.to_numpy(zero_copy_only=False).tolist()))
        place, at = words.indices.to_numpy(), lists.offsets.to_numpy()
        ids = np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter(map(len, found), np.int32, len(found)) // 4
        begins = np.cumsum(sizes, dtype=np.int32) - sizes
        # From the ids of the chunks to those of the texts: each word's run of ids.
        sizes = sizes[place]
        ends = np.cumsum(sizes, dtype=np.int32)
        runs = np.repeat(begins[place] - (ends - sizes), sizes)
        runs += np.arange(len(runs), dtype=np.int32)
        return ids[runs], np.append(np.int32(0), ends)[at - at[0]]

    def encode(self, text: str) -> bytes:
        return self.encode_all(pa.array([text], pa.string()))[0].tobytes()


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def cut(n: int, max_tokens: int = MAX_TOKENS) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids, longest first."""
    start = 0
    while n - start >= max_tokens:
        yield start, max_tokens
        start += max_tokens
    while start < n:
        length = 1 << (n - start).bit_length() - 1
        yield start, length
        start += length


def pieces(docs: DataFrame, max_tokens: int = MAX_TOKENS, tokenizer: str = TOKENIZER, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]) per piece; see ``pack``."""
    if max_tokens & (max_tokens - 1) or max_tokens < 1:
        raise ValueError("max_tokens must be a power of two")
    python_ready(docs)
    kind = dict(docs.dtypes)["doc_id"]
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    if with_ids:
        names, schema = [*names, "ids"], schema + ", ids array<long>"

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        enc = encoder(public_tokenizers.path(tokenizer))
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in (b.slice(k, TEXTS) for b in batches for k in range(0, len(b), TEXTS)):
            ids, at = enc.encode_all(batch.column("text"))
            rows: list[tuple] = []
            lists: list[np.ndarray] = []
            for k in range(len(batch)):
                data = ids[at[k] : at[k + 1]].tobytes() + end
                n = len(data) // 4
                for start, length in cut(n, max_tokens):
                    part = data[4 * start : 4 * (start + length)]
                    rows.append((k, start, length, zlib.crc32(part), n))
                    if with_ids:
                        lists.append(np.frombuffer(part, "<u4").astype(np.int64))
            row, *numbers = np.array(rows, np.int64).reshape(-1, 5).T
            columns = [batch.column("doc_id").take(pa.array(row)), *map(pa.array, numbers)]
            if with_ids:
                columns.append(pa.array(lists, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names)
            pa.default_memory_pool().release_unused()

    return docs.select("doc_id", "text").mapInArrow(split, schema)


def pack(docs: DataFrame, max_tokens: int = MAX_TOKENS, tokenizer: str = TOKENIZER, with_ids: bool = False) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text): the columns of ``pieces``, sequence_id, offset.

    Sequences are numbered from 0 bucket by bucket, longest first, then by
    doc_id (null ids first) and start; ``length`` names the bucket.  A null or
    empty text has the end id alone.  Rows repeated with an id are packed each
    for itself.  Other columns are ignored; an empty table gives an empty
    result.
    """
    made = stored(pieces(docs, max_tokens, tokenizer, with_ids), "pack-pieces")
    order = [F.col("length").desc(), F.col("doc_id"), F.col("start"), F.col("ids_crc32")]
    return numbered(made, order, "pack-order", "sequence_id").withColumn("offset", F.lit(0).cast("long"))
