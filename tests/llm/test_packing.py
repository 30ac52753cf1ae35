import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ledgerspark.llm import packing as P

PATH = public_tokenizers.path(P.TOKENIZER)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_encoder_equals_the_tokenizer(tokenizer, awkward):
    rng = random.Random(5)
    letters = "abcXYZéÀßµª²½0129'.,!|<>-_ \n\t\r\x0b\x1c\x85\xa0\xad́’漢ΣσIİﬁ🙂"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 60))) for _ in range(400)]
    texts += ["it's DON'T we'll I'd 'S", "<|endoftext|> a<|startoftext|>b", "é café", *[t or "" for _, t in awkward]]
    enc = P.WordEncoder(PATH)
    for t in texts:
        want = tokenizer.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == want, t


def test_frequent_words_stay_in_a_full_cache(monkeypatch):
    monkeypatch.setattr(P, "CACHE_ENTRIES", 50)
    encoded = []
    cache = P._Cache(lambda key: encoded.append(key) or key.encode())
    for k in range(1000):  # 20 times as many rare words as it holds
        assert cache[f"rare{k}"] == f"rare{k}".encode() and cache[f"often{k % 10}"] == f"often{k % 10}".encode()
        assert len(cache) <= 50
    assert len(encoded) == 1010 and len(cache.aside) <= 50


def test_a_word_is_encoded_once_whatever_its_case_and_end(tokenizer, monkeypatch):
    enc, pieces, looked = P.WordEncoder(PATH), [], []
    one, get = enc._piece, enc.chunks.__getitem__
    monkeypatch.setattr(enc, "_piece", lambda piece: pieces.append(piece) or one(piece))

    class Chunks:
        def __getitem__(self, key):
            looked.append(key)
            return get(key)

    enc.chunks = Chunks()
    texts = ["Ébloui ébloui. word? WORD", None, "", "word Word, ÉBLOUI! word", "word", "…word. İword. word.. ²word, word(#_$$$, word<|"]
    ids, at = enc.encode_all(pa.array(texts))
    assert len(at) == len(texts) + 1 and sorted(looked) == sorted({c for t in texts for c in (t or "").split(" ")})
    for k, t in enumerate(texts):
        assert ids[at[k] : at[k + 1]].tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids
    # "²word," is cut by the split pattern.
    assert pieces.count("ébloui") == 1 and pieces.count("word") == 2


def test_cut_is_a_power_of_two_decomposition():
    for n in [1, 2, 3, 4095, 4096, 4097, 10000]:
        parts = list(P.cut(n))
        assert sum(k for _, k in parts) == n and all(k & (k - 1) == 0 and k <= 4096 for _, k in parts)
        assert [s for s, _ in parts] == np.cumsum([0] + [k for _, k in parts])[:-1].tolist()


def test_pieces_cover_every_document(make_docs, awkward, tokenizer):
    rows = P.pack(make_docs(awkward), max_tokens=64, with_ids=True).collect()
    assert sorted(r["sequence_id"] for r in rows) == list(range(len(rows)))
    assert all(r["offset"] == 0 and r["length"] == len(r["ids"]) for r in rows)
    assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in rows)
    by = defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
    for i, t in awkward:
        if i is None or i == 8:  # repeated ids
            continue
        want = tokenizer.encode(t or "", add_special_tokens=False).ids + [P.END_ID]
        parts = sorted(by[i], key=lambda r: r["start"])
        assert [x for r in parts for x in r["ids"]] == want and parts[0]["doc_tokens"] == len(want)
    lengths = [r["length"] for r in sorted(rows, key=lambda r: r["sequence_id"])]
    assert lengths == sorted(lengths, reverse=True)


def test_empty_table(make_docs):
    assert P.pack(make_docs([])).count() == 0
