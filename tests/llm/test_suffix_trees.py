import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark import cloudpickle

from ledgerspark.llm import suffix_trees as S


def brute(rows, window):
    texts = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, *_ in rows]
    least = {}
    for (i, *_), words in zip(rows, texts):
        for k in range(len(words) - window + 1):
            w = tuple(words[k : k + window])
            if i is not None and i < least.get(w, float("inf")):
                least[w] = i
    out = []
    for (i, *_), words in zip(rows, texts):
        gone = np.zeros(len(words), bool)
        for k in range(len(words) - window + 1):
            if least.get(tuple(words[k : k + window]), float("inf")) < (float("inf") if i is None else i):
                gone[k : k + window] = True
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((i, len(words), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def planted(rng, n=60):
    base = [[f"w{rng.randrange(9)}" for _ in range(rng.randrange(3, 60))] for _ in range(8)]
    rows = []
    for _ in range(n):
        words = [w for _ in range(rng.randrange(0, 4)) for w in rng.choice(base)[rng.randrange(0, 6) :]]
        for _ in range(rng.randrange(0, 3)):
            if words:
                words[rng.randrange(len(words))] = "x"
        rows.append((rng.choice([None, *range(40)]), rng.choice([" ", "\n", " \t"]).join(words)))
    return rows


def test_awkward_rows(make_docs, awkward):
    assert Counter(map(tuple, S.substring_dedup(make_docs(awkward)).collect())) == brute(awkward, 50)


@pytest.mark.parametrize("leaves", (1, 3, 4096))
@pytest.mark.parametrize("seed", range(2))
def test_random_passages(make_docs, seed, leaves):
    rows = planted(random.Random(seed))
    got = S.substring_dedup(make_docs(rows), window=12, gram=3, leaves=leaves)
    assert Counter(map(tuple, got.collect())) == brute(rows, 12)


def test_a_gram_as_long_as_the_window(make_docs):
    rows = planted(random.Random(5))
    got = S.substring_dedup(make_docs(rows), window=5, gram=5)
    assert Counter(map(tuple, got.collect())) == brute(rows, 5)


@pytest.fixture
def small_chunks(monkeypatch):
    """Chunks and trees of a few rows, in the Python workers too: the module travels by value."""
    monkeypatch.setattr(S, "CHUNK_BYTES", 300)
    monkeypatch.setattr(S, "LEAVES", 2)
    cloudpickle.register_pickle_by_value(S)
    yield
    cloudpickle.unregister_pickle_by_value(S)


def test_small_chunks(make_docs, small_chunks):
    rows = planted(random.Random(7))
    got = S.substring_dedup(make_docs(rows), window=12, gram=3, leaves=4)
    assert Counter(map(tuple, got.collect())) == brute(rows, 12)


def test_one_passage_in_most_documents(make_docs):
    rng = random.Random(3)
    passage = [f"p{k}" for k in range(70)]
    rows = [(k, " ".join([f"a{k}x{j}" for j in range(30)] + passage[: 50 + k % 20] + [f"b{k}x{rng.randrange(99)}"] * 20)) for k in range(80)]
    got = S.substring_dedup(make_docs(rows), leaves=10)
    assert Counter(map(tuple, got.collect())) == brute(rows, 50)


def test_deep_nodes_are_the_windows_in_common():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 2, 400)
    start, group = np.arange(380), np.arange(380) % 3
    order, node = S.deep_nodes(words, start, group, 7)
    want = {}
    for s in start:
        want.setdefault((group[s], *words[s : s + 7]), set()).add(int(s))
    got = {}
    for leaf, k in zip(order, node):
        got.setdefault(k, set()).add(int(leaf))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_empty_table(make_docs):
    assert S.substring_dedup(make_docs([])).count() == 0
