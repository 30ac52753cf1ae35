import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark import cloudpickle

from ledgerspark.llm import suffix_dedup as S


def brute(rows, length):
    data = [(t or "").encode() for _, t, *_ in rows]
    seen = Counter(d[k : k + length] for d in data for k in range(len(d) - length + 1))
    out = []
    for (i, *_), d in zip(rows, data):
        gone = np.zeros(len(d), bool)
        for k in range(len(d) - length + 1):
            if seen[d[k : k + length]] > 1:
                gone[k : k + length] = True
        kept = bytes(np.frombuffer(d, np.uint8)[~gone])
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((i, len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def test_awkward_rows(make_docs, awkward):
    rows = [r for r in awkward if r[0] not in (6, 7)] + [(30, "q" * 999), (31, "q" * 400), (32, "ab" * 450)]
    assert Counter(map(tuple, S.suffix_dedup(make_docs(rows)).collect())) == brute(rows, 400)


@pytest.mark.parametrize("seed", range(2))
def test_random_passages(make_docs, seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdé \n") for _ in range(rng.randrange(20, 900))) for _ in range(8)]
    rows = []
    for k in range(40):
        text = list("".join(rng.choice(base)[rng.randrange(0, 15) :] for _ in range(rng.randrange(0, 4))))
        for _ in range(rng.randrange(0, 3)):
            if text:
                text[rng.randrange(len(text))] = "#"
        rows.append((k, "".join(text)))
    got = S.suffix_dedup(make_docs(rows), length=100, gram=8, grids=(16, 1))
    assert Counter(map(tuple, got.collect())) == brute(rows, 100)


def test_runs_do_not_depend_on_chunks(monkeypatch):
    text = "".join(random.Random(1).choice("abcdefgh ") for _ in range(5000)).encode()
    whole = {(r["m"], s) for r in S.runs(text) for s in range(r["first"], r["last"] + 1)}
    monkeypatch.setattr(S, "CHUNK", 700)
    cut = {(r["m"], s) for r in S.runs(text) for s in range(r["first"], r["last"] + 1)}
    assert whole == cut and len(whole) == 5000 - 399


@pytest.mark.parametrize("chunk", (60, 700))
def test_a_run_across_chunks_is_one_run(monkeypatch, chunk):
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefgh ") for _ in range(5000)).encode()
    whole = S.runs(text)
    monkeypatch.setattr(S, "CHUNK", chunk)
    assert np.array_equal(S.runs(text), whole)


@pytest.fixture
def small_chunks(monkeypatch):
    """CHUNK of 300 bytes, in the Python workers too: the module travels by value."""
    monkeypatch.setattr(S, "CHUNK", 300)
    cloudpickle.register_pickle_by_value(S)
    yield
    cloudpickle.unregister_pickle_by_value(S)


def test_long_texts_in_small_chunks(make_docs, small_chunks):
    rng = random.Random(5)
    once = ["".join(rng.choice("abcdefgh \n") for _ in range(3000)) for _ in range(4)]
    passage = once[3][400:1000]
    rows = [(0, once[0]), (1, once[1][:1500] + passage + once[1][1500:]), (2, once[2] + passage[:450]), (3, "xy" * 700)]
    got = S.suffix_dedup(make_docs(rows), length=100, gram=8, grids=(16, 1))
    assert Counter(map(tuple, got.collect())) == brute(rows, 100)


@pytest.mark.parametrize("size, n_removed", [(330, 0), (399, 0), (400, 400), (480, 480)])
def test_passages_of_over_50_words_go_from_400_bytes_on(make_docs, size, n_removed):
    rng = random.Random(size)

    def prose(n):
        return "".join(rng.choice("abcdefgh ") for _ in range(n))

    letters = prose(size - 54).replace(" ", "i")
    cuts = sorted(rng.sample(range(1, len(letters)), 54))
    passage = " ".join(letters[a:b] for a, b in zip([0, *cuts], [*cuts, len(letters)]))
    assert len(passage.split()) == 55 and len(passage) == size
    rows = [(k, prose(700) + a + passage + b + prose(700)) for k, (a, b) in enumerate(["()", "[]", "<>"])]
    rows.append((3, prose(1500)))
    got = [tuple(r) for r in S.suffix_dedup(make_docs(rows)).collect()]
    assert Counter(got) == brute(rows, 400)
    assert {r[0]: r[2] for r in got} == {0: n_removed, 1: n_removed, 2: n_removed, 3: 0}


def test_empty_table(make_docs):
    assert S.suffix_dedup(make_docs([])).count() == 0
