import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerspark.llm import collocations as C
from ledgerspark.llm.grams import hash_filter, passes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, max_words=3, min_count=10, percent=50, top=2000):
    counts, total = defaultdict(Counter), Counter()
    for _, text, *rest in rows:
        lang = (rest[0] if rest else "en") or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, max_words + 1):
                counts[lang].update(tuple(words[k : k + n]) for k in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        kept = []
        for p, a in found.items():
            if any(100 * b >= percent * a for q, b in found.items() if len(q) > len(p)
                   and any(q[k : k + len(p)] == p for k in range(len(q) - len(p) + 1))):
                continue
            score, _, left, r = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, r))
        for rank, (s, a, p, left, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, r, total[lang], -s))
    return sorted(out)


def given(rng, n=120):
    pool = ["The", "the", "red", "Fox", "é", "x y", "漢字", "a", "of", "it", "Run", "b"]
    rows = []
    for k in range(n):
        text = "".join(rng.choice(pool) + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ",", ""]) for _ in range(60))
        rows.append((k, text, rng.choice(["en", "de", None, "und"])))
    return rows


@pytest.mark.parametrize("max_words", (1, 2, 3, 4))
def test_brute_force(make_docs, max_words):
    rows = given(random.Random(max_words))
    got = C.collocations(make_docs(rows), max_words=max_words, top=25)
    assert sorted(map(tuple, got.collect())) == brute(rows, max_words, top=25)


def test_awkward_rows(make_docs, awkward):
    rows = awkward * 4
    assert sorted(map(tuple, C.collocations(make_docs(rows)).collect())) == brute(rows)


def test_empty_table(make_docs):
    assert C.collocations(make_docs([])).count() == 0


def test_colliding_fingerprints_are_told_apart():
    words = np.array([1, 2, 3, 1, 2, 4, 5, 1, 2])
    at = np.array([0, 1, 3, 4, 7])  # 1 2, 2 3, 1 2, 2 4, 1 2
    found = {}
    for pointer, f in C.same_phrases(words, at, np.array([9, 9, 9, 9, 9], np.uint64), 2):
        found |= {tuple(words[p : p + 2].tolist()): int(c) for p, c in zip(pointer, f) if c}
    assert found == {(1, 2): 3, (2, 3): 1, (2, 4): 1}


def test_filter_never_loses_a_member(spark):
    h = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 20000)
    table = hash_filter(spark.createDataFrame([(int(x),) for x in h[:3000]], "h long"), 20).value
    on = passes(table, h.view(np.uint64), 20)
    assert on[:3000].all() and on[3000:].mean() < 0.01


def test_word_hashes_do_not_depend_on_blocks(monkeypatch):
    from ledgerspark.llm import grams

    words = [bytes(random.Random(k).choices(range(97, 100), k=k % 7)) for k in range(500)] + [b"z" * 400]
    data = b"".join(w + b" " for w in words)
    whole = grams.words_of(data)[0]
    monkeypatch.setattr(grams, "BLOCK_BYTES", 64)
    cut, starts, ends = grams.words_of(data)
    assert (whole == cut).all() and [data[a:b] for a, b in zip(starts, ends)] == words
    assert len(set(whole.tolist())) == len(set(words))
