import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerspark.llm import spelling as S

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(rows, one_in=199, letters=6, least=5, ratio=5):
    n = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % one_in == 0 else run] += 1
    n = {w: c for w, c in n.items() if len(w) >= letters and c >= least}
    by = {w: [v for v in n if near(v, w)] for w in n}
    form = {}
    for w, vs in by.items():
        if vs:
            v = min(vs, key=lambda v: (-n[v], v))
            if n[v] >= ratio * n[w]:
                form[w] = v
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(by[w]), n[form[w]] if w in form else None))
    return sorted(out)


def given(rng, stems=60, docs=40):
    words = []
    for _ in range(stems):
        stem = "".join(rng.choice("abcé") for _ in range(rng.randrange(5, 12)))
        words.append((stem, rng.choice([1, 1, 30])))
        for _ in range(rng.randrange(0, 5)):
            k, how = rng.randrange(len(stem)), rng.randrange(3)
            words.append((stem[:k] + ("" if how == 0 else rng.choice("abcéÿ")) + stem[k + (how != 1) :], rng.choice([1, 2, 6])))
    text = [w for w, c in words for _ in range(5 * c)]
    rng.shuffle(text)
    return [(k, rng.choice([" ", ", ", "1", "\n"]).join(t.capitalize() if rng.random() < 0.2 else t for t in text[k::docs])) for k in range(docs)]


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("how", ({}, {"tile": 2}, {"share": 3}, {"longest": (2,), "one_in": 3}, {"longest": (8, 2), "share": 50}))
def test_brute_force(make_docs, seed, how):
    rows = given(random.Random(seed))
    got = sorted(map(tuple, S.spelling_variants(make_docs(rows), **how).collect()), key=lambda r: r[0])
    assert got == brute(rows, how.get("one_in", 199))
    assert any(r[1] for r in got)


def test_awkward_rows(make_docs, awkward):
    rows = (awkward + [(40, "Ünïcode × ÿöüäßé naïvet"), (None, "anonymous anonymos"), (41, "z" * 70000 + " " + "z" * 70001)]) * 6
    assert sorted(map(tuple, S.spelling_variants(make_docs(rows)).collect())) == brute(rows)


def test_chains_end_at_the_root(make_docs):
    chain = ["abcdefg", "abcdefgh", "abcdefghi", "abcdefghij", "abcdefghijk"]
    rows = [(k, " ".join(w for j, w in enumerate(chain) for _ in range(5**j))) for k in range(5)]
    got = sorted(map(tuple, S.spelling_variants(make_docs(rows), one_in=10**9).collect()))
    assert got == brute(rows, 10**9) and {r[2] for r in got} == {chain[-1]}


def test_an_edit_changes_no_more_grams_than_the_bound():
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(5, 11))) for _ in range(400)})
    grams = Counter(w[a : a + k] for w in words for k in range(2, 6) for a in range(len(w) - k + 1))
    d = S.Grams({g: f for g, f in grams.items() if len(g) == 2 or (grams[g[:-1]] > 150 and rng.random() < 0.7)})
    for a in words:
        cut = d.cut(a)
        beyond = len(cut) - d.bound(a, cut)
        for b in words:
            if near(a, b):
                other = d.cut(b)
                n, m = len(a), len(b)
                shared = sum(any(a[s:e] == b[t:f] and (s == t or n - e == m - f) for t, f in other) for s, e in cut)
                assert shared >= beyond, (a, b)


def test_letter_tables():
    t = lambda *w: np.frombuffer("".join(w).encode("latin-1"), np.uint8).reshape(len(w), -1)
    assert S.one_replaced(t("abc", "abc", "abc"), t("abd", "abc", "xyc")).tolist() == [True, False, False]
    assert S.one_more(t("abc", "abc", "aab", "abc"), t("xabc", "abdc", "aaab", "bcab")).tolist() == [True, True, True, False]


def test_empty_table(make_docs):
    assert S.spelling_variants(make_docs([])).count() == 0


def test_moved_checksums():
    text = "Étéland abcdefgh " + "ü" * 40 + " " + "y" * 200 + " abcdefgh"
    for one_in in (1, 2, 3):
        got = S.noisy_words(["7", ""], [text, text], 1, one_in)
        want = Counter()
        for i in ("7", ""):
            for run in re.findall("[A-Za-zÀ-ÿ]+", text):
                run = run.translate(LOWER)
                h = zlib.crc32(f"{i}:{run}".encode())
                want[run[: h % len(run)] + run[h % len(run) + 1 :] if h % one_in == 0 else run] += 1
        assert {w.decode("latin-1"): n for w, n in got.items()} == dict(want)
