import random
from collections import Counter

import numpy as np
from conftest import words

from ledgerspark.llm import near_dedup as N


def shingle_counts(text):
    w = (text or "").split()
    return Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()


def similarity(a, b):
    """The sum over common d of 1 / (the sum over all e of max(a[e] / a[d], b[e] / b[d]))."""
    every = list(set(a) | set(b))
    wa, wb = (np.array([w[e] for e in every], float) for w in (a, b))
    both = (wa > 0) & (wb > 0)
    totals = np.maximum(wa / wa[both][:, None], wb / wb[both][:, None]).sum(axis=1)
    return float((1 / totals).sum())


def test_exact_similarity():
    rng = random.Random(1)
    for _ in range(30):
        a = " ".join(words(rng, 40, 6))
        b = " ".join([*a.split()[:25], *words(rng, 15, 6)])
        got = N.probability_jaccard(N.shingles(a.encode()), N.shingles(b.encode()))
        assert abs(got - similarity(shingle_counts(a), shingle_counts(b))) < 1e-9


def test_registers_estimate_the_similarity():
    rng = random.Random(4)
    base = words(rng, 60, 30)
    a, b = " ".join(base * 2), " ".join(base + words(rng, 25, 30))
    items = [N.shingles(t.encode()) for t in (a, b)]
    regs = N.registers(items, m=4096)
    assert abs((regs[0] == regs[1]).mean() - N.probability_jaccard(*items)) < 0.03
    assert (N.registers(items[:1])[0] == N.registers(items)[0]).all()


def test_classes_equal_brute_force(make_docs, awkward):
    rng, rows = random.Random(9), list(awkward)
    for g in range(12):
        base = words(rng, rng.randrange(60, 200))
        for k in range(6):
            text = list(base)
            for _ in range(rng.randrange(0, 4)):
                text[rng.randrange(len(text))] = "edit"
            rows.append((100 + 10 * g + k, " ".join(text)))
    chain = words(rng, 120)
    for k in range(8):  # each link holds, the ends differ
        rows.append((500 + k, " ".join(chain[3 * k :] + [f"z{j}" for j in range(3 * k)])))
    counts = [shingle_counts(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if counts[a] and counts[b] and (counts[a] == counts[b] or similarity(counts[a], counts[b]) >= 0.8 - 1e-12):
                root[find(a)] = find(b)
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(find(k), []).append(rows[k][0])
    want = Counter()
    for ids in groups.values():
        ids = sorted(ids, key=lambda v: (v is None, v))
        for j, i in enumerate(ids):
            want[(i, ids[0], len(ids), j == 0)] += 1
    docs = make_docs(rows)
    assert Counter(map(tuple, N.near_dedup(docs).collect())) == want
    left = N.near_unique(docs)
    assert left.columns == docs.columns
    assert Counter(r["doc_id"] for r in left.collect()) == Counter(r[0] for r in want.elements() if r[3])


def test_mixed_buckets_lose_no_link(make_docs):
    """A group around a base that is not in the table: links between members only."""
    rng = random.Random(12)
    base = words(rng, 300)
    rows = []
    for k in range(60):
        text = list(base)
        for _ in range(rng.randrange(1, 9)):
            text[rng.randrange(len(text))] = f"e{rng.randrange(10**6)}"
        rows.append((k, " ".join(text)))
    counts = [shingle_counts(t) for _, t in rows]
    root = list(range(60))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(60):
        for b in range(a):
            if similarity(counts[a], counts[b]) >= 0.8:
                root[max(find(a), find(b))] = min(find(a), find(b))
    got = {r["doc_id"]: r["class_id"] for r in N.near_dedup(make_docs(rows)).collect()}
    assert got == {k: find(k) for k in range(60)}


def test_a_large_bucket_meets_in_bounded_pieces(make_docs, monkeypatch):
    """Tiles of two texts, strips of two tiles: many keys for one bucket, and the classes of one tile."""
    rng = random.Random(12)
    base = words(rng, 300)
    rows = []
    for k in range(60):
        text = list(base)
        for _ in range(rng.randrange(1, 9)):
            text[rng.randrange(len(text))] = f"e{rng.randrange(10**6)}"
        rows.append((k, " ".join(text)))
    docs = make_docs(rows)
    want = {r["doc_id"]: r["class_id"] for r in N.near_dedup(docs).collect()}
    monkeypatch.setattr(N, "TILE", 2)
    monkeypatch.setattr(N, "STRIP", 2)
    assert {r["doc_id"]: r["class_id"] for r in N.near_dedup(docs).collect()} == want


def test_recall_over_planted_near_copies(make_docs):
    """600 pairs across 0.80 to 0.95 of similarity, no two pairs alike: the share found."""
    rng, rows, true = random.Random(31), [], []
    for p in range(600):
        text = [f"{w}{p}" for w in words(rng, 120)]
        other = list(text)
        for place in rng.sample(range(0, 120, 6), rng.randrange(1, 4)):
            other[place] = "edit"
        rows += [(2 * p, " ".join(text)), (2 * p + 1, " ".join(other))]
        true.append(similarity(shingle_counts(rows[-2][1]), shingle_counts(rows[-1][1])) >= 0.8)
    got = {r["doc_id"]: r["class_id"] for r in N.near_dedup(make_docs(rows)).collect()}
    found = [got[2 * p + 1] == 2 * p for p in range(600)]
    hits = sum(f for f, t in zip(found, true, strict=True) if t)
    print(f"{sum(true)} pairs of 0.8 or more, {hits} found")
    assert sum(true) > 200 and hits >= 0.9 * sum(true)
    assert not any(f for f, t in zip(found, true, strict=True) if not t)


def test_components_of_a_path_and_a_star(spark):
    path = [(k, k + 1) for k in range(40)] + [(1000, 100 + k) for k in range(20)] + [(7, 7)]
    random.Random(0).shuffle(path)
    roots = {r["node"]: r["root"] for r in N.components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert all(roots[k] == 0 for k in range(41)) and all(roots[100 + k] == 100 for k in range(20)) and roots[1000] == 100


def test_empty_table(make_docs):
    assert N.near_dedup(make_docs([])).count() == 0
    assert np.asarray(N.shingles(b" \n")[0]).size == 0


def test_unique_rows_are_the_kept_ones(make_docs, awkward):
    base = " ".join(f"w{k}" for k in range(200))
    near = base.replace("w199", "other")
    rows = awkward + [(20, base), (20, near), (20, base), (21, near), (None, near), (22, ""), (22, "")]
    docs = make_docs(rows).selectExpr("*", "'mine' AS _key", "'own' AS _language")
    kept = docs.join(N.near_dedup(docs).where("kept").select("doc_id").distinct(), "doc_id", "left_semi").count()
    got = N.near_unique(docs)
    assert got.columns == docs.columns
    found = got.collect()
    assert len(found) == N.near_dedup(docs).where("kept").count() and kept
    assert {r["_key"] for r in found} == {"mine"}
    assert sum(r["doc_id"] in (20, 21) for r in found) == 1 and sum(r["doc_id"] == 22 for r in found) == 2
