import random
import re
from collections import Counter, defaultdict

from ledgerspark.llm.mixing import mix, mix_documents, mix_taken

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    total, target, free = 1.5 * sum(sizes.values()), {}, set(order)
    while free:
        left = total - sum(target.values())
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in free}
        target |= {s: 2.0 * sizes[s] for s in over}
        free -= over
    return target


def corpus(seed=1):
    rng, rows = random.Random(seed), []
    for k in range(300):
        source = rng.choice(["a", "a", "a", "a", "b", "c", "d", None, "é", "Z"])
        rows.append((k, " ".join(f"w{k}_{j}" for j in range(rng.randrange(0, 60))) if k % 17 else None, "en", source))
    return rows + [(1000, "only one", "en", "tiny"), (1001, "", "en", "void"), (1005, "again a b", "en", "a"), (1005, "again a b", "en", "a")]


def test_taken_words_meet_the_targets(make_docs):
    rows = corpus()
    got = mix_taken(make_docs(rows), block_words=64).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    want = brute_targets(sizes)
    source = {r[0]: r[3] for r in rows}
    taken = Counter()
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and abs(r["target"] - want[s]) < 1e-6
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in sizes)


def test_prefixes_of_the_mix_keep_the_weights(make_docs):
    rows = [(k, " ".join(["w"] * 50), "en", "abc"[k % 3]) for k in range(600)]
    docs, pieces = mix(make_docs(rows), block_words=100)
    source = {r["row_no"]: r["source"] for r in docs.collect()}
    slots = defaultdict(set)
    for p in pieces.collect():
        slots[p["slot"]].add(source[p["row_no"]])
    order = [next(iter(slots[t])) for t in sorted(slots)]
    assert all(len(v) == 1 for v in slots.values())
    share = Counter(order)
    for n in (30, 100, 200):
        part = Counter(order[:n])
        assert all(abs(part[s] - n * share[s] / len(order)) <= 6 for s in share)


def test_reruns_agree(make_docs):
    rows = corpus(2)
    one = Counter(map(tuple, mix_taken(make_docs(rows).repartition(1), block_words=64).collect()))
    two = Counter(map(tuple, mix_taken(make_docs(rows).repartition(7), block_words=64).collect()))
    assert one == two


def test_documents_of_the_mix(make_docs):
    rows = corpus()
    docs = make_docs(rows)
    out = mix_documents(docs, block_words=64)
    assert out.columns == docs.columns
    words = Counter()
    for r in out.collect():
        words[r["doc_id"]] += len(WORD.findall(r["text"]))
        assert r["n_chars"] == len(r["text"])
    taken = Counter()
    for r in mix_taken(docs, block_words=64).collect():
        taken[r["doc_id"]] += r["taken"]
    assert +words == +taken


def test_empty_table(make_docs):
    assert mix_taken(make_docs([])).count() == 0
    assert mix_taken(make_docs([(1, None), (2, "")])).count() == 2
