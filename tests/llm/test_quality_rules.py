import re
from collections import Counter

from ledgerspark.llm import quality_rules as Q


def brute(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    covered = {k + o for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for o in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)),
            len(covered), len(lines), len(re.findall("[A-Z]", t)))


def test_measurements(make_docs, awkward):
    rows = awkward + [(40, "# a | b <c> $5 100% & *"), (41, "SHOUT " * 60), (42, "a b c a b c a b"), (43, "a a a a")]
    got = Q.rule_ledger(make_docs(rows)).collect()
    want = Counter((i, *brute(t)) for i, t in rows)
    assert Counter((r["doc_id"], *(r[m] for m in Q.MEASURES)) for r in got) == want


def test_repeat_words_with_many_distinct_words(monkeypatch):
    words = [b"%d" % (k % 700) for k in range(3000)]
    assert Q.repeat_words(words) == 3000
    assert Q.repeat_words([b"%d" % k for k in range(50)]) == 0


def test_policies_and_ablation(make_docs):
    good = " ".join(f"word{k}" for k in range(80))
    rows = [(1, good), (2, "short"), (3, good + " ####" * 30), (4, good.upper()), (5, "x y z " * 50)]
    ledger = Q.rule_ledger(make_docs(rows))
    loose = {r["doc_id"]: r["kept"] for r in Q.apply_policy(ledger, 1).collect()}
    strict = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in Q.apply_policy(ledger, 2).collect()}
    assert loose == {1: True, 2: False, 3: True, 4: True, 5: False}
    assert strict == {1: (False, True), 2: (True, False), 3: (False, False), 4: (False, False), 5: (True, False)}
    cost = {r["rule"]: (r["failed"], r["only_this"], r["kept_without"]) for r in Q.ablation(ledger, 2).collect()}
    assert cost["few_words"] == (1, 1, 2) and cost["shouting"] == (1, 1, 2)


def test_empty_table(make_docs):
    assert Q.rule_ledger(make_docs([])).count() == 0
