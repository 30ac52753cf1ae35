import hashlib
import re
from collections import Counter, defaultdict

import pytest

from ledgerspark.llm.exact_dedup import exact_dedup, exact_unique


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t, *_ in rows]
    groups = defaultdict(list)
    for k, t in enumerate(norm):
        groups[t].append(k)
    out = []
    for t, ks in groups.items():
        ids = sorted((rows[k][0] for k in ks), key=lambda v: (v is None, v))
        stays = ids[0]
        for j, i in enumerate(ids):
            out.append((i, stays, len(ks), j == 0, hashlib.sha256(t.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("block", [4, 4096])
def test_equals_brute_force(make_docs, awkward, block):
    rows = awkward[:6] + awkward[7:] if block == 4 else awkward
    rows = rows + [(20, "abcdefgh1"), (21, "abcdefgh1"), (22, "abcdefgh2"), (23, "abcd"), (24, "abcdabcd"), (25, "abcdabcd ")]
    df = exact_dedup(make_docs(rows), block)
    assert Counter(map(tuple, df.collect())) == brute(rows)


def test_unique_keeps_one_row_of_each_text(make_docs, awkward):
    docs = make_docs(awkward)
    left = exact_unique(docs)
    assert left.columns == docs.columns
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "") for r in left.collect()]
    assert sorted(texts) == sorted({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in awkward})


def test_empty_table(make_docs):
    assert exact_dedup(make_docs([])).count() == 0
    assert exact_unique(make_docs([])).count() == 0
